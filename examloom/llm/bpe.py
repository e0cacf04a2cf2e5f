"""Byte-level BPE encoding and decoding (operator 8).

Encoding. The merge table is compiled into a transducer over bytes. A
configuration is (bytes of a token that has begun, token before them, tokens
not yet emitted); a state is the set of configurations that some future byte
can still extend, and it is built only when a text first reaches it, while the
table of states has room. A step
moves every configuration by one byte; one whose bytes form a token that may
stand after the token before it ends there, and of these exactly one is the
merge order's own choice. What all configurations agree on is emitted at once,
so the lookahead is bounded by the longest token. Two tokens may stand side by
side if merging their joined bytes gives just these two.

Decoding is a stream: the bytes of each token run through an incremental UTF-8
state machine that holds at most three bytes back.
"""

from __future__ import annotations

import base64
import marshal
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

MAX_STATES = 50_000
#: A version of marshal that writes equal values as equal bytes.
PLAIN = 2
MEMO_PIECES = 350_000
MEMO_PAIRS = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token per line, base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class State:
    """A set of configurations, kept as bytes: they are looked at only where a new byte leads on."""

    __slots__ = ("key", "next", "packed")

    def __init__(self, key: bytes):
        self.key = key
        self.next: dict[int, tuple[State, bytes]] = {}
        self.packed: bytes | None = None

    @property
    def configs(self) -> tuple:
        """(trie node of the bytes begun, token before them or -1, tokens not yet emitted), earliest start first."""
        return marshal.loads(self.key)

    @property
    def rest(self) -> bytes:
        """What remains to be emitted if the input ends here."""
        if self.packed is None:
            self.packed = array("i", self.configs[-1][2]).tobytes()
        return self.packed


class Transducer:
    """Encodes byte strings by a rank table.

    States are made on demand, up to ``MAX_STATES``; from there on, input that
    leaves the known states is followed configuration by configuration, with
    the same result.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.child: dict[int, int] = {}  # node << 8 | byte -> node
        self.rank_at = [-1]
        self.grows = bytearray(1)
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                self.grows[node] = 1
                key = node << 8 | byte
                node = self.child.get(key, 0)
                if not node:
                    node = self.child[key] = len(self.rank_at)
                    self.rank_at.append(-1)
                    self.grows.append(0)
            self.rank_at[node] = rank
        if any(self.rank_at[self.child.get(byte, 0)] < 0 for byte in range(256)):
            raise ValueError("the rank table lacks a single byte")
        self.pairs: dict[int, bool] = {}
        self.start = State(marshal.dumps(((0, -1, ()),), PLAIN))
        self.states = {self.start.key: self.start}

    def merged(self, data: bytes) -> list[int]:
        """The merge loop itself, for strings of two tokens."""
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def may_follow(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return found

    def step(self, state: State, byte: int) -> tuple[State, bytes] | None:
        """The state after one more byte and the tokens (packed) emitted on the way; None if it is unknown and there is no room for it."""
        live, rank = [], -1
        for node, before, tokens in state.configs:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            if rank < 0 and self.rank_at[node] >= 0 and (before < 0 or self.may_follow(before, self.rank_at[node])):
                rank, ended = self.rank_at[node], tokens
            if self.grows[node]:
                live.append((node, before, tokens))
        live.append((0, rank, (*ended, rank)))
        shared = live[0][2]
        for _, _, tokens in live[1:]:
            n = 0
            for a, b in zip(shared, tokens):
                if a != b:
                    break
                n += 1
            shared = shared[:n]
            if not n:
                break
        if n := len(shared):
            live = [(node, before, tokens[n:]) for node, before, tokens in live]
        key = marshal.dumps(tuple(live), PLAIN)
        after = self.states.get(key)
        if after is None:
            if len(self.states) >= MAX_STATES:
                return None
            after = self.states[key] = State(key)
        edge = state.next[byte] = after, array("i", shared).tobytes()
        return edge

    def follow(self, state: State, data: bytes) -> bytes:
        """Tokens (packed) of the rest of an input from a state on, without making states."""
        child, rank_at, grows, pairs = self.child, self.rank_at, self.grows, self.pairs
        live = [(node, before, (None, tokens)) for node, before, tokens in state.configs]  # tokens as a chain from the last one back
        for byte in data:
            after, rank = [], -1
            for node, before, chain in live:
                node = child.get(node << 8 | byte)
                if node is None:
                    continue
                if rank < 0:
                    r = rank_at[node]
                    if r >= 0:
                        if before < 0:
                            rank, ended = r, chain
                        else:
                            fits = pairs.get(before << 32 | r)
                            if fits is None:
                                fits = self.may_follow(before, r)
                            if fits:
                                rank, ended = r, chain
                if grows[node]:
                    after.append((node, before, chain))
            after.append((0, rank, (ended, (rank,))))
            live = after
        parts, chain = [], live[-1][2]
        while chain is not None:
            chain, tokens = chain
            parts.append(tokens)
        return array("i", [t for tokens in reversed(parts) for t in tokens]).tobytes()

    def encode(self, data: bytes) -> bytes:
        """Token ids of one piece, packed as 32-bit integers."""
        state, out = self.start, []
        for i, byte in enumerate(data):
            edge = state.next.get(byte)
            if edge is None:
                edge = self.step(state, byte)
                if edge is None:
                    out.append(self.follow(state, data[i:]))
                    return b"".join(out)
            state, emitted = edge
            if emitted:
                out.append(emitted)
        out.append(state.rest)
        return b"".join(out)


class Pieces(dict):
    """Packed ids by piece, filled on demand and emptied when full. A piece that is a token itself is that token."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.transducer.ranks.get(data)
        found = self.transducer.encode(data) if rank is None else array("i", (rank,)).tobytes()
        if len(self) >= MEMO_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = found
        return found


#: UTF-8: lead byte ranges, with the range of the byte that follows and how many follow in all (Unicode 15, table 3-7).
LEADS = (
    (0xC2, 0xDF, 0x80, 0xBF, 1),
    (0xE0, 0xE0, 0xA0, 0xBF, 2),
    (0xE1, 0xEC, 0x80, 0xBF, 2),
    (0xED, 0xED, 0x80, 0x9F, 2),
    (0xEE, 0xEF, 0x80, 0xBF, 2),
    (0xF0, 0xF0, 0x90, 0xBF, 3),
    (0xF1, 0xF3, 0x80, 0xBF, 3),
    (0xF4, 0xF4, 0x80, 0x8F, 3),
)


class Utf8Machine:
    """Incremental UTF-8. A state is the bytes held back; ill-formed sequences become U+FFFD, one per maximal subpart."""

    def __init__(self):
        self.lead = {b: (low, high, more) for first, last, low, high, more in LEADS for b in range(first, last + 1)}

    def feed(self, held: bytes, data: bytes) -> tuple[str, bytes]:
        """The characters completed by ``data`` and the bytes now held back."""
        out: list[str] = []
        begun = bytearray()
        low, high, more = 0, 0, 0
        for b in held + data:
            if begun:
                if low <= b <= high:
                    begun.append(b)
                    low, high, more = 0x80, 0xBF, more - 1
                    if not more:
                        out.append(begun.decode())
                        begun.clear()
                    continue
                out.append("�")
                begun.clear()
            if b < 0x80:
                out.append(chr(b))
            elif b in self.lead:
                low, high, more = self.lead[b]
                begun.append(b)
            else:
                out.append("�")
        return "".join(out), bytes(begun)


class Codec:
    """Encoder and streaming decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(read_ranks(path))
        self.pieces = Pieces(self.transducer)
        self.machine = Utf8Machine()
        # From the empty state most tokens complete all their characters: those moves are looked up at once.
        self.moves: dict[int, str] = {}
        self.others: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        for rank, token in self.transducer.bytes_of.items():
            text, held = self.machine.feed(b"", token)
            if held:
                self.others[b"", rank] = text, held
            else:
                self.moves[rank] = text

    def encode(self, text: str) -> bytes:
        """Token ids, packed as native 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, ids: Iterable[int]) -> str:
        """Text of a stream of ids; an id outside the table raises KeyError. Bytes still held back at the end become U+FFFD."""
        moves, others, held, out = self.moves.get, self.others, b"", []
        for rank in ids:
            if not held:
                text = moves(rank)
                if text is not None:
                    out.append(text)
                    continue
            move = others.get((held, rank))
            if move is None:
                move = others[held, rank] = self.machine.feed(held, self.transducer.bytes_of[rank])
                if len(others) > MEMO_PAIRS:
                    others.clear()
                    others[held, rank] = move
            text, held = move
            out.append(text)
        return "".join(out) + ("�" if held else "")


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once in each Python worker."""
    return common.worker_tables((Codec, path, pattern), lambda: Codec(path, pattern))


def _with(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])


def _lists(packed: list[bytes]) -> pa.Array:
    offsets, at = array("i", (0,)), 0
    for p in packed:
        at += len(p) // 4
        offsets.append(at)
    values = pa.Array.from_buffers(pa.int32(), at, [None, pa.py_buffer(b"".join(packed))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few texts are held as Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of a text column as ``ids_col`` array<int>; a column of that name is replaced.

    A null or empty text has no ids. Repeated rows are encoded each, long texts
    whole; other columns pass through whatever their names.
    """
    kept = df.drop(ids_col) if ids_col != text_col else df
    schema = T.StructType([*kept.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in _small(batches):
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            yield _with(batch, [ids_col], [_lists([c.encode(t) if t else b"" for t in texts])])

    return common.map_in_arrow(kept, run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of an ids column as ``out_col``; a column of that name is replaced. Null or no ids: empty."""
    kept = df.drop(out_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(out_col, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in _small(batches):
            ids = batch.column(batch.schema.names.index(ids_col)).to_pylist()
            yield _with(batch, [out_col], [pa.array([c.decode(x) if x else "" for x in ids], pa.string())])

    return common.map_in_arrow(kept, run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: both columns, the text decoded from the ids alone.

    A null or empty text has no ids and decodes to an empty text; repeated rows
    are treated each, long texts whole; an empty table stays empty. Columns of
    the two names are replaced, others pass through whatever their names.
    """
    kept = df.drop(*[c for c in (ids_col, out_col) if c != text_col])
    schema = T.StructType([*kept.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False), T.StructField(out_col, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in _small(batches):
            texts = batch.column(batch.schema.names.index(text_col)).to_pylist()
            packed = [c.encode(t) if t else b"" for t in texts]
            ids = _lists(packed)
            back = [c.decode(memoryview(p).cast("i")) if p else "" for p in packed]
            yield _with(batch, [ids_col, out_col], [ids, pa.array(back, pa.string())])

    return common.map_in_arrow(kept, run, schema)

