"""Removal of repeated byte strings by hash-compared suffix sorting (operator 2).

A byte goes if it lies in a string of ``length`` bytes that also starts
anywhere else in the corpus. Sorting every suffix of the corpus would shuffle
it many times over, so only suffixes at anchors are sorted:

1. Prefix polynomial hashes give the hash of every core (``length - slack``
   bytes) of a text. In each window of ``length`` bytes the core of the least
   hash is the anchor, so equal windows have equal anchors at equal offsets.
2. Anchors meet by core. Where the whole surroundings of an anchor (all
   windows that hold it) occur twice, by two independent hashes, a polynomial
   one of the core and XXH3 of the surroundings, they are covered. Where a core occurs
   with different surroundings only, the match ends nearby: these anchors
   fetch their surroundings.
3. The suffixes that start at such anchors, and the prefixes before them read
   backwards, are merge-sorted; two are compared by a binary search for their
   common extension with prefix hashes. The common extensions of neighbours are
   verified byte by byte. A window repeats where suffix and prefix classes agree.
4. A core with many different surroundings is refined: half the windows extend
   the core to one side, half to the other, until groups are small or windows
   are counted singly. Such cores are noticed where anchors are made (``HOT``
   different surroundings in one chunk of text) or when they are counted
   (``GROUP``); their rows are dealt out by surroundings, never by core alone.

Covered spans return to their texts, which are dealt out by text, not by group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

LENGTH = 400
#: Different surroundings of one core that one task sorts.
GROUP = 128
#: A core with so many different surroundings in one chunk is common: its anchors are not gathered by core.
HOT = 16
#: Surroundings sorted together, in whole groups.
BATCH = 4096
#: Windows of a text that are looked at together.
STEP = 4 << 20
#: Bytes of text whose anchors are combined before they are shuffled.
CHUNK = 16 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


class Powers:
    """Powers of the base and of its inverse modulo 2 ** 64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = 1 << n.bit_length()
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, _U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_powers = Powers()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(29))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial hash of the first i bytes; that of [a, b) is (sums[b] - sums[a]) / base ** a."""
    _powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * _powers.up[: len(data)], out=sums[1:])
    return sums


def _least(x: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or greatest) of every window of a width."""
    w = 1
    while 2 * w <= width:
        x = pick(x[:-w], x[w:])
        w *= 2
    rest = width - w
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, length: int, slack: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, core hashes and surroundings' hashes of a text's anchors; none if it is shorter than ``length``.

    ``step`` windows are looked at together, so that a very long text takes no
    more memory than a shorter one; the anchors are the same for every step.
    """
    import xxhash

    n, core = len(data), length - slack
    found, view = [], memoryview(data)
    for first in range(0, n - length + 1, step):
        last = min(first + step, n - length + 1)
        low = max(0, first - slack)
        part = data[low : last + slack + length]
        sums = prefix_hashes(part)
        h = _mix((sums[core:] - sums[:-core]) * _powers.down[: len(part) - core + 1])
        inside = h[first - low : last - low + slack]
        least = _least(inside, slack + 1)
        # A place is chosen if one of the windows that hold its core has no lesser hash.
        edge = np.zeros(slack, _U)
        at = np.flatnonzero(_least(np.concatenate([edge, least, edge]), slack + 1, np.maximum) == inside) + first
        a, b = np.maximum(at - slack, 0), np.minimum(at + length, n)
        # A hash of another kind than the core's, over the bytes themselves.
        around = np.fromiter((xxhash.xxh3_64_intdigest(view[x:y], z) for x, y, z in zip(a.tolist(), b.tolist(), (at - a).tolist())), _U, len(at))
        found.append((at, h[at - low], around))
    if not found:
        return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, _U)
    at, key, around = (np.concatenate(x) for x in zip(*found))
    at, kept = np.unique(at, return_index=True)
    return at, key[kept], around[kept]


def _merged(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching spans of each owner (small whole numbers)."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    reach = np.maximum.accumulate(end + owner * (1 << 40)) - owner * (1 << 40)
    new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])))
    first = np.flatnonzero(new)
    return owner[first], start[first], np.maximum.reduceat(end, first)


#: kind 0: an anchor; 1: one that stands for several equal ones; 2: a covered span, in ``around`` as start << 32 | end;
#: + COMMON: its core is common and ``salt`` deals it out; MARK: no anchor, says that the core is common.
COMMON, MARK = 4, 8
ANCHORS = T.StructType([T.StructField(n, T.LongType()) for n in ("key", "around", "ka", "place")] + [T.StructField("kind", T.ByteType()), T.StructField("salt", T.ByteType())])
#: What classes of anchors tell a text: kind 2 as above in ``value``; 0 or 1 (+ COMMON): fetch the surroundings of the anchor at place, for core ``value``; 1 needs no answer.
TOLD = T.StructType([T.StructField(n, T.LongType()) for n in ("ka", "kb", "place", "value")] + [T.StructField("kind", T.ByteType())])


def _batch(schema: T.StructType, columns: list) -> pa.RecordBatch:
    arrays = []
    for field, values in zip(schema.fields, columns):
        kind = {T.LongType(): pa.int64(), T.ByteType(): pa.int8(), T.BinaryType(): pa.binary(), T.IntegerType(): pa.int32()}[field.dataType]
        if isinstance(values, np.ndarray):
            values = values.view(np.int64) if values.dtype == _U else values
            arrays.append(pa.array(values, kind) if values.dtype != object else pa.array(values.tolist(), kind))
        else:
            arrays.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _anchor_rows(length: int, slack: int):
    def combined(held: list) -> pa.RecordBatch:
        at, key, around, ka, kb = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((around, key))
        at, key, around, ka, kb = at[order], key[order], around[order], ka[order], kb[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (around[1:] != around[:-1])))
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(at)))
        several = np.repeat(sizes, sizes) > 1
        kind = np.where(several, 1, 0).astype(np.int8)
        # Equal surroundings that meet here are covered already; one of them goes on to meet others.
        extra = several & ~new
        docs, owner = np.unique(np.stack([ka[several], kb[several]], 1), axis=0, return_inverse=True) if several.any() else (np.empty((0, 2), np.int64), np.empty(0, np.int64))
        owner, start, end = _merged(owner.reshape(-1), np.maximum(at[several] - slack, 0), at[several] + length)
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.cumsum(new_key) - 1
        common_key = np.bincount(group[first], minlength=group[-1] + 1) >= HOT
        common = common_key[group]
        marks = np.flatnonzero(new_key & common)
        keep = ~extra
        spans = start << 32 | end
        zeros = np.zeros(len(marks), np.int64)
        return _batch(
            ANCHORS,
            [
                np.concatenate([key[keep].view(np.int64), _mix((docs[owner, 0] + start).view(_U)).view(np.int64), key[marks].view(np.int64)]),
                np.concatenate([around[keep].view(np.int64), spans, zeros]),
                np.concatenate([ka[keep], docs[owner, 0], zeros]),
                np.concatenate([kb[keep] << 32 | at[keep], docs[owner, 1] << 32, zeros]),
                np.concatenate([kind[keep] + COMMON * common[keep].astype(np.int8), np.full(len(spans), 2, np.int8), np.full(len(marks), MARK, np.int8)]),
                np.concatenate([np.where(common[keep], (around[keep] % _U(127)).astype(np.int8) + 1, 0).astype(np.int8), np.zeros(len(spans) + len(marks), np.int8)]),
            ],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _sliced(batches):
            for ka, kb, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                data = _bytes(text)
                at, key, around = anchors(data, length, slack)
                if len(at):
                    held.append((at, key, around, np.full(len(at), ka), np.full(len(at), kb)))
                size += len(data)
                if size > CHUNK and held:
                    yield combined(held)
                    held, size = [], 0
        if held:
            yield combined(held)

    return run


def _classified(slack: int, length: int):
    """Anchors, sorted by core and surroundings, to what their texts are told."""

    def told(key, around, ka, place, kind, salt) -> pa.RecordBatch:
        group = np.cumsum(np.concatenate(([True], (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])))) - 1
        common = np.bincount(group, kind >= COMMON, minlength=group[-1] + 1) > 0
        key, around, ka, place, kind, group = (x[kind != MARK] for x in (key, around, ka, place, kind, group))
        if not len(key):
            return _batch(TOLD, [np.empty(0, np.int64)] * 4 + [np.empty(0, np.int8)])
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (around[1:] != around[:-1])))
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(key)))
        several = np.repeat((sizes > 1) | (np.maximum.reduceat(kind & 1, first) == 1), sizes)
        different = (np.bincount(group[first], minlength=len(common)) > 1) | common
        single = different[group] & ~several
        open_ = common.copy()
        open_[group[single]] = True
        stands = several & new & open_[group]  # one of each repeated surroundings, for singles to be compared with
        at = place & 0xFFFFFFFF
        spans = np.maximum(at - slack, 0) << 32 | at + length
        kb = place >> 32
        extra = COMMON * common[group].astype(np.int8)
        return _batch(
            TOLD,
            [
                np.concatenate([ka[several], ka[single], ka[stands]]),
                np.concatenate([kb[several], kb[single], kb[stands]]),
                np.concatenate([at[several], at[single], at[stands]]),
                np.concatenate([spans[several], key[single], key[stands]]),
                np.concatenate([np.full(several.sum(), 2, np.int8), extra[single], extra[stands] + np.int8(1)]),
            ],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(6)]
            done = rows[4] == 2
            if done.any():
                _, around, ka, place, _, _ = (x[done] for x in rows)
                yield _batch(TOLD, [ka, place >> 32, np.zeros(len(ka), np.int64), around, np.full(len(ka), 2, np.int8)])
                rows = [x[~done] for x in rows]
            if not len(rows[0]):
                continue
            held.append(rows)
            if len({(x[0][i], x[5][i]) for x in held for i in (0, -1)}) > 1:
                whole = [np.concatenate(x) for x in zip(*held)]
                tail = int(np.flatnonzero((whole[0] != whole[0][-1]) | (whole[5] != whole[5][-1]))[-1]) + 1
                yield told(*[x[:tail] for x in whole])
                held = [[x[tail:] for x in whole]]
        if held:
            yield told(*[np.concatenate(x) for x in zip(*held)])

    return run


#: Spans of a text as packed pairs of 32-bit numbers; wants: packed (core, place, kind) of anchors to fetch.
PER_TEXT = T.StructType([T.StructField("ka", T.LongType()), T.StructField("kb", T.LongType()), T.StructField("spans", T.BinaryType()), T.StructField("wants", T.BinaryType())])


def _per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What one text is told, rows sorted by text, in one row."""

    def packed(ka, kb, place, value, kind) -> pa.RecordBatch:
        new = np.concatenate(([True], (ka[1:] != ka[:-1]) | (kb[1:] != kb[:-1])))
        first, owner = np.flatnonzero(new), np.cumsum(new) - 1
        span = kind == 2
        o, s, e = _merged(owner[span], value[span] >> 32, value[span] & 0xFFFFFFFF)
        pairs = np.stack([s, e], 1).astype(np.int32)
        cuts = np.searchsorted(o, np.arange(len(first) + 1))
        want = np.flatnonzero(~span)
        records = np.stack([value[want], place[want], kind[want].astype(np.int64)], 1)
        wcuts = np.searchsorted(owner[want], np.arange(len(first) + 1))
        return _batch(
            PER_TEXT,
            [
                ka[first],
                kb[first],
                [pairs[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())],
                [records[a:b].tobytes() for a, b in zip(wcuts[:-1].tolist(), wcuts[1:].tolist())],
            ],
        )

    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(i).to_numpy() for i in range(5)])
        ka, kb = held[-1][0], held[-1][1]
        if ka[0] != ka[-1] or kb[0] != kb[-1] or len(held) > 1 and (held[-2][0][-1] != ka[0] or held[-2][1][-1] != kb[0]):
            whole = [np.concatenate(x) for x in zip(*held)]
            tail = int(np.flatnonzero((whole[0] != whole[0][-1]) | (whole[1] != whole[1][-1]))[-1]) + 1
            yield packed(*[x[:tail] for x in whole])
            held = [[x[tail:] for x in whole]]
    if held:
        yield packed(*[np.concatenate(x) for x in zip(*held)])


#: Surroundings of anchors. ``off`` is the anchor's place in them; ``windows``: first << 16 | last of the windows asked for, by
#: how far they start before the anchor; kind 1 needs no answer and is there for others to be compared with (+ COMMON as above).
AROUND = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("key", "ka", "kb", "place")]
    + [T.StructField("off", T.IntegerType()), T.StructField("windows", T.IntegerType()), T.StructField("kind", T.ByteType()), T.StructField("bytes", T.BinaryType())]
)


def _fetched(length: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            rows: list[list] = [[] for _ in AROUND.names]
            for ka, kb, text, wants in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                data = (text or "").encode()
                for key, at, kind in np.frombuffer(wants, np.int64).reshape(-1, 3).tolist():
                    a = max(0, at - slack)
                    for column, value in zip(rows, (key, ka, kb, at, at - a, slack, kind, data[a : at + length])):
                        column.append(value)
            yield _batch(AROUND, rows)

    return run


class Suffixes:
    """Byte strings of several groups, to be sorted within their groups."""

    def __init__(self, group: np.ndarray, strings: list[bytes], width: int):
        n = len(strings)
        self.group, self.n, self.strings = group, n, strings
        self.lengths = np.fromiter(map(len, strings), np.int64, n)
        self.data = np.zeros((n, width + 1), np.uint8)
        for i, s in enumerate(strings):
            self.data[i, : len(s)] = np.frombuffer(s, np.uint8)
        _powers.reach(width + 1)
        self.sums = np.zeros((n, width + 1), _U)
        np.cumsum((self.data[:, :width].astype(_U) + _U(1)) * _powers.up[:width], axis=1, out=self.sums[:, 1:])

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common beginning of strings, by binary search with prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.lengths[x], self.lengths[y])
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.sums[x, middle] == self.sums[y, middle]
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.extension(x, y)
        ends_x, ends_y = n == self.lengths[x], n == self.lengths[y]
        return np.where(ends_x, ~ends_y | or_equal, ~ends_y & (self.data[x, n] < self.data[y, n]))

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the strings, and the common extension of each with the one before it (-1 at the start of a group)."""
        n = self.n
        first = np.flatnonzero(np.concatenate(([True], self.group[1:] != self.group[:-1])))
        sizes = np.diff(np.append(first, n))
        begin = np.repeat(first, sizes)
        end = begin + np.repeat(sizes, sizes)
        order, place, run = np.arange(n), np.arange(n), 1
        while run < sizes.max():
            local = place - begin
            half = local // run & 1  # 0: left run of a pair, 1: right run
            pair = begin + local // (2 * run) * (2 * run)
            active = np.flatnonzero(pair + run < end)
            half, pair = half[active], pair[active]
            low = np.where(half, pair, pair + run)
            high = np.where(half, pair + run, np.minimum(pair + 2 * run, end[active]))
            sibling = low.copy()
            own = order[active]
            for _ in range(run.bit_length() + 1):
                searching = np.flatnonzero(low < high)
                if not len(searching):
                    break
                middle = (low[searching] + high[searching]) >> 1
                before = self.less(order[middle], own[searching], half[searching].astype(bool))
                low[searching] = np.where(before, middle + 1, low[searching])
                high[searching] = np.where(before, high[searching], middle)
            rank = low - sibling
            target = pair + (active - np.where(half, pair + run, pair)) + rank
            merged = order.copy()
            merged[target] = own
            order, run = merged, 2 * run
        return order, self._verified(order)

    def _exact(self, order: np.ndarray) -> np.ndarray:
        x, y = order[:-1], order[1:]
        shortest = np.minimum(self.lengths[x], self.lengths[y])
        differ = self.data[x] != self.data[y]
        differ[np.arange(len(x)), shortest] = True
        return differ.argmax(1)

    def _verified(self, order: np.ndarray) -> np.ndarray:
        """Common extensions of neighbours, from the bytes; strings whose hashes collide are sorted again by their bytes."""
        out = np.full(self.n, -1, np.int64)
        if self.n < 2:
            return out
        inside = self.group[order[1:]] == self.group[order[:-1]]
        exact = self._exact(order)
        if (inside & (exact != self.extension(order[:-1], order[1:]))).any():
            order[:] = sorted(range(self.n), key=lambda i: (self.group[i], self.strings[i]))
            exact = self._exact(order)
        out[1:] = np.where(inside, exact, -1)
        return out


def repeated_windows(group: np.ndarray, strings: list[bytes], offsets: np.ndarray, length: int, slack: int) -> np.ndarray:
    """(string, d) table: whether the window that starts d bytes before the anchor also occurs around another anchor of the group."""
    after = Suffixes(group, [s[o:] for s, o in zip(strings, offsets.tolist())], length)
    before = Suffixes(group, [s[:o][::-1] for s, o in zip(strings, offsets.tolist())], slack)
    (o1, c1), (o2, c2) = after.sort(), before.sort()
    n = len(strings)
    out = np.zeros((n, slack + 1), bool)
    class1, class2 = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(slack + 1):
        fits = (before.lengths >= d) & (after.lengths >= length - d)
        if not fits.any():
            continue
        class1[o1] = np.cumsum(c1 < length - d)
        class2[o2] = np.cumsum(c2 < d)
        both = class1 * (n + 1) + class2
        order = np.argsort(both, kind="stable")
        same = both[order[1:]] == both[order[:-1]]
        hit = np.zeros(n, bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        out[:, d] = hit & fits
    return out


#: kind 2: a covered span of a text, from place to value; 0 or 1: surroundings of a core with too many of them.
SOLVED = T.StructType([*AROUND.fields, T.StructField("value", T.LongType())])


def _solved(length: int, slack: int):
    """Surroundings sorted by core, to covered spans; those of large groups pass through."""
    empty = lambda: [[] for _ in AROUND.names]

    def solve(rows: list[list]) -> pa.RecordBatch:
        key, ka, kb, place, off, _, kind, data = rows
        keys = np.array(key, np.int64)
        found = repeated_windows(np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1]))), data, np.array(off, np.int64), length, slack)
        found[np.array(kind) == 1] = False
        padded = np.zeros((len(key), slack + 3), np.int8)
        padded[:, 1:-1] = found
        edges = np.diff(padded, axis=1)
        i, low = np.nonzero(edges == 1)
        _, high = np.nonzero(edges == -1)
        at, none = np.array(place, np.int64)[i], np.zeros(len(i), np.int64)
        columns = [none, np.array(ka, np.int64)[i], np.array(kb, np.int64)[i], at - (high - 1), none.astype(np.int32), none.astype(np.int32), none.astype(np.int8) + 2, [None] * len(i), at - low + length]
        return _batch(SOLVED, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, group, key, large = empty(), empty(), None, False
        for batch in _sliced(batches, 2048):
            rows = [batch.column(i).to_pylist() for i in range(len(AROUND.names))]
            keys = np.array(rows[0], np.int64)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if rows[6][a] >= COMMON:
                    # Rows of common cores come first in their core: none of its others are small groups.
                    part = [column[a:b] for column in rows]
                    part[6] = [k & 1 for k in part[6]]
                    yield _batch(SOLVED, [*part, [None] * (b - a)])
                    continue
                if rows[0][a] != key:
                    if len(group[0]) > 1:
                        for column, values in zip(ready, group):
                            column += values
                    if len(ready[0]) >= BATCH:
                        yield solve(ready)
                        ready = empty()
                    group, key, large = empty(), rows[0][a], False
                for column, values in zip(group, rows):
                    column += values[a:b]
                if large or len(group[0]) > GROUP:
                    yield _batch(SOLVED, [*group, [None] * len(group[0])])
                    group, large = empty(), True
        if len(group[0]) > 1:
            for column, values in zip(ready, group):
                column += values
        if ready[0]:
            yield solve(ready)

    return run


#: Surroundings with the hash of all of them.
HALVES = T.StructType([*AROUND.fields, T.StructField("around", T.LongType())])


def _string_hash(data: bytes, salt: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data, salt) - (1 << 63)


def _halved(length: int):
    """Surroundings of an anchor to those of either half of its windows, keyed by the bytes that all windows of the half hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            rows: list[list] = [[] for _ in HALVES.names]
            for key, ka, kb, place, off, windows, kind, data in zip(*[batch.column(i).to_pylist() for i in range(len(AROUND.names))]):
                low, high = windows >> 16, windows & 0xFFFF
                middle = (low + high) // 2
                for first, last in {(low, middle), (min(middle + 1, high), high)}:
                    if off < first or len(data) - off < length - last:
                        continue  # no window of this half lies inside the text
                    a = max(0, off - last)
                    part = data[a : off + length - first]
                    core = _string_hash(data[off - first : off + length - last], key + first & 0xFFFFFFFF)
                    values = (core, ka, kb, place, off - a, first << 16 | last, kind, part, _string_hash(part, off - a))
                    for column, value in zip(rows, values):
                        column.append(value)
            yield _batch(HALVES, rows)

    return run


def _spans_of_groups(around: DataFrame, length: int, slack: int) -> DataFrame:
    """(ka, kb, start, end) of all repeated windows around anchors that ask for them."""
    spans = None
    while True:
        salt = F.when(F.col("kind") >= COMMON, F.pmod(F.xxhash64("ka", "place"), F.lit(127))).otherwise(0)
        solved = common.cut(around.repartition("key", salt).sortWithinPartitions("key").mapInArrow(_solved(length, slack), SOLVED))
        found = solved.where(F.col("kind") == 2).select("ka", "kb", F.col("place").alias("start"), F.col("value").alias("end"))
        spans = found if spans is None else spans.unionByName(found)
        large = solved.where(F.col("kind") != 2).drop("value")
        if large.isEmpty():
            return spans
        # At least one window fewer in every round, and half of them as a rule; a single window is settled by counting.
        halves = common.cut(large.select(*AROUND.names).mapInArrow(_halved(length), HALVES))
        classes = common.cut(
            halves.groupBy("key", "around").agg(
                F.sum(F.col("kind") + 1).alias("n"),
                F.first(F.struct("ka", "kb", "place", "off", "windows", "kind", "bytes")).alias("one"),
            )
        )
        several = classes.where(F.col("n") > 1).select("key", "around")
        equal = halves.where(F.col("kind") == 0).join(several, ["key", "around"], "left_semi")
        start = F.col("place") - F.col("off")
        spans = spans.unionByName(equal.select("ka", "kb", start.alias("start"), (start + F.octet_length("bytes")).alias("end")))
        shared = common.cut(classes.groupBy("key").agg(F.count("*").alias("m"), F.min("n").alias("least")).where((F.col("m") > 1) & (F.col("least") == 1)).select("key", "m"))
        kind = F.when(F.col("n") > 1, 1).otherwise(F.col("one.kind")) + F.when(F.col("m") > GROUP, COMMON).otherwise(0)
        around = classes.join(shared, "key").select("key", "one.ka", "one.kb", "one.place", "one.off", "one.windows", kind.cast("tinyint").alias("kind"), "one.bytes")


def _removed(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            text, spans, more = (batch.column(batch.num_columns - 3 + i).to_pylist() for i in range(3))
            n_bytes, n_removed, n_spans, kept = [], [], [], []
            for t, s, m in zip(text, spans, more):
                data = (t or "").encode()
                pairs = np.frombuffer((s or b"") + (m or b""), np.int32).reshape(-1, 2).astype(np.int64)
                end = np.minimum(pairs[:, 1], len(data))
                _, start, end = _merged(np.zeros(len(pairs), np.int64), pairs[:, 0], end)
                parts, at = [], 0
                for a, b in zip(start.tolist(), end.tolist()):
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                n_bytes.append(len(data))
                n_removed.append(int((end - start).sum()))
                n_spans.append(len(start))
                kept.append(b"".join(parts))
            arrays = [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *arrays], names=names)

    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` without its text column, with n_bytes, n_removed, n_spans (long) and kept (binary: the remaining bytes).

    Strings are judged on the input; overlaps count, matches never cross rows.
    A null text is empty. Texts below ``length`` bytes lose nothing; repeated
    rows, ids included, are copies of each other and lose all they share; long
    texts are treated whole; an empty table gives an empty result. Columns of
    the four names are replaced, all others pass through.
    """
    slack = length * 8 // 25
    if slack < 1:
        raise ValueError("length must be at least 4 bytes")
    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    others = [c for c in df.columns if c != text_col and c not in added]
    names = {n: common.fresh(df, n) for n in ("__ka", "__kb", "__text")}
    text, ident = common.col(text_col), common.col(id_col)
    # Rows are known by two hashes of id and text, 96 bits together.
    docs = df.select(*[common.col(c) for c in others], F.xxhash64(ident, text).alias(names["__ka"]), F.hash(ident, text).cast("long").alias(names["__kb"]), text.alias(names["__text"]))
    keyed = docs.select(F.col(names["__ka"]).alias("ka"), F.col(names["__kb"]).alias("kb"), F.col(names["__text"]).alias("text"))
    long = keyed.where(F.octet_length("text") >= length).select("ka", "kb", "text")
    met = long.mapInArrow(_anchor_rows(length, slack), ANCHORS).repartition("key", "salt").sortWithinPartitions("key", "salt", "around").mapInArrow(_classified(slack, length), TOLD)
    told = common.cut(met.repartition("ka", "kb").sortWithinPartitions("ka", "kb").mapInArrow(_per_text, PER_TEXT))
    wants = told.where(F.octet_length("wants") > 0).select("ka", "kb", "wants")
    around = long.join(wants, ["ka", "kb"]).select("ka", "kb", "text", "wants").mapInArrow(_fetched(length, slack), AROUND)
    near = _spans_of_groups(around, length, slack).select("ka", "kb", F.lit(0).cast("long").alias("place"), (F.shiftleft("start", 32) + F.col("end")).alias("value"), F.lit(2).cast("tinyint").alias("kind"))
    more = near.repartition("ka", "kb").sortWithinPartitions("ka", "kb").mapInArrow(_per_text, PER_TEXT).select("ka", "kb", F.col("spans").alias("more"))
    spans = told.join(more, ["ka", "kb"], "left").select("ka", "kb", "spans", "more")
    joined = docs.join(spans, (docs[names["__ka"]] == spans["ka"]) & (docs[names["__kb"]] == spans["kb"]), "left")
    result = T.StructType([*df.select(*[common.col(c) for c in others]).schema.fields, *[T.StructField(n, T.LongType(), False) for n in added[:3]], T.StructField("kept", T.BinaryType(), False)])
    return common.map_in_arrow(joined.select(*[common.col(c) for c in others], F.col(names["__text"]), "spans", "more"), _removed(result.names), result)
