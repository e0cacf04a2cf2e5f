"""SimHash near-duplicates with a byte-position inverted index (operator 3).

Two 64-bit fingerprints that differ in at most four bits share at least four of
their eight bytes, each at its own position. Lists of single bytes would each
hold 1/256 of the corpus, so postings are kept for every choice of three
positions and the three bytes there (56 per fingerprint). Where two fingerprints
meet, the shared positional bytes of the pair are tallied; pairs below the
guaranteed four are dropped, and the bits of the rest are compared. Of all lists
in which a pair meets, only that of its first three shared positions counts it.

Only different fingerprints are indexed, so a group of copies is one entry. A
long list is not paired out: it gives a spanning forest of its links. Beyond
``BLOCK`` entries it is split by every fourth position, as a pair must share one
more, and what is still longer is dealt out as pairs of blocks over many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, graph

SHINGLE = 4
MOST_BITS = 4
SEED = 42
#: Entries of a posting list, or of a block of one, that one task compares with each other.
BLOCK = 4096
#: Lists up to this length are paired as they are.
SHORT = 16

#: Bytes that linked fingerprints share, at least, and positions of a list.
LEAST_SHARED, LISTED = 8 - MOST_BITS, 3
POSITIONS = tuple(combinations(range(8), LISTED))


def _byte_mask(positions) -> int:
    return sum(0xFF << 8 * p for p in positions)


MASKS = np.array([_byte_mask(c) for c in POSITIONS], np.uint64)
#: By choice, the masks that add one position to it.
WIDER = [[int(np.uint64(_byte_mask((*c, p))).view(np.int64)) for p in range(8) if p not in c] for c in POSITIONS]
#: Positions before the last one of a choice that are not in it: a pair that shares one of these counts elsewhere.
OTHERS = np.array([[1 if p < max(c) and p not in c else 0 for p in range(8)] for c in POSITIONS], np.uint8)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text's shingles of words; 0 for a text without words."""
    import xxhash

    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(ws) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[at : at + (1 << 14)], np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "simhash") -> DataFrame:
    """``df`` with the SimHash of a text as ``out_col`` (long, never null); a column of that name is replaced."""

    @F.pandas_udf(T.LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.free_tables()
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return df.withColumn(out_col, of(common.col(text_col)))


def _linked(x: np.ndarray, y: np.ndarray, choice: np.ndarray | None = None) -> np.ndarray:
    """Which pairs share enough bytes and differ in few enough bits; with ``choice``, only those that count in the lists of these choices."""
    differ = x ^ y
    shared = differ.view(np.uint8).reshape(-1, 8) == 0  # little-endian: byte p is position p
    near = shared.sum(1) >= LEAST_SHARED
    here = np.flatnonzero(near)
    near[here] = np.bitwise_count(differ[here]) <= MOST_BITS
    if choice is not None:
        here = np.flatnonzero(near)
        near[here] = ~(shared[here] & OTHERS[choice[here]].astype(bool)).any(1)
    return near


def _forest(left: np.ndarray, right: np.ndarray, choice: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two arrays of fingerprints, or within one (left is right)."""
    nodes = left if left is right else np.concatenate([left, right])
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    shift = 0 if left is right else len(left)
    a, b = [], []
    for i in range(len(left)):
        others = right[i + 1 :] if left is right else right
        near = np.flatnonzero(_linked(others, left[i], None if choice is None else np.full(len(others), choice)))
        for j in near.tolist():
            j += i + 1 if left is right else shift
            p, q = find(i), find(j)
            if p != q:
                parent[q] = p
                a.append(i)
                b.append(j)
    return nodes[a], nodes[b]


LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("choice", T.IntegerType())])


def _links_of_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of posting lists, which come sorted. A list beyond BLOCK entries is passed on: fingerprint, masked bytes, choice."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def out(a, b, choice=None):
        n = len(a)
        third = pa.nulls(n, pa.int32()) if choice is None else pa.array(choice, pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), third], names=LINKS.names)

    def lists(choice, masked, fp):
        starts = np.flatnonzero(np.concatenate(([True], (choice[1:] != choice[:-1]) | (masked[1:] != masked[:-1]))))
        sizes = np.diff(np.append(starts, len(fp)))
        for start, size in zip(starts[sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist()):
            part = np.unique(fp[start : start + size])
            if len(part) > BLOCK:
                yield out(part, np.full(len(part), masked[start]), np.full(len(part), choice[start], np.int32))
            else:
                yield out(*_forest(part, part, int(choice[start])))
        left = np.repeat(np.where(sizes > SHORT, 0, sizes), sizes) - (np.arange(len(fp)) - np.repeat(starts, sizes)) - 1  # entries after this one in its list
        for d in range(1, SHORT):
            at = np.flatnonzero(left >= d)
            if not len(at):
                break
            near = _linked(fp[at], fp[at + d], choice[at])
            if near.any():
                yield out(fp[at[near]], fp[at[near] + d])

    for batch in batches:
        arrays = (batch.column(0).to_numpy().astype(np.int32), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy().view(np.uint64))
        if not len(arrays[0]):
            continue
        choice, masked, _ = arrays
        # The last list of a batch may go on in the next one.
        tail = len(choice)
        changes = np.flatnonzero((choice[1:] != choice[:-1]) | (masked[1:] != masked[:-1]))
        tail = int(changes[-1]) + 1 if len(changes) else 0
        if held and (held[-1][0][-1] != choice[0] or held[-1][1][-1] != masked[0]):
            yield from lists(*[np.concatenate(x) for x in zip(*held)])
            held = []
        if tail:
            held.append(tuple(x[:tail] for x in arrays))
            yield from lists(*[np.concatenate(x) for x in zip(*held)])
            held = []
        held.append(tuple(x[tail:] for x in arrays))
    if held:
        yield from lists(*[np.concatenate(x) for x in zip(*held)])


def _links_of_blocks(key, frame: pd.DataFrame) -> pd.DataFrame:
    """Links within one block of a long list or between two."""
    first, second = int(key[1]), int(key[2])
    fp = frame["fp"].to_numpy().view(np.uint64)
    block = frame["block"].to_numpy()
    left = fp[block == first]
    a, b = _forest(left, left if first == second else fp[block == second])
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links of a column ``fp`` of different fingerprints, enough of them to keep every component together."""
    masks = F.from_json(F.lit(str([int(m) for m in MASKS.view(np.int64)])), "array<bigint>")
    postings = fps.select("fp", F.posexplode(masks).alias("choice", "mask")).select("choice", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")
    found = postings.repartition("choice", "masked").sortWithinPartitions("choice", "masked").mapInArrow(_links_of_lists, LINKS)
    found = common.cut(found)
    short = found.where(F.col("choice").isNull()).select("a", "b")
    long = found.where(F.col("choice").isNotNull()).select("choice", F.col("a").alias("fp"))
    if long.isEmpty():
        return short
    # Members of a long list go on to those of one position more; what several lists come to is one list.
    wider = F.element_at(F.from_json(F.lit(json.dumps(WIDER)), "array<array<bigint>>"), F.col("choice") + 1)
    split = long.select("fp", F.explode(wider).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("masked")).distinct()
    split = split.select(F.struct("mask", "masked").alias("bytes"), "fp")
    # Blocks by hash of the fingerprint; every pair of blocks is a group of its own.
    sizes = split.groupBy("bytes").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("bytes", F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("blocks"))
    dealt = split.join(sizes, "bytes").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bytes", "fp", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")
    )
    return short.unionByName(pairs.groupBy("bytes", "first", "second").applyInPandas(_links_of_blocks, "a long, b long"))


def with_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fp_col: str = "simhash", component_col: str = "component_id") -> DataFrame:
    """Id, SimHash and component of every row: the least id that links reach from it, its own included.

    Links join fingerprints of at most ``MOST_BITS`` different bits; equal
    fingerprints are linked, those of texts without words (null too) as well.
    Repeated rows come out each; a null id is never the least; an empty table
    gives an empty result. Only ids and fingerprints are shuffled.
    """
    docs = common.cut(fingerprints(df.select(common.col(id_col).alias("id"), common.col(text_col).alias("text")), "text", "fp").select("id", "fp"))
    fps = docs.groupBy("fp").agg(F.min("id").alias("least"))
    roots = graph.components(links(fps.select("fp")))
    # Only fingerprints with a link have a root; a root itself is found by its own members.
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    of_root = common.cut(members.join(fps, members["node"] == fps["fp"]).groupBy("root").agg(F.min("least").alias("component")))
    linked = members.join(of_root, "root").select(F.col("node").alias("fp"), "component")
    # Cut off, so that both sides of the last join are plain shuffles and a fingerprint with many copies can be split.
    linked = common.cut(fps.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component")))
    return docs.join(linked, "fp").select(F.col("id").alias(id_col), F.col("fp").alias(fp_col), F.col("component").alias(component_col))


def written(simhash: Column) -> Column:
    """A SimHash as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(simhash), 16, "0"))


# Similar texts: exact Jaccard similarity of their shingles, where 64 bits can't tell one of 0.8 from one of 0.5.
#
# Shingles are ordered, the frequent ones last. If two sets are similar enough,
# the first shingle they share comes early in both: enough of each must be left
# from there on. Only such prefixes are indexed, and only pairs that can still
# reach the similarity from a shared shingle on are looked at.

WIDE_SHINGLE = 5
SIMILARITY = 0.8
#: Bytes of text whose shingles are counted for the order; shingles seen less often there count as rare.
SAMPLE_BYTES, FREQUENT = 32 << 20, 4
#: Lists of the index up to this length give all their pairs; longer ones are dealt out as pairs of blocks of so many shingles.
SHORT_LIST, BLOCK_SHINGLES = 32, 1 << 18
#: Each makes another member of a long list the one that all others are compared with first.
TURNS = (0, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x3C6EF372FE94F82A)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted different 64-bit hashes of a text's shingles of five words; a shorter text is one shingle."""
    import xxhash

    ws = (text or "").encode().lower().split()
    joined = b" ".join(ws)
    if len(ws) <= WIDE_SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(ws) - WIDE_SHINGLE + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[WIDE_SHINGLE - 1 :].tolist())], np.uint64))


def most_differing(similarity: float, total=1):
    """Shingles that lie in one only of two sets of this Jaccard similarity, at most, if the sets have ``total`` together."""
    return (1 - similarity) / (1 + similarity) * total


def least_shared(similarity: float, total):
    """Shingles that two sets of this Jaccard similarity share, at least, if they have ``total`` together."""
    return (total - most_differing(similarity, total)) / 2 - 1e-6


def _of_texts(make: Callable[[int, np.ndarray], list[np.ndarray]], names: list[str]):
    """A function for mapInArrow over (node, text): rows of longs that ``make`` gives for a node and its shingles, once in a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.free_tables()
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = []
                for node, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if node not in seen:
                        seen.add(node)
                        found.append(make(node, shingle_set(text)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in zip(*found)], names=names)

    return run


def _order(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that are frequent in a sample of bounded size, sorted, and their counts. Any order finds all pairs; this one keeps lists short."""
    total = texts.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0
    sample = texts.where(F.pmod(F.xxhash64("node"), F.lit(int(total // SAMPLE_BYTES) + 1)) == 0)
    counted = sample.mapInArrow(_of_texts(lambda node, s: [s], ["shingle"]), "shingle long").groupBy("shingle").count().where(F.col("count") >= FREQUENT).toArrow()
    shingles = counted.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], counted.column("count").to_numpy()[order]


def _prefixes(frequent: np.ndarray, counts: np.ndarray, similarity: float):
    """(shingle, node, place) of the first shingles of every text; place has the set's size in its upper half, and how many are left there in its lower one."""

    def make(node: int, s: np.ndarray) -> list[np.ndarray]:
        kept = len(s) - int(np.ceil(similarity * len(s) - 1e-6)) + 1
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
            s = s[np.argsort(np.where(frequent[at] == s, counts[at], 0), kind="stable")]
        return [s[:kept], np.full(kept, node, np.int64), (len(s) << 32) + len(s) - np.arange(kept)]

    return make


INDEX = ["shingle", "node", "place"]
MET = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", *INDEX)])


def _met(similarity: float):
    """A function for mapInArrow over the index, sorted by shingle and node: pairs (a, b) to be compared, and the members of long lists that may have further ones."""

    def reach(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.minimum(x & 0xFFFFFFFF, y & 0xFFFFFFFF) >= least_shared(similarity, (x >> 32) + (y >> 32))

    def out(pairs, members=None):
        n = len(pairs[0]) if members is None else len(members[0])
        columns = [*pairs, *[pa.nulls(n, pa.int64())] * 3] if members is None else [*[pa.nulls(n, pa.int64())] * 2, *members]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=MET.names)

    def lists(shingle, node, place):
        other = np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])))
        shingle, node, place = shingle[other], node[other], place[other]
        starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
        sizes = np.diff(np.append(starts, len(shingle)))
        for start, size in zip(starts[sizes > SHORT_LIST].tolist(), sizes[sizes > SHORT_LIST].tolist()):
            x, p = node[start : start + size], place[start : start + size]
            if size <= BLOCK:
                some = np.array([np.count_nonzero(reach(p[i], p)) > (reach(p[i], p[i])) for i in range(size)])
                x, p = x[some], p[some]
            if len(x) > 1:
                # Most members of a group are linked to one of few; the others are left to the blocks.
                centre = int(np.argmin(x ^ TURNS[shingle[start] % len(TURNS)]))
                near = reach(p[centre], p) & (x != x[centre])
                yield out((np.maximum(x[near], x[centre]), np.minimum(x[near], x[centre])))
                yield out((), (np.full(len(x), shingle[start]), x, p))
        left = np.repeat(np.where(sizes > SHORT_LIST, 0, sizes), sizes) - (np.arange(len(shingle)) - np.repeat(starts, sizes)) - 1  # entries after this one in its list
        for d in range(1, SHORT_LIST):
            at = np.flatnonzero(left >= d)
            if not len(at):
                break
            at = at[reach(place[at], place[at + d])]
            if len(at):
                yield out((np.maximum(node[at], node[at + d]), np.minimum(node[at], node[at + d])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.free_tables()
        held: list[list[np.ndarray]] = []
        for batch in batches:
            arrays = [c.to_numpy() for c in batch.columns]
            if not len(arrays[0]):
                continue
            # The last list of a batch may go on in the next one.
            changes = np.flatnonzero(arrays[0][1:] != arrays[0][:-1])
            tail = int(changes[-1]) + 1 if len(changes) else 0
            if held and (tail or held[-1][0][-1] != arrays[0][0]):
                yield from lists(*[np.concatenate(x) for x in zip(*held, [x[:tail] for x in arrays])])
                held = []
            elif tail:
                yield from lists(*[x[:tail] for x in arrays])
            held.append([x[tail:] for x in arrays])
        if held:
            yield from lists(*[np.concatenate(x) for x in zip(*held)])

    return run


#: Counts of a text's shingles by the upper bits of their hashes, one for about four shingles; none if a count exceeds a byte.
SKETCH = T.StructType([T.StructField("node", T.LongType()), T.StructField("size", T.LongType()), T.StructField("sketch", T.BinaryType())])
LEAST_BITS = 6


def _sketch(s: np.ndarray) -> bytes:
    bits = max(LEAST_BITS, len(s).bit_length() - 2)
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return b"" if counts.max() > 255 else counts.astype(np.uint8).tobytes()


def most_shared(x: bytes, y: bytes, least: int) -> int:
    """Shingles that two texts share, at most, by their sketches; ``least``, the size of the smaller text, where one has none."""
    if not x or not y:
        return least
    a, b = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (x, y))
    m = min(len(a), len(b))
    return int(np.minimum(a.reshape(m, -1).sum(1), b.reshape(m, -1).sum(1)).sum())


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_sketch(s) for s in sets], pa.binary())], names=SKETCH.names)


def _possible(similarity: float):
    """A function for mapInArrow over (a, b, size and sketch of a, size and sketch of b): the pairs whose sketches allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, m, y = (batch.column(i).to_pylist() for i in range(2, 6))
            near = [most_shared(x[i], y[i], min(n[i], m[i])) >= least_shared(similarity, n[i] + m[i]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return run


def _verified(similarity: float):
    """A function for mapInArrow over (a, b, text of a, text of b): the pairs whose sets of shingles are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = {2: ("", shingle_set("")), 3: ("", shingle_set(""))}

        def of(column: int, text: str) -> np.ndarray:
            if last[column][0] != text:
                last[column] = text, shingle_set(text)
            return last[column][1]

        for batch in batches:
            near = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (of(c, batch.column(c)[i].as_py()) for c in (2, 3))
                shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                near[i] = shared >= least_shared(similarity, len(x) + len(y))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(near)) for c in batch.columns[:2]], names=["a", "b"])

    return run


def _plausible(similarity: float):
    """Members of one block of a long list, or of two, that their sketches allow a link to a member of another component."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        first, second = int(key[1]), int(key[2])
        block, size = frame["block"].to_numpy(), frame["size"].to_numpy()
        _, group = np.unique(frame["root"].to_numpy(), return_inverse=True)
        sketches = [np.frombuffer(x, np.uint8) for x in frame["sketch"]]
        width = np.fromiter(map(len, sketches), np.int64, len(sketches))
        near = width == 0  # without a sketch a text is always taken further
        for w in np.unique(width[width > 0]).tolist():
            wide = np.flatnonzero(width >= w)
            coarse = np.stack([sketches[i].reshape(w, -1).sum(1, dtype=np.int32) for i in wide.tolist()])
            for k in np.flatnonzero(width[wide] == w).tolist():
                i = int(wide[k])
                others = {first, second} - {block[i]} or {block[i]}
                fits = (group[wide] != group[i]) & np.isin(block[wide], list(others)) & (np.minimum(size[wide], size[i]) >= least_shared(similarity, size[wide] + size[i]))
                at = np.flatnonzero(fits)
                if len(at):
                    shared = np.minimum(coarse[at], coarse[k]).sum(1)
                    at = at[shared >= least_shared(similarity, size[wide[at]] + size[i])]
                    near[wide[at]] = True
                    near[i] |= len(at) > 0
        if (width == 0).any():
            near[:] = True
        return pd.DataFrame({"shingle": frame["shingle"].to_numpy()[near], "node": frame["node"].to_numpy()[near]})

    return run


def _links_of_list_blocks(similarity: float):
    """Links within one block of a long list or between two, enough of them to keep together what is linked, with the links already known."""

    def run(key, frame: pd.DataFrame) -> pd.DataFrame:
        first, second = int(key[1]), int(key[2])
        node, block = frame["node"].to_numpy(), frame["block"].to_numpy()
        sets = [shingle_set(t) for t in frame["text"]]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        ends = np.cumsum(sizes)
        _, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owners = np.repeat(np.arange(len(sets)), sizes)[np.argsort(places, kind="stable")]
        begins = np.cumsum(counts) - counts
        _, group = np.unique(frame["root"].to_numpy(), return_inverse=True)
        a, b = [], []
        for i in np.flatnonzero(block == first).tolist():
            mine = places[ends[i] - sizes[i] : ends[i]]
            n = counts[mine]
            at = np.repeat(begins[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            near = np.bincount(owners[at], minlength=len(sets)) >= least_shared(similarity, sizes + sizes[i])
            near &= (block == second) & (group != group[i])
            for j in np.flatnonzero(near).tolist():
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    a.append(node[i])
                    b.append(node[j])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return run


def similar_links(texts: DataFrame, similarity: float = SIMILARITY, known: DataFrame | None = None) -> DataFrame:
    """(a, b): links of texts whose sets of shingles have this Jaccard similarity, enough of them to keep every component together.

    ``texts`` has node (long, the same for equal texts) and text. Every
    link is verified on the shingles, after a bound from sketches that no similar pair falls below. Pairs of short lists are all compared. In a
    long list all members are compared with one first; if that leaves more than
    one component, every two members of different ones are compared in blocks,
    by their sketches and, where these leave it open, by their shingles.
    Links (a, b) that are ``known`` already are taken over. Repeated rows count once; null texts count as one without words; an empty
    table gives no links; other columns are not looked at.
    """
    paths: list[str] = []
    index = texts.mapInArrow(_of_texts(_prefixes(*_order(texts), similarity), INDEX), "shingle long, node long, place long")
    met = common.written(index.repartition("shingle").sortWithinPartitions("shingle", "node").mapInArrow(_met(similarity), MET), paths)
    pairs = common.cut(met.where(F.col("a").isNotNull()).select("a", "b").distinct())
    long = met.where(F.col("shingle").isNotNull()).select(*INDEX)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(long.select("node")).distinct()
    some = common.written(texts.groupBy("node").agg(F.first("text").alias("text")).join(wanted, "node", "left_semi"), paths)
    # Texts move only where sketches, which are a small part of them, leave it open whether a pair is similar.
    sketches = common.written(some.select("node", "text").mapInArrow(_sketches, SKETCH), paths)
    left, right = (sketches.select(F.col("node").alias(n), F.col("size").alias(f"size_{n}"), F.col("sketch").alias(f"sketch_{n}")) for n in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "size_a", "sketch_a", "size_b", "sketch_b")
    possible = common.cut(both.mapInArrow(_possible(similarity), "a long, b long"))
    few = common.written(some.join(possible.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"), paths)
    left, right = (few.select(F.col("node").alias(n), F.col("text").alias(f"of_{n}")) for n in "ab")
    found = common.cut(possible.join(left, "a").join(right, "b").select("a", "b", "of_a", "of_b").mapInArrow(_verified(similarity), "a long, b long"))
    if known is not None:
        found = found.unionByName(known)
    if long.isEmpty():
        return _without(paths, found)
    members = common.cut(long.join(graph.components(found), "node", "left").select("shingle", "node", F.coalesce("root", "node").alias("root"), F.shiftright("place", 32).alias("size")))
    dealt = _dealt(members, F.count("*") / BLOCK).join(sketches.select("node", "sketch"), "node")
    open_ = common.written(dealt.groupBy("shingle", "first", "second").applyInPandas(_plausible(similarity), "shingle long, node long").distinct(), paths)
    dealt = _dealt(members.join(open_, ["shingle", "node"], "left_semi"), F.sum("size") / BLOCK_SHINGLES)
    few = common.written(some.join(open_.select("node").distinct(), "node", "left_semi"), paths)
    more = dealt.join(few, "node").groupBy("shingle", "first", "second").applyInPandas(_links_of_list_blocks(similarity), "a long, b long")
    return _without(paths, found.unionByName(common.cut(more)))


def _without(paths: list[str], result: DataFrame) -> DataFrame:
    """A result that is cut off from the folders it was made from, which go."""
    for path in paths:
        common.remove_folder(result.sparkSession, path)
    return result


def _dealt(members: DataFrame, blocks: Column) -> DataFrame:
    """Members of lists that have several components, once for every pair of blocks that theirs is in."""
    apart = members.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.ceil(blocks).cast("int").alias("blocks")).where(F.col("x") != F.col("y"))
    dealt = members.join(apart.select("shingle", "blocks"), "shingle").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "shingle", "node", "root", "size", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")
    )


def _fingerprint_links(docs: DataFrame) -> DataFrame:
    """(a, b): every node of operator 3's components beside the least one; ``docs`` has node and text."""
    found = with_components(docs, "node", "text")
    return common.cut(found.where(F.col("node") != F.col("component_id")).select(F.col("node").alias("a"), F.col("component_id").alias("b")).distinct())


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, by_fingerprint: bool = False) -> DataFrame:
    """``df`` with one row of every group of near-duplicates: that of the least id, and of texts with that id the one of the least hash; all columns from it.

    Rows are grouped if their texts are equal, or if their texts' shingles of
    five words are similar; with ``by_fingerprint`` also if ``with_components``
    puts them in one component. Texts without words are equal to each other. Rows
    with a null id stay, whatever their text. Of repeated rows (id and text)
    one stays, any of them if other columns differ; different texts of one id
    are judged each. An empty table gives an empty result; columns of any
    names pass through.
    """
    node_col = common.fresh(df, "__node")
    text = F.coalesce(common.col(text_col), F.lit(""))
    node = F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(text)).otherwise(F.lit(0))
    docs = df.where(common.col(id_col).isNotNull()).select(common.col(id_col).alias("id"), node.alias("node"), text.alias("text"))
    known = _fingerprint_links(docs.select("node", "text")) if by_fingerprint else None
    found = similar_links(docs.where(F.col("node") != 0).select("node", "text"), similarity, known)
    roots = graph.components(found)
    rows = common.written(docs.groupBy("id", "node").count())
    nodes = rows.groupBy("node").agg(F.min("id").alias("least")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = nodes.groupBy("root").agg(F.min(F.struct(F.col("least").alias("id"), "node")).alias("first"))
    first = nodes.select("node", "root").join(first, "root").select("node", F.col("first.id").alias("first_id"), F.col("first.node").alias("first_node"))
    # What goes is a small part of all rows, so its ids move and not the texts that stay.
    gone = rows.join(first, "node").where((F.col("id") != F.col("first_id")) | (F.col("node") != F.col("first_node"))).select("id", "node")
    repeated = rows.where(F.col("count") > 1).select("id", "node")
    here = lambda frame, other: frame.join(other, (common.col(id_col) == other["id"]) & (F.col(node_col) == other["node"]), "left_anti")
    kept = here(df.withColumn(node_col, node), common.written(gone))
    if not repeated.isEmpty():
        again = (common.col(id_col) == repeated["id"]) & (F.col(node_col) == repeated["node"])
        kept = here(kept, repeated).unionByName(kept.join(repeated, again, "left_semi").dropDuplicates([id_col, node_col]))
    return kept.drop(node_col)
