"""Benchmark decontamination by greedy string tiling (operator 5).

Words shared by a text and a benchmark item are joined on seeds of LEAST words.
An item whose words are not covered by seeds up to the threshold is passed
over: no tile can lie outside seeds. For the rest the longest matches between
text and item that overlap no earlier tile are marked again and again, found by
Karp-Rabin hashes of shrinking length; the share of the item's words inside
tiles is its coverage. Tiles may lie in any order, so reordered passages count.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Words of a seed, and so of the shortest tile.
LEAST = 3
THRESHOLD = 0.8
#: Items are sent to the executors in blocks of at most so many characters (an item beyond that is a block of its own), at most
#: so many blocks at once; every block meets every document.
BLOCK_CHARS, BLOCKS_AT_ONCE = 8_000_000, 4

_WORD = re.compile(r"[^\W_]+")
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _seeds(ids: np.ndarray) -> np.ndarray:
    """64-bit hashes of all stretches of LEAST word numbers. Seeds only say where tiles can lie, so a collision does no harm."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(ids) - LEAST + 1, np.uint64)
        for k in range(LEAST):
            h = (h + ids[k : len(ids) - LEAST + 1 + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
    return h


def _runs(marked: bytearray, least: int) -> list[tuple[int, int]]:
    """Stretches of at least so many unmarked places."""
    out, at, n = [], 0, len(marked)
    while at < n:
        end = marked.find(1, at)
        end = n if end < 0 else end
        if end - at >= least:
            out.append((at, end))
        at = end + 1
    return out


def _windows(values: Sequence[int], marked: bytearray, length: int) -> Iterator[tuple[int, int]]:
    """(place, Karp-Rabin hash) of every unmarked window."""
    top = pow(_BASE, length - 1, _PRIME)
    for start, end in _runs(marked, length):
        h = 0
        for i in range(start, start + length):
            h = (h * _BASE + values[i] + 1) % _PRIME
        yield start, h
        for i in range(start + length, end):
            h = ((h - (values[i - length] + 1) * top) * _BASE + values[i] + 1) % _PRIME
            yield i - length + 1, h


def tiles(text: Sequence[int], item: Sequence[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (place in the text, place in the item, length) by running Karp-Rabin greedy string tiling. Negative numbers match nothing."""
    in_text = bytearray(v < 0 for v in text)
    in_item = bytearray(v < 0 for v in item)
    out: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), len(text)))
    while length >= least:
        places: dict[int, list[int]] = {}
        for b, h in _windows(item, in_item, length):
            places.setdefault(h, []).append(b)
        if not places:
            if length == least:
                break
            length = max(least, length // 2)
            continue
        found: list[tuple[int, int, int]] = []
        for a, h in _windows(text, in_text, length):
            for b in places.get(h, ()):
                if any(text[a + k] != item[b + k] for k in range(length)):
                    continue
                if a and b and text[a - 1] == item[b - 1] and not in_text[a - 1] and not in_item[b - 1]:
                    continue  # part of the match that starts one place before
                n = length
                while a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n] and not in_text[a + n] and not in_item[b + n]:
                    n += 1
                found.append((-n, a, b))
        if not found:
            if length == least:
                break
            length = max(least, length // 2)
            continue
        heapq.heapify(found)
        while found:
            minus, a, b = heapq.heappop(found)
            n = -minus
            if 1 in in_text[a : a + n] or 1 in in_item[b : b + n]:
                # An earlier tile took part of it: its free stretches come back in order of length.
                taken = bytearray(in_text[a + k] | in_item[b + k] for k in range(n))
                for start, end in _runs(taken, length):
                    heapq.heappush(found, (start - end, a + start, b + start))
                continue
            in_text[a : a + n] = in_item[b : b + n] = b"\x01" * n
            out.append((a, b, n))
        if length == least:
            break
        length = max(least, length // 2)
    return sorted(out)


class Index:
    """Seeds of a block of benchmark items."""

    def __init__(self, items: Sequence[tuple[Any, str]], threshold: float):
        self.threshold = threshold
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[Any, list[int]]] = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text or "")]
            if ids:
                self.items.append((item_id, ids))
        seeds, owners, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        self.short: dict[int, list[int]] = {}  # items below LEAST words, by their first word
        for k, (_, ids) in enumerate(self.items):
            if len(ids) < LEAST:
                self.short.setdefault(ids[0], []).append(k)
                continue
            seeds.append(_seeds(np.array(ids, np.int64)))
            owners.append(np.full(len(seeds[-1]), k))
            places.append(np.arange(len(seeds[-1])))
        seeds, owners, places = np.concatenate(seeds), np.concatenate(owners), np.concatenate(places)
        order = np.argsort(seeds, kind="stable")
        self.keys, self.first, self.count = np.unique(seeds[order], return_index=True, return_counts=True)
        self.owners, self.places = owners[order], places[order]

    def hits(self, text: str | None) -> list[tuple[Any, float, int, int]]:
        """(item, coverage, tiles, first word of the text in a tile) of all items covered up to the threshold."""
        ws = words(text or "")
        if not ws:
            return []
        ids = np.fromiter(map(self.vocabulary.get, ws, [-1] * len(ws)), np.int64, len(ws))
        out = self._short_hits(ids) if self.short else []
        known = ids >= 0
        at = np.flatnonzero(known[:-2] & known[1:-1] & known[2:]) if len(ids) >= LEAST else np.empty(0, np.int64)
        if not len(at) or not len(self.keys):
            return out
        seeds = _seeds(ids)[at]
        key = np.searchsorted(self.keys, seeds)
        key[key == len(self.keys)] = 0
        met = self.keys[key] == seeds
        at, key = at[met], key[met]
        if not len(at):
            return out
        n = self.count[key]
        posting = np.repeat(self.first[key] - np.cumsum(n) + n, n) + np.arange(n.sum())
        owner, place, at = self.owners[posting], self.places[posting], np.repeat(at, n)
        order = np.argsort(owner, kind="stable")
        owner, place, at = owner[order], place[order], at[order]
        edges = np.flatnonzero(np.diff(owner)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(owner)]):
            item_id, item = self.items[owner[lo]]
            need = math.ceil(self.threshold * len(item) - 1e-9)
            if (hi - lo) * LEAST < need:
                continue
            reached = np.zeros(len(item) + LEAST, bool)
            for k in range(LEAST):
                reached[place[lo:hi] + k] = True
            if reached.sum() < need:
                continue
            # Only words inside seeds of this item can lie in tiles; what is left out between them becomes one gap.
            inside = np.zeros(len(ids), bool)
            for k in range(LEAST):
                inside[at[lo:hi] + k] = True
            kept = np.flatnonzero(inside)
            text_ids, where = [], []
            for p, v in zip(kept.tolist(), ids[kept].tolist()):
                if where and where[-1] != p - 1:
                    text_ids.append(-1)
                    where.append(-1)
                text_ids.append(v)
                where.append(p)
            found = tiles(text_ids, item)
            covered = sum(t[2] for t in found)
            if covered >= need:
                out.append((item_id, covered / len(item), len(found), where[found[0][0]]))
        return out

    def _short_hits(self, ids: np.ndarray) -> list[tuple[Any, float, int, int]]:
        """Items of fewer words than a seed count if they stand in the text whole."""
        out = []
        for word, owners in self.short.items():
            for a in np.flatnonzero(ids == word).tolist():
                left = [k for k in owners if ids[a : a + len(self.items[k][1])].tolist() == self.items[k][1]]
                out += [(self.items[k][0], 1.0, 1, a) for k in left]
                owners = [k for k in owners if k not in left]
                if not owners:
                    break
        return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[Any, str]]]:
    block, size = [], 0
    for r in benchmark.select(common.col(id_col), common.col(text_col)).where(common.col(text_col).isNotNull()).toLocalIterator():
        if block and size + len(r[1]) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += len(r[1])
    if block:
        yield block


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    out_col: str = "hits",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with the benchmark items that a text holds as ``out_col``: array of (item_id, coverage, tiles, first_word).

    The benchmark is the query set: it goes to the executors in blocks of
    bounded size and each block meets every document, so documents are neither
    shuffled nor left out. No more than ``BLOCKS_AT_ONCE`` blocks are held by the
    driver or an executor: a benchmark of more is met in passes, between which
    the documents with the hits so far are written to the shared folder. A null or empty text has no hits, nor has any text
    if the benchmark is empty; items without words are never found, those
    below ``LEAST`` words only whole; repeated items and documents count each.
    An existing ``out_col`` is replaced, other columns pass through.
    """
    item_type = benchmark.select(common.col(item_id_col)).schema[0].dataType
    kind = T.ArrayType(T.StructType([T.StructField("item_id", item_type), T.StructField("coverage", T.DoubleType()), T.StructField("tiles", T.IntegerType()), T.StructField("first_word", T.IntegerType())]))
    before = common.fresh(docs, "__before")
    result = docs.withColumn(before, F.array().cast(kind))
    sent: list[Broadcast] = []
    for i, block in enumerate(_blocks(benchmark, item_id_col, item_text_col)):
        if i and i % BLOCKS_AT_ONCE == 0:
            result = common.written(result)
            for b in sent:
                b.destroy()
            sent = []
        sent.append(docs.sparkSession.sparkContext.broadcast(block))
        hits = _hits_column(sent[-1], kind, threshold)(common.col(text_col))
        result = result.withColumn(before, F.concat(before, hits) if i else hits)
    return result.withColumn(out_col, F.col(before)).drop(before)


def _hits_column(sent: Broadcast, kind: T.DataType, threshold: float):
    @F.pandas_udf(kind)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.free_tables()
        index = Index(sent.value, threshold)
        keys = ("item_id", "coverage", "tiles", "first_word")
        for texts in batches:
            yield pd.Series([[dict(zip(keys, h)) for h in index.hits(t)] for t in texts], dtype=object)

    return hits


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; texts without words, nulls too, hold none. Rows and columns as in ``with_hits``."""
    hits = common.fresh(docs, "__hits")
    return with_hits(docs, benchmark, text_col, item_id_col, item_text_col, hits, threshold).where(F.size(hits) == 0).drop(hits)
