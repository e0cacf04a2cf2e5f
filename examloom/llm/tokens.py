"""Token counts by heap-and-linked-list byte-pair merging (operator 7).

The vocabulary is that of a sentencepiece BPE model with byte fallback. A text
is cut where no piece can reach across (before every word mark, around
characters that no piece holds beside others); each part is merged on its own:
a heap gives the adjacent pair of the lowest rank, a doubly linked list joins
it. Tokens = initial symbols - merges; no identifier is ever made. Counts of
parts are remembered per Python worker in a table of bounded size.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

MARK = "▁"  # sentencepiece's sign for a space
MEMO_PARTS = 400_000


class PieceModel:
    """Ranks of a sentencepiece BPE model, read from its file."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ranks: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ranks[sp.id_to_piece(i)] = -sp.get_score(i)
        letters = {c for piece in self.ranks for c in piece}
        if not letters <= self.ranks.keys():
            raise ValueError("every character of a piece must be a piece itself")
        if any(MARK in piece.lstrip(MARK) for piece in self.ranks):
            raise ValueError("a piece holds a word mark after another character")
        # A character that no longer piece holds never takes part in a merge.
        joined = "".join(sorted({c for piece in self.ranks if len(piece) > 1 for c in piece}))
        self.parts = re.compile(f"[{re.escape(joined)}]+|[^{re.escape(joined)}]")
        self.memo: dict[str, int] = {}
        self.words = Words(self)

    def merged(self, part: str) -> int:
        """Tokens of one part: symbols less merges. Characters outside the vocabulary count their UTF-8 bytes."""
        ranks, n = self.ranks, len(part)
        count = sum(1 if c in ranks else len(c.encode()) for c in part)
        if n < 2:
            return count
        ends = list(range(1, n + 1))  # ends[i]: where the symbol that starts at i ends; the next symbol starts there
        before = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(part[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        alive = bytearray(b"\x01") * n
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = ends[i]
            if not alive[i] or middle >= n or ends[middle] != end or middle == end:
                continue
            alive[middle] = 0
            ends[i] = end
            count -= 1
            if end < n:
                before[end] = i
                rank = ranks.get(part[i : ends[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ends[end]))
            left = before[i]
            if left >= 0:
                rank = ranks.get(part[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end))
        return count

    def chunk(self, chunk: str) -> int:
        """Tokens of a chunk: word marks, if any, and what follows up to the next ones."""
        total = 0
        for part in self.parts.findall(chunk):
            found = self.memo.get(part)
            if found is None:
                if len(self.memo) >= MEMO_PARTS:
                    self.memo.clear()
                found = self.merged(part)
                if len(part) <= 64:
                    self.memo[part] = found
            total += found
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")  # the mark itself and a space are one symbol
        if "" not in words:
            return sum(map(self.words.__getitem__, words))
        # Runs of spaces belong to the word after them; at the end they stand alone.
        total, run = 0, 1
        for word in words[:-1]:
            if word:
                total += self.words[word] if run == 1 else self.chunk(MARK * run + word)
                run = 1
            else:
                run += 1
        last = words[-1]
        return total + (self.words[last] if run == 1 and last else self.chunk(MARK * run + last))


class Words(dict):
    """Counts of words after one space, filled on demand and emptied when full."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> int:
        found = self.model.chunk(MARK + word)
        if len(self) >= MEMO_PARTS:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """The model of a file, built once in each Python worker."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def token_count(text: Column, path: str) -> Column:
    """The number of tokens (long) of a text column. A null or empty text has 0; ``path`` must exist on every executor."""

    @F.pandas_udf(T.LongType())
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model(path)
        for texts in batches:
            yield pd.Series([m.count(t) if t else 0 for t in texts], dtype="int64")

    return counts(text)


def count_tokens(df: DataFrame, path: str, text_col: str = "text", out_col: str = "n_tokens") -> DataFrame:
    """``df`` with its token counts as ``out_col``; a column of that name is replaced.

    Null and empty texts count 0, repeated rows are counted each, an empty
    table stays empty, texts of any length are counted whole, and other
    columns pass through unseen.
    """
    return df.withColumn(out_col, token_count(common.col(text_col), path))
