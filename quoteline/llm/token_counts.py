"""Token counts of a SentencePiece BPE model by heap and linked list, without emitting ids.

A chunk starts as its characters in a doubly linked list.  A heap holds the adjacent pairs whose join is a
piece, lowest rank (best score) first, leftmost first among equals; popping a pair that still stands
joins it and pushes the two new neighbours.  The count is the symbols at the start minus the merges;
a character that is no piece counts one for each of its UTF-8 bytes (byte fallback).

Chunks are parts of a text that no piece crosses, so they are counted apart, and the count of a chunk
is kept in a table per worker, bounded in entries and bytes.  One pass, no shuffle.

Edge cases: null and empty texts have no bytes and no tokens; special strings inside a text are plain
text, as the library treats them; a text without any space is one long chunk (n log n), which is not
kept after its batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, released, resident, slices, tokenizer_path
from .piece_bpe import PieceModel

COUNT_SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def merge_count(chunk: str, rank: dict[str, float]) -> int:
    """Symbols of ``chunk`` after every possible merge, a character outside ``rank`` counting one for
    each byte."""
    n = len(chunk)
    if n == 1:
        return 1 if chunk in rank else len(chunk.encode())
    get = rank.get
    heap = [(r, i, pair) for i in range(n - 1) if (r := get(pair := chunk[i : i + 2])) is not None]
    extra = 0 if chunk.isascii() and chunk.isprintable() else sum(len(c.encode()) - 1 for c in chunk if c not in rank)
    heapify(heap)
    symbol, after, before, left = list(chunk), list(range(1, n + 1)), list(range(-1, n - 1)), n
    while heap:
        _, i, pair = heappop(heap)
        j = after[i]
        if symbol[i] is None or j >= n or symbol[i] + symbol[j] != pair:
            continue  # one of the two has been merged since
        symbol[i], symbol[j], left = pair, None, left - 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            joined = pair + symbol[k]
            if (r := get(joined)) is not None:
                heappush(heap, (r, i, joined))
        if (h := before[i]) >= 0:
            joined = symbol[h] + pair
            if (r := get(joined)) is not None:
                heappush(heap, (r, h, joined))
    return left + extra


class PieceCounter:
    def __init__(self, path: str, memo_size: int = 250_000):
        self.model, self.memo = PieceModel(path), Memo(memo_size)

    def counts(self, texts: list[str]) -> list[int]:
        chunks = [self.model.chunks(t) for t in texts]
        rank = self.model.rank
        self.memo.put((chunk, merge_count(chunk, rank)) for chunk in self.memo.missing(chunks))
        get = self.memo.young.__getitem__
        out = [sum(map(get, own)) for own in chunks]
        self.memo.trim()
        return out


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens above ``limit``)."""
    path = tokenizer or tokenizer_path("piece_bpe_32k.model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = resident(("counter", path), lambda: PieceCounter(path))
        for batch in released(batches):
            texts, sizes = batch.column(1).to_pylist(), batch.column(2)
            counts: list[int] = []
            for a, b in slices(texts, 1_000_000):
                counts += counter.counts([t or "" for t in texts[a:b]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(counts, pa.int64()), pa.array([c > limit for c in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"))
    return source.mapInArrow(count, COUNT_SCHEMA)
