"""Substring deduplication by recompression.

Every word sequence of ``window`` words that also starts earlier in the corpus (smaller document id, or the
same document and an earlier word) is found, and the words it covers are removed.

*Naming.*  A text's words are symbols.  First every run of one word gets one name; then, round by round,
adjacent pairs (a, b) with ``a`` on the left and ``b`` on the right side of the alphabet are replaced by one
name.  Names are 64-bit hashes of what they replace and sides are bits of hashes of the symbols, so naming is
global without any exchange: wherever a word sequence occurs, its interior gets the same symbols, apart
from those that depend on words outside of it.  Each symbol carries the range of words it depends on.

*Filter.*  A window that occurs twice shares all symbols that depend on its words only.  Symbols are
counted over the corpus; a window that holds a symbol of its own which occurs once occurs once itself.

*Verification.*  The windows left are compared by 128-bit hashes of their word sequences, and the first
place of each in (document, word) order is kept.

*Distribution.*  Documents are dealt once into chunks of bounded bytes (by a hash of the id; a chunk is a
group of documents, not a copy class, so it cannot grow hot) and that exchange is used by the three
passes.  Symbols and windows leave a chunk once per chunk, so one that fills a third of the corpus makes at
most one row for each chunk, and nothing is ever expanded to pairs.  Lineage is whole: a lost
executor only repeats its tasks.

Edge cases: a null text has no words; texts of fewer words than the window keep everything; rows with one
document id are taken in the order of their texts' bytes, one after the other; a null id comes first.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, release
from .words import Words, sequence_hashes, signed, split_words

RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_NULL_ID = np.iinfo(np.int64).min
_FAR = 1 << 40


# --- the parse ---------------------------------------------------------------------------------


def parse(hashes: np.ndarray, doc: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after ``rounds`` rounds of pair naming: their names and the first and last word that they depend
    on.  ``doc`` numbers the text of each word; no symbol crosses texts."""
    n = len(hashes)
    if not n:
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    # runs of one word; where a run ends depends on the words next to it, and at the border of a text on the
    # border, which no other place of the same words need have: such symbols depend on everything
    new = np.ones(n, dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    length = (last - first + 1).astype(np.uint64)
    d = doc[first]
    symbol = mix(hashes[first] + length * np.uint64(0x9E3779B97F4A7C15))
    lo, hi = first.copy(), last.copy()
    inner = np.concatenate(([False], d[1:] == d[:-1], [False]))
    lo = np.where(inner[:-1], lo - 1, -_FAR)
    hi = np.where(inner[1:], hi + 1, _FAR)
    for k in range(rounds):
        left = (mix(symbol + np.uint64(2 * k + 1)) & np.uint64(1)).view(np.int64).astype(bool)
        together = np.zeros(len(symbol) + 1, dtype=bool)  # [i]: i - 1 and i are neighbours in one text
        together[1:-1] = d[1:] == d[:-1]
        pair = np.zeros(len(symbol), dtype=bool)
        pair[:-1] = left[:-1] & ~left[1:] & together[1:-1]
        second = np.zeros(len(symbol), dtype=bool)
        second[1:] = pair[:-1]
        # a symbol stays alone because of the neighbour it could have joined
        low, high = lo.copy(), hi.copy()
        alone = np.flatnonzero(~pair & ~second)
        a = alone[left[alone] & together[alone + 1]]
        low[a], high[a] = np.minimum(lo[a], lo[a + 1]), np.maximum(hi[a], hi[a + 1])
        a = alone[~left[alone] & together[alone]]
        low[a], high[a] = np.minimum(lo[a], lo[a - 1]), np.maximum(hi[a], hi[a - 1])
        p = np.flatnonzero(pair)
        symbol = symbol.copy()
        symbol[p] = mix(symbol[p] * np.uint64(0xD6E8FEB86659FD93) + symbol[p + 1] * np.uint64(0xA0761D6478BD642F)
                        + np.uint64(k))
        low[p], high[p] = np.minimum(lo[p], lo[p + 1]), np.maximum(hi[p], hi[p + 1])
        keep = ~second
        symbol, lo, hi, d = symbol[keep], low[keep], high[keep], d[keep]
    return symbol, lo, hi


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in a range starts[i]:ends[i]."""
    step = np.bincount(starts, minlength=size + 1)[: size + 1] - np.bincount(ends, minlength=size + 1)[: size + 1]
    return np.cumsum(step[:-1]) > 0


# --- a chunk of documents -----------------------------------------------------------------------


class _Chunk:
    """The documents of a chunk in (id, bytes of text) order, their words and windows."""

    def __init__(self, table: pa.Table, window: int):
        release()  # of the chunk before
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text").to_pylist()
        raw = [b"" if t is None else t.encode("utf-8", "replace") for t in texts]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, raw[i]))
        self.ids = [ids[i] for i in order]
        self.words: Words = split_words([texts[i] for i in order])
        self.window = window
        counts = self.words.counts
        keys = np.array([_NULL_ID if i is None else i for i in self.ids], dtype=np.int64)
        # words are numbered through all rows of one id
        first = self.words.first[:-1]
        same = np.zeros(len(keys), dtype=bool)
        same[1:] = keys[1:] == keys[:-1]
        base = np.where(same, 0, first)
        base = np.maximum.accumulate(base) if len(base) else base
        doc = self.words.docs()
        self.doc = doc
        self.key = keys[doc]
        self.place = np.arange(len(doc)) - base[doc]
        room = np.maximum(counts - window + 1, 0)  # windows start at the first words of each text
        self.starts = np.flatnonzero(np.arange(len(doc)) - first[doc] < room[doc])

    def symbols(self, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols that some window holds whole, with their ranges of words."""
        name, lo, hi = parse(self.words.hashes, self.doc, rounds)
        fits = hi - lo < self.window
        return name[fits], lo[fits], hi[fits]

    def hashes(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(sequence_hashes(self.words.hashes, starts, starts + self.window, k) for k in (0, 1))


def _first_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row the first row with the same (a, b)."""
    if not len(a):
        return np.zeros(0, np.int64)
    order = np.lexsort((b, a))  # stable: equal rows stay in order
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    out = np.empty(len(a), dtype=np.int64)
    out[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))]
    return out


def remove_repeats(docs: DataFrame, window: int = 20, rounds: int = 4, chunk_bytes: int = 8_000_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    Words are the runs of bytes other than 09-0D and 20.  Windows are judged on the input, not on what is left.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    n_chunks = max(1, math.ceil(size / chunk_bytes))
    # names are cut to so many bits that a name is taken by chance once in some hundred symbols at most
    mask = np.uint64((1 << min(63, math.ceil(math.log2(size + 2)) + 7)) - 1)
    chunks = source.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).cast("int"))

    def emit_symbols(table: pa.Table) -> pa.Table:
        name, _, _ = _Chunk(table, window).symbols(rounds)
        name = np.unique(name & mask)
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"symbol": pa.array(signed(name)), "chunk": pa.array(np.full(len(name), chunk, np.int32))})

    symbols = chunks.groupBy("chunk").applyInArrow(emit_symbols, "symbol long, chunk int")
    # a row for each symbol and chunk: those of other chunks too go back to their chunks
    shared = symbols.withColumn("n", F.count("*").over(Window.partitionBy("symbol"))).where("n > 1") \
        .select("chunk", "symbol")

    def emit_windows(table: pa.Table, again: pa.Table) -> pa.Table:
        names = ["h1", "h2", "doc_id", "place", "chunk"]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())], names)
        own = _Chunk(table, window)
        name, lo, hi = own.symbols(rounds)
        name = name & mask
        kinds, where, n = np.unique(name, return_inverse=True, return_counts=True)
        elsewhere = np.isin(kinds, again.column("symbol").to_numpy().view(np.uint64), assume_unique=True)
        once = ~(elsewhere | (n > 1))[where]
        total = len(own.doc)
        unique = _covered(total, np.maximum(hi[once] - window + 1, 0), lo[once] + 1)
        starts = own.starts[~unique[own.starts]]
        a, b = own.hashes(starts)
        first = _first_of(a, b) == np.arange(len(a))  # later ones in the chunk need no other chunk's word
        starts, a, b = starts[first], a[first], b[first]
        chunk = table.column("chunk")[0].as_py()
        return pa.table([pa.array(signed(a)), pa.array(signed(b)), pa.array(own.key[starts]),
                         pa.array(own.place[starts]), pa.array(np.full(len(starts), chunk, np.int32))], names)

    windows = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        emit_windows, "h1 long, h2 long, doc_id long, place long, chunk int")
    in_order = Window.partitionBy("h1", "h2").orderBy("doc_id", "place")
    later = windows.withColumn("rank", F.row_number().over(in_order)).where("rank > 1").select("chunk", "doc_id", "place")

    def result(table: pa.Table, later: pa.Table) -> pa.Table:
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if not table.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())], names)
        own = _Chunk(table, window)
        total = len(own.doc)
        # windows that repeat one of this chunk ...
        a, b = own.hashes(own.starts)
        gone = _first_of(a, b) != np.arange(len(a))
        # ... and first ones of this chunk that another chunk has earlier
        if later.num_rows:
            marked = np.zeros(total, dtype=bool)
            ids, places = later.column("doc_id").to_numpy(), later.column("place").to_numpy()
            begin = np.flatnonzero(np.concatenate(([True], own.key[1:] != own.key[:-1])))
            at = begin[np.searchsorted(own.key[begin], ids)] + places
            marked[at] = True
            # a copy inside the chunk of a window that is not first anywhere is gone already
            gone |= marked[own.starts]
        starts = own.starts[gone]
        removed = _covered(total, starts, starts + window)
        counts = own.words.counts
        cuts = np.concatenate(([0], np.cumsum(removed)))[own.words.first]
        n_removed = np.diff(cuts)
        digests = []
        for i in range(len(own.ids)):
            words = own.words.text(i).split()
            if n_removed[i]:
                gap = removed[own.words.first[i] : own.words.first[i + 1]]
                words = [w for w, r in zip(words, gap.tolist(), strict=True) if not r]
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return pa.table([pa.array(own.ids, pa.int64()), pa.array(counts.astype(np.int64)),
                         pa.array(n_removed.astype(np.int64)), pa.array(digests, pa.string())], names)

    return chunks.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(result, RESULT_SCHEMA)


def brute_force(rows: list[tuple], window: int = 20) -> list[tuple]:
    """The definition, for tests: (doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    seen, out = set(), []
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((doc, len(words), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out
