"""Benchmark decontamination with one Aho-Corasick automaton.

Test items (questions and answers) are normalised to words, cut into windows of ``window`` consecutive
words, and all windows become the patterns of one automaton.  Each document is normalised the same way
and scanned once; matches are counted in words and mapped back to places in the original text.

The automaton is built by every worker from a broadcast list of windows.  The list's size is checked: items
are read in blocks of at most ``block_bytes`` of text, and beyond one block the documents are scanned once
for each block and the hits of the blocks are united, so memory never grows with the benchmark.

Edge cases: a text or item without words (null, empty, punctuation) has no hits; an item of fewer words
than the window is one window; equal items and repeated item ids count once per id; repeated document rows
each give a row.  Items with a null id are left out unless ``null_items`` is set, as the query and the pipeline do:
then their windows are hits as all others, together they count as one item (a null in ``items``), and they add nothing to
the digest of the ids.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, resident, stored

# Fixed by the definition of a word: digits, letters a to z and every byte above 7F; A-Z are lowered.
_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

HIT_SCHEMA = ("doc_id long, n_words long, n_hit long, items array<string>, "
              "spans array<struct<start:int,end:int>>")


def normalised_words(text: str | None) -> list[bytes]:
    """Words of a text: UTF-8 bytes, only A-Z lowered."""
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


def item_windows(items: list[tuple], window: int) -> dict[str, tuple[int, set]]:
    """Pattern -> (its words, the items that hold it).  Patterns are words between single spaces, one
    character per byte."""
    found: dict[str, tuple[int, set]] = {}
    for item, text in items:
        words = normalised_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            part = words[i : i + window]
            pattern = (b" " + b" ".join(part) + b" ").decode("latin-1")
            found.setdefault(pattern, (len(part), set()))[1].add(item)
    return found


def _automaton(patterns: list[tuple[str, int, tuple]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, n, items in patterns:
        found.add_word(pattern, (n, items))
    found.make_automaton()
    return found


def scan(text: str | None, automaton) -> tuple[int, int, list, list[tuple[int, int]]]:
    """Words, words hit, items found and the hit passages as character spans of the original text."""
    words = normalised_words(text)
    if not words or automaton is None:
        return len(words), 0, [], []
    hay = b" " + b" ".join(words) + b" "
    matches = list(automaton.iter(hay.decode("latin-1")))
    if not matches:
        return len(words), 0, [], []
    spaces = np.cumsum(np.frombuffer(hay, dtype=np.uint8) == 32)
    step, items = np.zeros(len(words) + 1, dtype=np.int64), set()
    for end, (n, own) in matches:
        last = int(spaces[end]) - 1  # one past the last word
        step[last - n] += 1
        step[last] -= 1
        items.update(own)
    hit = np.cumsum(step[:-1]) > 0
    raw = text.encode("utf-8", "replace")
    places = [m.span() for m in _WORD.finditer(raw)]
    edges = np.flatnonzero(np.diff(hit.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    spans = [(len(raw[: places[a][0]].decode()), len(raw[: places[b - 1][1]].decode()))
             for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True)]
    return len(words), int(hit.sum()), list(items), spans


def _shared_patterns(docs: DataFrame, items: list[tuple], window: int):
    patterns = [(p, n, tuple(None if i is None else str(i) for i in own)) for p, (n, own) in item_windows(items, window).items()]
    return docs.sparkSession.sparkContext.broadcast(patterns)


def _built(shared):
    """The automaton of broadcast patterns, built once in a worker."""
    own = shared.value
    # the patterns are kept beside the automaton, so their identity stays theirs
    return resident(("automaton", id(own)), lambda: (own, _automaton(own) if own else None))[1]


def _scan_block(docs: DataFrame, items: list[tuple], window: int) -> DataFrame:
    shared = _shared_patterns(docs, items, window)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(shared)
        for batch in released(batches):
            rows = [scan(t, automaton) for t in batch.column(1).to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in r[3]] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([sorted(r[2], key=lambda i: (i is None, i)) for r in rows], pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "n_words", "n_hit", "items", "spans"])

    return docs.mapInArrow(hits, HIT_SCHEMA)


def _spans_united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits of several blocks of one row: spans merged, words counted in the text again."""
    for batch in released(batches):
        rows = []
        for text, groups in zip(batch.column("text").to_pylist(), batch.column("groups").to_pylist(), strict=True):
            marks = sorted((s["start"], s["end"]) for g in groups or [] for s in g)
            merged: list[list[int]] = []
            for a, b in marks:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            rows.append((sum(len(normalised_words(text[a:b])) for a, b in merged), merged))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array([r[0] for r in rows], pa.int64()),
             batch.column("items"),
             pa.array([[{"start": a, "end": b} for a, b in r[1]] for r in rows],
                      pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
            ["doc_id", "n_words", "n_hit", "items", "spans"])


def _item_blocks(benchmark: DataFrame, block_bytes: int, item_col: str, text_col: str,
                 null_items: bool) -> Iterator[list[tuple]]:
    """The items, at least once and in blocks of about ``block_bytes`` of text."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(text_col).alias("text")) \
        .where("text IS NOT NULL" if null_items else "text IS NOT NULL AND item_id IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield [tuple(r) for r in own.collect()]


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8_000_000,
                         text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                         null_items: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window occurs.  Blocks of items filter one after the other."""
    at, out = docs.columns.index(text_col), docs

    def clean(rows: DataFrame, items: list[tuple]) -> DataFrame:
        shared = _shared_patterns(rows, items, window)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _built(shared)
            for batch in released(batches):
                yield batch.filter(pa.array([not scan(t, automaton)[1] for t in batch.column(at).to_pylist()], pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    for n, items in enumerate(_item_blocks(benchmark, block_bytes, item_col, item_text_col, null_items)):
        out = clean(stored(out, "decontamination-block") if n else out, items)  # a worker holds one automaton
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8_000_000,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", null_items: bool = False) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit (words inside an occurrence of a window), ``items`` (ids as
    strings, sorted, of the items found) and ``spans`` (the hit passages as character offsets of the text)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = _item_blocks(benchmark, block_bytes, item_col, item_text_col, null_items)
    items = next(blocks)
    more = next(blocks, None)
    if more is None:  # the benchmark fits the bound
        return _scan_block(source, items, window)
    # every row gets a key, so that equal rows stay apart when the blocks' hits come together
    keyed = stored(source.withColumn("row", F.monotonically_increasing_id()), "decontamination-rows")
    found = None
    for own in itertools.chain((items, more), blocks):
        one = stored(_scan_block(keyed.select(F.col("row").alias("doc_id"), "text"), own, window).where("n_hit > 0"),
                     "decontamination-hits")
        found = one if found is None else found.unionByName(one)
    # at most one row for each block and document row comes together
    groups = found.groupBy(F.col("doc_id").alias("row")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.collect_list("spans").alias("groups"))
    counted = _scan_block(keyed.select(F.col("row").alias("doc_id"), "text"), [], window) \
        .select(F.col("doc_id").alias("row"), "n_words")
    whole = keyed.join(counted, "row").join(groups, "row", "left").select(
        "doc_id", "n_words", "text", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "groups")
    return whole.mapInArrow(_spans_united, HIT_SCHEMA)


def digests(hits: DataFrame) -> DataFrame:
    """The contract's columns of :func:`find_contamination`."""
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """The definition, for tests: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    cut = [(str(i), normalised_words(t)) for i, t in items]
    out = []
    for doc, text in docs:
        words, hit, found = normalised_words(text), set(), set()
        for item, own in cut:
            n = min(window, len(own))
            for j in range(len(own) - n + 1 if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == own[j : j + n]:
                        hit.update(range(i, i + n))
                        found.add(item)
        out.append((doc, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return out
