"""Line deduplication within an edit bound, by a deletion-neighbourhood join.

A line is the sequence of its words (runs of bytes other than white space).  Two lines of at least
``min_words`` words match when at most one word is inserted, deleted or replaced between them (word edit
distance 1); shorter lines match when their words are equal.  A line is removed if an earlier line of the corpus
(smaller document id, or the same document and an earlier line) matches it; lines are judged on the input, not on
what is left.  Lines without words are never removed.

*Exact copies* are found by 128-bit hashes of the lines' words.

*Deletion neighbourhood.*  A line's variants are the line with one word left out, as 128-bit keys with the place
of the missing word.  Lines with one variant at one place differ in that word only; a line that equals a
variant of another is one word shorter.  So a match is an equality of keys, and as only the earliest line of
a key matters, keys are reduced to minima and no pairs are emitted, however many lines share a variant.  What
a line matched is then verified by the edit distance of the two texts.

*Which lines emit variants.*  Of two lines at distance 1 either the first or the last ``(n - 1) // 2`` words are
equal, ``n`` being the longer length (pigeonhole).  Lines emit the keys of these halves first, and only lines that
share one with another line emit their variants.

*Distribution.*  Documents are dealt once into chunks of bounded bytes by a hash of the id, and the passes use
that one exchange.  A chunk sends each line, half and variant once, with its earliest place there, so a line or
template that fills a third of the corpus makes at most one row for each chunk.

Edge cases: null and empty texts have no lines; a line break is ``\\n`` (a ``\\r`` before it is white space); rows
with one id are taken in the order of their texts' bytes, one after the other; a null id comes first; columns
besides id and text are carried along, whatever their names (a new column whose name is taken gets a ``_`` behind).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_residents
from .words import sequence_hashes, signed, split_words

_NULL_ID = np.iinfo(np.int64).min
_WHOLE = -1


def edit_distance_at_most_one(a: list, b: list) -> bool:
    """Whether at most one insertion, deletion or replacement turns ``a`` into ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    i, short = 0, min(len(a), len(b))
    while i < short and a[i] == b[i]:
        i += 1
    j = 0
    while j < short - i and a[-1 - j] == b[-1 - j]:
        j += 1
    return max(len(a), len(b)) - i - j <= 1


class _Lines:
    """The documents of a chunk in (id, bytes of text) order and their lines with words."""

    def __init__(self, ids: list, texts: list, min_words: int):
        raw = [b"" if t is None else t.encode("utf-8", "replace") for t in texts]
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, raw[i]))
        self.ids = np.array([_NULL_ID if ids[i] is None else ids[i] for i in self.order], dtype=np.int64)
        self.min_words = min_words
        self.words = words = split_words([texts[i] for i in self.order])
        breaks = np.flatnonzero(words.data == 0x0A)  # each text ends with one of its own
        begin = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else np.zeros(0, np.int64)
        first, last = np.searchsorted(words.starts, begin), np.searchsorted(words.starts, breaks)
        doc = np.searchsorted(words.doc_starts, begin, side="right") - 1
        some = last > first
        self.begin, self.end = begin[some], breaks[some]
        self.first, self.last, self.doc = first[some], last[some], doc[some]
        self.size = self.last - self.first
        # lines are numbered through all rows of one id
        self.key = self.ids[self.doc]
        at = np.arange(len(self.key))
        new = np.ones(len(at), dtype=bool)
        new[1:] = self.key[1:] != self.key[:-1]
        self.heads = at[new]
        self.place = at - self.heads[np.cumsum(new) - 1] if len(at) else at
        self.h1, self.h2 = (sequence_hashes(words.hashes, self.first, self.last, k) for k in (0, 1))
        self.is_first = _first_rows(self.h1, self.h2)  # of equal lines in the chunk

    def at(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers of the lines (id, place)."""
        return self.heads[np.searchsorted(self.key[self.heads], keys)] + places

    def text(self, i: int) -> bytes:
        return self.words.data[self.begin[i] : self.end[i]].tobytes()

    def halves(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, key) of the halves of the first of equal lines that may have edits: the first and the last
        ``(n - 1) // 2`` words, and ``n // 2`` for a partner that is one word longer."""
        lines = np.flatnonzero(self.is_first & (self.size >= max(2, self.min_words)))
        a, b, n = self.first[lines], self.last[lines], self.size[lines]
        out_lines, out_keys = [], []
        for size, some in (((n - 1) // 2, np.ones(len(n), bool)), (n // 2, n % 2 == 0)):
            s, e, k = a[some], b[some], size[some]
            salt = k.astype(np.uint64) * np.uint64(2)
            out_keys += [sequence_hashes(self.words.hashes, s, s + k) + salt,
                         sequence_hashes(self.words.hashes, e - k, e) + salt + np.uint64(1)]
            out_lines += [lines[some], lines[some]]
        return np.concatenate(out_lines), np.concatenate(out_keys)

    def variants(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(line, place of the missing word, two key halves); each line itself has the place -1."""
        size = self.size[lines]
        owner = np.repeat(lines, size)
        i = self.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        k1, k2 = (sequence_hashes(self.words.hashes, self.first[owner], self.last[owner], k, i) for k in (0, 1))
        return (np.concatenate((lines, owner)), np.concatenate((np.full(len(lines), _WHOLE), i - self.first[owner])),
                np.concatenate((self.h1[lines], k1)), np.concatenate((self.h2[lines], k2)))


def _first_rows(*columns: np.ndarray) -> np.ndarray:
    """Whether a row is the first with its values."""
    out = np.zeros(len(columns[0]), dtype=bool)
    if len(out):
        order = np.lexsort(columns[::-1])
        new = np.ones(len(out), dtype=bool)
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
        out[order[new]] = True
    return out


_KEYS = "k1 long, k2 long, place int, row_id long, line long, chunk int, gone boolean"
_NEAR = "chunk int, row_id long, line long, other string, gone boolean"


def _table(schema: str, columns: list) -> pa.Table:
    types = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def remove_repeated_lines(docs: DataFrame, min_words: int = 10, chunk_bytes: int = 4_000_000, id_col: str = "doc_id",
                          text_col: str = "text", digest: bool = False) -> DataFrame:
    """The rows of ``docs`` with the repeated lines taken out of the text, and two columns more: ``n_lines``
    (lines with words) and ``n_removed``.  With ``digest`` instead doc_id, n_lines, n_removed and kept_sha256
    (of the text that is left)."""
    names = docs.columns
    id_at, text_at = names.index(id_col), names.index(text_col)
    # private names, so that no column clashes
    source = docs.select(F.col(id_col), F.col(text_col)).toDF("c0", "c1") if digest \
        else docs.toDF(*(f"c{i}" for i in range(len(names))))
    c_id, c_text = ("c0", "c1") if digest else (f"c{id_at}", f"c{text_at}")
    columns_in = source.columns
    size = source.agg(F.coalesce(F.sum(F.octet_length(c_text)), F.lit(0)).alias("n")).first()["n"]
    n_chunks = max(1, math.ceil(size / chunk_bytes))
    chunks = source.withColumn("chunk", F.pmod(F.xxhash64(F.col(c_id).cast("long")), F.lit(n_chunks)).cast("int"))

    def lines_of(table: pa.Table) -> _Lines:
        drop_residents()
        return _Lines(table.column(c_id).cast(pa.int64()).to_pylist(), table.column(c_text).to_pylist(), min_words)

    def chunk_of(table: pa.Table) -> int:
        return table.column("chunk")[0].as_py()

    def emit_lines(table: pa.Table) -> pa.Table:
        """A row for each distinct line (half false) and each distinct half, with the smallest and largest
        line hash behind it."""
        own, chunk = lines_of(table), chunk_of(table)
        one = np.flatnonzero(own.is_first)
        line, key = own.halves()
        order = np.lexsort((own.h1[line], key))
        line, key = line[order], key[order]
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        last = np.append(begin, len(key))[1:] - 1
        n = len(one) + len(begin)
        return _table(
            "k1 long, k2 long, row_id long, line long, top long, half boolean, chunk int",
            [np.concatenate((signed(own.h1[one]), signed(key[begin]))),
             np.concatenate((signed(own.h2[one]), np.zeros(len(begin), np.int64))),
             np.concatenate((own.key[one], signed(own.h1[line[begin]]))),
             np.concatenate((own.place[one], np.zeros(len(begin), np.int64))),
             np.concatenate((np.zeros(len(one), np.int64), signed(own.h1[line[last]]))),
             np.arange(n) >= len(one), np.full(n, chunk)])

    emitted = chunks.groupBy("chunk").applyInArrow(
        emit_lines, "k1 long, k2 long, row_id long, line long, top long, half boolean, chunk int")
    # one exchange for both: of lines the rank by place, of halves whether different lines share them (the
    # hash order is unsigned in a chunk, so smallest and largest only tell equal from different)
    by_key = Window.partitionBy("half", "k1", "k2")
    ranked = emitted.withColumns({
        "rank": F.row_number().over(by_key.orderBy("row_id", "line")),
        "low": F.min(F.least("row_id", "top")).over(by_key), "high": F.max(F.greatest("row_id", "top")).over(by_key)})
    back = ranked.where("(NOT half AND rank > 1) OR (half AND low < high)").select("chunk", "half", "k1", "row_id", "line")

    def emit_variants(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table(_KEYS, [[]] * 7)
        own, chunk = lines_of(table), chunk_of(table)
        half = back.column("half").to_numpy(zero_copy_only=False).astype(bool)
        b_k1, b_row, b_line = (back.column(c).to_numpy() for c in ("k1", "row_id", "line"))
        line, key = own.halves()
        chosen = np.unique(line[np.isin(signed(key), b_k1[half])])
        owner, place, k1, k2 = own.variants(chosen)
        order = np.lexsort((owner, k2, k1, place))  # owners are numbered in document order
        owner, place, k1, k2 = owner[order], place[order], k1[order], k2[order]
        first = np.ones(len(owner), dtype=bool)
        first[1:] = (place[1:] != place[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        # later lines of a variant match the first one in the chunk: verified here, where both texts are
        leader = owner[np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))] if len(owner) else owner
        gone = set()
        for i in np.flatnonzero(~first).tolist():
            a, b = int(owner[i]), int(leader[i])
            if a not in gone and edit_distance_at_most_one(own.text(a).split(), own.text(b).split()):
                gone.add(a)
        near = np.array(sorted(gone), dtype=np.int64)
        exact_keys, exact_lines = b_row[~half], b_line[~half]
        lead = np.flatnonzero(first)
        n = len(near) + len(exact_keys)
        zeros = np.zeros(n, np.int64)
        return _table(_KEYS, [
            np.concatenate((signed(k1[lead]), signed(own.h1[near]), zeros[: len(exact_keys)] + exact_lines)),
            np.concatenate((signed(k2[lead]), signed(own.h2[near]), exact_keys)),
            np.concatenate((place[lead], zeros - 2)),
            np.concatenate((own.key[owner[lead]], own.key[near], exact_keys)),
            np.concatenate((own.place[owner[lead]], own.place[near], exact_lines)),
            np.full(len(lead) + n, chunk), np.arange(len(lead) + n) >= len(lead)])

    variants = chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(emit_variants, _KEYS)
    spot = F.struct("row_id", "line", "chunk")
    same_words, same_place = Window.partitionBy("k1", "k2"), Window.partitionBy("k1", "k2", "place")
    matched = variants.withColumns({
        "whole": F.min(F.when(F.col("place") == _WHOLE, spot)).over(same_words),
        "variant": F.min(F.when(F.col("place") >= 0, spot)).over(same_words),
        "beside": F.min(spot).over(same_place)})
    other = F.when(F.col("place") == _WHOLE, F.col("variant")).otherwise(F.least("beside", "whole"))
    found = matched.withColumn("m", F.when(~F.col("gone"), other)).where("gone OR m < struct(row_id, line, chunk)") \
        .select(F.coalesce("m.chunk", "chunk").alias("at"), "chunk", "row_id", "line", "gone",
                F.col("m.row_id").alias("m_row"), F.col("m.line").alias("m_line")).distinct()

    def fetch(table: pa.Table, asked: pa.Table) -> pa.Table:
        """The text of the earlier line, for the check in the chunk of the later one."""
        columns = [asked.column(c) for c in ("chunk", "row_id", "line")]
        gone = asked.column("gone").to_pylist()
        texts: list = [None] * len(gone)
        want = [i for i, g in enumerate(gone) if not g]
        if want and table.num_rows:
            ids = table.column(c_id).cast(pa.int64())
            rows, at = asked.column("m_row").to_numpy(zero_copy_only=False)[want], asked.column("m_line").to_numpy(zero_copy_only=False)[want]
            rows = rows.astype(np.int64)
            need = set(rows.tolist())
            keep = [i for i, d in enumerate(ids.to_pylist()) if (_NULL_ID if d is None else d) in need]
            own = lines_of(table.take(keep))
            for i, line in zip(want, own.at(rows, at.astype(np.int64)).tolist(), strict=True):
                texts[i] = own.text(line).decode()
        return _table(_NEAR, [*(c.combine_chunks() for c in columns), texts, gone])

    near = chunks.groupBy("chunk").cogroup(found.groupBy("at")).applyInArrow(fetch, _NEAR)

    out_schema = "doc_id long, n_lines long, n_removed long, kept_sha256 string" if digest else ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields) + ", n_lines long, n_removed long"

    def result(table: pa.Table, near: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table.select(columns_in).append_column("n_lines", pa.array([], pa.int64())) \
                .append_column("n_removed", pa.array([], pa.int64())) if not digest else _table(out_schema, [[]] * 4)
        own = lines_of(table)
        removed = ~own.is_first
        if near.num_rows:
            at = own.at(near.column("row_id").to_numpy(), near.column("line").to_numpy())
            for i, text, gone in zip(at.tolist(), near.column("other").to_pylist(), near.column("gone").to_pylist(), strict=True):
                if gone or edit_distance_at_most_one(own.text(i).split(), text.encode().split()):
                    removed[i] = True
        n_docs = len(own.ids)
        n_lines = np.bincount(own.doc, minlength=n_docs)
        n_removed = np.bincount(own.doc[removed], minlength=n_docs)
        texts = table.column(c_text).to_pylist()
        cut: dict[int, list[int]] = {}
        for i in np.flatnonzero(removed).tolist():
            cut.setdefault(int(own.doc[i]), []).append(i)
        out = list(texts)
        for d, lines in cut.items():
            raw, start = own.words.text(d), int(own.words.doc_starts[d])
            drop = {int(own.begin[i]) - start for i in lines}
            kept, place = [], 0
            for line in raw.split(b"\n"):
                if place not in drop:
                    kept.append(line)
                place += len(line) + 1
            out[own.order[d]] = b"\n".join(kept).decode()
        back_to_row = np.empty(n_docs, dtype=np.int64)
        back_to_row[own.order] = np.arange(n_docs)
        n_lines, n_removed = n_lines[back_to_row], n_removed[back_to_row]
        if digest:
            return _table(out_schema, [table.column(c_id).cast(pa.int64()).combine_chunks(), n_lines, n_removed,
                                       [hashlib.sha256((t or "").encode()).hexdigest() for t in out]])
        columns = [pa.chunked_array([pa.array(out, pa.string())]) if c == c_text else table.column(c) for c in columns_in]
        return pa.table([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                        [*columns_in, "n_lines", "n_removed"])

    done = chunks.groupBy("chunk").cogroup(near.groupBy("chunk")).applyInArrow(result, out_schema)
    if digest:
        return done
    return done.toDF(*names, *(next(c + "_" * k for k in range(99) if c + "_" * k not in names) for c in ("n_lines", "n_removed")))


def brute_force(rows: list[tuple], min_words: int = 10) -> list[tuple]:
    """The definition, for tests: (doc_id, n_lines, n_removed, kept_sha256) of (doc_id, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    seen: list[list] = []
    out = []
    for doc, text in rows:
        kept, n, gone = [], 0, 0
        for line in (text or "").encode().split(b"\n"):
            words = line.split()
            if words:
                n += 1
                if any(words == s or (min(len(words), len(s)) >= min_words and edit_distance_at_most_one(words, s))
                       for s in seen):
                    gone += 1
                else:
                    kept.append(line)
                seen.append(words)
            else:
                kept.append(line)
        out.append((doc, n, gone, hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return out
