"""How far each source's words diverge from those of the other sources of its language.

*Terms.*  ``bytes.translate`` lower-cases A-Z and blanks every other ASCII byte in one pass, ``bytes.split`` cuts the
terms (so letters outside ASCII belong to terms unchanged) and a ``Counter`` per document gives the occurrences;
its keys count the documents.  A task adds the counters of its documents by (lang, source), in a table
of bounded size, and Spark sums the rows of all tasks.

*Measures.*  A language keeps the ``V`` terms in at least ``min_docs`` of its documents.  A group (lang, source)
and the language as a whole give a kept term ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, ``N`` being the
occurrences of all kept terms there; two such numbers diverge by ``f = floor((p - q)^2 / (p + q))``.  ``pair`` rows hold the
sum of ``f`` over all kept terms for every two sources of a language, ``term`` rows the ``top`` terms that a group
uses more than its language does.  All arithmetic is exact (decimals for ``p``, integers for ``f``).

*Distribution.*  Counts stay sparse: one row for each (lang, source, term) that occurs.  Pairs of sources
are compared in blocks of about ``BLOCK`` sources by slices of about ``SLICE`` of the language's terms, so the rows of a task
are bounded by block and slice; terms that neither source has all add the same ``f``, so their number is enough.
A hot source is no larger than another one after the first sum.

Edge cases: null text, lang and source are ``''``; rows count as documents, so repeated rows (or ids) count again;
a group without terms has count 0 for every kept term; without kept terms (``V = 0``) pairs have value 0
and there are no term rows; a language of one source has no pairs; an empty table gives no rows.  Ties of value
go to the smaller item by UTF-8 bytes.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import released, stored

#: Terms that a task holds before it hands on what it has counted, and their bytes.
HELD_TERMS, HELD_BYTES = 200_000, 32_000_000
#: Sources of a block, and terms of a slice.
BLOCK, SLICE = 128, 8_192

_BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_COUNTS = "lang string, source string, term string, n long, d long"
_PARTIAL = "lang string, source string, item string, f long, t long, v long, f0 long"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text (UTF-8), in order."""
    return text.translate(_BLANKED).split()


class _Held:
    """Counts of one task by (lang, source): occurrences and documents of each term."""

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[dict, Counter]] = {}
        self.rows: Counter = Counter()
        self.size = self.bytes = 0

    def add(self, key: tuple[str, str], text: bytes) -> None:
        self.rows[key] += 1
        occurrences, documents = self.groups.setdefault(key, ({}, Counter()))
        own = Counter(terms_of(text))
        before = len(documents)
        for term, n in own.items():
            occurrences[term] = occurrences.get(term, 0) + n
        documents.update(own.keys())
        if new := len(documents) - before:
            self.size += new
            self.bytes += sum(map(len, own))  # never less than what the new ones take

    def full(self) -> bool:
        return self.size >= HELD_TERMS or self.bytes >= HELD_BYTES

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row for each term of each group, and one without a term that counts the group's documents."""
        for (lang, source), (occurrences, documents) in self.groups.items():
            terms = [None, *occurrences]
            size = len(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array([0, *occurrences.values()], pa.int64()),
                 pa.array([self.rows[lang, source], *map(documents.__getitem__, occurrences)], pa.int64())],
                ["lang", "source", "term", "n", "d"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in released(batches):
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            held.add((lang.as_py(), source.as_py()), text.as_py())
            if held.full():
                yield from held.batches()
                held = _Held()
    yield from held.batches()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and d (documents that hold it) of every term; the row without a
    term stands for the group itself, d being its documents."""
    def text_of(column: str, name: str):
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(name)

    source = docs.select(text_of(lang_col, "lang"), text_of(source_col, "source"), text_of(text_col, "text").cast("binary"))
    return (source.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


def _share(count: str, occurrences: str) -> str:
    """``p`` of a count among ``occurrences``, exact: a product of 10^9 and a bigint does not fit in one.  Null
    where nothing is kept."""
    return (f"CAST(1 + (CAST(1000000000 AS DECIMAL(10, 0)) * CAST({count} + 2 AS DECIMAL(20, 0)))"
            f" DIV CAST(nullif({occurrences} + 2 * v, 0) AS DECIMAL(20, 0)) AS BIGINT)")


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """The sums of ``f`` of one slice of terms for the sources of one block with those of another one."""
    sources, blocks = right.column("source").to_pylist(), right.column("block").to_numpy()
    absent = right.column("p0").to_numpy(zero_copy_only=False)
    lang, low, high, v = (right.column(c)[0].as_py() for c in ("lang", "low", "high", "v"))
    absent = absent.astype(np.int64) if v else np.zeros(len(sources), np.int64)
    terms = left.column("term").combine_chunks().dictionary_encode()
    if isinstance(terms, pa.ChunkedArray):
        terms = terms.combine_chunks()
    number = {s: i for i, s in enumerate(sources)}
    share = np.repeat(absent[:, None], len(terms.dictionary), axis=1)
    share[np.array([number[s] for s in left.column("source").to_pylist()], np.int64),
          terms.indices.to_numpy(zero_copy_only=False)] = left.column("p").to_numpy()

    def diverge(p, q):
        total = p + q
        return (p - q) ** 2 // np.where(total == 0, 1, total)

    first, second = np.flatnonzero(blocks == low), np.flatnonzero(blocks == high)
    one, other, f, f0 = [], [], [], []
    for i in first:
        against = second[second > i] if low == high else second
        for start in range(0, len(against), 32):
            some = against[start:start + 32]
            one += [sources[i]] * len(some)
            other += [sources[j] for j in some]
            f.append(diverge(share[some], share[i][None, :]).sum(1, dtype=np.int64))
            f0.append(diverge(absent[some], absent[i]))
    size = len(one)
    numbers = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (f, f0)]
    return pa.table({
        "lang": pa.array([lang] * size, pa.string()), "source": pa.array(one, pa.string()),
        "item": pa.array(other, pa.string()), "f": pa.array(numbers[0], pa.int64()),
        "t": pa.array(np.full(size, share.shape[1]), pa.int64()), "v": pa.array(np.full(size, v), pa.int64()),
        "f0": pa.array(numbers[1], pa.int64()),
    })


def _pairs(kept: DataFrame, groups: DataFrame, block: int, slice_terms: int) -> DataFrame:
    """``value`` of every two sources of a language, once in each direction."""
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("s"), F.max("v").alias("v"))
    sizes = sizes.selectExpr("lang", f"CAST(ceil(s / {block}) AS INT) AS blocks",
                             f"CAST(greatest(1, ceil(v / {slice_terms})) AS INT) AS slices")
    dealt = "CAST(pmod(xxhash64(source), blocks) AS INT)"
    met = ["lang", "least(block, other) AS low", "greatest(block, other) AS high", "slice", "source"]
    rows = (groups.join(sizes, "lang").selectExpr("*", f"{dealt} AS block", "explode(sequence(0, blocks - 1)) AS other")
            .selectExpr("*", "explode(sequence(0, slices - 1)) AS slice").selectExpr(*met, "block", "v", f"{_share('0', 'own')} AS p0"))
    shares = (kept.join(groups, ["lang", "source"]).join(sizes, "lang")
              .selectExpr("lang", "source", "term", f"{_share('n', 'own')} AS p", f"{dealt} AS block",
                          "CAST(pmod(xxhash64(term), slices) AS INT) AS slice", "explode(sequence(0, blocks - 1)) AS other")
              .selectExpr(*met, "term", "p"))
    key = ["lang", "low", "high", "slice"]
    partial = shares.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(_compare, _PARTIAL)
    sums = partial.groupBy("lang", "source", "item").agg(
        F.expr("CAST(sum(f) + (max(v) - sum(t)) * max(f0) AS BIGINT)").alias("value"))
    return sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", block: int = BLOCK, slice_terms: int = SLICE) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank; see the module's text."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    used = counts.where("term IS NOT NULL")
    terms = stored(used.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("d").alias("df"))
                   .where(F.col("df") >= min_docs).select("lang", "term", "all_n"), "divergence-terms")
    kept = stored(used.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "all_n"), "divergence-kept")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all_n").alias("whole"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = stored(
        counts.where("term IS NULL").select("lang", "source").join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .selectExpr("lang", "source", *(f"coalesce({c}, 0L) AS {c}" for c in ("own", "v", "whole"))), "divergence-groups")

    shares = kept.join(groups, ["lang", "source"]).selectExpr(
        "lang", "source", "term AS item", f"{_share('n', 'own')} AS p", f"{_share('all_n', 'whole')} AS q")
    over = shares.where("p > q").selectExpr("lang", "source", "item", "(p - q) * (p - q) DIV (p + q) AS value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return part(_pairs(kept, groups, block, slice_terms), "pair").unionByName(part(over, "term").where(F.col("rank") <= top))


def brute_force(rows, min_docs: int = 10, top: int = 10) -> set[tuple]:
    """The definition over (text, lang, source) rows, for tests."""
    import re

    cut = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    rows = [((x or ""), (lang or ""), (s or "")) for x, lang, s in rows]
    found = [(lang, s, cut.findall(x.translate(lower))) for x, lang, s in rows]
    out = set()
    for lang in {r[0] for r in found}:
        own = [r for r in found if r[0] == lang]
        df = Counter(t for _, _, words in own for t in set(words))
        kept = {t for t, n in df.items() if n >= min_docs}
        by = {s: Counter() for _, s, _ in own}
        for _, s, words in own:
            by[s].update(t for t in words if t in kept)
        whole = sum(by.values(), Counter())

        def p(c: Counter, t: str) -> int:
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(x: int, y: int) -> int:
            return (x - y) ** 2 // (x + y)

        for s, c in by.items():
            pairs = [(o, sum(f(p(c, t), p(by[o], t)) for t in kept)) for o in by if o != s]
            terms = [(t, f(p(c, t), p(whole, t))) for t in kept if c[t] and p(c, t) > p(whole, t)]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out |= {(lang, s, part, item, value, r + 1) for r, (item, value) in enumerate(ranked)}
    return out
