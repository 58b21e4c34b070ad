"""How quality filters interact: what each one removes, in every order in which they may be applied.

*Cells.*  Each document fails some of five filters, which makes a mask of five bits.  Spark counts the documents of
every (part, mask), at most 32 cells a part; good and toxic ones are counted with them.

*Walk.*  The 32 sets of active filters are visited in Gray-code order, so that each step turns one filter on or
off.  Every cell keeps the number of active filters that it fails; when that number leaves or reaches zero, the
cell's documents leave or rejoin the running survivors.  The survivors of all 32 sets are stored, and what a filter
does at a step of any order is the difference of two of them.

*Repeats.*  Filter E fails a text that a smaller doc_id has, anywhere in the table.  Texts are known by their SHA-256:
documents are summed by (digest, part) first, before and after the shuffle, and only one row a part and text
remains to be compared with the smallest id of its text; a text that a third of all documents share costs no more.

Edge cases: a null text is empty (no words: it fails A only, unless repeated), a null source is ``''``; a document
without an id fails E never, and its labels are unknown; rows with the smallest id of a text pass E, all of them if that
id is repeated; a document is good (toxic) if any of its label rows says so; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Sets of active filters in an order in which neighbours differ by one filter.
GRAY_CODE = [i ^ i >> 1 for i in range(1 << len(FILTERS))]

_WORDS = r"array_remove(split(x, '[ \\t-\\r]+'), '')"
#: Bits of the filters that a text alone decides, from the text ``x``.
_TEXT_MASK = r"""
  IF(size(words) < 50, 1, 0) + IF(100L * size(array_distinct(words)) < 65L * size(words), 2, 0)
  + IF(100L * (length(x) - length(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5L * length(x), 4, 0)
  + IF(length(x) <> length(translate(x, '#$%&*|', '')), 8, 0)"""
_RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
           "good_lost long, toxic_lost long, shapley long")


def text_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: doc_id, part, digest of the text and mask of the filters A to D that it fails."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("x"))
    return text.selectExpr("doc_id", "part", "x", f"{_WORDS} AS words").selectExpr(
        "doc_id", "part", "unhex(sha2(x, 256)) AS digest", f"CAST({_TEXT_MASK} AS INT) AS mask")


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """part, mask (filter A is bit 1, E bit 16), n, good and toxic documents of every cell."""
    marked = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.expr("CAST(quality = 1 AS INT)")).alias("good"), F.max(F.expr("CAST(toxic = 1 AS INT)")).alias("toxic"))
    # the long texts are read once: their masks and digests are written before anything is joined
    masks = stored(text_masks(docs, id_col, text_col, source_col), "filter-masks")
    same = masks.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    rows = same.join(marked, "doc_id", "left").selectExpr(
        "doc_id", "part", "digest", "mask", "n", "n * coalesce(good, 0) AS good", "n * coalesce(toxic, 0) AS toxic")
    # by text and part: everything, and what passes E there: rows of the smallest id and rows without one
    least = F.min(F.expr("IF(doc_id IS NULL, NULL, struct(doc_id, n, good, toxic))")).alias("least")
    whole = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    nameless = [F.sum(F.expr(f"IF(doc_id IS NULL, {c}, 0L)")).alias(f"no_id_{c}") for c in ("n", "good", "toxic")]
    texts = rows.groupBy("digest", "part", "mask").agg(least, *whole, *nameless)
    first = F.min("least.doc_id").over(Window.partitionBy("digest")).alias("first_id")  # a row a part
    passing = {c: f"no_id_{c} + IF(least.doc_id = first_id, least.{c}, 0L)" for c in ("n", "good", "toxic")}
    split = texts.select("*", first).selectExpr(
        "part", "mask", "explode(array("
        + ", ".join(f"struct({bit} AS bit, " + ", ".join(f"coalesce({text.format(c=c, p=p)}, 0L) AS {c}" for c, p in passing.items()) + ")"
                    for bit, text in ((0, "{p}"), (16, "{c} - coalesce({p}, 0L)"))) + ")) AS s")
    return (split.selectExpr("part", "mask + s.bit AS mask", "s.n AS n", "s.good AS good", "s.toxic AS toxic")
            .groupBy("part", "mask").agg(*whole).where("n > 0"))


def survivors(masks: np.ndarray, amounts: np.ndarray) -> np.ndarray:
    """Per set of active filters (by its bits) the sums of ``amounts`` over the cells that fail none of them."""
    failing = np.zeros(len(masks), np.int64)
    running = amounts.sum(0)
    states = np.zeros((len(GRAY_CODE), amounts.shape[1]), np.int64)
    states[0] = running
    for before, after in zip(GRAY_CODE, GRAY_CODE[1:]):
        bit = before ^ after
        touched = masks & bit > 0
        if after & bit:  # turned on: cells that failed nothing so far leave
            running = running - amounts[touched & (failing == 0)].sum(0)
            failing[touched] += 1
        else:  # turned off: cells that failed this one only come back
            failing[touched] -= 1
            running = running + amounts[touched & (failing == 0)].sum(0)
        states[after] = running
    return states


def _walk(table: pa.Table) -> pa.Table:
    """All orders and steps of one part, from its cells."""
    part = table.column("part")[0].as_py()
    masks = table.column("mask").to_numpy().astype(np.int64)
    amounts = np.stack([table.column(c).to_numpy() for c in ("n", "good", "toxic")], axis=1)
    states = survivors(masks, amounts)
    failing = [int(amounts[masks >> b & 1 > 0, 0].sum()) for b in range(len(FILTERS))]
    alone = [int(amounts[masks == 1 << b, 0].sum()) for b in range(len(FILTERS))]
    rows, shapley = [], [0] * len(FILTERS)
    for order in ORDERS:
        active = 0
        for step, name in enumerate(order, 1):
            b = FILTERS.index(name)
            before, after = states[active], states[active | 1 << b]
            active |= 1 << b
            lost = (before - after).tolist()
            shapley[b] += lost[0]
            rows.append((part, order, step, int(after[0]), lost[0], failing[b] - lost[0], alone[b], lost[1], lost[2], b))
    columns = list(zip(*rows))
    columns[-1] = [shapley[b] for b in columns[-1]]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    return pa.table({f.strip().split()[0]: pa.array(c, k) for f, c, k in zip(_RESULT.split(","), columns, kinds)})


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """part, filter_order, step and what the filter of that step does there; see the module's text."""
    return cells(docs, labels, id_col, text_col, source_col).groupBy("part").applyInArrow(_walk, _RESULT)


def brute_force(rows, labels) -> set[tuple]:
    """The definition, filter by filter, over (doc_id, text, source) and (doc_id, quality, toxic) rows."""
    import re

    rows = [(d, x or "", s or "") for d, x, s in rows]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first: dict = {}
    for d, x, _ in rows:
        if d is not None:
            first[x] = min(first.get(x, d), d)
    docs = []
    for d, x, s in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", x)) > 5 * len(x), "D": bool(re.search(r"[#$%&*|]", x)),
                 "E": d is not None and d > first[x]}
        docs.append((s, fails, d in good, d in toxic))
    out = set()
    for part in {r[0] for r in docs}:
        own = [r for r in docs if r[0] == part]
        result, shapley = [], dict.fromkeys(FILTERS, 0)
        for order in ORDERS:
            left = own
            for step, name in enumerate(order, 1):
                gone = [r for r in left if r[1][name]]
                left = [r for r in left if not r[1][name]]
                shapley[name] += len(gone)
                result.append((name, order, step, len(left), len(gone), sum(r[1][name] for r in own) - len(gone),
                               sum(r[1][name] and sum(r[1].values()) == 1 for r in own),
                               sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out |= {(part, *r[1:], shapley[r[0]]) for r in result}
    return out
