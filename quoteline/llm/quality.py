"""Quality classifier: a sparse ensemble of rules (RuleFit) compiled to Spark column expressions.

*Statistics.*  Every whole text is reduced to some twenty numbers (shares of byte classes, word lengths,
repetition of words and lines, ...), computed for a batch of texts at once on their bytes.

*Rules.*  Small randomised regression trees are grown on the residuals of those before them; every node but a root
is a rule, the conjunction of the comparisons on the way to it.  Rules and winsorised statistics get logistic
weights with a lasso penalty (accelerated proximal gradient), which leaves a few dozen; the penalty is chosen on a
held-back fifth of the training rows.

*Scoring.*  What is left is one arithmetic expression over statistic columns, run in generated code.

Training uses a bounded sample: at most about ``max_rows`` labelled ids, chosen by a hash of the id, and one row
of each: where rows with other texts share an id, the one with the smallest statistics, in their order.

Edge cases: a null text counts as empty, and an empty one is scored from its statistics like any other; without
labels, or with one label only, every score is the smoothed share of label 1; several labels of one document
count as their mean, null labels not at all; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released, slices, stored
from .words import split_words

STATS = ("log_bytes", "log_words", "lines", "word_bytes", "long_words", "upper", "lower", "digit", "space", "mark", "stop",
         "pipe", "other", "high", "distinct_words", "top_word", "same_next", "distinct_lines", "short_lines",
         "upper_words", "mark_words", "line_words")

_CLASS = np.full(256, 5, dtype=np.uint8)  # 0 upper, 1 lower, 2 digit, 3 space, 4 .,;:!?'"()-, 5 other marks, 6 high
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 0, 1, 2, 6
_CLASS[[0x20, 9, 10, 11, 12, 13]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4


def statistics(texts: list[str | None]) -> np.ndarray:
    """A row of :data:`STATS` for each text (None: empty)."""
    words = split_words(texts)
    n = len(texts)
    size = np.diff(words.doc_starts) - 1
    doc_of_byte = np.repeat(np.arange(n), np.diff(words.doc_starts))
    kind = _CLASS[words.data]
    kinds = np.bincount(doc_of_byte * 7 + kind, minlength=7 * n).reshape(n, 7)
    kinds[:, 3] -= 1  # the line break behind each text
    bytes_ = np.maximum(size, 1)
    count = words.counts
    some = np.maximum(count, 1)
    doc = words.docs()

    def per_doc(weights=None, mask=None):
        d = doc if mask is None else doc[mask]
        return np.bincount(d, weights=None if weights is None else weights, minlength=n)

    length = (words.ends - words.starts).astype(np.float64)
    order = np.lexsort((words.hashes, doc))
    d, h = doc[order], words.hashes[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    most = np.zeros(n)
    np.maximum.at(most, d[first], times)
    again = np.zeros(len(doc), dtype=bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (doc[1:] == doc[:-1])
    head = kind[words.starts] if len(doc) else np.zeros(0, np.uint8)
    tail = kind[words.ends - 1] if len(doc) else np.zeros(0, np.uint8)
    second = kind[np.minimum(words.starts + 1, len(kind) - 1)] if len(doc) else np.zeros(0, np.uint8)
    # lines: the words before each line break
    breaks = np.flatnonzero(words.data == 0x0A)
    line_doc = np.searchsorted(words.doc_starts, breaks, side="right") - 1
    line_end = np.searchsorted(words.starts, breaks)
    line_size = np.diff(line_end, prepend=0)
    line_hash = np.zeros(len(breaks), dtype=np.uint64)
    run = np.concatenate(([np.uint64(0)], np.cumsum(words.hashes, dtype=np.uint64)))
    line_hash = run[line_end] - run[line_end - line_size]
    full = line_size > 0
    lines = np.bincount(line_doc[full], minlength=n)
    key = np.lexsort((line_hash[full], line_doc[full]))
    ld, lh = line_doc[full][key], line_hash[full][key]
    fresh = np.ones(len(lh), dtype=bool)
    fresh[1:] = (ld[1:] != ld[:-1]) | (lh[1:] != lh[:-1])
    any_line = np.maximum(lines, 1)
    pipes = np.bincount(doc_of_byte[words.data == 0x7C], minlength=n)
    stops = np.bincount(doc_of_byte[(words.data == 0x2E) | (words.data == 0x21) | (words.data == 0x3F)], minlength=n)
    return np.stack([
        np.log1p(size), np.log1p(count), np.log1p(lines), per_doc(length) / some, per_doc(mask=length > 15) / some,
        kinds[:, 0] / bytes_, kinds[:, 1] / bytes_, kinds[:, 2] / bytes_, kinds[:, 3] / bytes_, kinds[:, 4] / bytes_,
        stops / some, pipes / some, kinds[:, 5] / bytes_, kinds[:, 6] / bytes_, np.bincount(d[first], minlength=n) / some,
        most / some, per_doc(mask=again) / some, np.bincount(ld[fresh], minlength=n) / any_line,
        np.bincount(line_doc[full & (line_size < 4)], minlength=n) / any_line,
        per_doc(mask=(head == 0) & (second == 0) & (length > 1)) / some,
        per_doc(mask=(tail == 5) | (tail == 2)) / some, count / any_line,
    ], axis=1).astype(np.float64)


# --- learning ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Conjunction of (statistic, is_above, threshold): x > t where above, else x <= t."""

    parts: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for j, above, t in self.parts:
            out &= (x[:, j] > t) if above else (x[:, j] <= t)
        return out


@dataclass
class Model:
    intercept: float
    rules: list[tuple[float, Rule]]
    linear: list[tuple[float, int, float, float, float]]  # weight, statistic, low, high, scale

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.intercept)
        for w, rule in self.rules:
            z += w * rule.holds(x)
        for w, j, low, high, scale in self.linear:
            z += w * np.clip(x[:, j], low, high) / scale
        return 1 / (1 + np.exp(-z))

    def expression(self, columns: list[str]) -> Column:
        """The score as a Spark column over the statistics."""
        z = F.lit(self.intercept)
        for w, rule in self.rules:
            test = None
            for j, above, t in rule.parts:
                one = F.col(columns[j]) > F.lit(t) if above else F.col(columns[j]) <= F.lit(t)
                test = one if test is None else test & one
            z = z + F.when(test, F.lit(w)).otherwise(F.lit(0.0))
        for w, j, low, high, scale in self.linear:
            z = z + F.lit(w / scale) * F.least(F.greatest(F.col(columns[j]), F.lit(low)), F.lit(high))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree_rules(x: np.ndarray, target: np.ndarray, rng, depth: int) -> tuple[list[Rule], np.ndarray]:
    """Rules of one tree grown to ``target`` by squares, over random statistics and quantile cuts, and what the
    tree predicts."""
    rules, out = [], np.zeros(len(x))

    def grow(rows: np.ndarray, parts: tuple, left: int) -> None:
        if parts:
            rules.append(Rule(parts))
        y = target[rows]
        best = None
        if left and len(rows) >= 20:
            for j in rng.choice(x.shape[1], size=8, replace=False):
                column = x[rows, j]
                for t in np.unique(np.quantile(column, np.linspace(0.05, 0.95, 10))):
                    low = column <= t
                    n = int(low.sum())
                    if 5 <= n <= len(rows) - 5:
                        s = y[low].sum()
                        gain = s * s / n + (y.sum() - s) ** 2 / (len(rows) - n)
                        if best is None or gain > best[0]:
                            best = (gain, int(j), float(t), low)
        if best is None:
            out[rows] = y.mean() if len(rows) else 0.0
            return
        _, j, t, low = best
        grow(rows[low], (*parts, (j, False, t)), left - 1)
        grow(rows[~low], (*parts, (j, True, t)), left - 1)

    grow(np.arange(len(x)), (), depth)
    return rules, out


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 150) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty by accelerated proximal gradient; the intercept is free."""
    n = len(y)
    design = np.concatenate((np.ones((n, 1)), a), axis=1)
    vector = np.ones(design.shape[1])
    for _ in range(15):  # the largest eigenvalue bounds the step
        vector = design.T @ (design @ vector)
        vector /= np.linalg.norm(vector)
    rate = 4 * n / max(np.linalg.norm(design @ vector) ** 2, 1e-9)
    w = np.zeros(design.shape[1])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[0] = np.log(mean / (1 - mean))
    look, t = w.copy(), 1.0
    for _ in range(steps):
        grad = design.T @ (1 / (1 + np.exp(-(design @ look))) - y) / n
        new = look - rate * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * penalty, 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, seed: int = 1) -> Model:
    """Rules from ``trees`` trees on half samples, then lasso weights; the penalty of least held-back loss."""
    if not len(y) or y.min() == y.max():
        mean = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Model(float(np.log(mean / (1 - mean))), [], [])
    rng = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    score = np.full(len(y), y.mean())
    for _ in range(trees):
        rows = rng.choice(len(y), size=min(len(y), max(50, min(3000, len(y) // 2))), replace=False)
        found, _ = _tree_rules(x[rows], (y - score)[rows], rng, depth)
        rules.update(dict.fromkeys(found))
        leaves = [r for r in found if len(r.parts) == max(len(q.parts) for q in found)]
        for rule in leaves:
            inside = rule.holds(x)
            if inside.any():
                score[inside] = np.clip(score[inside] + 0.1 * (y - score)[inside].mean(), 0, 1)
    masks, kept, seen = [], [], set()
    for rule in rules:
        hold = rule.holds(x)
        key = np.packbits(hold).tobytes()
        if 0.005 * len(y) <= hold.sum() <= 0.995 * len(y) and key not in seen:
            seen.add(key)
            masks.append(hold)
            kept.append(rule)
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    scale = np.maximum(np.clip(x, low, high).std(0), 1e-9) / 0.4
    usable = np.flatnonzero(high > low)
    a = np.concatenate([np.array(masks, dtype=np.float64).T.reshape(len(y), len(kept)),
                        (np.clip(x, low, high) / scale)[:, usable]], axis=1)
    back = rng.random(len(y)) < 0.2
    best = None
    for penalty in (0.02, 0.005, 0.002):
        b, w = _lasso(a[~back], y[~back], penalty)
        p = np.clip(1 / (1 + np.exp(-(a[back] @ w + b))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[back] * np.log(p) + (1 - y[back]) * np.log(1 - p)) if back.any() else penalty
        if best is None or loss < best[0]:
            best = (loss, penalty)
    intercept, w = _lasso(a, y, best[1], 300)
    return Model(intercept, [(float(v), r) for v, r in zip(w, kept, strict=False) if v],
                 [(float(v), int(j), float(low[j]), float(high[j]), float(scale[j]))
                  for v, j in zip(w[len(kept):], usable, strict=True) if v])


# --- Spark -----------------------------------------------------------------------------------------


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and a column for each of :data:`STATS`, from whole texts, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 1_000_000):
                x = statistics(texts[a:b])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *(pa.array(c) for c in x.T)],
                                                 ["doc_id", *STATS])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in STATS))


def is_held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text is divisible by ``folds`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = 12_000,
                  cut: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score (likelihood of label 1) and predicted (1 where score >= ``cut``)."""
    stats = stored(text_statistics(docs, id_col, text_col), "quality-stats")  # some 180 bytes a row, read twice
    own = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")) \
        .where("doc_id IS NOT NULL AND label IS NOT NULL").where(~is_held_out("doc_id"))
    n = own.select("doc_id").distinct().count()
    share = int(1_000_000 * min(1.0, max_rows / max(n, 1))) + 1
    chosen = own.where(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) < share) \
        .groupBy("doc_id").agg(F.avg("label").alias("label"))
    # one row an id, combined before the shuffle: an id that a third of the rows share counts once
    rows = stats.join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct(*STATS)).alias("s"), F.first("label").alias("label")) \
        .select("doc_id", "s.*", "label").orderBy("doc_id").toArrow()
    x = np.stack([rows.column(c).to_numpy() for c in STATS], axis=1) if rows.num_rows else np.zeros((0, len(STATS)))
    model = fit(x, rows.column("label").to_numpy() if rows.num_rows else np.zeros(0))
    score = model.expression(list(STATS))
    return stats.select("doc_id", is_held_out("doc_id").alias("held_out"), score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= cut).cast("int"))
