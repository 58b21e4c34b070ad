"""Near-duplicate documents by consistent weighted sampling.

*Weights.*  A text is the set of its shingles of five words; a shingle weighs ``(1 + ln tf) * idf`` with
``idf = ln(1 + 1 / (p + 0.25))``, ``p`` being the share of all documents that hold it.  The smoothing keeps
shingles of less than some hundredths of the corpus about alike (else a large family of copies would be pushed
apart by its own frequency) and takes weight from boilerplate.  ``p`` is counted over all documents in a table of 2^20 hashed
cells: a fixed size, and a shared cell adds about (shingles a document) / 2^20 to ``p`` at any corpus size.

*Samples.*  Improved consistent weighted sampling: for a sample ``k`` every shingle ``x`` of the text draws
``r, c ~ Gamma(2, 1)`` and ``beta ~ U(0, 1)`` from a hash of ``(x, k)``, which is the same in every text.  With
the level ``t = floor(ln w / r + beta)`` and ``ln y = r (t - beta)`` the sample is the pair ``(x, t)`` of the least
``ln c - ln y - r``; two texts agree in it with the probability of their weighted Jaccard similarity.  The draws are
looked up in tables of 65,536 draws by 16 bits of the hash each.  A pair ``(x, t)`` is named by that least
value itself, a function of the 48 bits and ``t``.

*Candidates.*  Samples are banded.  Equal texts are one class from the start.  In every bucket a few pivots
are compared with the members of other classes; what is confirmed joins classes, pivots leave the bucket, and
the next round takes eight times as many, until every bucket holds one class or no member is left to
compare.  So a bucket of ``n`` copies costs ``n`` comparisons, no link between classes is lost, and no
group is gathered in one task: pivots are minima (combined before the shuffle) and members meet them in a
join that Spark may split.

*Verification.*  A pair is compared in the first bucket that it shares.  If its total weights or the parities of
its shingles (256 cells for each of three tiers of idf; a lower bound of what only one text has, so nothing is lost) exclude
the threshold, or its 128 samples put it below ``min_agree`` (four bits of each are compared), it is left out: at a
similarity of 0.8 the estimate has a standard deviation of 0.037, and a pair falls below 0.65 or meets no
bucket about three times in 10,000.  All others are verified by the exact weighted Jaccard similarity of their whole texts, bucket by bucket, a large bucket cut into blocks of bounded size.

Edge cases: a text of fewer than five words is one shingle of all its words; texts without words (null,
empty, blank) are copies of each other only when their bytes are equal (null and empty count as equal); rows
with one id and text are copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_residents, mix, release, released, slices, stored, stored_and_measured
from .words import sequence_hashes, signed, split_words

CELLS = 1 << 20
SMOOTHING = 0.25
#: Shingles are told apart by the least idf of their tier, each a tenth below the one before, from the largest idf down
FLOORS = tuple(float(np.log1p(1.0 / SMOOTHING)) * 0.9**k for k in (1, 2, 3))
PARITIES = 256  # cells of a tier
_SCALE = 1.0 / (1 << 53)
_GOLDEN = 0x9E3779B97F4A7C15


# --- shingles ----------------------------------------------------------------------------------


def shingles(texts: list[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, how often) of the distinct shingles of each text, by text number."""
    words = split_words(texts)
    counts = words.counts
    doc = words.docs()
    size = np.minimum(counts, n)
    at = np.arange(len(doc)) - words.first[:-1][doc]
    starts = np.flatnonzero(at <= (counts - size)[doc])
    doc = doc[starts]
    hashes = sequence_hashes(words.hashes, starts, starts + size[doc])
    border = np.searchsorted(doc, np.arange(len(counts) + 1)).tolist()
    for a, b in pairwise(border):  # texts are in order: each one's hashes are sorted in place
        if b - a > 1:
            hashes[a:b].sort()
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    return doc[first], hashes[first], np.diff(np.append(first, len(doc)))


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)  # 2^20 of them


def weights(hashes: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1.0 + np.log(tf)) * idf[cells(hashes)]


def idf_table(counts: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log1p(1.0 / (counts / max(n_docs, 1) + SMOOTHING))


# --- samples -----------------------------------------------------------------------------------


def _uniform(k: int, n: int = 1 << 16) -> np.ndarray:
    """``n`` numbers in (0, 1), another stream for each ``k``."""
    key = np.arange(n, dtype=np.uint64) + np.uint64((k + 1) * _GOLDEN & (1 << 64) - 1)
    return ((mix(key) >> np.uint64(11)).astype(np.float64) + 0.5) * _SCALE


def _gamma_draws(k: int) -> np.ndarray:
    """Draws of Gamma(2, 1): the sum of two exponential ones."""
    return -np.log(_uniform(k)) - np.log(_uniform(k + 1))


def _same_everywhere(x: np.ndarray) -> np.ndarray:
    """Cut to single precision, so the last bit of a logarithm, which may hang on the processor, is not in it."""
    return x.astype(np.float32).astype(np.float64)


_R, _LN_C = _same_everywhere(_gamma_draws(0)), _same_everywhere(np.log(_gamma_draws(2)))
_BETA = (np.arange(1 << 16) + 0.5) / (1 << 16)  # computed in place where samples are drawn


def signatures(doc: np.ndarray, hashes: np.ndarray, w: np.ndarray, n_docs: int, n_samples: int) -> np.ndarray:
    """``n_samples`` samples (as 64-bit hashes) of each text from its weighted shingles, by text number; texts
    without shingles get zeros."""
    out = np.zeros((n_docs, n_samples), dtype=np.uint64)
    if not len(doc):
        return out
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    rows, ln_w = doc[first], np.log(w)
    x, y = np.empty_like(hashes), np.empty_like(hashes)
    at, (r, beta, v) = y.view(np.int64), np.empty((3, len(hashes)))
    fields = x.astype("<u8", copy=False).view("<u2").reshape(-1, 4)
    for k in range(n_samples):
        # a hash of shingle and sample in place, as in mix()
        np.add(hashes, np.uint64((k + 1) * _GOLDEN & (1 << 64) - 1), out=x)
        np.right_shift(x, np.uint64(30), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint64(0xBF58476D1CE4E5B9), out=x)
        np.right_shift(x, np.uint64(27), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, np.uint64(0x94D049BB133111EB), out=x)
        np.right_shift(x, np.uint64(48), out=y)
        np.take(_R, at, out=r, mode="clip")
        np.add(fields[:, 2], 0.5, out=beta)
        beta *= 1.0 / (1 << 16)  # a power of two: exact
        np.divide(ln_w, r, out=v)
        v += beta
        np.floor(v, out=v)  # the level
        v -= beta
        v += 1.0
        v *= r
        np.copyto(at, fields[:, 1], casting="unsafe")
        np.take(_LN_C, at, out=r, mode="clip")
        np.subtract(r, v, out=v)
        out[rows, k] = np.minimum.reduceat(v, first).view(np.uint64)
    out[rows] = mix(out[rows])
    return out


def parities(doc: np.ndarray, hashes: np.ndarray, idf: np.ndarray, n_docs: int) -> np.ndarray:
    """For each text, as longs, the parities of its shingles in ``PARITIES`` cells for each of ``FLOORS`` (those of a
    lower idf are left out).  Each cell that differs between two texts holds a shingle that only one of them has."""
    own = idf[cells(hashes)]
    tier = sum((own < f).astype(np.int64) for f in FLOORS)
    some, width = tier < len(FLOORS), len(FLOORS) * PARITIES
    at = doc[some] * width + tier[some] * PARITIES + (hashes[some] % np.uint64(PARITIES)).astype(np.int64)
    odd = (np.bincount(at, minlength=n_docs * width) & 1).astype(np.uint8).reshape(n_docs, width)
    return np.packbits(odd, axis=1, bitorder="little").view("<i8")


def band_keys(samples: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` samples."""
    bands = samples.shape[1] // rows
    parts = samples.reshape(len(samples), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(_GOLDEN), parts.shape[:2])
    for k in range(rows):
        key = mix(key + parts[:, :, k] * np.uint64(0xD6E8FEB86659FD93))
    return key


# --- Spark ---------------------------------------------------------------------------------------

SAMPLES, ROWS, BANDS, MIN_AGREE = 128, 4, 16, 0.65
_SLICES = 256
_SIGNED = "row_id long, node binary, weight double, bands array<long>, samples array<long>, odd array<long>"


def _document_frequencies(source: DataFrame, shingle: int) -> tuple[np.ndarray, int]:
    """Documents that hold a shingle of each cell, counted over all rows: each task adds up one table of
    fixed size and sends it in slices, which are summed by slice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_residents()
        total, rows = np.zeros(CELLS, dtype=np.int64), 0
        for batch in released(batches):
            texts = batch.column(0).to_pylist()
            rows += len(texts)
            for a, b in slices(texts, 500_000):
                total += np.bincount(cells(shingles(texts[a:b], shingle)[1]), minlength=CELLS)
        if rows:
            parts = total.reshape(_SLICES, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(_SLICES, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CELLS // _SLICES, dtype=np.int64)
        for blob in table.column("counts"):
            total += np.frombuffer(blob.as_buffer(), dtype=np.int64)
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    spread = source.select("text").mapInArrow(count, "slice int, counts binary")
    found = spread.groupBy("slice").applyInArrow(add, "slice int, counts binary").collect()  # 8 MB, always
    out = np.zeros((_SLICES, CELLS // _SLICES), dtype=np.int64)
    for r in found:
        out[r["slice"]] = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    del found
    release()
    return out.reshape(-1), source.count()


def _sign(source: DataFrame, idf, shingle: int) -> DataFrame:
    """Per row its total weight, band keys, samples (four bits each, 16 in a long) and parities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in released(batches):
            texts = batch.column(2).to_pylist()
            for a, b in slices(texts, 500_000):
                doc, hashes, tf = shingles(texts[a:b], shingle)
                w = weights(hashes, tf, table)
                samples = signatures(doc, hashes, w, b - a, SAMPLES)
                total = np.bincount(doc, weights=w, minlength=b - a).astype(np.float64)
                keys = band_keys(samples[:, : ROWS * BANDS], ROWS)
                bits = (samples >> np.uint64(60)).astype(np.uint8)
                odd = parities(doc, hashes, table, b - a)
                packed = (bits[:, 0::2] | bits[:, 1::2] << 4).view("<i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(total),
                     pa.FixedSizeListArray.from_arrays(pa.array(signed(keys).ravel()), BANDS).cast(pa.list_(pa.int64())),
                     pa.FixedSizeListArray.from_arrays(pa.array(packed.ravel()), SAMPLES // 16).cast(pa.list_(pa.int64())),
                     pa.FixedSizeListArray.from_arrays(pa.array(odd.ravel()), odd.shape[1]).cast(pa.list_(pa.int64()))],
                    ["row_id", "node", "weight", "bands", "samples", "odd"])

    return source.select("row_id", "node", "text").mapInArrow(run, _SIGNED)


def _agreement(a: str, b: str) -> str:
    """SQL: the similarity that the samples show.  Four bits of x = a ^ b are zero where two samples agree (or,
    once in 16 times, by chance): they are brought together in the lowest of the four."""
    parts = []
    for i in range(SAMPLES // 16):
        x = f"({a}.samples[{i}] ^ {b}.samples[{i}])"
        bits = " | ".join([x, *(f"shiftrightunsigned({x}, {k})" for k in (1, 2, 3))])
        parts.append(f"bit_count(({bits}) & 1229782938247303441L)")
    return f"(1 - ({' + '.join(parts)}) * {16 / 15 / SAMPLES})"


def _within_reach(a: str, b: str, threshold: float) -> str:
    """SQL: whether the parities leave a similarity of ``threshold`` possible.  Texts of total weights u and v share
    at most (u + v - d) / 2, d being the weight that only one of them has: the least idf of the tier or more
    for each cell that differs."""
    each = PARITIES // 64
    apart = " + ".join(f"({' + '.join(f'bit_count({a}.odd[{k * each + i}] ^ {b}.odd[{k * each + i}])' for i in range(each))}) * "
                       f"{least * (1 + threshold)!r}D" for k, least in enumerate(FLOORS))
    return f"{apart} <= ({a}.weight + {b}.weight) * {(1 - threshold) * (1 + 1e-9)!r}D + 1e-9D"


def _first_common_band(a: str, b: str) -> str:
    return "CASE " + " ".join(f"WHEN {a}.bands[{i}] = {b}.bands[{i}] THEN {i}" for i in range(BANDS)) + " END"


def _components(edges: DataFrame) -> DataFrame:
    """(node, label) of the connected parts of edges (a, b), the label being the smallest node: large-star and
    small-star steps until nothing changes, each step written to the shared folder."""
    edges, n, checksum = stored_and_measured(edges.where("a <> b").distinct(), "near-edges")
    while n:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("b < a")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                           F.col("m").alias("b")).where("a <> b").distinct()
        before = (n, checksum)
        edges, n, checksum = stored_and_measured(small, "near-edges")
        if (n, checksum) == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _texts_of(source: DataFrame, wanted: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """(node, text), once for each node of ``wanted``.  The texts meet bitmaps of the wanted nodes' hashes first,
    ``bits`` bits in all (2 MB broadcast at any size of the corpus), so the join that decides exchanges the wanted
    texts and few others; with far more nodes than bits it exchanges all texts, with the same result."""
    spot = F.pmod(F.xxhash64("node"), F.lit(bits))
    marks = wanted.select(spot.alias("spot")).groupBy(F.expr("spot div 32768").alias("map")) \
        .agg(F.expr("bitmap_construct_agg(spot % 32768)").alias("marks"))
    byte = "cast(conv(hex(substring(marks, cast(spot % 32768 div 8 as int) + 1, 1)), 16, 10) as int)"
    likely = source.select("node", "text", spot.alias("spot")).join(
        F.broadcast(marks), F.expr(f"spot div 32768 = map AND shiftright({byte}, cast(spot % 8 as int)) & 1 = 1"))
    # an inner join: a semi join would be moved below the bitmaps and exchange all texts
    return likely.select("node", "text").join(wanted.distinct(), "node").dropDuplicates(["node"])


def _verify(pairs: DataFrame, texts: DataFrame, idf, shingle: int, threshold: float, block: int = 256) -> DataFrame:
    """Pairs (key, n, a, b) whose weighted Jaccard similarity is at least ``threshold``.  The pairs of a bucket
    are compared where its texts meet; a bucket of many nodes (``n``) is cut into pairs of groups of about
    ``block`` nodes, so a task never holds more than two groups."""
    def nodes_of(rows: DataFrame, *keys: str) -> DataFrame:
        """Each node once for each key; both sides are combined before the shuffle."""
        one, two = (rows.select(*keys, F.col(c).alias("node")).distinct() for c in ("a", "b"))
        return one.unionByName(two).distinct()

    def group(c: str):
        return F.pmod(F.xxhash64(c), F.ceil(F.col("n") / block)).cast("int")

    placed = pairs.withColumns({"ga": group("a"), "gb": group("b")}) \
        .select("key", "a", "b", F.least("ga", "gb").alias("g"), F.greatest("ga", "gb").alias("h"))
    need = nodes_of(placed, "key", "g", "h")
    here = need.join(texts, "node").select(*(F.col(c).alias(f"{c}_") for c in ("key", "g", "h")), "node", "text")

    def compare(pairs: pa.Table, here: pa.Table) -> pa.Table:
        nodes = here.column("node").to_pylist()
        order = {n: i for i, n in enumerate(nodes)}
        doc, hashes, tf = shingles(here.column("text").to_pylist(), shingle)
        w = weights(hashes, tf, idf.value)
        cut = np.searchsorted(doc, np.arange(len(nodes) + 1))
        total = np.bincount(doc, weights=w, minlength=len(nodes))
        out_a, out_b = [], []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            i, j = order[a], order[b]
            x, y = slice(cut[i], cut[i + 1]), slice(cut[j], cut[j + 1])
            at = np.searchsorted(hashes[y], hashes[x])
            at[at == cut[j + 1] - cut[j]] = 0
            hit = hashes[y][at] == hashes[x]
            common = np.minimum(w[x][hit], w[y][at[hit]]).sum()
            if common >= threshold * (total[i] + total[j] - common) * (1 - 1e-12):
                out_a.append(a)
                out_b.append(b)
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})

    return placed.groupBy("key", "g", "h").cogroup(here.groupBy("key_", "g_", "h_")).applyInArrow(
        compare, "a binary, b binary")


def _node_columns(id_col: Column, text_col: Column) -> tuple[Column, Column, Column]:
    text = F.coalesce(text_col, F.lit(""))
    return (F.coalesce(id_col.cast("long"), F.lit(np.iinfo(np.int64).min)), F.unhex(F.md5(text.cast("binary"))), text)


def with_nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_id (the id, a null one as the smallest long), node (the class of equal texts) and text."""
    columns = _node_columns(F.col(id_col), F.col(text_col))
    return docs.select(*(c.alias(n) for c, n in zip(columns, ("row_id", "node", "text"), strict=True)))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, shingle: int = 5, min_agree: float = MIN_AGREE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row_id and node of :func:`with_nodes`, class_id (the smallest row_id of its class) and is_first
    (the row, or the equal rows, that stand for the class: smallest row_id, then smallest node)."""
    source = with_nodes(docs, id_col, text_col)
    spark = docs.sparkSession
    counts, n_docs = _document_frequencies(source, shingle)
    idf = spark.sparkContext.broadcast(idf_table(counts, n_docs))
    signed_rows = stored(_sign(source, idf, shingle), "near-signed")
    nodes = signed_rows.where("weight > 0").select("node", "weight", "bands", "samples", "odd").dropDuplicates(["node"])
    banded = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    sizes = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = stored(banded.join(sizes, "key"), "near-buckets")
    # the text that most copies come from shares the most buckets: it makes the best pivot
    popular = met.groupBy("node").agg(F.sum("n").alias("pop"))
    members = stored(met.select("key", "band", "node", "n").join(popular.join(nodes, "node"), "node"), "near-members")
    parts = stored(popular.select("node", F.col("node").alias("comp")), "near-parts")
    agree, first_band = _agreement("m", "p"), _first_common_band("m", "p")
    width = 1
    while True:
        current = members.join(parts, "node")
        open_ = current.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
        active, n, _ = stored_and_measured(current.join(open_, "key"), "near-active")
        if not n:
            break
        slot = F.pmod(F.xxhash64("node"), F.lit(width))
        pivots = stored(active.groupBy("key", slot.alias("slot")).agg(
            F.max(F.struct("pop", "node", "n", "band", "comp", "weight", "bands", "samples", "odd")).alias("p")).select("key", "p.*"), "near-pivots")
        rest = stored(active.join(pivots.select("key", "node"), ["key", "node"], "left_anti"), "near-rest")
        columns = ("key", "n", "band", "node", "pop", "weight", "bands", "samples", "odd", "comp")
        both = rest.select(*columns, F.lit(True).alias("other")) \
            .unionByName(pivots.select(*columns, F.lit(False).alias("other")))  # pivots meet each other once
        met_now = both.alias("m").join(pivots.alias("p"), F.expr(
            f"m.key = p.key AND m.comp <> p.comp AND (m.other OR m.node < p.node) AND least(m.weight, p.weight) >= {threshold * (1 - 1e-9)} * greatest(m.weight, p.weight)"
            f" AND {first_band} = m.band AND {agree} >= {min_agree} AND {_within_reach('m', 'p', threshold)}"))
        pairs, n, _ = stored_and_measured(met_now.select(F.col("m.key").alias("key"), "m.n", F.least("m.node", "p.node").alias("a"),
                                      F.greatest("m.node", "p.node").alias("b")).distinct(), "near-pairs")
        if n:
            # texts of the nodes that are really compared, a small share of those that share a bucket with others
            compared = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
            links, n, _ = stored_and_measured(_verify(pairs, _texts_of(source, compared), idf, shingle, threshold), "near-links")
            if n:
                comp = parts.select("node", "comp")
                edges = links.join(comp.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a") \
                    .join(comp.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b") \
                    .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
                labels = _components(edges).select(F.col("node").alias("comp"), "label")
                parts = stored(parts.join(labels, "comp", "left").select("node", F.coalesce("label", "comp").alias("comp")),
                               "near-parts")
        members = rest.drop("comp")
        width *= 8
    idf.unpersist()
    named = signed_rows.select("row_id", "node").join(parts, "node", "left") \
        .select("row_id", "node", F.coalesce("comp", "node").alias("comp"))
    heads = named.groupBy("comp").agg(F.min(F.struct("row_id", "node")).alias("head"))
    return named.join(heads, "comp").select("row_id", "node", F.col("head.row_id").alias("class_id"),
                                            (F.struct("row_id", "node") == F.col("head")).alias("is_first"))


def one_of_each(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their classes, with all their columns; of equal rows (id and text)
    one stays."""
    names = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names))))
    c_id, c_text = (F.col(f"c{names.index(c)}") for c in (id_col, text_col))
    row_id, node, _ = _node_columns(c_id, c_text)
    # what goes and what is repeated is far less than what stays: the texts are joined with those rows only, so
    # they are not exchanged while the rows fit in a broadcast by Spark's own estimate, and once beyond that
    found = near_duplicates(docs, threshold, id_col=id_col, text_col=text_col)
    keys = found.groupBy("row_id", "node").agg(F.first("is_first").alias("stays"), F.count(F.lit(1)).alias("n"))
    marked = stored(keys.where("NOT stays OR n > 1"), "near-marked")
    keyed = inner.withColumns({"row_id": row_id, "node": node})
    out = keyed.join(marked.select("row_id", "node"), ["row_id", "node"], "left_anti")
    again = marked.where("stays").select("row_id", "node")
    if not again.isEmpty():  # rows equal in id and text: one of each
        same = Window.partitionBy("row_id", "node").orderBy(F.lit(0))
        once = keyed.join(again, ["row_id", "node"], "left_semi").withColumn("n", F.row_number().over(same)).where("n = 1")
        out = out.unionByName(once.select(*out.columns))
    return out.select(*(f"c{i}" for i in range(len(names)))).toDF(*names)


def classes(found: DataFrame) -> DataFrame:
    """doc_id, class_id and is_first of :func:`near_duplicates`, null ids as null."""
    null = F.lit(np.iinfo(np.int64).min)
    return found.select(F.nullif("row_id", null).alias("doc_id"), F.nullif("class_id", null).alias("class_id"),
                        "is_first")


def similarity(a: str | None, b: str | None, idf: np.ndarray, shingle: int = 5) -> float:
    """Weighted Jaccard similarity of two texts (0 when neither has a word)."""
    doc, hashes, tf = shingles([a, b], shingle)
    w = weights(hashes, tf, idf)
    x, y = (dict(zip(hashes[doc == k].tolist(), w[doc == k].tolist(), strict=True)) for k in (0, 1))
    common = sum(min(v, y[k]) for k, v in x.items() if k in y)
    total = sum(x.values()) + sum(y.values()) - common
    return common / total if total else 0.0


def brute_force(rows: list[tuple], threshold: float = 0.8, shingle: int = 5) -> list[tuple]:
    """The definition, for tests: (doc_id, class_id) with all pairs of texts compared."""
    counts = np.zeros(CELLS, dtype=np.int64)
    for _, text in rows:
        counts += np.bincount(cells(shingles([text], shingle)[1]), minlength=CELLS)
    idf = idf_table(counts, len(rows))
    texts = sorted({t or "" for _, t in rows})
    parent = list(range(len(texts)))

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(len(texts)):
        for j in range(i):
            if similarity(texts[i], texts[j], idf, shingle) >= threshold:
                parent[root(i)] = root(j)
    place = {t: i for i, t in enumerate(texts)}
    low = reduce(lambda d, r: d | {root(place[r[1] or ""]): min(r[0], d.get(root(place[r[1] or ""]), r[0]))}, rows, {})
    return [(d, low[root(place[t or ""])]) for d, t in rows]
