"""Approximate nearest neighbours by multi-index hashing.

*Codes.*  Vectors are scaled to length one, centred, turned to their principal axes and then by a learned rotation
that brings them close to the corners of a cube (iterative quantisation); the signs are the code.  The rotation and
the search radius are learnt on a bounded sample (``sample`` vectors, by a hash of the vector); every vector is
indexed.

*Index.*  A code is split into substrings of eight bits; per substring a table lists the codes by its value.  Two
codes within ``r`` bits differ in at most ``r // m`` bits of one of the ``m`` substrings (pigeonhole), so probing
all values within that many bits of the query's substring, in every table, retrieves every code within the
radius.  The candidates found are cut to the radius and reranked by cosine in double precision.  The radius
is the one that held ``target`` of the true neighbours of the sample's queries.  Where a block of the index
gives fewer than ``k`` codes inside the radius, its radius is widened to all.

*Distribution.*  Equal vectors are one entry with their ``k + 1`` smallest ids (a vector held by a third of the
rows is one entry).  Entries are dealt into blocks of about ``block`` rows, queries into groups, and each
(block, group) meets in one task which holds no more than those; a block gives ``k + 1`` ids for each
query, and the smallest are chosen by a ranking that Spark combines before the shuffle.  Vectors of each length
have a rotation, a radius, blocks and groups of their own.

Edge cases: vectors that are null, zero or hold null or non-finite components take no part, as query or as
candidate, nor do rows without an id; vectors are compared with those of their own length, of whatever lengths a table
holds; a row that is repeated counts once; an id with several vectors is one query and one candidate, near by
its largest cosine; fewer candidates than ``k`` are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RESULT_SCHEMA = "query_id long, rank int, vec_id long, score double"
_BYTE_BITS = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_DISTANCE = _BYTE_BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


# --- learning ------------------------------------------------------------------------------------


class Coder:
    """Centre and rotation; ``codes`` gives the signs, packed to bytes (the substrings)."""

    def __init__(self, sample: np.ndarray, rounds: int = 30, seed: int = 1):
        dims = sample.shape[1]
        self.bits = 8 * math.ceil(dims / 8)
        self.mean = sample.mean(0) if len(sample) else np.zeros(dims)
        centred = sample - self.mean
        _, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(dims))
        rng = np.random.default_rng(seed)
        turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        view = centred @ axes
        for _ in range(rounds if len(sample) else 0):
            u, _, vt = np.linalg.svd(np.sign(view @ turn).T @ view)
            turn = (u @ vt).T
        self.rotation = axes @ turn

    def codes(self, unit: np.ndarray) -> np.ndarray:
        signs = (unit - self.mean) @ self.rotation > 0
        return np.packbits(np.pad(signs, ((0, 0), (0, self.bits - signs.shape[1]))), axis=1)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of the original vectors in double precision."""
    return (vectors @ query) / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))


def learn_radius(coder: Coder, sample: np.ndarray, k: int, target: float) -> int:
    """The Hamming radius that holds ``target`` of the true neighbours of up to 300 queries of the sample."""
    if len(sample) < 2:
        return coder.bits
    unit = _units(sample)
    codes = coder.codes(unit)
    queries = np.linspace(0, len(sample) - 1, min(300, len(sample))).astype(int)
    near = unit[queries] @ unit.T
    near[np.arange(len(queries)), queries] = -2
    top = np.argpartition(-near, min(k, len(sample) - 1) - 1, axis=1)[:, :k]
    away = _DISTANCE[codes[queries][:, None, :], codes[top]].sum(-1)
    return int(np.quantile(away, target, method="higher"))


# --- a block of the index --------------------------------------------------------------------------


class MultiIndex:
    """Tables of the codes of a block, one for each byte of the code."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            self.tables.append((order, np.searchsorted(codes[order, j], np.arange(257))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Numbers of all codes within ``radius`` bits of ``code``."""
        m = len(self.tables)
        found = np.zeros(len(self.codes), dtype=bool)
        for j, (order, cut) in enumerate(self.tables):
            # the first substrings get the remainder: r + 1 <= sum of (own radius + 1)
            own = (radius + 1 + j) // m - 1 if radius < 8 * m else 8
            for value in np.flatnonzero(_DISTANCE[code[j]] <= own).tolist() if own >= 0 else ():
                found[order[cut[value] : cut[value + 1]]] = True
        hits = np.flatnonzero(found)
        return hits[_DISTANCE[self.codes[hits], code].sum(1, dtype=np.int64) <= radius]


# --- Spark -----------------------------------------------------------------------------------------


def nearest(vectors: DataFrame, k: int = 5, every: int = 50, sample: int = 4000, target: float = 0.98,
            block: int = 8192, queries_each: int = 2048, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """For each row whose id is divisible by ``every`` its ``k`` nearest other rows: query_id, rank (from 1), vec_id
    and score (cosine), nearest first, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where("vec_id IS NOT NULL AND v IS NOT NULL")
    good = rows.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0)).distinct()  # repeated rows are one, combined before the shuffle
    # equal vectors: the k + 1 smallest ids.  Two vectors may have one smallest id, so a node is named by both
    first = Window.partitionBy("v").orderBy("vec_id")
    entries = stored(
        good.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumns({"node": F.concat_ws(":", F.col("ids")[0], F.xxhash64("v")), "dims": F.size("v")}),
        "ann-entries")
    sizes = {r["dims"]: r["n"] for r in entries.groupBy("dims").agg(F.count("*").alias("n")).collect()}  # a row a length
    if not sizes:
        return spark.createDataFrame([], RESULT_SCHEMA)
    share = F.create_map(*[F.lit(x) for d, n in sizes.items() for x in (d, int(1e6 * min(1.0, sample / n)) + 1)])
    picked = entries.where(F.pmod(F.xxhash64("node", F.lit("sample")), F.lit(1_000_000)) < share[F.col("dims")]) \
        .select("v", "dims").toArrow()  # about ``sample`` of each length
    learnt = {}
    for d in sizes:
        own = picked.filter(pc.equal(picked.column("dims"), d)).column("v").combine_chunks()
        x = own.flatten().to_numpy().reshape(-1, d)
        coder = Coder(_units(x))
        learnt[d] = (coder, learn_radius(coder, x, k, target))
    shared = spark.sparkContext.broadcast(learnt)

    asked = stored(good.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
                   .join(entries.select("v", "node"), "v").select("query_id", "node"), "ann-queries")
    nodes = asked.select("node").distinct().join(entries.select("node", "dims", "v"), "node")
    n_asked = {r["dims"]: r["n"] for r in nodes.groupBy("dims").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame([(d, math.ceil(sizes[d] / block), math.ceil(n / queries_each)) for d, n in n_asked.items()],
                                 "dims int, n_blocks int, n_groups int")
    # every query group visits every block of its length; a visit is one task of bounded size
    at_blocks = nodes.join(plan, "dims").withColumn("g", F.pmod(F.xxhash64("node"), F.col("n_groups")).cast("int")) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    index = entries.join(plan, "dims").withColumn("b", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")) \
        .withColumn("g", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)))

    def visit(queries: pa.Table, own: pa.Table) -> pa.Table:
        names, types = ["node", "score", "vec_id"], [pa.string(), pa.float64(), pa.int64()]
        if not queries.num_rows or not own.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        dims = queries.column("dims")[0].as_py()
        coder, radius = shared.value[dims]

        def matrix(column) -> np.ndarray:
            return column.combine_chunks().flatten().to_numpy().reshape(-1, dims)

        base, asked = matrix(own.column("v_")), matrix(queries.column("v"))
        index = MultiIndex(coder.codes(_units(base)))
        codes, q_nodes = coder.codes(_units(asked)), queries.column("node").to_pylist()
        ids = own.column("ids").combine_chunks()
        cut, flat = ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy()
        norms = np.linalg.norm(base, axis=1)

        def nearest_ids(q: int, hits: np.ndarray) -> list[tuple[float, int]]:
            """The k + 1 nearest ids among the entries, each once."""
            score = (base[hits] @ asked[q]) / (norms[hits] * np.linalg.norm(asked[q]))
            best: dict[int, float] = {}
            order = np.lexsort((flat[cut[hits]], -score)).tolist()
            for i, j in enumerate(order):
                if len(best) > k and score[j] < score[order[i - 1]]:  # entries of equal score are taken together
                    break
                for x in flat[cut[hits[j]] : cut[hits[j] + 1]].tolist():
                    best.setdefault(x, float(score[j]))
            return sorted((-s, x) for x, s in best.items())[: k + 1]

        out_node, out_score, out_id = [], [], []
        for q, node in enumerate(q_nodes):
            best = nearest_ids(q, index.within(codes[q], radius))
            if len(best) < k + 1:
                best = nearest_ids(q, index.within(codes[q], coder.bits))
            out_node += [node] * len(best)
            out_score += [-s for s, _ in best]
            out_id += [x for _, x in best]
        return pa.table([pa.array(x, t) for x, t in zip((out_node, out_score, out_id), types, strict=True)], names)

    found = at_blocks.select("dims", "b", "g", "node", "v").groupBy("dims", "b", "g").cogroup(
        index.select(*(F.col(c).alias(f"{c}_") for c in ("dims", "b", "g", "v")), "ids").groupBy("dims_", "b_", "g_")
    ).applyInArrow(visit, "node string, score double, vec_id long")
    # k + 1 ids for each query vector: one of them may be the query itself
    once = found.groupBy("node", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    top = once.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return asked.join(top, "node").where("query_id <> vec_id") \
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def brute_force(rows: list[tuple], k: int = 5, every: int = 50) -> dict[int, list[tuple[int, float]]]:
    """The definition, for tests: query id -> its nearest (vec_id, score), by exact search."""
    good: dict[int, list[np.ndarray]] = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, dtype=np.float64))
    by_length: dict[int, tuple[list, list]] = {}
    for i, vs in good.items():
        for v in vs:
            ids, x = by_length.setdefault(len(v), ([], []))
            ids.append(i)
            x.append(v)
    stacked = {d: (ids, np.stack(x)) for d, (ids, x) in by_length.items()}
    out = {}
    for q in (i for i in good if i % every == 0):
        score: dict[int, float] = {}
        for v in good[q]:
            ids, x = stacked[len(v)]
            for i, c in zip(ids, cosines(v, x).tolist(), strict=True):
                if i != q:
                    score[i] = max(c, score.get(i, -2.0))
        out[q] = sorted(score.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out
