"""Near-duplicate documents by 64-bit fingerprints that differ in few bits.

*Fingerprints.*  A text is the list of its shingles of three words, repeats included; each shingle is hashed (XXH64,
seed 42) and a bit of the fingerprint is 1 if it is set in more than half of the hashes.  Equal fingerprints are
one node from the start.

*Embedding.*  A fingerprint is cut into 32 segments of two bits, and each segment is mapped to its number of set
bits, 0 to 2.  Changing one bit changes one number by one, so the Manhattan distance of two embeddings never
exceeds the number of bits in which the fingerprints differ.  The numbers are stored in unary (0: 00, 1: 01, 2: 11) in
one 64-bit word: the Manhattan distance is then the number of differing bits of two such words.

*Grid range-join.*  The 32 axes form ``GROUPS`` groups.  Points within Manhattan distance ``r`` agree on all
but ``r`` groups, so every choice of ``r`` groups is a grid whose cells fix the other axes and leave those of the choice
open, and each pair in range meets in a cell of one of the grids (15 grids of cells of 10 or 11 open
axes for ``r = 2``).  Within a cell the range condition is tested on the embeddings, and what passes is verified
on the fingerprints.  A cell is an equality key, so the join is one shuffle; cells of one point are dropped
before Python sees them.

*Large cells.*  Cells of up to ``DENSE`` points compare their points in vectors.  A larger one
looks up, for each point, all 2,081 fingerprints within two bits (sorted search), so its cost grows with its points
and not with their square.  A cell above ``SPLIT`` points is dealt once more, by the raw bits: the fingerprint is
cut into three parts of which one must be equal.  No point is left out of anything.

*Components.*  A cell hands on one link a point at most, to the smallest point of its component in the cell.
The links are contracted over all cells by rounds of large and small stars, each written to the shared folder, until
nothing changes.

Edge cases: A-Z only are lower-cased; one or two words are one shingle; without words (null, empty, blank) the
fingerprint is zero and is linked like any other; rows repeat in the result as they do in the input; a document without
an id gets a row, and a component without any id has a null one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, stored, stored_and_measured

RADIUS = 2
GROUPS = 6
#: Points of a cell that are compared with each other, and points of a cell that is dealt by raw bits.
DENSE, SPLIT = 2_000, 200_000
#: Share of the rows from which a fingerprint counts as hot: there are fewer than this many of them.
HOT_SHARE = 1_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_ODD = 0x5555555555555555
_SHINGLES_AT_ONCE = 65_536
_ROWS_AT_ONCE = 50_000


# --- fingerprints ------------------------------------------------------------------------------


def fingerprint(text: bytes | None, n: int = 3) -> int:
    """The fingerprint of one text (UTF-8) as an unsigned number."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(n, len(words))
    stops = ends[size - 1:].tolist()
    starts = [0, *(ends[:len(words) - size] + 1).tolist()]
    digest, total = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for k in range(0, len(stops), _SHINGLES_AT_ONCE):
        hashes = b"".join([digest(line[a:b], 42) for a, b in zip(starts[k:k + _SHINGLES_AT_ONCE], stops[k:k + _SHINGLES_AT_ONCE])])
        total += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(stops)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        mark, "doc_id long, fp long")


# --- embedding and grids -----------------------------------------------------------------------


def embed(fp: np.ndarray) -> np.ndarray:
    """The bit counts of the 32 segments in unary, two bits each."""
    one = np.uint64(1)
    odd = np.uint64(_ODD)
    return (fp | fp >> one) & odd | (fp & fp >> one & odd) << one


#: The same as a Spark expression of ``fp``.
_EMBED = (f"((fp | shiftrightunsigned(fp, 1)) & {_ODD}L)"
          f" | shiftleft(fp & shiftrightunsigned(fp, 1) & {_ODD}L, 1)")


def grids(radius: int = RADIUS, groups: int = GROUPS) -> list[int]:
    """For every choice of ``radius`` groups of axes the bits of all the other axes, as a signed long."""
    bounds = [2 * round(32 * k / groups) for k in range(groups + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    out = []
    for left_open in combinations(masks, radius):
        fixed = ((1 << 64) - 1) & ~sum(left_open)
        out.append(fixed - (1 << 64) if fixed >> 63 else fixed)
    return out


def _parts(radius: int) -> list[int]:
    """Masks that cut 64 bits into ``radius + 1`` parts, as signed longs."""
    bounds = [64 * k // (radius + 1) for k in range(radius + 2)]
    masks = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def in_cells(points: DataFrame, radius: int = RADIUS, groups: int = GROUPS, split: int = SPLIT) -> DataFrame:
    """(grid, cell, part, fp): the cells of at least two points, each with its points."""
    masks = ", ".join(f"struct({i} AS grid, e & {m}L AS cell)" for i, m in enumerate(grids(radius, groups)))
    rows = points.selectExpr("fp", f"{_EMBED} AS e").selectExpr("fp", f"explode(array({masks})) AS c").selectExpr(
        "c.grid AS grid", "c.cell AS cell", "fp")
    sizes = rows.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = rows.join(sizes, ["grid", "cell"])
    raw = ", ".join(f"struct({i} AS k, fp & {m}L AS part)" for i, m in enumerate(_parts(radius)))
    dealt = f"CASE WHEN size > {split} THEN array({raw}) ELSE array(struct(-1 AS k, 0L AS part)) END"
    return met.selectExpr("grid", "cell", "fp", f"explode({dealt}) AS p").selectExpr("grid", "cell", "p.k AS k", "p.part AS part", "fp")


# --- links within cells ------------------------------------------------------------------------


def _join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the components of ``i`` and ``j``; every label is the smallest position of its component."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def near_masks(radius: int = RADIUS) -> np.ndarray:
    """All 64-bit words with one to ``radius`` bits set."""
    return np.array([sum(1 << b for b in bits) for k in range(1, radius + 1) for bits in combinations(range(64), k)], np.uint64)


def links(cell: np.ndarray, fp: np.ndarray, radius: int = RADIUS, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray]:
    """(fp, smallest fp of its component in the cell) of linked points.  ``cell`` numbers the cells in
    ascending order, ``fp`` ascends within a cell."""
    label = np.arange(len(fp))
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    size = np.diff(np.append(first, len(fp)))
    large = size > dense
    u = embed(fp)
    left = np.where(np.repeat(large, size), 0, np.repeat(first + size, size) - np.arange(len(fp)) - 1)  # points after this one
    i = np.flatnonzero(left > 0)
    step = 1
    while len(i):
        j = i + step
        near = np.bitwise_count(u[i] ^ u[j]) <= radius  # the Manhattan distance of the embeddings
        a, b = i[near], j[near]
        same = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        if same.any():
            _join_labels(label, a[same], b[same])
        step += 1
        i = i[left[i] >= step]
    for k in np.flatnonzero(large):
        own = fp[first[k]:first[k] + size[k]]
        for mask in near_masks(radius):
            at = np.searchsorted(own, own ^ mask)
            at[at == len(own)] = 0
            hit = np.flatnonzero(own[at] == own ^ mask)
            if len(hit):
                _join_labels(label, first[k] + hit, first[k] + at[hit])
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def cell_links(cells: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """(u, v), ``u > v`` by their bits: the links of all cells, at most one a point and cell."""
    key = ["grid", "cell", "k", "part"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(table: pa.Table) -> pa.RecordBatch:
            columns = [table.column(c).to_numpy() for c in key]
            new = np.zeros(table.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            number = np.cumsum(new)
            fp = table.column("fp").to_numpy().view(np.uint64)
            order = np.lexsort((fp, number))
            u, v = links(number[order], fp[order], radius, dense)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64), pa.int64()) for x in (u, v)], ["u", "v"])

        def last_cell(table: pa.Table) -> int:
            """Where the last cell starts: the next batch may go on with it."""
            same = np.ones(table.num_rows, bool)
            for c in key:
                x = table.column(c).to_numpy()
                same &= x == x[-1]
            return int(np.argmin(same[::-1])) if not same.all() else table.num_rows

        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in released(batches):
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
            if rows < _ROWS_AT_ONCE:
                continue
            held = pa.Table.from_batches(waiting).combine_chunks()
            keep = last_cell(held)
            if keep < held.num_rows:
                yield linked(held.slice(0, held.num_rows - keep))
            rest = held.slice(held.num_rows - keep).combine_chunks()
            # a long cell waits until it has doubled, so it is copied a few times only
            waiting, rows = rest.to_batches(), min(0, _ROWS_AT_ONCE - keep)
        if waiting:
            yield linked(pa.Table.from_batches(waiting).combine_chunks())

    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(find, "u long, v long")


# --- components --------------------------------------------------------------------------------


def components(links: DataFrame, u: str = "u", v: str = "v", label: str = "components") -> DataFrame:
    """(u, v) for links between numbers: the smallest number ``v`` of the component of every ``u`` but itself.

    Alternating large and small stars: each round points the larger neighbours of a node at its smallest one,
    then its smaller ones.  Every round is written to the shared folder, and rounds end when the links no longer change."""
    edges = links.selectExpr(f"greatest({u}, {v}) AS u", f"least({u}, {v}) AS v").where("u <> v").distinct()
    edges, *seen = stored_and_measured(edges, label)
    while seen[0]:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("v AS u", "m AS v").where("u <> v").unionByName(low.selectExpr("u", "m AS v")).distinct()
        edges, *now = stored_and_measured(small, label)
        if now == seen:
            break
        seen = now
    return edges


def near_duplicates(docs: DataFrame, radius: int = RADIUS, groups: int = GROUPS, id_col: str = "doc_id",
                    text_col: str = "text", shingle: int = 3, dense: int = DENSE, split: int = SPLIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id reachable) of every row."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle), "simhash-marked")
    points = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-points")
    found = components(cell_links(in_cells(points.select("fp"), radius, groups, split), radius, dense), label="simhash-links")
    members = found.selectExpr("u AS fp", "v AS root").unionByName(found.selectExpr("v AS fp", "v AS root").distinct())
    ids = members.join(points.select("fp", "first"), "fp").groupBy("root").agg(F.min("first").alias("component"))
    linked = members.join(ids, "root").select("fp", "component")
    own = stored(points.join(linked.withColumn("in", F.lit(True)), "fp", "left").selectExpr(
        "fp", "n", "IF(in, component, first) AS component_id"), "simhash-classes")
    # a fingerprint of a thousandth of the rows or more is met by a broadcast: there are fewer than a thousand
    total = own.agg(F.sum("n")).first()[0] or 0
    hot = own.where(F.col("n") * HOT_SHARE > F.lit(total)).select("fp", "component_id")
    cold = own.join(F.broadcast(hot.select("fp")), "fp", "left_anti").select("fp", "component_id")
    often = marked.join(F.broadcast(hot), "fp")
    rest = marked.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(cold, "fp")
    return often.unionByName(rest).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")


def brute_force(rows, radius: int = RADIUS, shingle: int = 3) -> list[tuple]:
    """The definition over (doc_id, text) rows, pair by pair, for tests."""
    import re

    cut = re.compile(r"[^\x20\x09-\x0D]+")
    lower = {c: c + 32 for c in range(65, 91)}
    prints = []
    for _, text in rows:
        words = cut.findall((text or "").translate(lower))
        own = [words[i:i + shingle] for i in range(max(len(words) - shingle + 1, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in own]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids, default=None)))
    return out
