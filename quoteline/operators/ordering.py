"""Row numbers in the order of a sorted DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_positions(ordered: DataFrame, out: str = "position") -> DataFrame:
    """``ordered`` with the place of each row in its output order, from 1.

    For a frame that ends in a sort.  A global sort leaves ranges of rows in the order of the partitions: the
    number within a partition plus the rows of all partitions before it is the place.  One row a partition is
    counted and added up; no window sees all rows, and nothing is collected.  ``ordered`` must give the same order every time
    it is computed (a sort on a unique key).
    """
    # monotonically_increasing_id: the partition in the upper bits, the number within it in the lower 33
    marked = ordered.withColumn("_at", F.monotonically_increasing_id()).selectExpr(
        "* EXCEPT (_at)", "shiftright(_at, 33) AS _part", f"(_at & {(1 << 33) - 1}L) AS _own")
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return marked.join(offsets, "_part").selectExpr("* EXCEPT (_part, _own, _before)", f"_before + _own + 1 AS {out}")
