"""A row's place in a global order, as data."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a row's number within its task, as ``monotonically_increasing_id`` lays them out.
ROW_BITS = 33


def with_position(df: DataFrame, *order: Column | str, store: Callable[[DataFrame], DataFrame], name: str = "position") -> DataFrame:
    """The rows of ``df`` with their place, from 1, in the given order (O1-O3).

    No window runs over everything: rows are range-partitioned and sorted, numbered within their range, and stored by ``store``
    once; the ranges' row counts, one number per range, then give each range what lies before it. Rows that are equal in
    ``order`` get places in some order, so end it in a key if places must be the same in every run.
    """
    numbered = store(df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", ROW_BITS).alias("_part")
    before, offsets = 0, []
    # a row per range
    for number, rows in sorted(numbered.groupBy(part).agg(F.count(F.lit(1))).collect()):
        offsets.append((number, before))
        before += rows
    ranges = df.sparkSession.createDataFrame(offsets, "_part bigint, _before bigint")
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    placed = numbered.withColumn("_part", part).join(F.broadcast(ranges), "_part")
    return placed.select(*df.columns, place.alias(name))
