"""Joins that survive a key holding a large share of all rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Parts into which a hot key's rows are dealt, and first merges of the tasks' summaries.
PARTS, MERGES = 64, 64


def hot_keys(
    df: DataFrame, columns: Sequence[str], *, min_share: float = 0.002, min_rows: int = 1_000_000
) -> dict[str, tuple[str, ...]]:
    """Values that hold at least ``min_share`` of the rows and at least ``min_rows`` rows, per column.

    One pass for all columns and no grouping by key: every task keeps a summary of its frequent values, of a size that depends on
    ``min_share`` alone, and summaries merge, in two steps, into one row. A summary of m values is wrong by at most 3.5 / m of
    the rows, and m is 16 / ``min_share``, so no value over the limits is missed; one a fifth below may be named too, which
    costs nothing: joins by named and unnamed keys give the same rows. NULL is never hot, as it joins nothing.
    """
    tracked = min(1_000_000, max(1000, round(16 / min_share)))
    most = min(tracked, max(100, round(2 / min_share)))
    summaries = [F.expr(f"approx_top_k_accumulate(`{name}`, {tracked})").alias(f"k{k}") for k, name in enumerate(columns)]
    by_part = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("part")).agg(F.count(F.lit(1)).alias("rows"), *summaries)
    merged = [
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(k{k}, {tracked}), {most})").alias(f"k{k}") for k in range(len(columns))
    ]
    # grouped, as a task without summaries has none to start a merge from
    found = by_part.groupBy(F.lit("all")).agg(F.sum("rows").alias("rows"), *merged).first()
    if found is None:
        return {name: () for name in columns}
    floor = max(min_rows, found["rows"] * min_share)
    return {
        name: tuple(sorted(item for item, count in found[f"k{k}"] if item is not None and count >= floor))
        for k, name in enumerate(columns)
    }


def join_unique(many: DataFrame, one: DataFrame, key: str, hot: Sequence[str] = (), parts: int = PARTS) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has few rows per key, usually one.

    ``one`` usually comes out of a grouping or a window on the same key. Its partitioning is then reused, but the
    adaptive skew split needs a fresh shuffle on both sides and cannot help. With ``hot`` keys both sides are dealt anew, in one
    join: a hot key's rows in ``many`` fall into ``parts`` parts by a hash of their columns, and its rows in ``one`` (no more
    than ``len(hot)`` keys have any) go to each part. Each side is read once, nothing is broadcast, and every matching pair meets
    in exactly one part, so the result does not depend on ``hot``.
    """
    if not hot:
        return many.join(one, key)
    is_hot = F.col(key).isin(*hot)
    part = F.when(is_hot, F.pmod(F.xxhash64(*many.columns), F.lit(parts))).otherwise(F.lit(0)).cast("int")
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    dealt = many.withColumn("_part", part)
    return dealt.join(one.withColumn("_part", F.explode(every)), [key, "_part"]).drop("_part")
