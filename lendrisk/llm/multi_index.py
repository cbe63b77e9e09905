"""Approximate nearest neighbours by an inverted multi-index (operator 5).

Unit vectors are cut in two halves, each quantised by a codebook of its own; the pair of nearest centroids is a vector's cell. A
query meets the cells in order of the summed distance of their two centroids, by a heap, until they hold enough vectors, and
those are compared exactly, on the original vectors in double precision. Queries and cells meet in blocks of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendrisk.llm.pretokens import spread
from lendrisk.llm.scratch import written

#: Most rows of a cell, and most queries, that meet in one block.
BLOCK_ROWS, BLOCK_QUERIES = 4096, 2048


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _square_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2 * x @ centres.T


@dataclass(frozen=True)
class Codebooks:
    """The centroids of the two halves."""

    halves: tuple[np.ndarray, np.ndarray]

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = unit.shape[1] // 2
        return _square_distances(unit[:, :cut], self.halves[0]), _square_distances(unit[:, cut:], self.halves[1])

    def cells(self, unit: np.ndarray) -> np.ndarray:
        one, two = self.distances(unit)
        return one.argmin(axis=1) * len(self.halves[1]) + two.argmin(axis=1)

    def reach(self, unit: np.ndarray, sizes: np.ndarray, wanted: float) -> tuple[np.ndarray, np.ndarray]:
        """Per query the summed distance up to which the cells hold ``wanted`` vectors, and which first centroids have such cells.

        Cells are met in order of their summed distance, from a heap; a cell's two distances say whether it was met.
        """
        one, two = self.distances(unit)
        bound = np.zeros(len(unit))
        width = len(self.halves[1])
        for at in range(len(unit)):
            rank_one, rank_two = np.argsort(one[at], kind="stable"), np.argsort(two[at], kind="stable")
            first, second = one[at][rank_one].tolist(), two[at][rank_two].tolist()
            held = sizes.reshape(-1, width)[rank_one][:, rank_two].tolist()
            heap, seen = [(first[0] + second[0], 0, 0)], 0
            # a pair is offered by the one before it in the row, rows by their first pair: each once
            while heap and seen < wanted:
                bound[at], i, j = heapq.heappop(heap)
                seen += held[i][j]
                if j + 1 < width:
                    heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
                if j == 0 and i + 1 < len(first):
                    heapq.heappush(heap, (first[i + 1] + second[0], i + 1, 0))
        bound += 1e-9  # so that rounding loses no cell
        return bound, one + two.min(axis=1, keepdims=True) <= bound[:, None]


def _k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids from evenly spaced starting rows; a centroid without rows moves to the row farthest from its own."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        d = _square_distances(x, centres)
        own = d.argmin(axis=1)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
        far = np.argsort(d[np.arange(len(x)), own])[::-1]
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[far[: len(empty)]]
    return centres


def usable(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column) -> DataFrame:
    """(id, vector, asked) of distinct rows with an id and a vector that is not null, zero, or with null or non-finite parts.

    Vectors of another length than most rows have (of lengths equally frequent the least counts) take no part either, be they queries
    or candidates, as they can't be compared. ``asked`` says whether any row of that id and vector is a query.
    """
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asked"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))
    length = rows.groupBy(F.size(v).alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1)
    kept = rows.join(F.broadcast(length), F.size(v) == F.col("n"), "left_semi")
    return kept.groupBy("id", "vector").agg(F.coalesce(F.bool_or("asked"), F.lit(False)).alias("asked"))


def _collected(df: DataFrame) -> np.ndarray:
    table = df.select("vector").toArrow()
    return _matrix(table.column(0).combine_chunks()) if table.num_rows else np.zeros((0, 0))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    share: float = 0.6,
    least: int = 0,
    sample: int = 8192,
) -> DataFrame:
    """The ``k`` nearest found of each query: (query_id, rank, ``id_col``, score), by falling cosine, ties by smaller id.

    ``is_query`` is a condition on ``vectors``. Candidates are all rows but those with the query's own id; rows that repeat an id
    and its vector count once. Codebooks are learnt from at most ``sample`` vectors, spread by a hash of the id; every usable row is
    indexed, in 5.5 n^0.23 cells a half (at most 1,024). A query reads cells until they hold the ``share`` of all vectors, at every
    size, and ``least`` vectors if that is given. The default share suits vectors without any structure to index, where nearer cells hold little more of the nearest;
    lower it for others and measure the recall. Of equal vectors only the k + 1 of least id can be among the nearest, and only those
    are indexed. Null ids and vectors that can't be compared take no part (``usable``); other columns are ignored.
    """
    spark = vectors.sparkSession
    part = written(usable(vectors, id_col, vector_col, is_query))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = written(part.withColumn("nth", place).where(F.col("nth") <= k + 1).select("id", "vector"))
    asked = part.where("asked").select("id", "vector")
    n = rows.count()
    thinned = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 2 * sample / max(n, 1)))
    seen = _collected(rows.where(thinned).orderBy(F.xxhash64("id"), "id").limit(sample))
    out = f"query_id bigint, rank int, `{id_col}` bigint, score double"
    if not len(seen):
        return spark.createDataFrame([], out)
    seen = _unit(seen)
    centres = min(len(seen), 1024, math.ceil(5.5 * n**0.23))
    cut = seen.shape[1] // 2
    books = spark.sparkContext.broadcast(Codebooks((_k_means(seen[:, :cut], centres), _k_means(seen[:, cut:], centres))))

    @F.arrow_udf("int")
    def cell_of(x: pa.Array) -> pa.Array:
        return pa.array(books.value.cells(_unit(_matrix(x))) if len(x) else [], pa.int32())

    index = rows.withColumn("cell", cell_of("vector"))
    index = written(index.select("id", "vector", F.floor(F.col("cell") / centres).cast("int").alias("row"), "cell"))
    sizes = np.zeros(centres * centres, np.int64)
    for row in index.groupBy("cell").count().collect():  # at most 2**20 cells
        sizes[row[0]] = row[1]
    sizes_there = spark.sparkContext.broadcast(sizes)
    wanted = max(least, share * n)

    @F.arrow_udf("struct<bound:double,rows:array<int>>")
    def reach(x: pa.Array) -> pa.Array:
        found = zip(*books.value.reach(_unit(_matrix(x)), sizes_there.value, wanted), strict=True) if len(x) else ()
        out = [{"bound": bound, "rows": np.flatnonzero(near).tolist()} for bound, near in found]
        return pa.array(out, pa.struct([("bound", pa.float64()), ("rows", pa.list_(pa.int32()))]))

    # a query meets the cells of one first centroid together; the heaps of many queries are worked through in many tasks
    spread_out = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    probes = written(spread_out.withColumn("met", reach("vector")).select("id", "vector", "met.bound", F.explode("met.rows").alias("row")))
    shape = index.groupBy("row").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("row_blocks"))
    load = probes.groupBy("row").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("query_blocks"))
    shape = written(shape.join(load, "row"))  # at most a row per centroid

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one of its own blocks, once for each block of the other side."""
        block = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        kept = [c for c in df.columns if c != "row"]
        return df.join(F.broadcast(shape), "row").select("row", block.alias(own), copies.alias(other), *kept)

    def block(entries: pa.Table, queries: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if entries.num_rows and queries.num_rows:
            entries = entries.sort_by("cell")
            ids, cells = entries.column("id").to_numpy(), entries.column("cell").to_numpy()
            x, q = (_matrix(t.column("vector").combine_chunks()) for t in (entries, queries))
            x, q = x / np.abs(x).max(axis=1, keepdims=True), q / np.abs(q).max(axis=1, keepdims=True)
            x_norm, q_norm = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", q, q))
            row = entries.column("row")[0].as_py()
            one, two = books.value.distances(_unit(q))
            near = one[:, row, None] + two <= queries.column("bound").to_numpy()[:, None]
            for at, own in enumerate(queries.column("id").to_pylist()):
                met = row * centres + np.flatnonzero(near[at])
                opens = np.searchsorted(cells, met)
                those = spread(opens, np.searchsorted(cells, met, "right") - opens)
                those = those[ids[those] != own]
                # einsum sums every pair in the same order, so that equal vectors tie
                score = np.einsum("ij,j->i", x[those], q[at]) / (x_norm[those] * q_norm[at])
                if len(those) > 4 * k:
                    high = score >= np.partition(score, len(score) - k)[len(score) - k]
                    those, score = those[high], score[high]
                lead = np.lexsort((ids[those], -score))[:k]
                found.append((np.full(len(lead), own), ids[those[lead]], score[lead]))
        q_ids, ids, score = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"query_id": pa.array(q_ids, pa.int64()), "id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})

    keys = ["row", "row_blocks", "query_blocks"]
    entries = dealt(index, "row_blocks", "query_blocks").groupBy(*keys)
    queries = dealt(probes, "query_blocks", "row_blocks").groupBy(*keys)
    met = entries.cogroup(queries).applyInArrow(block, "query_id bigint, id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = met.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
