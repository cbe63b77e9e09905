"""Vector codes from codebooks that are learnt over cover trees (operator 12).

Vectors are cut into equal parts and each part gets a codebook by Lloyd's rounds. The rows of a task are taken in chunks, and each
part of a chunk is put into a cover tree once: a node covers its points within a power of two of its centre, its children's centres
lie farther apart than half of that, and the first child keeps the centre. Points lie in the tree's order beside their cumulative
sums, so a node's sum is a difference of two. In every round a node whose centre is nearer to one entry than to any other by more
than twice the node's radius goes to that entry whole, by the triangle inequality; other nodes descend, and only the points of
undecided leaves are compared with the entries one by one. Trees don't depend on codebooks, so they are stored and read in each round.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendrisk.llm.pretokens import spread
from lendrisk.llm.scratch import written

#: Most rows and components of a chunk, most points of a leaf, and most distances taken at a time.
CHUNK_ROWS, CHUNK_CELLS, LEAF_POINTS, MOST_DISTANCES = 4096, 1 << 21, 32, 1 << 20
#: Node columns: its points' first place and end, its children's first number and end (none: both 0), its radius.
NODE = np.dtype([("lo", "<i4"), ("hi", "<i4"), ("from", "<i4"), ("to", "<i4"), ("radius", "<f8")])


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: int64 products, or float64 ones where these are exact."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * most * most * max(a.shape[1], 1) < 1 << 53:
        a, b = a.astype(np.float64), b.astype(np.float64)
    return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)


@dataclass(frozen=True)
class CoverTree:
    """``points`` in tree order, ``order`` their rows in the chunk, and ``nodes``, parents before children, siblings together."""

    points: np.ndarray
    order: np.ndarray
    nodes: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> CoverTree:
        order = np.arange(len(points))
        nodes: list[list[float]] = [[0, len(points), 0, 0, 0.0]]
        at = 0
        while at < len(nodes):
            lo, hi = nodes[at][:2]
            mine = order[lo:hi]
            far = _from_first(points[mine])
            most = int(far.max(initial=0))
            nodes[at][4] = math.sqrt(most) * (1 + 1e-12)
            if hi - lo > LEAF_POINTS and most:
                # the power of two that covers the node, halved
                cover = 4.0 ** (math.ceil(math.log2(most) / 2) - 1)
                nodes[at][2], place = len(nodes), lo
                left = mine
                while len(left):
                    near = far <= cover
                    child, left = left[near], left[~near]
                    order[place : place + len(child)] = child
                    nodes.append([place, place + len(child), 0, 0, 0.0])
                    place += len(child)
                    far = _from_first(points[left])
                nodes[at][3] = len(nodes)
            at += 1
        return cls(points[order], order, np.array([tuple(x) for x in nodes], NODE))

    def nearest(self, entries: np.ndarray) -> np.ndarray:
        """The number of the nearest of ``entries`` for each point in tree order, the lower of equally near ones."""
        out = np.zeros(len(self.points), np.int64)
        open_ = np.zeros(1, np.int64)
        undecided = []
        while len(open_):
            nodes = self.nodes[open_]
            d = np.sqrt(_blocked(self.points[np.minimum(nodes["lo"], max(len(self.points) - 1, 0))], entries))
            best = d.argmin(axis=1)
            first = d[np.arange(len(d)), best]
            d[np.arange(len(d)), best] = np.inf
            second = d.min(axis=1)
            # far beyond what rounding can do
            margin = 1e-9 * (1 + first + nodes["radius"])
            whole = second - first > 2 * nodes["radius"] + margin
            sure = nodes[whole]
            size = (sure["hi"] - sure["lo"]).astype(np.int64)
            out[spread(sure["lo"].astype(np.int64), size)] = np.repeat(best[whole], size)
            nodes = nodes[~whole]
            leaf = nodes["to"] == 0
            undecided.append(nodes[leaf])
            inner = nodes[~leaf]
            open_ = spread(inner["from"].astype(np.int64), (inner["to"] - inner["from"]).astype(np.int64))
        rest = np.concatenate(undecided)
        rest = spread(rest["lo"].astype(np.int64), (rest["hi"] - rest["lo"]).astype(np.int64))
        out[rest] = _blocked(self.points[rest], entries).argmin(axis=1) if len(rest) else 0
        return out

    def sums(self, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """How many points each of ``n`` entries got, and their sum: runs of one entry are differences of cumulative sums."""
        total = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
        np.cumsum(self.points, axis=0, out=total[1:])
        opens = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
        ends = np.r_[opens[1:], len(own)][: len(opens)]
        sums = np.zeros((n, self.points.shape[1]), np.int64)
        np.add.at(sums, own[opens], total[ends] - total[opens])
        return np.bincount(own, minlength=n), sums


def _from_first(points: np.ndarray) -> np.ndarray:
    away = points - points[:1]
    return np.einsum("ij,ij->i", away, away)


def _blocked(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    step = max(1, MOST_DISTANCES // max(len(entries), 1))
    return np.concatenate([square_distances(points[k : k + step], entries) for k in range(0, max(len(points), 1), step)])


def scaled(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> tuple[DataFrame, int]:
    """(id, label, v) with v the vector's components as whole numbers, and the vectors' length; see ``coded`` for what is left out."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf)))
    usual = rows.groupBy(F.size(v).alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").first()
    length = usual["n"] if usual else 0
    most = math.isqrt((1 << 62) // max(length, 1)) // 2  # squared distances then fit 64 bits
    whole = F.transform(v, lambda x: F.floor(x * float(scale)))
    fits = F.forall(v, lambda x: F.abs(x * float(scale)) < float(most))
    checked = F.when(fits, whole).otherwise(F.raise_error(F.lit("a vector's component is too large for 64-bit distances")))
    return rows.where(F.size(v) == length).withColumn("v", checked.cast("array<bigint>")), length


def _matrix(lists: pa.Array, length: int, padded: int) -> np.ndarray:
    out = np.zeros((len(lists), padded), np.int64)
    if len(lists) and length:
        out[:, :length] = lists.flatten().to_numpy().reshape(len(lists), length)
    return out


def _planted(rows: DataFrame, parts: int, length: int, width: int) -> DataFrame:
    """A row per chunk of ``rows``: ids, labels, and each part's tree."""
    label = rows.schema["label"].dataType.simpleString()
    kind = rows.schema["id"].dataType.simpleString()
    step = max(64, min(CHUNK_ROWS, CHUNK_CELLS // max(parts * width, 1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = -(-batch.num_rows // step)
            for k in range(count):
                lo, hi = (batch.num_rows * x // count for x in (k, k + 1))
                part = batch.slice(lo, hi - lo)
                n = part.num_rows
                points = _matrix(part.column(2), length, parts * width)
                trees = [CoverTree.of(points[:, p * width : (p + 1) * width]) for p in range(parts)]
                stored = [(t.points.tobytes(), t.order.astype("<i4").tobytes(), t.nodes.tobytes()) for t in trees]
                ends = pa.array([0, n], pa.int32())
                yield pa.record_batch(
                    [
                        pa.ListArray.from_arrays(ends, part.column(0)),
                        pa.ListArray.from_arrays(ends, part.column(1)),
                        *(pa.array([[x[k] for x in stored]], pa.list_(pa.binary())) for k in range(3)),
                    ],
                    names=["ids", "labels", "points", "order", "nodes"],
                )

    schema = f"ids array<{kind}>, labels array<{label}>, points array<binary>, `order` array<binary>, nodes array<binary>"
    return rows.mapInArrow(work, schema)


def _trees(batch: pa.RecordBatch, row: int, width: int) -> Iterator[CoverTree]:
    for points, order, nodes in zip(*(batch.column(c)[row].as_py() for c in ("points", "order", "nodes")), strict=True):
        order = np.frombuffer(order, "<i4")
        yield CoverTree(np.frombuffer(points, np.int64).reshape(len(order), width), order, np.frombuffer(nodes, NODE))


def _round(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, position) after one round; the driver sees their sums alone."""
    parts, entries, width = books.shape
    there = chunks.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = there.value
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, tree in enumerate(_trees(batch, row, width)):
                    n, sums = tree.sums(tree.nearest(books[p]), entries)
                    count[p] += n
                    total[p] += sums
        part, entry = np.nonzero(count)
        sums = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(total[part, entry].ravel()))
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), sums]
        yield pa.record_batch(columns, names=["part", "entry", "n", "sums"])

    met = chunks.select("points", "order", "nodes").mapInArrow(work, "part int, entry int, n bigint, sums array<bigint>")
    sums = [F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width)]
    after = books.copy()
    for row in met.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # a row per entry
        after[row["part"], row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(width)]
    return after


def codebooks_of(rows: DataFrame, chunks: DataFrame, parts: int, entries: int, rounds: int, length: int, width: int) -> np.ndarray:
    """The codebooks after ``rounds`` rounds that start from the rows of least id."""
    first = rows.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).toArrow().column(0).combine_chunks()
    books = _matrix(first, length, parts * width).reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if books.size else 0):
        books = _round(chunks, books)
    return books


def digest(books: np.ndarray, length: int) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position, without the zeros that fill up a last part."""
    parts, _, width = books.shape
    kept = [books[p, :, : max(0, min(width, length - p * width))].ravel() for p in range(parts)]
    return hashlib.sha256(",".join(str(x) for part in kept for x in part.tolist()).encode()).hexdigest()


def coded(
    vectors: DataFrame,
    *,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray, int]:
    """Codes of ``vectors``: a stored table (id, label, code, error), the codebooks (part, entry, position), and the vectors' length.

    Components become floor(``scale`` x). Codebooks start from the ``entries`` (at most 256) kept rows of least id, null ids last and
    rows that repeat an id by their vectors. Each of ``rounds`` rounds gives every part to the nearest entry, the lower of equally
    near ones, and moves each entry to the componentwise floor of its parts' mean; an entry without parts stays. ``code`` holds an
    entry's number per part in two hex digits, ``error`` the squared distances summed. With fewer kept rows than ``entries`` there
    are as many entries as rows; an empty table gives no rows and no entries.

    Left out are vectors that are null or hold null or non-finite components, and those of another length than most (of lengths
    equally frequent the least counts), which no codebook fits; lengths that ``parts`` doesn't divide are filled up with zeros. Repeated
    rows and null ids and labels are coded like any other. Other columns are ignored, whatever their names. A component so large
    that squared distances might pass 64 bits stops the run with a message.

    The rows are stored once, in trees of at most 4096 rows; each round reads those and sends a sum per entry and task.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code's two hex digits hold 256 entries")
    rows, length = scaled(vectors, id_col, vector_col, label_col, scale)
    width = -(-length // parts)
    chunks = written(_planted(rows, parts, length, width))
    books = codebooks_of(rows, chunks, parts, entries, rounds, length, width)
    there = chunks.sparkSession.sparkContext.broadcast(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = there.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(row, 1).flatten() for c in ("ids", "labels"))
                code, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(_trees(batch, row, width)):
                    own = tree.nearest(books[p])
                    away = tree.points - books[p][own]
                    code[tree.order, p] = own
                    error[tree.order] += (away * away).sum(axis=1)
                text = code.tobytes().hex()
                codes = [text[k : k + 2 * parts] for k in range(0, len(text), 2 * parts)]
                yield pa.record_batch([ids, labels, pa.array(codes, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])

    kinds = [rows.schema[c].dataType.simpleString() for c in ("id", "label")]
    return written(chunks.mapInArrow(work, f"id {kinds[0]}, label {kinds[1]}, code string, error bigint")), books, length


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error summed over rows of equal label, null labels together."""
    sums = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
