"""Token ids in shards with a minimal perfect hash index (operator 7).

A store is a folder of shards in ascending order of the document key, one row each in Parquet files, so that any file system Spark
reaches can hold it. A shard's payload is the raw little-endian ids of its documents, each document ended by an id; two bytes
an id if the vocabulary allows, else four. Its index maps a key to the place of its documents in constant time and holds no
keys itself: levels of bits give every key a number of its own from 0 to n - 1, under which a fingerprint of the key and the
first of its rows stand. A key that isn't there is told by the fingerprint, all but one in two thousand millions. Beside the index
a shard lists its rows' keys, from which the whole store is read back and a key that was found is told for certain. The rows of
one key may fill several shards, each of which has the key in its index; their bounds, the first and last key, tell which ones.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendrisk.llm.bpe import encode, vocabulary
from lendrisk.llm.pretokens import slices
from lendrisk.llm.words import mix

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Bits per key on each level, levels before the rest is listed, and ids in a shard before the next row opens another.
SPACE, MOST_LEVELS, SHARD_IDS = 2, 24, 1 << 20
#: Shards whose bounds may go to every task for keyed access: 16 MB.
MOST_SHARDS = 1_000_000
SHARD_SCHEMA = "part int, seq int, start_in_part bigint, n_ids bigint, first {kind}, last {kind}, keys array<{kind}>, hashes array<bigint>, row_starts array<bigint>, width int, payload binary, bits binary, level_sizes array<int>, rest array<bigint>, fingerprints array<int>, first_rows array<int>"


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = np.array([level + 1], np.uint64) * GOLDEN
    return (mix(hashes ^ salt) % np.uint64(size)).astype(np.int64)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes * GOLDEN + np.uint64(77)) >> np.uint64(33)).astype(np.int32)


@dataclass(frozen=True)
class PerfectHash:
    """Levels of bits, one after another; the keys that no level could part are listed in ``rest``."""

    bits: np.ndarray
    level_sizes: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        """Number the distinct ``hashes``: on each level, a key alone on its bit is settled."""
        parts, sizes, left = [], [], hashes
        while len(left) and len(sizes) < MOST_LEVELS:
            size = SPACE * len(left)
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(alone)
            sizes.append(size)
            left = left[~alone[at]]
        return cls(np.concatenate(parts) if parts else np.zeros(0, bool), np.array(sizes, np.int64), np.sort(left))

    @functools.cached_property
    def _before(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.bits)]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Each key's number. One that wasn't there at the start gets any number, or -1."""
        out, open_, first = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for level, size in enumerate(self.level_sizes.tolist()):
            at = first + _place(hashes[open_], level, size)
            hit = self.bits[at]
            out[open_[hit]] = self._before[at[hit]]
            open_, first = open_[~hit], first + size
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, hashes[open_]), len(self.rest) - 1)
            hit = self.rest[at] == hashes[open_]
            out[open_[hit]] = self._before[-1] + at[hit]
        return out


def _shard(part: int, seq: int, start: int, width: int, rows: list[tuple[object, int, np.ndarray]]) -> dict[str, object]:
    """A shard of (key, key's hash, ids) rows in order of the key."""
    hashes = np.array([h for _, h, _ in rows], np.int64).view(np.uint64)
    opens = np.flatnonzero([k == 0 or rows[k][0] != rows[k - 1][0] for k in range(len(rows))])
    index = PerfectHash.of(hashes[opens])
    number = index.numbers(hashes[opens])
    prints, first_rows = np.zeros(len(opens), np.int32), np.zeros(len(opens), np.int32)
    prints[number], first_rows[number] = _fingerprint(hashes[opens]), opens
    row_starts = np.cumsum([0, *(len(ids) for _, _, ids in rows)])
    ids = np.concatenate([ids for _, _, ids in rows])
    return {
        "part": part, "seq": seq, "start_in_part": start, "n_ids": len(ids), "first": rows[0][0], "last": rows[-1][0], "keys": [k for k, _, _ in rows],
        "hashes": hashes.view(np.int64), "row_starts": row_starts, "width": width,
        "payload": ids.astype("<u2" if width == 2 else "<u4").tobytes(), "bits": np.packbits(index.bits).tobytes(),
        "level_sizes": index.level_sizes, "rest": index.rest.view(np.int64), "fingerprints": prints, "first_rows": first_rows,
    }


def write_ids(
    documents: DataFrame,
    folder: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = 0,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode every whole text, append ``end_id``, and write the ids in ascending order of ``id_col`` to ``folder``.

    ``path`` is a byte-level BPE file of the tokenizers library, and the ids are that library's; the merges are run in batches
    over distinct words (``bpe.encode``), which takes a third less time than handing the library each word.

    Null and empty texts are the end id alone. Rows that repeat an id follow one another, ordered by the first 64 characters of
    their text, then by its hash; a null id comes first. An empty table writes an empty store. Ranges are drawn over id and text, so that the rows of one id are dealt
    to several tasks, unless they are equal. A task holds one shard at a time: ``shard_ids`` ids and one text's more.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    kind = documents.schema[id_col].dataType

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        width = 2 if max(vocabulary(path).size, end_id + 1) <= 1 << 16 else 4
        part, seq, start, held = TaskContext.get().partitionId(), 0, 0, 0
        open_: list[tuple[object, int, np.ndarray]] = []
        key_type = to_arrow_type(kind)
        types = {
            "part": pa.int32(), "seq": pa.int32(), "start_in_part": pa.int64(), "n_ids": pa.int64(), "first": key_type, "last": key_type,
            "keys": pa.list_(key_type), "hashes": pa.list_(pa.int64()), "row_starts": pa.list_(pa.int64()), "width": pa.int32(),
            "payload": pa.binary(), "bits": pa.binary(), "level_sizes": pa.list_(pa.int32()), "rest": pa.list_(pa.int64()),
            "fingerprints": pa.list_(pa.int32()), "first_rows": pa.list_(pa.int32()),
        }

        def flushed() -> pa.RecordBatch:
            shard = _shard(part, seq, start, width, open_)
            return pa.record_batch([pa.array([shard[name]], t) for name, t in types.items()], names=list(types))

        for batch in batches:
            for a, b in slices(batch.column(2)):
                piece = batch.slice(a, b - a)
                ids, first = encode(piece.column(2), path)
                for k, (key, hashed) in enumerate(zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)):
                    if held >= shard_ids:
                        yield flushed()
                        seq, start, held, open_ = seq + 1, start + held, 0, []
                    own = np.append(ids[first[k] : first[k + 1]], end_id)
                    open_.append((key, hashed, own))
                    held += len(own)
        if open_:
            yield flushed()

    ordered = documents.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("hash"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # equal rows may lie on both sides of a border, so each has a number; the driver draws the borders from keys without whole texts
    order = [F.col("id"), F.substring("text", 1, 64), F.xxhash64("text"), F.col("nth")]
    ordered = ordered.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("nth")
    schema = SHARD_SCHEMA.replace("{kind}", kind.simpleString())
    ordered.mapInArrow(rows, schema).write.option("compression", "zstd").parquet(folder)


def _loaded(shards: pa.RecordBatch, at: int) -> tuple[PerfectHash, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's index, fingerprints, first rows, row starts and payload, as arrays over the row that holds them."""
    numbers = {c: shards.column(c)[at].values.to_numpy() for c in ("level_sizes", "rest", "fingerprints", "first_rows", "row_starts")}
    bits, payload = (shards.column(c)[at].as_buffer() for c in ("bits", "payload"))
    sizes = numbers["level_sizes"].astype(np.int64)
    packed = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool)
    index = PerfectHash(packed, sizes, numbers["rest"].view(np.uint64))
    ids = np.frombuffer(payload, "<u2" if shards.column("width")[at].as_py() == 2 else "<u4")
    return index, numbers["fingerprints"], numbers["first_rows"].astype(np.int64), numbers["row_starts"], ids


def _first_rows(index: PerfectHash, prints: np.ndarray, first_rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Each key's first row by the index, or -1 for a key that isn't there."""
    number = index.numbers(hashes)
    known = number >= 0
    known[known] = prints[number[known]] == _fingerprint(hashes[known])
    return np.where(known, first_rows[np.maximum(number, 0)] if len(first_rows) else -1, -1)


def read_ids(spark: SparkSession, folder: str, *, id_col: str = "doc_id") -> DataFrame:
    """Every document of a store: (``id_col``, start, n_tokens, ids_crc32), looked up shard by shard through its index.

    start counts the ids of all documents before it in the store. n_tokens includes the end id. ids_crc32 is the unsigned crc32
    of the ids as little-endian unsigned 32-bit integers.
    """
    store = spark.read.parquet(folder)
    kind = store.schema["first"].dataType.simpleString()
    # a row per part of the store: as many as the writing tasks
    totals = {r[0]: r[1] for r in store.groupBy("part").agg(F.sum("n_ids")).collect()}
    base, before = {}, 0
    for part in sorted(totals):
        base[part], before = before, before + totals[part]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                index, prints, first_rows, row_starts, ids = _loaded(batch, at)
                hashes = batch.column("hashes")[at].values.to_numpy().view(np.uint64)
                found = _first_rows(index, prints, first_rows, hashes)
                # rows of one key follow its first
                nth = np.arange(len(found)) - np.maximum.accumulate(np.where(np.r_[True, found[1:] != found[:-1]], np.arange(len(found)), 0))
                opens, closes = row_starts[found + nth], row_starts[found + nth + 1]
                wide = ids.astype("<u4")
                crc = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(opens.tolist(), closes.tolist(), strict=True)]
                start = base[batch.column("part")[at].as_py()] + batch.column("start_in_part")[at].as_py() + opens
                yield pa.record_batch(
                    [batch.column("keys").slice(at, 1).flatten(), pa.array(start, pa.int64()), pa.array(closes - opens, pa.int64()), pa.array(crc, pa.int64())],
                    names=[id_col, "start", "n_tokens", "ids_crc32"],
                )

    return store.mapInArrow(rows, f"`{id_col}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def lookup(spark: SparkSession, folder: str, keys: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The ids of some documents: (``id_col``, ids array<bigint>), a row per row of the store with one of the ``keys``.

    Keys that the store doesn't hold give no row; repeated keys count once. Keys must be of the store's type, and null finds
    nothing. Only the shards that the keys fall into are read further than their bounds. A shard's arrays are used where they lie:
    of its keys and ids only those asked for become Python objects.
    """
    store = spark.read.parquet(folder).withColumn("shard", F.struct("part", "seq"))
    bounds = store.select("part", "seq", "first", "last").orderBy("part", "seq").limit(MOST_SHARDS + 1).collect()
    if len(bounds) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards: write larger ones")
    kind = store.schema["first"].dataType.simpleString()
    # rows without an id come first, so the shards that begin or end with one do
    firsts, lasts = ([b[c] for b in bounds if b[c] is not None] for c in ("first", "last"))
    places = spark.sparkContext.broadcast((firsts, lasts, [(b.part, b.seq) for b in bounds]))

    @F.arrow_udf("array<struct<part:int,seq:int>>")
    def shards_of(wanted: pa.Array) -> pa.Array:
        firsts, lasts, shards = places.value
        n = len(shards)
        found = [shards[n - len(lasts) + bisect_left(lasts, key) : n - len(firsts) + bisect_right(firsts, key)] for key in wanted.to_pylist()]
        kind = pa.list_(pa.struct([("part", pa.int32()), ("seq", pa.int32())]))
        return pa.array([[{"part": part, "seq": seq} for part, seq in x] for x in found], kind)

    asked = keys.select(F.col(id_col).cast(kind).alias("key")).where("key is not null").distinct()
    # a key of very many rows lies in several shards
    asked = asked.withColumn("shard", F.explode(shards_of("key"))).withColumn("hash", F.xxhash64("key"))

    def block(shards: pa.Table, wanted: pa.Table) -> pa.Table:
        out = {id_col: [], "ids": []}
        rows = shards.combine_chunks().to_batches()
        for batch, at in ((batch, at) for batch in rows for at in range(batch.num_rows)):
            index, prints, first_rows, row_starts, ids = _loaded(batch, at)
            keys = batch.column("keys")[at].values
            found = _first_rows(index, prints, first_rows, wanted.column("hash").to_numpy().view(np.uint64))
            for key, row in zip(wanted.column("key").to_pylist(), found.tolist(), strict=True):
                while 0 <= row < len(keys) and keys[row].as_py() == key:
                    out[id_col].append(key)
                    out["ids"].append(ids[row_starts[row] : row_starts[row + 1]].tolist())
                    row += 1
        return pa.table({id_col: pa.array(out[id_col], shards.schema.field("first").type), "ids": pa.array(out["ids"], pa.list_(pa.int64()))})

    there = store.join(asked.select("shard").distinct(), "shard", "left_semi")
    return there.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(block, f"`{id_col}` {kind}, ids array<bigint>")
