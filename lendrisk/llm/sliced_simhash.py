"""Near copies by SimHash fingerprints that are compared bit plane by bit plane (operator 13).

A fingerprint has a bit for each of 64 places: whether more than half of a text's shingle hashes have it. Distinct fingerprints meet
where two of five groups of places agree, which any two within three differing bits do, as three bits can't spoil four groups.
Fingerprints that meet are compared in slices: a word of a bit plane holds one place of 64 neighbours, an exclusive-or with a
fingerprint's own bit marks the neighbours that differ there, and a carry-save counter (ones, twos, more) adds the mark for all 64 at
once. A word whose neighbours all differ in more places than allowed is abandoned, and the places by which they met are skipped.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendrisk.llm.components import components
from lendrisk.llm.pretokens import slices
from lendrisk.llm.scratch import written
from lendrisk.llm.words import BREAKS, words_of

BITS, RADIUS, WORDS, SEED = 64, 3, 3, 42
#: A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: The groups of places, and the pairs of groups by which fingerprints meet.
GROUPS = [np.arange(BITS * g // 5, BITS * (g + 1) // 5) for g in range(5)]
MEETINGS = list(itertools.combinations(range(5), 2))
#: Fingerprints of one key that are compared in one task, and words of 64 neighbours compared at a time.
CELL_ROWS, MOST_WORDS = 4096, 1 << 18
#: Hashes whose bits are counted at a time, and planes between two looks for words to abandon.
COUNTED, LOOK = 1 << 14, 4
ALL = np.uint64(2**64 - 1)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of each text (null: empty)."""
    words = words_of(texts, BREAKS, LOWER)
    n_words = np.diff(words.first)
    raw = words.raw
    # the words with one space between: their bytes one after another, each followed by a space
    size = words.end - words.begin
    ends = np.cumsum(size + 1)
    begins = ends - size - 1
    joined = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    inside = ~BREAKS[raw]
    place = np.ones(len(joined), bool)
    place[ends - 1] = False
    joined[place] = raw[inside]
    data = joined.tobytes()
    shingles = np.where(n_words > 0, np.maximum(n_words - WORDS + 1, 1), 0)
    own = np.repeat(np.arange(len(n_words)), shingles)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    opens = words.first[own] + nth
    closes = np.minimum(opens + WORDS, words.first[own + 1]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[a:b], SEED) for a, b in zip(begins[opens].tolist(), (ends[closes] - 1).tolist(), strict=True)), np.uint64, len(own)
    )
    set_ = np.zeros((len(n_words), BITS), np.int64)
    for k in range(0, len(hashes), COUNTED):
        bits = np.unpackbits(hashes[k : k + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        mine = own[k : k + COUNTED]
        starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        set_[mine[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits(2 * set_ > shingles[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _planes(prints: np.ndarray) -> np.ndarray:
    """(bit, word): place ``bit`` of 64 consecutive fingerprints in each word."""
    words = -(-len(prints) // 64)
    bits = np.zeros((words * 64, BITS), np.uint8)
    bits[: len(prints)] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8").reshape(BITS, words)


def close_pairs(prints: np.ndarray, opens: np.ndarray, closes: np.ndarray, skip: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs (i, j) with j in ``opens[i]:closes[i]`` whose fingerprints differ in ``RADIUS`` bits or fewer.

    ``skip[i]`` has the bits that need no comparison as i and all its j agree there; only bits that all rows skip are passed over.
    """
    planes = _planes(prints)
    first, last = opens // 64, np.where(closes > opens, -(-closes // 64), opens // 64)
    ends = np.cumsum(last - first)
    used = np.flatnonzero(((np.bitwise_and.reduce(skip) if len(skip) else ALL) >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1) == 0)
    at = 0
    while at < len(prints):
        # rows of at most so many words, or one row
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + MOST_WORDS, "right")))
        n = (last - first)[at:end]
        row = np.repeat(np.arange(at, end), n)
        word = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + first[row]
        at = end
        # neighbours out of reach count as too far from the start
        low, high = np.clip(opens[row] - word * 64, 0, 64), np.clip(closes[row] - word * 64, 0, 64)
        ones = np.zeros(len(row), np.uint64)
        twos, more = ones.copy(), ~(_below(high) & ~_below(low))
        for k, bit in enumerate(used):
            mine = (prints[row] >> np.uint64(bit)) & np.uint64(1)
            differ = planes[bit, word] ^ (np.uint64(0) - mine)
            carry = ones & differ
            ones ^= differ
            more |= twos & carry
            twos ^= carry
            if k % LOOK == LOOK - 1:
                live = more != ALL
                if live.sum() < 0.8 * len(live):
                    row, word, ones, twos, more = row[live], word[live], ones[live], twos[live], more[live]
        found = np.flatnonzero(more != ALL)
        lanes = np.unpackbits((~more[found]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, lane = np.nonzero(lanes)
        a, b = row[found[which]], word[found[which]] * 64 + lane
        # rows that came together by a clash of hashed keys don't agree where nothing was compared
        true = np.bitwise_count(prints[a] ^ prints[b]) <= RADIUS
        yield a[true], b[true]


def _below(n: np.ndarray) -> np.ndarray:
    """Words with the ``n`` lowest bits set, n from 0 to 64."""
    n = n.astype(np.uint64)
    return np.where(n >= 64, ALL, (np.uint64(1) << np.minimum(n, np.uint64(63))) - np.uint64(1))


class Forest:
    """Which of n nodes are joined; ``roots`` holds the least node of each one's tree."""

    def __init__(self, n: int):
        self.roots = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.roots[a], self.roots[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.roots, np.maximum(x, y), np.minimum(x, y))
            while (self.roots[self.roots] != self.roots).any():
                self.roots = self.roots[self.roots]


def _met(batch_keys: np.ndarray, sides: np.ndarray, meetings: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is similar within each run of equal keys: each fingerprint with the least one it hangs together with.

    Rows come by key and side. A run of one side is compared within itself, one of two sides across them.
    """
    n = len(prints)
    opens = np.flatnonzero(np.r_[True, batch_keys[1:] != batch_keys[:-1]])
    run = np.repeat(np.arange(len(opens)), np.diff(np.r_[opens, n]))
    start = opens[run]
    middle = opens + np.add.reduceat(sides == 0, opens)  # where a run's second side begins
    second = sides == 1
    low = start
    high = np.where(second, middle[run], np.arange(n))
    high = np.where(~second & np.isin(run, run[second]), low, high)
    known = np.zeros(len(MEETINGS), np.uint64)
    for k, groups in enumerate(MEETINGS):
        for bit in np.concatenate([GROUPS[g] for g in groups]):
            known[k] |= np.uint64(1) << np.uint64(bit)
    forest = Forest(n)
    for a, b in close_pairs(prints, low, high, known[meetings]):
        forest.join(a, b)
    linked = np.flatnonzero(forest.roots != np.arange(n))
    return prints[linked], prints[forest.roots[linked]]


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``prints`` (fp) that join all that are linked, stored.

    No link between different fingerprints is lost, but a task's links are cut down to one per fingerprint, to the least it hangs
    together with there. A key that very many fingerprints share is dealt out: its fingerprints fall into parts of about
    ``CELL_ROWS`` and each pair of parts meets in a cell of its own.
    """
    masks = [sum(1 << int(b) for g in groups for b in GROUPS[g]) for groups in MEETINGS]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    meetings = F.array(*(F.struct(F.lit(k).cast("tinyint").alias("meeting"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed)))
    keyed = prints.select("fp", F.explode(meetings).alias("m")).select("fp", "m.*")
    parts = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    shared = written(keyed.groupBy("meeting", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("meeting", "key", parts.alias("parts")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    met = keyed.join(shared, ["meeting", "key"]).withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.xxhash64("meeting", "key", F.least("own", "other"), F.greatest("own", "other"))
    met = met.select(cell.alias("cell"), "meeting", (F.col("own") > F.col("other")).cast("tinyint").alias("side"), "fp")
    dealt = met.repartition("cell").sortWithinPartitions("meeting", "cell", "side", "fp")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in itertools.chain(batches, [None]):
            table = pa.concat_tables([t for t in (held, pa.Table.from_batches([batch]) if batch is not None else None) if t is not None]) if held or batch else None
            if table is None or not table.num_rows:
                continue
            # the last cell may go on in the next batch
            cells = table.column("cell").to_numpy()
            whole = len(cells) if batch is None else int((np.flatnonzero(cells[1:] != cells[:-1]) + 1)[-1:].sum())
            held = table.slice(whole)
            if whole:
                columns = (table.column(c).slice(0, whole).to_numpy() for c in ("cell", "side", "meeting", "fp"))
                cell, side, meeting, fp = columns
                a, b = _met(cell, side, meeting, fp.view(np.uint64))
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return written(dealt.mapInArrow(work, "a bigint, b bigint").distinct())


def near_copies(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fingerprint, component_id) of each row of ``documents``.

    A-Z are lower-cased, words are runs of characters other than ASCII white space of the whole text (null: empty), and shingles are three
    words with one space between, each as often as it occurs; a text of one or two words is one shingle, one without words has
    the fingerprint zero. A shingle's hash is its XXH64 with seed 42. Fingerprints link at three differing bits or fewer, all
    pairs of them; component_id is the least id that is reached over links, itself included. Rows that repeat an id, or a text,
    are rows of their own; null ids never are the least, and a component of null ids alone has the null component_id. Other
    columns are ignored, whatever their names; an empty table gives no rows.

    Rows are stored with their fingerprints; what is compared and shuffled are distinct fingerprints alone.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                found = fingerprints(batch.column(1).slice(a, b - a)).view(np.int64)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(found)], names=["id", "fp"])

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    prints = written(rows.mapInArrow(work, f"id {kind}, fp bigint"))
    least = written(prints.groupBy("fp").agg(F.min("id").alias("least")))
    label = components(links(least.select("fp")))
    named = least.join(label, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("part"))
    of_part = named.groupBy("part").agg(F.min("least").alias("component_id"))
    of_print = written(named.join(of_part, "part").select("fp", "component_id"))
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return prints.join(of_print, "fp").select(F.col("id").alias(id_col), fingerprint.alias("fingerprint"), "component_id")
