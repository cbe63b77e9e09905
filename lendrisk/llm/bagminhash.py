"""Near copies by BagMinHash signatures, bands and verified multiset overlap (operator 2).

A document is the multiset of its five-word windows. Each window carries Poisson processes over (time, weight): one for the
weights 0 to 1, one for 1 to 2, 2 to 4, 4 to 8 and so on, all drawn from its hash alone. A document that holds the window c
times sees the points below weight c; in the topmost, partly covered process the points' weights decide. A signature position
keeps the earliest of the points that fall on it, so two documents agree on a position with the probability of their weighted
Jaccard similarity. Points later than what every position needs are never drawn, so the work is that of the windows plus a
constant per document.

Equal bands make candidates. No bucket is expanded into all its pairs: a bucket's texts are compared with one of them, verified links
join classes, and only texts of a bucket that then lie in different classes are compared with each other. Before any elements
are moved, two bounds leave out most pairs that aren't similar: their sizes, and 2,048 parities of their elements. The bounds lose
no similar pair, and what they leave is verified by the multiset overlap itself. At last a bucket's elements meet in one task, which hands
out no more links than join its classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendrisk.llm.components import components
from lendrisk.llm.pretokens import slices, spread
from lendrisk.llm.scratch import discard, written
from lendrisk.llm.sliced_simhash import Forest
from lendrisk.llm.words import mix, word_hashes

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: Texts whose windows are numbered together.
MOST_TEXTS = 1 << 16
#: Places of the parities that bound how similar two texts can be.
PARITY_BITS = 2048
#: Texts of one bucket that meet in one task, and their elements, as two such parts; texts compared at a time.
CELL_TEXTS, CELL_ELEMENTS, BLOCK_TEXTS = 4096, 1 << 21, 16
#: Text bytes whose windows are worked on at a time: points and elements take many times their room.
WINDOW_BYTES = 512 << 10


def _u64(x: int | np.ndarray) -> np.ndarray:
    return np.asarray(x).astype(np.uint64)


def windows(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows of each text: (text, hash, count), by text and hash. A text of fewer words is one window.

    Hashes have 48 bits, so that a text's place and a hash make one number, and one sort of numbers finds equal windows.
    """
    if len(texts) > MOST_TEXTS:
        parts = [windows(texts.slice(k, MOST_TEXTS), size) for k in range(0, len(texts), MOST_TEXTS)]
        text, value, count = zip(*parts, strict=True)
        return np.concatenate([x + k * MOST_TEXTS for k, x in enumerate(text)]), np.concatenate(value), np.concatenate(count)
    hashed, first = word_hashes(texts)
    n_words = np.diff(first)
    text = np.repeat(np.arange(len(n_words)), n_words)
    many = max(len(hashed) - size + 1, 0)
    value = hashed[:many]
    for k in range(1, size):
        value = value * GOLDEN + hashed[k : k + many]
    whole = text[:many] == text[size - 1 :] if many else np.zeros(0, bool)
    few = np.flatnonzero((n_words > 0) & (n_words < size))
    short = _u64(n_words[few])
    for k in range(size - 1):
        inside = n_words[few] > k
        short[inside] = mix(short[inside] * GOLDEN + hashed[first[few[inside]] + k])
    value = mix(np.concatenate([value[whole], short])) >> np.uint64(16)
    key = np.sort((_u64(np.concatenate([text[:many][whole], few])) << np.uint64(48)) | value)
    opens = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return (key[opens] >> np.uint64(48)).astype(np.int64), key[opens] & np.uint64(2**48 - 1), np.diff(np.r_[opens, len(key)])


def signatures(text: np.ndarray, value: np.ndarray, count: np.ndarray, n: int, size: int) -> np.ndarray:
    """BagMinHash signatures of n texts: an (n, ``size``) array of point times, infinite for a text without windows."""
    weight = np.bincount(text, weights=count, minlength=n)
    best = np.full(n * size, np.inf)
    # one process per window and dyadic weight range that the count reaches into
    level = np.zeros(len(text), np.int64)
    parts = [(np.arange(len(text)), level)]
    rest, k = np.flatnonzero(count > 1), 1
    while len(rest):
        parts.append((rest, np.full(len(rest), k)))
        rest, k = rest[count[rest] > 2**k], k + 1
    who = np.concatenate([p for p, _ in parts])
    level = np.concatenate([lv for _, lv in parts])
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1.0))
    width = np.where(level == 0, 1.0, low)
    seed = mix(value[who] + _u64(level + 1) * GOLDEN)
    owner, covered = text[who], count[who]
    time, drawn = np.zeros(len(who)), np.zeros(len(who), np.uint64)
    # by this time most texts have a point on every position; the others get more time
    limit = np.where(weight > 0, (np.log(size) + 1) / np.maximum(weight, 1), 0.0)
    live = np.arange(len(who))
    parked: list[np.ndarray] = []
    ahead = np.zeros(len(who))  # the next point's time
    first = mix(seed)
    ahead = -np.log(((first >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / (width * size)
    while len(live):
        due = ahead[live] <= limit[owner[live]]
        parked.append(live[~due])
        live = live[due]
        if len(live):
            time[live] = ahead[live]
            draw = mix(seed[live] ^ mix(drawn[live] * GOLDEN + np.uint64(1)))
            place = (draw >> np.uint64(32)) % np.uint64(size)
            at_weight = low[live] + width[live] * ((draw & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32)
            seen = at_weight < covered[live]
            np.minimum.at(best, owner[live][seen] * size + place[seen].astype(np.int64), time[live][seen])
            drawn[live] += np.uint64(1)
            draw = mix(seed[live] + drawn[live] * GOLDEN)
            ahead[live] = time[live] - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / (width[live] * size)
            continue
        short = np.isinf(best.reshape(n, size)).any(axis=1) & (weight > 0)
        if not short.any():
            break
        limit[short] += 2 / weight[short]
        live = np.concatenate(parked)
        live = live[short[owner[live]]]
        parked = []
    return best.reshape(n, size)


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of a signature."""
    bits = np.ascontiguousarray(signature[:, : bands * rows]).view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(mix(_u64(np.arange(1, bands + 1)) * GOLDEN), bits.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * GOLDEN + bits[:, :, k])
    return key


def digest_of(text: Column) -> Column:
    """What tells one text from another; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _elements_of(text: np.ndarray, value: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows of n texts as distinct numbers, sorted within a text, and each text's first one plus the end.

    The k-th occurrence of a window is a number of its own, so that two texts share as many numbers as their multisets do.
    """
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    each = mix(np.repeat(value, count) + _u64(nth) * GOLDEN)
    owner = np.repeat(text, count)
    each = each[np.lexsort((each, owner))]
    return each, np.r_[0, np.cumsum(np.bincount(text, weights=count, minlength=n).astype(np.int64))]


def _parities(each: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(text, word): for each of ``PARITY_BITS`` hashed places whether an odd number of the text's elements falls there.

    Two texts differ in at least as many elements as their parities differ in places.
    """
    out = np.zeros((len(first) - 1, PARITY_BITS // 64), np.uint64)
    place = (each % np.uint64(PARITY_BITS)).astype(np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    np.bitwise_xor.at(out.reshape(-1), row * (PARITY_BITS // 64) + place // 64, np.uint64(1) << _u64(place % 64))
    return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """An array of one binary value per row."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _signed(texts: DataFrame, bands: int, rows: int, window: int) -> DataFrame:
    """(digest, weight, keys, parity) of (digest, text); texts without words get no keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), WINDOW_BYTES):
                part = batch.slice(a, b - a)
                text, value, count = windows(part.column(1), window)
                n = part.num_rows
                keys = _bands(signatures(text, value, count, n, bands * rows), bands, rows).view(np.int64)
                weight = np.bincount(text, weights=count, minlength=n).astype(np.int64)
                filled = weight > 0
                first = np.r_[0, np.cumsum(filled * bands)]
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(keys[filled].ravel()))
                parity = _fixed(_parities(*_elements_of(text, value, count, n)))
                yield pa.record_batch([part.column(0), pa.array(weight), lists, parity], names=["digest", "weight", "keys", "parity"])

    return texts.mapInArrow(work, "digest binary, weight bigint, keys array<bigint>, parity binary")


def _elements(texts: DataFrame, window: int) -> DataFrame:
    """(t, elements) of (t, text), the elements as the bytes of sorted numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), WINDOW_BYTES):
                part = batch.slice(a, b - a)
                each, first = _elements_of(*windows(part.column(1), window), part.num_rows)
                held = [each[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch([part.column(0), pa.array(held, pa.binary())], names=["t", "elements"])

    return texts.mapInArrow(work, "t bigint, elements binary")


def _grows(table: DataFrame) -> DataFrame:
    """A side of a join that grows with the documents and so is never to be broadcast, however few rows it has this time."""
    return table.hint("merge")


def _may_be_similar(threshold: float, one: str, two: str) -> Column:
    """Whether sizes and parities of two texts, in columns of these endings, leave a similarity of ``threshold`` possible."""
    n, m = F.col(f"weight{one}"), F.col(f"weight{two}")
    return (n >= threshold * m) & (m >= threshold * n) & (F.col("differ") <= (1 - threshold) / (1 + threshold) * (n + m) + 1e-9)


def _possible(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, ...) whose sizes and parities leave the similarity possible: 256 bytes a text are moved, and no elements."""
    @F.arrow_udf("int")
    def differing(one: pa.Array, two: pa.Array) -> pa.Array:
        if not len(one):
            return pa.array([], pa.int32())
        x, y = (np.frombuffer(b"".join(p.to_pylist()), np.uint64).reshape(len(p), -1) for p in (one, two))
        return pa.array(np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int32))

    side = signed.select("t", "weight", "parity")
    one, two = (side.select(F.col("t").alias(x), F.col("weight").alias(f"weight_{x}"), F.col("parity").alias(f"parity_{x}")) for x in "ab")
    sized = pairs.join(_grows(one), "a").join(_grows(two), "b").withColumn("differ", differing("parity_a", "parity_b"))
    return sized.where(_may_be_similar(threshold, "_a", "_b")).select(*pairs.columns)


def _dealt(rows: DataFrame, group: str, size: str, key: str) -> DataFrame:
    """``rows`` with ``part``: one of ceil(``size`` / ``CELL_TEXTS``) parts of their group, by a hash of ``key``."""
    parts = F.ceil(F.col(size) / CELL_TEXTS).cast("int")
    return rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(key, group), F.col("parts")).cast("int"))


def _verified(pairs: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of stored texts' pairs whose multiset Jaccard similarity is at least ``threshold``, stored.

    Every b is a cell that its texts a come to. A cell of very many texts is dealt out, b with each part.
    """
    dealt = written(_dealt(pairs.join(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")), "b"), "b", "n", "a").select("a", "b", "part"))
    comers = dealt.select(F.col("b").alias("cell"), "part", F.col("a").alias("t"))
    hosts = dealt.select(F.col("b").alias("cell"), "part", F.col("b").alias("t")).distinct()
    asked = comers.unionByName(hosts).join(_grows(elements), "t").repartition("cell", "part")
    sorted_ = asked.sortWithinPartitions("cell", "part", F.col("t") != F.col("cell"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, host = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            cells, texts, elements = (batch.column(c) for c in ("cell", "t", "elements"))
            for own, t, held in zip(cells.to_pylist(), texts.to_pylist(), elements, strict=True):
                mine = np.frombuffer(held.as_buffer(), np.uint64)
                if t == own:  # a cell's host comes first
                    cell, host = own, mine
                    continue
                assert own == cell
                place = np.searchsorted(host, mine)
                place[place == len(host)] = 0
                shared = int((host[place] == mine).sum()) if len(host) else 0
                if shared >= threshold * (len(mine) + len(host) - shared):
                    out.append((t, own))
            yield pa.record_batch([pa.array([x[k] for x in out], pa.int64()) for k in range(2)], names=["a", "b"])

    links = written(sorted_.select("cell", "t", "elements").mapInArrow(work, "a bigint, b bigint"))
    discard(dealt)
    return links


def cell_links(
    t: np.ndarray, class_: np.ndarray, second: np.ndarray, each: np.ndarray, first: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) of verified similar texts that join all classes of one cell which any such pair joins; each joins two that were apart.

    Text k holds the elements ``each[first[k]:first[k + 1]]``. Texts of one side are compared with each other, those of two sides across.
    """
    parity, size = _parities(each, first), np.diff(first)
    code = np.unique(each, return_inverse=True)[1].astype(np.int32)
    node = np.unique(class_, return_inverse=True)[1]
    forest = Forest(int(node.max(initial=-1)) + 1)
    marked = np.zeros(int(code.max(initial=-1)) + 1, bool)
    found = []
    ones = np.flatnonzero(~second)
    twos = np.flatnonzero(second) if second.any() else ones
    for k in range(0, len(ones), BLOCK_TEXTS):
        mine = ones[k : k + BLOCK_TEXTS]
        near = _near(parity, size, mine, twos, threshold)
        for i, row in zip(mine.tolist(), near, strict=True):
            other = twos[row]
            other = other[forest.roots[node[other]] != forest.roots[node[i]]]
            if not len(other):
                continue
            marked[code[first[i] : first[i + 1]]] = True
            held = marked[code[spread(first[other], size[other])]]
            shared = np.add.reduceat(held, np.cumsum(size[other]) - size[other], dtype=np.int64)
            marked[code[first[i] : first[i + 1]]] = False
            other = other[shared >= threshold * (size[i] + size[other] - shared)]
            other = other[np.unique(forest.roots[node[other]], return_index=True)[1]]
            found += [(t[i], t[j]) for j in other.tolist()]
            forest.join(np.full(len(other), node[i]), node[other])
    ends = np.array(found, np.int64).reshape(-1, 2)
    return ends.max(axis=1), ends.min(axis=1)


def _near(parity: np.ndarray, weight: np.ndarray, ones: np.ndarray, twos: np.ndarray, threshold: float) -> np.ndarray:
    """(one, two): whether the sizes and parities of two texts leave the similarity possible."""
    far = np.bitwise_count(parity[ones][:, None] ^ parity[twos][None]).sum(axis=2, dtype=np.int32)
    n, m = weight[ones][:, None], weight[twos][None]
    return (far <= (1 - threshold) / (1 + threshold) * (n + m) + 1e-9) & (n >= threshold * m) & (m >= threshold * n)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one ``cell`` after another; equal cells lie together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        at = 0
        for end in np.r_[np.flatnonzero(cells[1:] != cells[:-1]) + 1, len(cells)].astype(int) if len(cells) else ():
            if held and held[0].column("cell")[0].as_py() != cells[at]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _across(members: DataFrame, label: DataFrame, signed: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) that join all classes of which two texts of one bucket are similar, stored.

    A bucket's texts are compared in blocks, parity by parity, and the texts that may be similar to one of another class are
    handed on, each once. Their elements then meet in the same cells, which hand out links that join classes. So neither step makes
    more rows than it reads. A bucket of very many texts or elements falls into parts, and each two parts meet in a cell of their own.
    """
    classed = members.join(label, F.col("t") == F.col("node"), "left").select("key", "t", F.coalesce("component", "t").alias("class"))
    named = written(classed)
    split = named.groupBy("key").agg(F.min("class").alias("p"), F.max("class").alias("q")).where("p != q").select("key")
    opened = written(named.join(_grows(split), "key").join(_grows(signed.select("t", "weight")), "t"))
    size = F.greatest(F.count(F.lit(1)).cast("double"), F.sum("weight") * (CELL_TEXTS / CELL_ELEMENTS)).alias("n")
    open_ = written(_dealt(opened.join(_grows(opened.groupBy("key").agg(size)), "key"), "key", "n", "t").select("key", "t", "class", "parts", "part"))
    sized = open_.join(_grows(signed.select("t", "weight", "parity")), "t").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cell = F.struct("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")).alias("cell")
    met = sized.select(cell, (F.col("part") > F.col("other")).alias("second"), "t", "class", "weight", "parity").repartition("cell")
    met = met.sortWithinPartitions("cell", "second").select(F.xxhash64("cell").alias("cell"), "second", "t", "class", "weight", "parity")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches):
            class_, weight, second = (rows.column(c).to_numpy() for c in ("class", "weight", "second"))
            parity = np.frombuffer(b"".join(rows.column("parity").to_pylist()), np.uint64).reshape(len(class_), -1)
            ones = np.flatnonzero(~second)
            twos = np.flatnonzero(second) if second.any() else ones
            asked = np.zeros(len(class_), bool)
            for k in range(0, len(ones), BLOCK_TEXTS):
                mine = ones[k : k + BLOCK_TEXTS]
                near = _near(parity, weight, mine, twos, threshold) & (class_[mine][:, None] != class_[twos][None])
                asked[mine] |= near.any(axis=1)
                asked[twos] |= near.any(axis=0)
            yield from rows.select(["cell", "second", "t", "class"]).filter(pa.array(asked)).combine_chunks().to_batches()

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _cells(batches):
            t, class_, second = (rows.column(c).to_numpy() for c in ("t", "class", "second"))
            held = rows.column("elements").to_pylist()
            each = np.frombuffer(b"".join(held), np.uint64)
            a, b = cell_links(t, class_, second, each, np.cumsum([0, *(len(x) // 8 for x in held)]), threshold)
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    asked = written(met.mapInArrow(possible, "cell bigint, second boolean, t bigint, class bigint"))
    full = asked.join(_grows(elements), "t").select("cell", "second", "t", "class", "elements").repartition("cell").sortWithinPartitions("cell", "second")
    links = written(full.mapInArrow(linked, "a bigint, b bigint").distinct())
    discard(named, opened, open_, asked)
    return links


def near_copies(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 5,
    threshold: float = 0.8,
    bands: int = 24,
    rows: int = 4,
) -> DataFrame:
    """Classes of near copies: (``id_col``, class_id, n_links), one row per row of ``documents``.

    Words are runs of characters other than ASCII white space, taken as they are. Two different texts are linked if the multisets
    of their five-word windows have a Jaccard similarity of ``threshold`` or more; classes are the connected components, and
    class_id is the least ``id_col`` in one. n_links counts the links found from a text to other texts, each verified; texts that
    already share a class needn't all be compared. Equal texts share a class, null and empty ones theirs; texts of fewer than
    five words are one window. Null ids keep their class. Bands of 4 of 96 positions miss a pair at 0.8 three times in a million.
    """
    return _labelled(*_linked(documents, id_col, text_col, window, threshold, bands, rows), id_col)


def first_rows(
    documents: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 5,
    threshold: float = 0.8,
    bands: int = 24,
    rows: int = 4,
) -> DataFrame:
    """One row (id, digest) per class of ``near_copies``: its least id, null if it has none, and of that id's texts the least digest."""
    named = _named(*_linked(documents, id_col, text_col, window, threshold, bands, rows))
    first = F.min(F.struct(F.col("least").isNull().alias("unnamed"), F.col("least").alias("id"), "digest"))
    return named.groupBy("class").agg(first.alias("first")).select("first.id", "first.digest")


def _linked(
    documents: DataFrame, id_col: str, text_col: str, window: int, threshold: float, bands: int, rows: int
) -> tuple[DataFrame, DataFrame]:
    """The rows (id, digest) of ``documents``, and (digest, component, n_links) of the texts that have links, stored."""
    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", digest_of(F.col("text")))
    signed = _signed(texts.select("digest", "text"), bands, rows, window).dropDuplicates(["digest"])
    signed = written(signed.withColumn("t", F.monotonically_increasing_id()))  # a short number per text
    buckets = signed.select("t", F.explode("keys").alias("key"))
    shared = written(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    members = written(buckets.join(_grows(shared), "key"))
    # a bucket's texts meet one drawn by hash, in each bucket another
    leads = written(members.groupBy("key").agg(F.min_by("t", F.xxhash64("t", "key")).alias("lead")))
    led = members.join(_grows(leads), "key").where("t != lead").groupBy(F.col("t").alias("a"), F.col("lead").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    led = written(_possible(written(led), signed, threshold))
    discard(shared, leads)
    wanted = written(members.select("t").distinct().join(_grows(signed.select("t", "digest")), "t"))  # stored, so that the join can split a text of very many copies
    once = texts.select("digest", "text").join(_grows(wanted), "digest").groupBy("t").agg(F.first("text").alias("text"))
    elements = written(_elements(once, window))
    # each text first meets the text with which it shares most bands
    closest = written(led.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b")))
    links = _verified(closest, elements, threshold)
    label = written(components(links))
    # then the others that it was drawn to, if they are of another class
    apart = written(_apart(led.select("a", "b").join(closest, ["a", "b"], "left_anti"), label))
    new = _verified(apart, elements, threshold)
    links, label = links.unionByName(new), _merged(label, new)
    discard(closest, led, apart)
    # at last all texts of a bucket that are still apart
    new = _across(members, label, signed, elements, threshold)
    links, label = links.unionByName(new), _merged(label, new)
    discard(members, elements)
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    found = label.join(degree, "node").join(signed.select(F.col("t").alias("node"), "digest"), "node")
    # 20 bytes, which no digest has
    found = written(found.select("digest", F.lpad(F.col("component").cast("string"), 20, "0").cast("binary").alias("component"), "n_links"))
    discard(signed, links, label, wanted)
    return texts.select("id", "digest"), found


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``label`` (node, component) after new ``links`` (a, b), stored; only components that they join are worked on."""
    of_a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    of_b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    named = links.join(of_a, "a", "left").join(of_b, "b", "left")
    across = written(named.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a != b").distinct())
    if across.isEmpty():
        return label
    over = written(components(across).select(F.col("node").alias("part"), F.col("component").alias("whole")))
    known = label.unionByName(over.select(F.col("part").alias("node"), F.col("part").alias("component"))).distinct()
    found = known.join(over, F.col("component") == F.col("part"), "left")
    merged = written(found.select("node", F.coalesce("whole", "component").alias("component")))
    discard(label, across, over)
    return merged


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    of_a = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    of_b = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    named = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return named.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _named(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each text (digest) with its least id, its links and its class; equal texts are counted together before any join."""
    least = rows.groupBy("digest").agg(F.min("id").alias("least"))
    return least.join(_grows(found), "digest", "left").withColumn("class", F.coalesce("component", "digest"))


def _labelled(rows: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Each row with its class's least id and its text's links."""
    named = written(_named(rows, found))
    class_id = named.groupBy("class").agg(F.min("least").alias("class_id"))
    of_digest = named.join(class_id, "class").select("digest", "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    of_digest = written(of_digest)
    discard(named, found)
    return rows.join(_grows(of_digest), "digest").select(F.col("id").alias(id_col), "class_id", "n_links")
