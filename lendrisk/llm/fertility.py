"""Quality rules by tokeniser fertility (operator 10).

Public vocabularies read text of the kinds they know in long tokens. Per document this measures characters per token under a
byte-level vocabulary, the share of tokens that a piece vocabulary can only spell byte by byte, and the entropy of the
token ids against the largest a text of that length can have. Each language (or script) has a band for each measure, taken
from the whole corpus: its median, and a spread that narrows with the text's length. Entropy falls with the logarithm of the
length instead, so its band lies around the language's line. A document outside a band is rejected, as is one that fails the
base counts.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendrisk.llm import bpe
from lendrisk.llm.pretokens import SMALL_SLICE_BYTES, slices
from lendrisk.llm.scratch import written
from lendrisk.llm.words import Words, words_of

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
MEANS = ("chars_per_token", "byte_share")
MEASURES = (*MEANS, "entropy_share")
#: Spreads from the middle at which a text leaves its band, and the least spread, per measure. For ``MEANS`` both hold for one token.
REACH = {"chars_per_token": 12.0, "byte_share": 12.0, "entropy_share": 6.0}
FLOOR = {"chars_per_token": 0.5, "byte_share": 0.25, "entropy_share": 0.01}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(of: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``of`` over each text's part."""
    return np.diff(np.r_[0, np.cumsum(of)][bounds])


def _dup_lines(texts: pa.Array) -> list[int]:
    """Lines with a word that equal an earlier line of the same text."""
    out = []
    for text in texts.to_pylist():
        lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
        out.append(len(lines) - len(set(lines)))
    return out


def _repeat_words(w: Words) -> np.ndarray:
    """Words inside a three-word window that occurs twice or more in the same text."""
    n = len(w.index)
    covered = np.zeros(n + 1, np.int64)
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    at = np.flatnonzero(text[2:] == text[:-2]) if n > 2 else np.zeros(0, np.int64)
    if len(at):
        # distinct ids make an exact key: pairs are numbered first, then triples with the text
        pair = np.unique(w.index[at] * (len(w.distinct) + 1) + w.index[at + 1], return_inverse=True)[1].astype(np.int64)
        triple = np.unique(pair * (len(w.distinct) + 1) + w.index[at + 2], return_inverse=True)[1].astype(np.int64)
        key = triple * len(w.first) + text[at]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        hit = at[twice]
        mark = np.zeros(n + 1, np.int64)
        np.add.at(mark, hit, 1)
        np.add.at(mark, hit + 3, -1)
        covered = (np.cumsum(mark) > 0).astype(np.int64)
    return _per_text(covered[:n], w.first)


@functools.cache
def _pieces(path: str) -> tuple[object, np.ndarray]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(k) or model.is_unknown(k) for k in range(model.get_piece_size())])


@functools.cache
def _piece_counts(path: str) -> bpe.WordStore:
    """Per word: its number of pieces, and how many of them are single bytes."""
    model, single = _pieces(path)

    def work(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = model.encode([x.decode("utf-8", "replace") for x in words], num_threads=1)
        n = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = np.fromiter(itertools.chain.from_iterable(coded), np.int64, int(n.sum()))
        return np.c_[n, _per_text(single[ids], np.cumsum(np.r_[0, n]))].ravel(), np.full(len(words), 2)

    return bpe.WordStore(work)


def _entropy_share(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Entropy of each text's ids over that of as many different ids; 1 for a text of less than two ids."""
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    key = np.sort(text * (1 << 32) + ids)
    opens = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.r_[opens, len(key)])
    owner = key[opens] >> 32 if len(key) else opens
    inner = np.bincount(owner, weights=count * np.log(np.maximum(count, 1)), minlength=len(n))
    full = np.log(np.maximum(n, 1))
    return np.where(n > 1, 1 - inner / np.maximum(n * full, 1e-12), 1.0)


def measure(texts: pa.Array, token_path: str, piece_path: str) -> dict[str, np.ndarray | list[int]]:
    """All base counts and fertility measures of a batch of texts (null: empty)."""
    w = words_of(texts)
    lead = (w.raw & 0xC0) != 0x80
    points = np.r_[0, np.cumsum(lead)]
    text_points = np.diff(points[w.bounds])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    ids, first = bpe.encode(texts, token_path)
    n_tokens = np.diff(first)
    store = _piece_counts(piece_path)
    row = store.places(w.distinct)[w.index]
    place = store.start[row]
    pieces, singles = _per_text(store.flat[place], w.first), _per_text(store.flat[place + 1], w.first)
    return {
        "n_words": np.diff(w.first),
        "word_chars": _per_text(points[w.end] - points[w.begin], w.first),
        "n_symbols": _per_text(symbol[w.raw], w.bounds),
        "n_dup_lines": _dup_lines(texts),
        "n_repeat_words": _repeat_words(w),
        "n_tokens": n_tokens,
        "chars_per_token": text_points / np.maximum(n_tokens, 1),
        "byte_share": singles / np.maximum(pieces, 1),
        "entropy_share": _entropy_share(ids, first),
    }


def measured(
    documents: DataFrame, *, text_col: str = "text", token_path: str | None = None, piece_path: str | None = None
) -> DataFrame:
    """``documents`` with a struct column ``fertility``: the base counts and the measures of each whole text."""
    token_path = token_path or public_tokenizers.path("byte_bpe_50k.json")
    piece_path = piece_path or public_tokenizers.path("piece_bpe_32k.model")
    kinds = dict.fromkeys((*BASE, "n_tokens"), pa.int64()) | dict.fromkeys(MEASURES, pa.float64())

    @F.arrow_udf("struct<" + ",".join(f"{c}:{'bigint' if k == pa.int64() else 'double'}" for c, k in kinds.items()) + ">")
    def fertility(texts: pa.Array) -> pa.Array:
        parts = [pa.array([], pa.struct(list(kinds.items())))]
        for a, b in slices(texts, SMALL_SLICE_BYTES):
            found = measure(texts.slice(a, b - a), token_path, piece_path)
            parts.append(pa.StructArray.from_arrays([pa.array(found[c], k) for c, k in kinds.items()], names=list(kinds)))
        return pa.concat_arrays(parts)

    return documents.select("*", fertility(F.col(text_col)).alias("fertility"))


def _level(slope: str) -> Column:
    """What a text's entropy share is above a line of that slope over the logarithm of its length."""
    return F.col("entropy_share") - F.col(slope) * F.log("n_tokens")


def bands(measures: DataFrame, *, group_col: str = "lang", min_texts: int = 30) -> DataFrame:
    """Each group's middle and spread of each measure: one row per value of ``group_col``, null included.

    A mean over n tokens strays as 1 / sqrt(n), so a text's distance from the median counts times sqrt(n_tokens); the spread is
    the interquartile range of that, as a standard deviation, and ``FLOOR`` at least. The entropy share is no mean: its middle and
    spread are those of the distances from the group's line over ln(n_tokens), whose slope is least squares. Copies would narrow
    the spread, so rows with equal measures count once. Only texts that pass the base counts are used. Groups of fewer than
    ``min_texts`` such rows take the values of all rows.
    """
    rows = measures.where(~F.col("base_failed")).select(group_col, "n_tokens", *MEASURES).distinct()
    key = F.col(group_col)
    # texts of one length have no slope
    middles = {f"{m}_mid": F.percentile_approx(m, 0.5, 10000) for m in MEANS}
    middles["entropy_share_slope"] = F.coalesce(F.regr_slope("entropy_share", F.log("n_tokens")), F.lit(0.0))
    size = rows.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"), *(x.alias(c) for c, x in middles.items()))
    overall = rows.agg(*(x.alias(f"_all_{c}") for c, x in middles.items())).withColumn("_one", F.lit(1))
    mids = size.withColumn("_one", F.lit(1)).join(F.broadcast(overall), "_one", "left")
    mids = mids.select(
        key.alias("_group"), (F.col("_n") < min_texts).alias("_few"), F.col("_all_entropy_share_slope").alias("_all_slope"),
        *(F.when(F.col("_n") < min_texts, F.col(f"_all_{c}")).otherwise(F.col(c)).alias(c) for c in middles),
    )
    # stored, so that Spark knows its size: a row per group, which is sent to every task only if there are few
    mids = written(mids)
    strays = rows.join(mids, key.eqNullSafe(F.col("_group")), "left").select(
        "_group", *((F.sqrt("n_tokens") * (F.col(m) - F.col(f"{m}_mid"))).alias(m) for m in MEANS),
        _level("entropy_share_slope").alias("_level"), _level("_all_slope").alias("_all_level"),
    )

    def spreads(df: DataFrame, name: str, level: str, *by: str) -> DataFrame:
        q = {m: F.percentile_approx(c, [0.25, 0.5, 0.75], 10000) for m, c in (*zip(MEANS, MEANS, strict=True), ("entropy_share", level))}
        wide = (F.greatest((q[m][2] - q[m][0]) / 1.349, F.lit(FLOOR[m])).alias(f"{m}_spread{name}") for m in MEASURES)
        return df.groupBy(*by).agg(*wide, q["entropy_share"][1].alias(f"entropy_share_mid{name}"))

    own = spreads(strays, "_own", "_level", "_group").withColumnRenamed("_group", "_own_group")
    every = spreads(strays, "_every", "_all_level").withColumn("_one", F.lit(1))
    found = mids.withColumn("_one", F.lit(1)).join(own, F.col("_group").eqNullSafe(F.col("_own_group")), "left")
    found = found.join(F.broadcast(every), "_one", "left")
    dealt = ("entropy_share_mid", *(f"{m}_spread" for m in MEASURES))
    return found.select(
        F.col("_group").alias(group_col), *middles,
        *(F.when(F.col("_few"), F.col(f"{c}_every")).otherwise(F.col(f"{c}_own")).alias(c) for c in dealt),
    )


def with_base_verdict(with_fertility: DataFrame) -> DataFrame:
    """The measures as columns, and ``base_failed``: under 50 words, or over half of them in repeated windows."""
    columns = [F.col(f"fertility.{c}").alias(c) for c in (*BASE, "n_tokens", *MEASURES)]
    kept = [c for c in with_fertility.columns if c != "fertility" and c not in {*BASE, "n_tokens", *MEASURES, "base_failed"}]
    df = with_fertility.select(*kept, *columns)
    return df.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def judged(measures: DataFrame, band: DataFrame, *, group_col: str = "lang", reach: dict[str, float] | None = None) -> DataFrame:
    """``measures`` with ``kept``: false if the base counts fail or a measure lies outside its group's band.

    The band around the group's median is ``reach`` spreads wide on both sides for a mean of one token, and narrows with
    sqrt(n_tokens); around the group's line of entropy it is ``reach`` spreads wide at any length. A group without a band (none of its texts passes the base counts) is judged by the base counts alone.
    """
    reach = REACH | (reach or {})
    band = band.withColumnRenamed(group_col, "_group")
    joined = measures.join(band, F.col(group_col).eqNullSafe(F.col("_group")), "left")
    strays = {m: F.sqrt("n_tokens") * F.abs(F.col(m) - F.col(f"{m}_mid")) for m in MEANS}
    strays["entropy_share"] = F.abs(_level("entropy_share_slope") - F.col("entropy_share_mid"))
    inside = F.lit(True)
    for m, stray in strays.items():
        inside &= F.coalesce(stray <= reach[m] * F.col(f"{m}_spread"), F.lit(True))
    return joined.select(*(c for c in measures.columns if c != "kept"), (~F.col("base_failed") & inside).alias("kept"))


def fertility_rules(documents: DataFrame, *, group_col: str = "lang", text_col: str = "text", keep_text: bool = True, **paths: str) -> DataFrame:
    """``documents`` (without the text, if it isn't to be kept) with the base counts, the measures, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail. Every row is judged, repeated rows alike. Columns of ``documents`` that bear
    a result's name are replaced. The measured rows are stored once, as the bands need all of them before the first verdict.
    """
    found = with_base_verdict(measured(documents, text_col=text_col, **paths))
    stored = written(found if keep_text else found.drop(text_col))
    return judged(stored, written(bands(stored, group_col=group_col)), group_col=group_col)
