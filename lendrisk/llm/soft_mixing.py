"""Mixing to target weights by soft domain membership (operator 6).

A softmax classifier, learnt from a table of labelled documents, gives each document a posterior over domains. Every document
gets a rate: how often it is to be taken. The rates are the nonnegative least-squares solution in which the expected tokens of
each domain, rate x tokens x posterior summed over all documents, match the targets. They are found by projected gradient steps:
a step aggregates the domains' expected shares over all documents, and its residual moves every rate at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendrisk.llm import bpe, latent
from lendrisk.llm.pretokens import SMALL_SLICE_BYTES, slices
from lendrisk.llm.scratch import discard, written

#: The public vocabulary whose ids are counted as tokens.
VOCABULARY = "byte_bpe_50k.json"


@dataclass(frozen=True)
class DomainModel:
    """Softmax weights over latent vectors, a bias last; ``domains`` are in the order of the posterior."""

    domains: tuple[str, ...]
    projection: latent.Projection | None
    weights: np.ndarray

    def posteriors(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), len(self.domains)))
        for a, b, rows in self.projection.of_texts(texts) if self.projection else ():
            out[a:b] = softmax(np.c_[rows, np.ones(len(rows))] @ self.weights)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_domains(
    documents: DataFrame,
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    most: int = 400,
    most_domains: int = 64,
    dimensions: int = 64,
) -> DomainModel:
    """Learn domains from ``labelled`` (``id_col``, ``domain_col``): at most ``most`` texts of each, spread by a hash of the id.

    Null domains and labels of ids without a document are left out; an id with several domains counts for the least of them.
    Without any labelled text the model knows no domain. Raises if there are more than ``most_domains``, which bounds what the
    driver holds.
    """
    marks = labelled.select(F.col(id_col).alias("_id"), F.col(domain_col).cast("string").alias("_domain")).where("_domain is not null and _id is not null")
    marks = marks.groupBy("_id").agg(F.min("_domain").alias("_domain"))
    if marks.select("_domain").distinct().limit(most_domains + 1).count() > most_domains:
        raise ValueError(f"more than {most_domains} domains")
    chosen = latent.sampled(marks, "_domain", most, F.col("_id"))
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_domain").agg(F.min("_text").alias("_text"))
    counts, found, _ = latent.collected_counts(rows, "_text", "_domain")
    if not found:
        return DomainModel((), None, np.zeros((0, 0)))
    domains = tuple(sorted(set(found)))
    projection = latent.fit(counts, dimensions)
    x = np.c_[projection.rows(counts), np.ones(len(found))].astype(np.float64)
    y = np.eye(len(domains))[[domains.index(d) for d in found]]
    y /= y.sum(axis=0)  # each domain weighs the same, however many texts it has
    weights = np.zeros((x.shape[1], len(domains)))
    for _ in range(400):
        p = softmax(x @ weights) * y.sum(axis=1, keepdims=True)
        weights -= 2.0 * (x.T @ (p - y) / len(domains) + 1e-4 * weights)
    return DomainModel(domains, projection, weights)


def memberships(documents: DataFrame, model: DomainModel, *, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``documents`` with ``n_tokens`` (ids of the whole text in ``vocabulary``) and ``posterior`` (array<double>, in the order of the model)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    file = vocabulary or public_tokenizers.path(VOCABULARY)

    @F.arrow_udf("struct<n:bigint,p:array<double>>")
    def member(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("n", pa.int64()), ("p", pa.list_(pa.float64()))])
        if not len(texts):
            return pa.array([], kind)
        n = np.concatenate([bpe.id_counts(texts.slice(a, b - a), file) for a, b in slices(texts, SMALL_SLICE_BYTES)])
        p = shared.value.posteriors(texts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), lists], fields=list(kind))

    found = documents.withColumn("_member", member(F.col(text_col)))
    return found.withColumn("n_tokens", F.col("_member.n")).withColumn("posterior", F.col("_member.p")).drop("_member")


def fit_rates(
    members: DataFrame,
    targets: list[float],
    *,
    ridge: float = 1e-3,
    most_steps: int = 60,
    tolerance: float = 1e-4,
    stored_every: int = 12,
) -> tuple[DataFrame, list[float]]:
    """``members`` with ``rate``, and the expected share of each domain under the rates.

    Minimises half the squared distance of the domains' expected shares of all tokens from ``targets`` (which sum to 1), each
    domain in units of the square root of its present share, plus ``ridge``/2 times the token-weighted squared distance of the
    rates from 1, over nonnegative rates. Domains without tokens can't be met and are left out of the aim. Steps end when no share
    is off by more than ``tolerance``, when they no longer change the shares, or after ``most_steps``. The driver sees one number
    per domain and step.
    """
    d = len(targets)
    n = F.col("n_tokens").cast("double")
    total = members.agg(F.sum(n)).first()[0] or 0.0
    if not total or not d:
        return members.withColumn("rate", F.lit(1.0)), [0.0] * d
    share = n / total
    p = [F.col("posterior")[k] for k in range(d)]
    first = members.agg(*(F.sum(share * x) for x in p), *(F.sum(share * x * y) for x in p for y in p)).first()
    now, gram = np.array(first[:d]), np.array(first[d:]).reshape(d, d)
    scale = np.where(now > 1e-9, 1 / np.maximum(now, 1e-9), 0.0)
    root = np.sqrt(scale)
    step = 1 / (np.linalg.eigvalsh(root[:, None] * gram * root).max() + ridge)
    # the steps need two columns; whatever else the rows hold is neither moved nor stored again
    rows, rate = members.select("n_tokens", "posterior").withColumn("rate", F.lit(1.0)), F.col("rate")
    pulls: list[list[float]] = []
    for k in range(1, most_steps + 1):
        pulls.append(((now - targets) * scale).tolist())
        pull = F.lit(0.0)
        for x, r in zip(p, pulls[-1], strict=True):
            pull = pull + x * r
        rate = F.greatest(F.lit(0.0), rate * (1 - step * ridge) + step * ridge - step * pull)
        moved = np.array(rows.agg(*(F.sum(share * x * rate) for x in p)).first())
        still = np.abs(moved - now).max() < tolerance / 100
        now = moved
        if still or np.abs((now - targets)[scale > 0]).max() < tolerance:
            break
        if k % stored_every == 0:
            stepped = written(rows.withColumn("rate", rate))
            discard(rows)
            rows, rate = stepped, F.col("rate")
    discard(rows)

    @F.arrow_udf("double")
    def replayed(posterior: pa.Array) -> pa.Array:
        """The rate that the same steps lead to from each posterior."""
        flat = posterior.flatten().to_numpy().reshape(len(posterior), -1)
        out = np.ones(len(posterior))
        for pull in pulls if len(posterior) else ():
            out = np.maximum(0.0, out * (1 - step * ridge) + step * ridge - step * (flat @ pull))
        return pa.array(out, pa.float64())

    return members.withColumn("rate", replayed("posterior")), now.tolist()


def copies_of(rate: Column, *key: Column) -> Column:
    """How often to take a row: the rate's whole part, and once more with its fraction as probability, by a hash of ``key``."""
    chance = F.pmod(F.xxhash64(*key), F.lit(1 << 40)).cast("double") / float(1 << 40)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def mixed(
    documents: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float] | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    domain_col: str = "domain",
    keep_text: bool = True,
    **options: float,
) -> DataFrame:
    """``documents`` with n_tokens, posterior, domain (the likeliest), rate, copies, and that domain's target and expected share.

    ``expected_share`` is what the rates give the domain of all tokens, to be held against ``target_share``: they differ by more than
    the tolerance where a target can't be met or more steps are needed. Tokens are those of a public vocabulary, so that texts
    without spaces count like others. Of equally likely domains the first by name is taken. Copies are drawn by a hash of id
    and text, so that rows without an id are drawn by their texts.

    ``targets`` gives domains their weights, in any unit; without it all are equal. Domains that ``targets`` doesn't name
    get 0. Null and empty texts have no tokens, so that their rate moves nothing; repeated rows get equal rates. An empty table,
    a table of empty texts and one without labelled texts keep rate 1. Columns of ``documents`` that bear a result's name are replaced.
    """
    model = fit_domains(documents, labelled, id_col=id_col, text_col=text_col, domain_col=domain_col)
    wanted = np.array([targets.get(x, 0.0) if targets else 1.0 for x in model.domains])
    if model.domains and (wanted.sum() <= 0 or (wanted < 0).any()):
        raise ValueError("targets must be nonnegative and name a learnt domain")
    targets_ = (wanted / max(wanted.sum(), 1e-300)).tolist()
    members = memberships(documents, model, text_col=text_col).withColumn("_draw", F.xxhash64(F.col(id_col), F.col(text_col)))
    members = written(members if keep_text else members.drop(text_col))
    rows, shares = fit_rates(members, targets_, **options)
    likeliest = F.array_position("posterior", F.array_max("posterior")).cast("int")
    domain = F.element_at(F.array(*map(F.lit, model.domains)), likeliest) if model.domains else F.lit(None).cast("string")
    for name, values in (("target_share", targets_), ("expected_share", shares)):
        known = F.element_at(F.array(*map(F.lit, values)), likeliest) if model.domains else F.lit(None).cast("double")
        rows = rows.withColumn(name, known)
    return rows.withColumn("domain", domain).withColumn("copies", copies_of(F.col("rate"), F.col("_draw"))).drop("_draw")
