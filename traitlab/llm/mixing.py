"""Mixing sources to target weights with soft membership (operator 1);
DataFrame functions only.

A classifier fitted on a labelled table gives every document posterior shares
of the domains: naive Bayes over a bounded vocabulary of the commonest words,
with the evidence of a text counted as at most ``evidence`` words, so that
membership stays soft.  Rates ``r >= 0`` of the documents are then sought with
``sum_d r_d * tokens_d * p_dk = target_k`` for every domain k: least squares in
relative errors by projected gradient from ``r = 1``.  One pass of the slim
table (tokens, posteriors, rate) per step gives the K sums of the residual; the
step follows from the K x K Gram matrix.  Only K numbers reach the driver per
step; the rate is an expression of them, written every few steps.

Edge cases: a null or empty text has no tokens, the prior's posteriors and rate
1; a null label is no training row; a null id is carried; without training rows
or tokens all rates are 1; a target for a domain without training rows raises
an error; repeated rows get equal rates; an empty table gives an empty
result."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import written

MAX_DOMAINS = 64


def _words(text: Column) -> Column:
    return F.split(F.lower(text), r"[\x20\x09-\x0D]+")


def fit_domains(labelled: DataFrame, domain_col: str, id_col: str = "doc_id", text_col: str = "text", per_domain: int = 400, vocabulary: int = 2000) -> tuple[list[str], list[float], DataFrame | None]:
    """(domains, log priors, table (word, s0..sK-1) of log likelihoods).  The
    fit sees about ``per_domain`` labelled rows of each domain (drawn by a hash
    of the id) and the table has at most ``vocabulary`` rows."""
    rows = labelled.where(F.col(domain_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(domain_col).cast("string").alias("domain"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    sizes = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().limit(MAX_DOMAINS + 1).collect()}
    if len(sizes) > MAX_DOMAINS:
        raise ValueError(f"over {MAX_DOMAINS} domains in {domain_col}")
    domains = sorted(sizes)
    if not domains:
        return [], [], None
    share = F.lit(0.0)
    for d in domains:
        share = F.when(F.col("domain") == d, F.lit(min(1.0, per_domain / sizes[d]))).otherwise(share)
    part = rows.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000)) < share * 1_000_000)
    counted = written(part.select("domain", F.explode(_words(F.col("t"))).alias("word")).where("word != ''").groupBy("word").pivot("domain", domains).count().fillna(0), "words")
    col = [F.col(f"`{d}`") for d in domains]
    total = sum(col[1:], col[0])
    best = counted.orderBy(total.desc(), "word").limit(vocabulary)
    sums = counted.agg(*[F.sum(c).alias(f"t{k}") for k, c in enumerate(col)]).first()
    score = [F.log((c + 1.0) / F.lit(float((sums[k] or 0) + vocabulary))).alias(f"s{k}") for k, c in enumerate(col)]
    n = sum(sizes.values())
    return domains, [float(np.log(sizes[d] / n)) for d in domains], written(best.select("word", *score), "vocabulary")


def posteriors(docs: DataFrame, domains: list[str], priors: list[float], scores: DataFrame, text_col: str = "text", evidence: float = 8.0) -> DataFrame:
    """``docs`` columns (but the text) plus ``tokens`` and ``p0..pK-1``."""
    keep = [c for c in docs.columns if c != text_col]
    k = range(len(domains))
    rows = docs.withColumn("_rid", F.monotonically_increasing_id()).withColumn("_w", F.filter(_words(F.coalesce(F.col(text_col), F.lit(""))), lambda w: w != ""))
    words = rows.select("_rid", *keep, F.size("_w").cast("long").alias("tokens"), F.explode_outer("_w").alias("word"))
    met = words.join(F.broadcast(scores), "word", "left")  # at most `vocabulary` rows
    sums = met.groupBy("_rid", *keep, "tokens").agg(F.count("s0").alias("_n"), *[F.sum(f"s{i}").alias(f"_s{i}") for i in k])
    weigh = F.lit(float(evidence)) / F.greatest(F.col("_n"), F.lit(float(evidence)))
    logit = sums.select(*keep, "tokens", *[(F.coalesce(F.col(f"_s{i}"), F.lit(0.0)) * weigh + priors[i]).alias(f"_l{i}") for i in k])
    logit = logit.withColumn("_m", F.greatest(*[F.col(f"_l{i}") for i in k]) if len(domains) > 1 else F.col("_l0"))
    exps = logit.select(*keep, "tokens", *[F.exp(F.col(f"_l{i}") - F.col("_m")).alias(f"_e{i}") for i in k])
    total = sum((F.col(f"_e{i}") for i in k), F.lit(0.0))
    return exps.select(*keep, "tokens", *[(F.col(f"_e{i}") / total).alias(f"p{i}") for i in k])


def solve_rates(members: DataFrame, targets: list[float], max_steps: int = 300, tolerance: float = 1e-6, per_write: int = 12) -> DataFrame:
    """``members`` (written; ``tokens``, ``p0..``) plus ``rate``."""
    k = range(len(targets))
    a = [F.col(f"p{i}") * F.col("tokens") for i in k]
    gram = members.agg(*[F.sum(a[i] * a[j]).alias(f"g{i}_{j}") for i in k for j in k if i <= j]).first()
    g = np.array([[float(gram[f"g{min(i, j)}_{max(i, j)}"] or 0.0) for j in k] for i in k])
    if not g.any():
        return members.withColumn("rate", F.lit(1.0))
    t = np.array(targets, dtype=float)
    scale = 1 / np.sqrt(np.maximum(np.diag(g), 1e-30))  # relative errors: the scaled Gram has a unit diagonal
    step = 1 / np.linalg.eigvalsh(g * scale[:, None] * scale[None, :]).max()
    table = members.withColumn("rate", F.lit(1.0))
    for turn in range(max_steps):
        sums = table.agg(*[F.sum(a[i] * F.col("rate")).alias(f"x{i}") for i in k]).first()
        residual = np.array([float(sums[i] or 0.0) for i in k]) - t
        if np.abs(residual).max() <= tolerance * max(t.max(), 1.0):
            break
        c = step * residual * scale**2
        move = sum((a[i] * float(c[i]) for i in k), F.lit(0.0))
        table = table.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - move))
        if turn % per_write == per_write - 1:
            table = written(table, "rates")
    return table


def mix(docs: DataFrame, labelled: DataFrame, domain_col: str, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", grow: bool = False, **fitting) -> DataFrame:
    """(doc_id, tokens, domain, rate): expected tokens ``rate * tokens * p`` by
    domain are in the proportions ``weights``.  Their total is that of ``docs``
    or, with ``grow``, the least at which no domain has to shrink."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    domains, priors, scores = fit_domains(labelled, domain_col, id_col, text_col, **fitting)
    if scores is None:
        size = F.when(F.trim("t") == "", 0).otherwise(F.size(F.filter(_words(F.col("t")), lambda w: w != "")))
        return rows.select("doc_id", F.coalesce(size, F.lit(0)).cast("long").alias("tokens"), F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"))
    if unknown := set(weights) - set(domains):
        raise ValueError(f"no labelled rows of {sorted(unknown)}")
    members = written(posteriors(rows, domains, priors, scores, "t"), "members")
    share = np.array([float(weights.get(d, 0.0)) for d in domains])
    share = share / share.sum()
    now = members.agg(*[F.sum(F.col(f"p{i}") * F.col("tokens")) for i in range(len(domains))]).first()
    now = np.array([float(x or 0.0) for x in now])
    total = max((n / s for n, s in zip(now, share) if s > 0), default=0.0) if grow else now.sum()
    out = solve_rates(members, (share * total).tolist())
    p = [F.col(f"p{i}") for i in range(len(domains))]
    best = F.greatest(*p) if len(p) > 1 else p[0]
    return out.select("doc_id", "tokens", F.coalesce(*[F.when(x == best, F.lit(d)) for x, d in zip(p, domains)]).alias("domain"), "rate")
