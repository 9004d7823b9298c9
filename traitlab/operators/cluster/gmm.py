"""Gaussian mixture by EM (C4 full covariance, C5 tied, C7 soft
assignment, C8 log-likelihood), in any number of dimensions.

Parameters (k weights, k*d means, k*d*d covariances) live on the driver and
travel as a broadcast, the covariances as inverted Cholesky factors.  One pass
per iteration over the features, written once: every task takes the log
densities of its rows as matrix products and adds up, per component, the
responsibilities r, r*(x - mu) and r*(x - mu)(x - mu)', mu being the mean the
pass started from; these sums (k * (1 + d + d*d) numbers) are mergeable.
Iteration semantics follow the reference loop: M-step, then log-likelihood of
the new parameters, stop when the absolute change is below ``tol``; labels
come from the last E-step (the parameters before the final M-step).  Rows with
a null feature take no part and get no label."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.functions.columns import det
from traitlab.functions.vectors import best_position, matrix, softmax_rows, summed, tasks_of, with_scores
from traitlab.session import scratch_table


@dataclass
class GMMParams:
    weights: np.ndarray  # k
    means: np.ndarray  # k x d
    covs: np.ndarray  # k x d x d


@dataclass
class GMMModel:
    cols: list[str]
    params: GMMParams
    label_params: GMMParams
    loglik: list[float] = field(default_factory=list)
    n_iter: int = 0

    def transform(self, df: DataFrame, out: str = "cluster", prob_prefix: str = "p_", use_label_params: bool = True) -> DataFrame:
        """Responsibilities and the most likely component (the first on ties)."""
        th = self.label_params if use_label_params else self.params
        k = len(th.weights)
        scored = with_scores(df, self.cols, factors(th), log_joint, k, "_lp")
        place = F.when(F.col("_lp").isNotNull(), (best_position("_lp") - 1).cast("int"))
        scored = scored.withColumn(out, place)
        share = F.transform("_lp", lambda v: F.exp(v - F.array_max("_lp")))
        scored = scored.withColumn("_lp", share).withColumn("_t", F.aggregate("_lp", F.lit(0.0), lambda a, v: a + v))
        return scored.withColumns({f"{prob_prefix}{j}": F.get("_lp", F.lit(j)) / F.col("_t") for j in range(k)}).drop("_lp", "_t")


def factors(th: GMMParams) -> list[tuple]:
    """Per component: mean, inverse of the covariance's Cholesky factor, and
    the constant of the log density with the weight."""
    out, d = [], th.means.shape[1]
    for weight, mean, cov in zip(th.weights, th.means, th.covs):
        low = np.linalg.cholesky(cov)
        const = (math.log(weight) if weight > 0 else -math.inf) - 0.5 * d * math.log(2.0 * math.pi) - float(np.log(np.diag(low)).sum())
        out.append((mean, np.linalg.inv(low), const))
    return out


def log_joint(parts: list[tuple], x: np.ndarray) -> np.ndarray:
    """Rows x components: ln(pi_j N(x | mu_j, S_j))."""
    return np.stack([const - 0.5 * np.square((x - mean) @ inv.T).sum(axis=1) for mean, inv, const in parts], axis=1)


def log_likelihood(df: DataFrame, cols: Sequence[str], th: GMMParams) -> float:
    """Sum over rows of ln sum_j pi_j N(x | mu_j, S_j)."""
    return em_statistics(df.select(*cols), cols, th)[0]


def em_statistics(df: DataFrame, cols: Sequence[str], th: GMMParams, tasks: int | None = None) -> tuple[float, int, np.ndarray, np.ndarray, np.ndarray]:
    """One pass: log-likelihood under ``th``, rows, and per component the sums
    of r, r*(x - mu), r*(x - mu)(x - mu)'."""
    k, d = th.means.shape
    cols = list(cols)

    def part(parts, batch):
        x = matrix(batch, cols)
        x = x[~np.isnan(x).any(axis=1)]
        lp = log_joint(parts, x)
        top = lp.max(axis=1, keepdims=True) if len(x) else lp
        r = softmax_rows(lp)
        sums = [np.array([float((top[:, 0] + np.log(np.exp(lp - top).sum(axis=1))).sum()) if len(x) else 0.0, len(x)]), r.sum(axis=0)]
        diffs = [x - mean for mean, _, _ in parts]
        sums += [r[:, j] @ diffs[j] for j in range(k)]
        sums += [((diffs[j] * r[:, j : j + 1]).T @ diffs[j]).ravel() for j in range(k)]
        return np.concatenate(sums)

    total = summed(df.select(*cols), factors(th), part, 2 + k + k * d + k * d * d, tasks)
    return float(total[0]), int(total[1]), total[2 : 2 + k], total[2 + k : 2 + k + k * d].reshape(k, d), total[2 + k + k * d :].reshape(k, d, d)


def m_step(n: int, nk: np.ndarray, s: np.ndarray, q: np.ndarray, about: np.ndarray, covariance: str = "full", reg: float = 0.0) -> GMMParams:
    """Parameters from the sums about the means ``about``."""
    k, d = s.shape
    shift = s / nk[:, None]
    covs = np.stack([q[j] / nk[j] - np.outer(shift[j], shift[j]) for j in range(k)])
    if covariance == "tied":
        pooled = sum(nk[j] * covs[j] for j in range(k)) / n
        covs = np.stack([pooled] * k)
    covs = covs + reg * np.eye(d)[None, :, :]
    return GMMParams(nk / n, about + shift, covs)


def init_params(df: DataFrame, key: str, cols: Sequence[str], k: int, seed: int = 42) -> GMMParams:
    """pi = 1/k, mu = the first k rows by det(key), Sigma = I."""
    rows = df.select(*cols, det(key, seed).alias("_d"), F.col(key).alias("_k")).orderBy("_d", "_k").limit(k).collect()
    means = np.array([[float(r[c]) for c in cols] for r in rows])
    d = len(cols)
    return GMMParams(np.full(k, 1.0 / k), means, np.stack([np.eye(d)] * k))


def gmm(
    df: DataFrame,
    key: str,
    cols: Sequence[str],
    k: int = 3,
    max_iter: int = 100,
    tol: float = 1e-4,
    covariance: str = "full",
    reg: float = 1e-6,
    seed: int = 42,
) -> GMMModel:
    """EM for a Gaussian mixture (``covariance`` 'full' or 'tied')."""
    cols = list(cols)
    th = init_params(df, key, cols, k, seed)
    prev = th
    lls: list[float] = []
    ll_old = 0.0
    it = 0
    data = scratch_table(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "mixture")
    tasks = tasks_of(data)
    _ll0, n, nk, s, q = em_statistics(data, cols, th, tasks)  # E-step with the start values
    for it in range(1, max_iter + 1):
        new = m_step(n, nk, s, q, th.means, covariance, reg)
        ll, n, nk, s, q = em_statistics(data, cols, new, tasks)  # LL of new params + next E-step sums
        prev, th = th, new
        lls.append(ll)
        if abs(ll - ll_old) < tol:
            break
        ll_old = ll
    return GMMModel(cols, th, prev, lls, it)


def gmm_ml(df: DataFrame, cols: Sequence[str], k: int = 3, max_iter: int = 100, tol: float = 1e-4, seed: int = 42, out: str = "cluster"):
    """C4 production path: Spark ML GaussianMixture (full covariance)."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=list(cols), outputCol="_features")
    data = va.transform(df)
    model = GaussianMixture(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol="_features", predictionCol=out, probabilityCol="_prob").fit(data)
    return model.transform(data).drop("_features", "_prob"), model
