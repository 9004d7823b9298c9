"""Feature transforms.

Statistics are fitted with one global aggregation (partial aggregation on
every partition, p or p*p numbers to the driver), then applied as plain
column arithmetic with literals: no second pass beyond the apply, no UDF."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitlab.operators.sample import MAX_GROUPS, collect_bounded

# ------------------------------------------------------------------ F1 / F2


@dataclass
class Scaler:
    cols: list[str]
    mean: list[float]
    std: list[float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        exprs = {}
        for c, m, s in zip(self.cols, self.mean, self.std):
            exprs[c + suffix] = F.lit(0.0) if s == 0 else (F.col(c) - F.lit(m)) / F.lit(s)
        return df.withColumns(exprs)


def fit_scaler(df: DataFrame, cols: Sequence[str]) -> Scaler:
    """Mean and population std of each column in one aggregation."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    r = df.agg(*aggs).collect()[0]
    return Scaler(list(cols), [float(r[f"m_{c}"]) for c in cols], [float(r[f"s_{c}"] or 0.0) for c in cols])


def standardize(train: DataFrame, cols: Sequence[str], *others: DataFrame):
    """(x - mean) / population std fitted on ``train``; constant -> 0.

    Returns (train', *others', scaler)."""
    sc = fit_scaler(train, cols)
    return (sc.transform(train), *[sc.transform(o) for o in others], sc)


def minmax(df: DataFrame, cols: Sequence[str], by: Sequence[str] | None = None, suffix: str = "") -> DataFrame:
    """(x - min) / (max - min); a constant column gives null (0/0).

    Global range: one aggregation, applied as literals.  Per-group range
    (``by``): one row per group, collected under a size bound and joined
    back with a broadcast.  Never an unpartitioned window over rows."""
    cols = list(cols)
    aggs = [x for c in cols for x in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))]
    if not by:
        r = df.agg(*aggs).collect()[0]
        exprs = {}
        for c in cols:
            lo, hi = r[f"_lo_{c}"], r[f"_hi_{c}"]
            exprs[c + suffix] = F.try_divide(F.col(c) - F.lit(lo), F.lit(hi) - F.lit(lo))
        return df.withColumns(exprs)
    keys = {b: f"_by{i}" for i, b in enumerate(by)}
    rng = df.groupBy(*by).agg(*aggs).withColumnsRenamed(keys)
    same = reduce(lambda x, y: x & y, [df[b].eqNullSafe(rng[k]) for b, k in keys.items()])
    j = df.join(rng, same, "left").drop(*keys.values())
    exprs = {c + suffix: F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) for c in cols}
    return j.withColumns(exprs).drop(*[f"_{k}_{c}" for c in cols for k in ("lo", "hi")])


# ------------------------------------------------------------------ F3 / F4


@dataclass
class LabelMap:
    labels: list

    def column(self, col: str):
        known = [v for v in self.labels if v is not None]
        if not known:
            return F.lit(None).cast("int")
        m = F.create_map(*[x for i, v in enumerate(known) for x in (F.lit(v), F.lit(i))])
        return F.try_element_at(m, F.col(col)).cast("int")


def encode_labels(df: DataFrame, y: str, out: str | None = None) -> tuple[DataFrame, LabelMap]:
    """sorted distinct labels -> 0..k-1 (alphabetical, like a label encoder);
    a null label stays null.

    The distinct set is bounded (classes), collected with a size check and
    applied as a literal map lookup."""
    vals = collect_bounded(df.select(y).where(F.col(y).isNotNull()).distinct().orderBy(y), MAX_GROUPS, "encode_labels")
    lm = LabelMap([r[0] for r in vals])
    return df.withColumn(out or f"{y}_code", lm.column(y)), lm


def one_hot(df: DataFrame, y: str, classes: Sequence, prefix: str = "is_") -> DataFrame:
    """one 0/1 column per class."""
    return df.withColumns({f"{prefix}{c}": F.col(y).eqNullSafe(F.lit(c)).cast("double") for c in classes})


# ------------------------------------------------------------------ moments

#: p x p numbers are held on the driver
MAX_MOMENT_COLUMNS = 4096


def moments(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean vector and population covariance matrix of ``cols`` over the
    rows without a null or NaN in them.

    One path for any number of columns, in the JVM: a summary pass (count,
    means, variances), then Spark's tree-aggregated correlation matrix, which
    centres the rows before it multiplies them; p x p numbers reach the
    driver."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation, Summarizer

    cols = list(cols)
    p = len(cols)
    if p > MAX_MOMENT_COLUMNS:
        raise ValueError(f"moments: {p} columns; at most {MAX_MOMENT_COLUMNS}")
    x = VectorAssembler(inputCols=cols, outputCol="_x", handleInvalid="skip").transform(df.select(*[F.col(c).cast("double").alias(c) for c in cols])).select("_x")
    r = x.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("_x")).alias("s")).first()["s"]
    n = int(r["count"])
    if n == 0:
        return 0, np.full(p, np.nan), np.full((p, p), np.nan)
    mean, var = r["mean"].toArray(), r["variance"].toArray() * ((n - 1) / n)
    cov = np.diag(var)
    if p > 1 and n > 1:
        corr = np.nan_to_num(Correlation.corr(x, "_x").first()[0].toArray())  # NaN where a column is constant
        std = np.sqrt(var)
        cov = corr * np.outer(std, std)
        np.fill_diagonal(cov, var)
    return n, mean, cov


def covariance_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Population covariance of every ordered pair as rows (var1, var2, cov):
    one aggregation, then the p*p numbers exploded."""
    cols = list(cols)
    r = df.agg(*[F.covar_pop(a, b).alias(f"{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j])
    cells = [
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"{min(i, j)}_{max(i, j)}").alias("cov"))
        for i, a in enumerate(cols)
        for j, b in enumerate(cols)
    ]
    return r.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


# ------------------------------------------------------------------ F5


@dataclass
class FactorModel:
    cols: list[str]
    mean: np.ndarray
    components: np.ndarray  # k x p loadings W
    noise_variance: np.ndarray  # p
    n_iter: int = 0
    loglike: list[float] = field(default_factory=list)

    def projection(self) -> np.ndarray:
        """p x k matrix P with scores = (x - mean) @ P."""
        w = self.components
        wpsi = w / self.noise_variance
        cov_z = np.linalg.inv(np.eye(w.shape[0]) + wpsi @ w.T)
        return wpsi.T @ cov_z

    def transform(self, df: DataFrame, prefix: str = "factor_") -> DataFrame:
        proj = self.projection()
        exprs = {}
        for j in range(proj.shape[1]):
            terms = [(F.col(c) - F.lit(float(self.mean[i]))) * F.lit(float(proj[i, j])) for i, c in enumerate(self.cols)]
            exprs[f"{prefix}{j + 1}"] = reduce(add, terms)
        return df.withColumns(exprs)


def _profile(cov: np.ndarray, psi: np.ndarray, k: int) -> tuple[np.ndarray, float]:
    """For given noise variances: the k x p loadings that maximise the
    likelihood, and the deviance per row ``log|S| + tr(S^-1 C)`` there, S being
    loadings' loadings + diag(psi) (Joreskog's profile form).

    In units of the noise the covariance has eigenvalues e; the best loadings
    keep the k largest, each less the unit of noise, and the model's own
    eigenvalues are max(e, 1) for these and 1 for the rest."""
    unit = 1.0 / np.sqrt(psi)
    e, v = np.linalg.eigh(unit[:, None] * cov * unit[None, :])
    kept, rest = slice(len(e) - k, len(e)), slice(0, len(e) - k)
    strength = np.clip(e[kept] - 1.0, 0.0, None)
    loadings = (v[:, kept] * np.sqrt(strength) / unit[:, None]).T[::-1]
    model = strength + 1.0
    deviance = np.log(psi).sum() + np.log(model).sum() + (e[kept] / model).sum() + e[rest].sum()
    return loadings, float(deviance)


def fit_factor_analysis(df: DataFrame, cols: Sequence[str], n_factors: int = 5, max_iter: int = 1000, tol: float = 1e-2) -> FactorModel:
    """maximum-likelihood factor analysis from the covariance matrix.

    ``moments`` is the only pass over the data.  On the driver a fixed-point
    iteration on p x p matrices alternates the best loadings for the noise
    variances with the noise that these loadings leave, until the
    log-likelihood rises by less than ``tol``.  Signs: the largest loading of
    every factor is positive."""
    n, mean, cov = moments(df, cols)
    k = min(n_factors, len(cols))
    psi = np.ones(len(cols))
    trace: list[float] = []
    loadings = np.zeros((k, len(cols)))
    for _ in range(max_iter):
        loadings, deviance = _profile(cov, psi, k)
        trace.append(-0.5 * n * (len(cols) * np.log(2 * np.pi) + deviance))
        if len(trace) > 1 and trace[-1] - trace[-2] < tol:
            break
        psi = np.maximum(np.diag(cov) - np.square(loadings).sum(axis=0), 1e-12)
    peak = loadings[np.arange(k), np.abs(loadings).argmax(axis=1)]
    return FactorModel(list(cols), mean, loadings * np.where(peak < 0, -1.0, 1.0)[:, None], psi, len(trace), trace)


def factor_scores(df: DataFrame, cols: Sequence[str], n_factors: int = 5, prefix: str = "factor_") -> tuple[DataFrame, FactorModel]:
    model = fit_factor_analysis(df, cols, n_factors)
    return model.transform(df, prefix), model


# ------------------------------------------------------------------ F6


@dataclass
class PCAModel:
    cols: list[str]
    mean: np.ndarray
    scale: np.ndarray
    loadings: np.ndarray  # p x k
    explained_variance: np.ndarray

    def transform(self, df: DataFrame, prefix: str = "pc") -> DataFrame:
        exprs = {}
        for j in range(self.loadings.shape[1]):
            terms = [
                (F.col(c) - F.lit(float(self.mean[i]))) * F.lit(float(self.loadings[i, j] / self.scale[i]))
                for i, c in enumerate(self.cols)
            ]
            exprs[f"{prefix}{j + 1}"] = reduce(add, terms)
        return df.withColumns(exprs)


def pca(df: DataFrame, cols: Sequence[str], k: int | None = None, scale: bool = True) -> tuple[DataFrame, PCAModel]:
    """centred (and scaled, sample std like R's prcomp) principal components.

    Eigen-decomposition of the p x p covariance/correlation matrix from one
    moments pass; sign rule: largest absolute loading positive."""
    n, mean, cov = moments(df, cols)
    p = len(cols)
    k = k or p
    cov_s = cov * n / max(n - 1, 1)
    sd = np.sqrt(np.diag(cov_s)) if scale else np.ones(p)
    sd = np.where(sd == 0, 1.0, sd)
    corr = cov_s / np.outer(sd, sd)
    evals, evecs = np.linalg.eigh(corr)
    order = np.argsort(evals)[::-1][:k]
    vecs = evecs[:, order]
    for j in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    model = PCAModel(list(cols), mean, sd, vecs, evals[order])
    return model.transform(df), model


def pca_loadings(spark, model: PCAModel) -> DataFrame:
    rows = [(c, j + 1, float(model.loadings[i, j])) for i, c in enumerate(model.cols) for j in range(model.loadings.shape[1])]
    return spark.createDataFrame(rows, "variable string, component int, loading double")


# ------------------------------------------------------------------ F7 / F8


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", intercept: bool = False) -> DataFrame:
    """Spark ML feature vector (plus an optional intercept column)."""
    from pyspark.ml.feature import VectorAssembler

    if intercept:
        df = df.withColumn("intercept", F.lit(1.0))
        cols = ["intercept", *cols]
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def feature_set(columns: Sequence[str], names: Sequence[str], registry: dict[str, Sequence[str]]) -> tuple[str, list[str]]:
    """F8: union of named column groups -> ('a+b', [cols]); absent names dropped."""
    cols: list[str] = []
    for n in names:
        for c in registry[n]:
            if c in columns and c not in cols:
                cols.append(c)
    return "+".join(names), cols


def as_array(df: DataFrame, cols: Sequence[str], out: str = "x") -> DataFrame:
    return df.withColumn(out, F.array(*[F.col(c).cast(T.DoubleType()) for c in cols]))
