"""Many clusterings of one feature table, fitted and rated together.

A pass over the table serves every configuration that is still open: each task
assigns its rows under all of them and adds up their sums.  A configuration
that has converged, or reached its last step, drops out.  K-Means and mixtures
follow ``kmeans`` and ``gmm`` step for step; rating takes two more passes for
all configurations (cluster sums; distances to the own centre and squared
silhouettes).  ``passes`` counts them."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.functions.vectors import matrix, softmax_rows, squared_distances, summed, tasks_of
from traitlab.operators.cluster.gmm import GMMParams, factors, log_joint, m_step
from traitlab.session import scratch_table


@dataclass
class Config:
    """One configuration: model 'KMeans' or 'GMM', its start rows, and where
    it stands."""

    model: str
    start: np.ndarray
    max_iter: int = 100
    tol: float = 1e-6
    covariance: str = "full"
    reg: float = 1e-6
    steps: int = 0
    done: bool = False
    error: str | None = None
    #: centres, or the mixture's parameters: those that give the labels, and the newest
    labels_by: object = None
    newest: object = None
    loglik: float = 0.0

    def __post_init__(self):
        k, d = self.start.shape
        self.newest = self.start.copy() if self.model == "KMeans" else GMMParams(np.full(k, 1.0 / k), self.start.copy(), np.stack([np.eye(d)] * k))
        self.labels_by = self.newest
        if self.max_iter == 0:
            self.done = True

    def scorer(self, which) -> tuple[str, object]:
        return self.model, (which if self.model == "KMeans" else factors(which))

    def place(self, which) -> tuple:
        """Equal for configurations that stand at the same parameters."""
        held = [which] if self.model == "KMeans" else [which.weights, which.means, which.covs]
        return self.model, *[(np.shape(v), np.asarray(v, dtype=float).tobytes()) for v in held]

    def size(self) -> int:
        k, d = self.start.shape
        return k * (d + 1) if self.model == "KMeans" else 2 + k + k * d + k * d * d


def batch_labels(scorer, x: np.ndarray) -> np.ndarray:
    model, params = scorer
    return squared_distances(x, params).argmin(axis=1) if model == "KMeans" else log_joint(params, x).argmax(axis=1)


def _step_sums(scorer, x: np.ndarray) -> np.ndarray:
    model, params = scorer
    if model == "KMeans":
        total = np.zeros((len(params), x.shape[1] + 1))
        np.add.at(total, batch_labels(scorer, x), np.column_stack([x, np.ones(len(x))]))
        return total.ravel()
    lp = log_joint(params, x)
    top, r = lp.max(axis=1, keepdims=True), softmax_rows(lp)
    diffs = [x - mean for mean, _, _ in params]
    parts = [np.array([(top[:, 0] + np.log(np.exp(lp - top).sum(axis=1))).sum(), len(x)]), r.sum(axis=0)]
    parts += [r[:, j] @ diffs[j] for j in range(len(params))]
    parts += [((diffs[j] * r[:, j : j + 1]).T @ diffs[j]).ravel() for j in range(len(params))]
    return np.concatenate(parts)


@dataclass
class Batch:
    """A feature table, written once, and its configurations."""

    data: DataFrame
    cols: list[str]
    tasks: int
    passes: int = 0
    seconds: list = field(default_factory=list)

    @classmethod
    def of(cls, df: DataFrame, cols: Sequence[str]) -> Batch:
        data = scratch_table(df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna(), "batch")
        return cls(data, list(cols), tasks_of(data))

    def _sum(self, scorers: list, sizes: list[int], part: Callable) -> list[np.ndarray]:
        """Per scorer the sum of part(scorer index, x), in one pass."""
        self.passes += 1
        cols = self.cols

        def work(scorers, batch):
            x = matrix(batch, cols)
            return np.concatenate([part(i, s, x) for i, s in enumerate(scorers)])

        total = summed(self.data, scorers, work, sum(sizes), self.tasks)
        return np.split(total, np.cumsum(sizes)[:-1])

    def fit(self, configs: list[Config], in_time: Callable[[], bool] = lambda: True) -> None:
        """Advances all configurations until each is done; when time is up,
        the open ones get the error 'skipped: time budget'."""
        first = True
        while open_ := [c for c in configs if not c.done and c.error is None]:
            if not in_time():
                for c in open_:
                    c.error = "skipped: time budget"
                return
            ready, scorers = [], {}
            for c in open_:
                try:
                    scorers.setdefault(c.place(c.newest), (c.size(), c.scorer(c.newest)))
                    ready.append(c)
                except np.linalg.LinAlgError as e:  # a component has collapsed
                    c.error = f"LinAlgError: {e}"
            if not ready:
                continue
            # configurations that differ in their stop alone share their sums while they stand at one place
            sums = dict(zip(scorers, self._sum([s for _, s in scorers.values()], [n for n, _ in scorers.values()], lambda i, s, x: _step_sums(s, x))))
            at = [c.place(c.newest) for c in ready]
            for c, total in zip(ready, (sums[p] for p in at)):
                _advance_kmeans(c, total) if c.model == "KMeans" else _advance_mixture(c, total, first)
            first = False

    def rate(self, configs: list[Config]) -> list[dict]:
        """Per configuration the metrics of C9-C12 and the squared silhouette,
        with the guard of C15."""
        ok = [c for c in configs if c.error is None]
        if not ok:
            return [{} for _ in configs]
        cols, d = self.cols, len(self.cols)
        mean = summed(self.data, None, lambda _, b: np.append(matrix(b, cols).sum(axis=0), b.num_rows), d + 1, self.tasks)
        self.passes += 1
        mean = mean[:-1] / max(mean[-1], 1)
        scorers, ks = [c.scorer(c.labels_by) for c in ok], [len(c.start) for c in ok]

        def sums(i, s, x):
            total, z = np.zeros((ks[i], d + 2)), x - mean
            np.add.at(total, batch_labels(s, x), np.column_stack([np.ones(len(x)), z, np.square(z).sum(axis=1)]))
            return total.ravel()

        held = [t.reshape(k, -1) for t, k in zip(self._sum(scorers, [k * (d + 2) for k in ks], sums), ks)]
        mus = [t[:, 1:-1] / np.maximum(t[:, :1], 1) for t in held]

        def spread(i, s, x):
            at, z, t = batch_labels(s, x), x - mean, held[i]
            n = t[:, 0]
            own = np.sqrt(np.square(z - mus[i][at]).sum(axis=1))
            dist = np.square(z).sum(axis=1)[:, None] - 2.0 * z @ mus[i].T + t[:, -1] / np.maximum(n, 1)
            row = np.arange(len(x))
            size = n[at]
            a = dist[row, at] * size / np.maximum(size - 1, 1)
            dist[:, n == 0] = np.inf
            dist[row, at] = np.inf
            b = dist.min(axis=1, initial=np.inf)
            top = np.maximum(a, b)
            with np.errstate(invalid="ignore", divide="ignore"):
                sil = np.where((size > 1) & (top != 0) & np.isfinite(b), (b - a) / top, 0.0)
            return np.append(np.bincount(at, own, minlength=len(n)), sil.sum())

        wide = self._sum(scorers, [k + 1 for k in ks], spread)
        found = iter([_metrics(t, w) for t, w in zip(held, wide)])
        return [next(found) if c.error is None else {} for c in configs]


def _advance_kmeans(c: Config, total: np.ndarray) -> None:
    total = total.reshape(len(c.start), -1)
    new = np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1), c.newest)
    shift = float(np.linalg.norm(new - c.newest, axis=1).max())
    c.newest = c.labels_by = new
    c.steps += 1
    c.done = c.steps >= c.max_iter or shift < c.tol


def _advance_mixture(c: Config, total: np.ndarray, first: bool) -> None:
    """E-step sums of the newest parameters: their log-likelihood decides the
    stop, else the M-step follows."""
    k, d = c.start.shape
    ll, n = float(total[0]), int(total[1])
    if c.steps:
        stop = abs(ll - c.loglik) < c.tol or c.steps >= c.max_iter
        c.loglik = ll
        if stop:
            c.done = True
            return
    nk, s, q = total[2 : 2 + k], total[2 + k : 2 + k + k * d].reshape(k, d), total[2 + k + k * d :].reshape(k, d, d)
    c.labels_by, c.newest = c.newest, m_step(n, nk, s, q, c.newest.means, c.covariance, c.reg)
    c.steps += 1


def _metrics(t: np.ndarray, wide: np.ndarray) -> dict:
    """Of cluster sums about the overall mean and (distance sums, silhouette
    sum); empty clusters do not count."""
    used = t[:, 0] > 0
    n, s, q = t[used, 0], t[used, 1:-1], t[used, -1]
    share = n / n.sum()
    out = {"n_clusters_found": int(used.sum()), "cluster_entropy": float(-(share * np.log(share)).sum())}
    if len(n) < 2:
        return out | {"calinski_harabasz": -1.0, "davies_bouldin": math.inf, "silhouette": -1.0}
    held, every = float((np.square(s).sum(axis=1) / n).sum()), s.sum(axis=0)
    between, within = held - float(every @ every) / n.sum(), float(q.sum()) - held
    ch = 0.0 if within <= 0 else float((between / (len(n) - 1)) / (within / (n.sum() - len(n)))) if n.sum() > len(n) else None
    mu, scatter, worst = s / n[:, None], wide[:-1][used] / n, []
    for i in range(len(n)):
        gap = np.sqrt(np.square(mu - mu[i]).sum(axis=1))
        far = gap > 0
        worst.append(((scatter[far] + scatter[i]) / gap[far]).max(initial=0.0))
    return out | {"calinski_harabasz": ch, "davies_bouldin": float(np.mean(worst)), "silhouette": float(wide[-1] / n.sum())}
