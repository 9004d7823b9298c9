"""A feed-forward network trained by mini-batches on Spark.

The rows are dealt into batches by a hash of their key, and a hash of its own
holds back a share for validation; both are written once, a folder per batch,
so that a step reads its batch alone.  A step broadcasts the flat parameters,
every task returns the gradient sum of its rows, and the driver, which holds
the parameters and the moment vectors, applies adam or momentum descent.  An
epoch takes the batches in an order drawn by the seed.  After it the held-out
loss and accuracy are measured: with ``early_stopping`` training ends when the
loss has not fallen by ``tol`` for ``n_iter_no_change`` epochs, and the best
parameters are kept; without, the same rule watches the training loss.

A loss is the mean cross entropy plus alpha/2 |weights|^2 / rows of the batch,
as in the reference's estimator; biases are not penalised.  Rows with a null
label or feature train nothing."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlab.functions.vectors import best_label, matrix, softmax_rows, summed, tasks_of, with_scores
from traitlab.operators.sample import MAX_GROUPS, collect_bounded
from traitlab.session import checkpoint_dir

#: batches that one epoch has at most unless ``batch_size`` is given
EPOCH_STEPS = 8
ACTIVATIONS = {
    "relu": (lambda v: np.maximum(v, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "logistic": (lambda v: 1.0 / (1.0 + np.exp(-v)), lambda a: a * (1.0 - a)),
    "identity": (lambda v: v, np.ones_like),
}


def shapes_of(widths: Sequence[int]) -> list[tuple[int, int]]:
    """Per layer (inputs + 1, outputs): the last row is the bias."""
    return [(a + 1, b) for a, b in zip(widths, widths[1:])]


def layers_of(flat: np.ndarray, widths: Sequence[int]) -> list[np.ndarray]:
    out, at = [], 0
    for a, b in shapes_of(widths):
        out.append(flat[at : at + a * b].reshape(a, b))
        at += a * b
    return out


def start_values(widths: Sequence[int], activation: str, seed: int) -> np.ndarray:
    """Uniform within sqrt(6 / (in + out)) (2 instead of 6 for logistic)."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in shapes_of(widths):
        bound = np.sqrt((2.0 if activation == "logistic" else 6.0) / (a - 1 + b))
        parts.append(rng.uniform(-bound, bound, a * b))
    return np.concatenate(parts)


def outputs(flat: np.ndarray, widths: Sequence[int], activation: str, x: np.ndarray) -> list[np.ndarray]:
    """Inputs of every layer, and last the class probabilities."""
    act = ACTIVATIONS[activation][0]
    values = [x]
    ms = layers_of(flat, widths)
    for m in ms[:-1]:
        values.append(act(values[-1] @ m[:-1] + m[-1]))
    return [*values, softmax_rows(values[-1] @ ms[-1][:-1] + ms[-1][-1])]


def batch_sums(flat: np.ndarray, widths: Sequence[int], activation: str, x: np.ndarray, y: np.ndarray, gradient: bool = True) -> np.ndarray:
    """[rows, cross entropy, hits, gradient...] summed over the rows."""
    values = outputs(flat, widths, activation, x)
    prob = values[-1]
    own = prob[np.arange(len(y)), y]
    head = [len(y), -np.log(np.maximum(own, 1e-300)).sum(), (prob.argmax(axis=1) == y).sum()]
    if not gradient:
        return np.array(head, dtype=float)
    slope = ACTIVATIONS[activation][1]
    g = prob.copy()
    g[np.arange(len(y)), y] -= 1.0
    parts = []
    for m, u in zip(reversed(layers_of(flat, widths)), reversed(values[:-1])):
        parts.append(np.vstack([u.T @ g, g.sum(axis=0)]).ravel())
        g = (g @ m[:-1].T) * slope(u)
    return np.concatenate([head, *reversed(parts)])


def weights_only(flat: np.ndarray, widths: Sequence[int]) -> np.ndarray:
    """The parameters with the biases set to zero."""
    out = flat.copy()
    for m in layers_of(out, widths):
        m[-1] = 0.0
    return out


class Adam:
    """First and second moments with bias correction."""

    def __init__(self, size: int, rate: float, b1: float = 0.9, b2: float = 0.999, eps: float = 1e-8):
        self.m, self.v, self.t = np.zeros(size), np.zeros(size), 0
        self.rate, self.b1, self.b2, self.eps = rate, b1, b2, eps

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.b1 * self.m + (1 - self.b1) * gradient
        self.v = self.b2 * self.v + (1 - self.b2) * gradient**2
        rate = self.rate * np.sqrt(1 - self.b2**self.t) / (1 - self.b1**self.t)
        return -rate * self.m / (np.sqrt(self.v) + self.eps)


class Momentum:
    """Descent with Nesterov momentum 0.9."""

    def __init__(self, size: int, rate: float, momentum: float = 0.9):
        self.v, self.rate, self.momentum = np.zeros(size), rate, momentum

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.v = self.momentum * self.v - self.rate * gradient
        return self.momentum * self.v - self.rate * gradient


SOLVERS = {"adam": Adam, "sgd": Momentum}


@dataclass
class Network:
    cols: list[str]
    classes: list
    widths: list[int]
    flat: np.ndarray
    activation: str = "relu"
    #: per epoch: training loss, held-out loss, held-out accuracy
    history: list = field(default_factory=list)

    def transform(self, df: DataFrame, out: str = "p", prob_prefix: str | None = "prob_") -> DataFrame:
        widths, activation = self.widths, self.activation
        scored = with_scores(df, self.cols, self.flat, lambda flat, x: outputs(flat, widths, activation, x)[-1], widths[-1], "_share")
        scored = scored.withColumn(out, best_label(self.classes, "_share"))
        if prob_prefix:
            scored = scored.withColumns({f"{prob_prefix}{c}": F.get("_share", F.lit(i)) for i, c in enumerate(self.classes)})
        return scored.drop("_share")


def batch_columns(key: str, batches: int, fraction: float, seed: int):
    """Batch of a row by hash of its key; -1 for the held-out share."""
    share = F.pmod(F.xxhash64(F.lit(seed), F.lit("held out"), key), F.lit(1_000_000)) < F.lit(round(fraction * 1_000_000))
    return F.when(share, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(batches))).cast("int")


def fit_network(
    train: DataFrame,
    cols: Sequence[str],
    y: str,
    key: str | None = None,
    hidden_layer_sizes: Sequence[int] = (100,),
    activation: str = "relu",
    solver: str = "adam",
    alpha: float = 1e-4,
    learning_rate_init: float = 1e-3,
    max_iter: int = 200,
    batch_size: int | None = None,
    early_stopping: bool = True,
    validation_fraction: float = 0.1,
    n_iter_no_change: int = 10,
    tol: float = 1e-4,
    seed: int = 42,
) -> Network:
    """``key`` identifies rows for the batches (else all feature values do).
    Without ``batch_size`` a batch is an ``EPOCH_STEPS``-th of the rows, at
    least 200."""
    if activation not in ACTIVATIONS or solver not in SOLVERS:
        raise ValueError(f"activation {activation!r}, solver {solver!r}")
    cols, spark = list(cols), train.sparkSession
    train = train.where(F.col(y).isNotNull()).dropna(subset=cols)
    classes = [r[0] for r in collect_bounded(train.select(y).distinct().orderBy(y), MAX_GROUPS, "classes")]
    if not classes:
        raise ValueError("no labelled rows")
    n = train.count()
    size = batch_size or max(200, -(-n // EPOCH_STEPS))
    batches = max(1, round(n * (1 - (validation_fraction if early_stopping else 0)) / size))
    code = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(y)) - 1).cast("int")
    slim = train.select(*([F.col(key).alias("_key")] if key else [F.xxhash64(*cols).alias("_key")]), code.alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols])
    path = f"{checkpoint_dir(spark).rstrip('/')}/network-{uuid.uuid4().hex}"
    slim.withColumn("_batch", batch_columns("_key", batches, validation_fraction if early_stopping else 0.0, seed)).drop("_key").write.partitionBy("_batch").parquet(path)
    table = spark.read.parquet(path)
    # a frame and its number of tasks per batch, planned once
    deals = {b: (part := table.where(F.col("_batch") == b).drop("_batch"), tasks_of(part)) for b in ([-1] if early_stopping else []) + list(range(batches))}
    widths = [len(cols), *hidden_layer_sizes, len(classes)]
    flat = start_values(widths, activation, seed)
    optimiser, rng = SOLVERS[solver](len(flat), learning_rate_init), np.random.default_rng(seed)

    def sums(which: int, gradient: bool) -> np.ndarray:
        def part(flat, batch):
            return batch_sums(flat, widths, activation, matrix(batch, cols), batch.column(batch.schema.get_field_index("_y")).to_numpy(zero_copy_only=False), gradient)

        rows, tasks = deals[which]
        return summed(rows, flat, part, 3 + (len(flat) if gradient else 0), tasks)

    history, best, kept, waited = [], np.inf, flat, 0
    for _ in range(max_iter):
        loss = rows = 0.0
        for which in rng.permutation(batches).tolist():
            total = sums(which, True)
            if not total[0]:
                continue
            weights = weights_only(flat, widths)
            loss += total[1] + alpha / 2 * float(weights @ weights)
            rows += total[0]
            flat = flat + optimiser.step((total[3:] + alpha * weights) / total[0])
        held = sums(-1, False) if early_stopping else None
        watched = held[1] / held[0] if held is not None and held[0] else loss / max(rows, 1)
        history.append([loss / max(rows, 1), held[1] / held[0] if held is not None and held[0] else None, held[2] / held[0] if held is not None and held[0] else None])
        waited = 0 if watched < best - tol else waited + 1
        if watched < best:
            best, kept = watched, flat
        if waited >= n_iter_no_change:
            break
    return Network(cols, classes, widths, kept if early_stopping else flat, activation, history)
