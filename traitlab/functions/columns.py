"""Scalar Column builders.  All are built-in Spark expressions, so they stay
inside whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "NUMBER_PATTERN",
    "det",
    "guarded_number",
    "reverse_key",
    "null_skipping_sum",
    "us_region",
    "sq_dist",
    "euclid",
    "arg_min",
    "arg_max",
    "softmax",
    "softmax_columns",
    "relu",
    "elapsed_seconds",
    "text_label",
]

# The text a number may have, surrounding blanks allowed
# (pandas ``to_numeric`` accepts these shapes; we also reject 'nan' and 'inf').
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# The deterministic ordering key shared with the SQL oracle.
DET_MULT = 1103515245
DET_ADD = 12345
DET_MOD = 2147483648


def det(key: str | Column, seed: int = 42) -> Column:
    """Deterministic pseudo-random ordering key of a row id, between -2**31
    and 2**31.  The id is reduced first, so that no id overflows; equal keys
    are ordered by the id itself."""
    k = F.col(key) if isinstance(key, str) else key
    return ((k.cast("long") % F.lit(DET_MOD) * F.lit(DET_MULT) + F.lit(DET_ADD * seed)) % F.lit(DET_MOD)).cast("long")


def guarded_number(c: str | Column) -> Column:
    """Text -> double; anything that is not a plain decimal number -> null."""
    col = F.col(c) if isinstance(c, str) else c
    t = col.cast("string")
    # one regex test, one cast (the cast ignores the surrounding blanks)
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def reverse_key(c: str | Column, lo: int = 1, hi: int = 5) -> Column:
    """Reverse-keyed answer ``lo + hi - v`` (6 - v on a 1..5 scale)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.lit(lo + hi) - col


def null_skipping_sum(cols: Sequence[str | Column]) -> Column:
    """Row-wise sum that treats null as 0 (pandas ``sum(axis=1)``)."""
    parts = [F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0)) for c in cols]
    return reduce(add, parts) if parts else F.lit(0.0)


# US region boxes, tested in this order, bounds inclusive.
US_REGION_BOXES = [
    ("Northeast", 36.5, 47.5, -82.0, -66.9),
    ("Midwest", 36.5, 49.0, -104.0, -82.0),
    ("South", 24.5, 36.5, -105.0, -75.0),
    ("West", 31.0, 49.0, -125.0, -102.0),
]
US_REGION_ELSE = "Unknown/Outside U.S."


def us_region(lat: str | Column, lon: str | Column) -> Column:
    """Latitude/longitude -> US region; first matching box wins."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    expr = None
    for name, la0, la1, lo0, lo1 in US_REGION_BOXES:
        cond = la.between(la0, la1) & lo.between(lo0, lo1)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(US_REGION_ELSE)


def sq_dist(cols: Sequence[str], center: Sequence[float | Column]) -> Column:
    """Squared Euclidean distance of the row to a point (literals or columns)."""
    terms = []
    for c, v in zip(cols, center):
        d = F.col(c) - (v if isinstance(v, Column) else F.lit(float(v)))
        terms.append(d * d)
    return reduce(add, terms)


def euclid(cols: Sequence[str], center: Sequence[float | Column]) -> Column:
    return F.sqrt(sq_dist(cols, center))


def arg_min(values: Sequence[Column]) -> Column:
    """0-based position of the smallest value; the first one wins ties."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def arg_max(values: Sequence[Column]) -> Column:
    arr = F.array(*values)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def softmax(values: Sequence[Column]) -> list[Column]:
    """Softmax with maximum shift, one Column per class."""
    m = F.greatest(*values) if len(values) > 1 else values[0]
    exps = [F.exp(v - m) for v in values]
    total = reduce(add, exps)
    return [e / total for e in exps]


def softmax_columns(df, scores: Sequence[Column], outs: Sequence[str], tmp: str = "_sm"):
    """Softmax of per-class score expressions as staged projections: scores,
    then the row maximum, then the exponentials, then the normaliser, each
    computed once per row.  (Inlining the whole formula into every output
    column multiplies the expression size by the number of classes.)"""
    k = len(scores)
    s_cols = [f"{tmp}_s{i}" for i in range(k)]
    e_cols = [f"{tmp}_e{i}" for i in range(k)]
    df = df.withColumns(dict(zip(s_cols, scores)))
    df = df.withColumn(f"{tmp}_m", F.greatest(*[F.col(c) for c in s_cols]) if k > 1 else F.col(s_cols[0]))
    df = df.withColumns({e: F.exp(F.col(s) - F.col(f"{tmp}_m")) for s, e in zip(s_cols, e_cols)})
    df = df.withColumn(f"{tmp}_t", reduce(add, [F.col(e) for e in e_cols]))
    df = df.withColumns({o: F.col(e) / F.col(f"{tmp}_t") for o, e in zip(outs, e_cols)})
    return df.drop(*s_cols, *e_cols, f"{tmp}_m", f"{tmp}_t")


def relu(c: Column) -> Column:
    return F.greatest(c, F.lit(0.0))


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """Whole seconds between two timestamps, floored."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.floor((F.unix_micros(e) - F.unix_micros(s)) / F.lit(1_000_000)).cast("long")


def text_label(c: str | Column) -> Column:
    """Class label as text; null becomes the class ``'nan'``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit("nan"))
