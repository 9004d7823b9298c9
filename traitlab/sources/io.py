"""Sources and sinks.

Readers take explicit schemas (no inference in production) and never set
``nullValue='NA'``: the ISO code of Namibia is the text ``NA``."""

from __future__ import annotations

import importlib
import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traitlab.sources.dims import COUNTRY_SCHEMA


def split_tab_lines(lines: DataFrame, columns: Sequence[str], value: str = "value", keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Split each text line on tab into the named string columns.

    ``split`` is a codegen expression, so this is one narrow pass."""
    split_once = lines.select(*keep, F.split(F.col(value), "\t", -1).alias("_parts"))
    return split_once.select(*keep, *[F.col("_parts").getItem(i).alias(c) for i, c in enumerate(columns)])


def read_tab_text(spark: SparkSession, path: str, row_id: str | None = "row_id") -> DataFrame:
    """Tab-separated text file with a header line; every column is text.

    ``row_id`` numbers the rows in file order (0-based, gap-free) without
    leaving the JVM: ``monotonically_increasing_id`` is (partition << 33) +
    position, so the id is the partition's offset (row counts per input
    partition: one small aggregate, bounded by the number of partitions)
    plus the position."""
    df = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)
    if row_id is None:
        return df
    return with_row_index(df, row_id)


def with_row_index(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Exact 0-based row number in input order, computed with one count per
    partition (no single-partition window, no Python rows)."""
    from traitlab.operators.sample import collect_bounded

    tagged = df.withColumn("_mid", F.monotonically_increasing_id())
    part = F.shiftright("_mid", 33)
    counts = collect_bounded(tagged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")), 10_000_000, "partition counts")
    offs, acc = {}, 0
    for r in sorted(counts, key=lambda r: r["_p"]):
        offs[int(r["_p"])] = acc
        acc += int(r["_n"])
    omap = F.create_map(*[x for k, v in offs.items() for x in (F.lit(k), F.lit(v))]) if offs else F.create_map(F.lit(0), F.lit(0))
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    cols = [c for c in df.columns]
    return tagged.select((F.element_at(omap, part) + pos).cast("long").alias(out), *[F.col(f"`{c}`") for c in cols])


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, header: bool = True) -> DataFrame:
    """CSV with header and an explicit schema; quoted commas allowed (S3)."""
    reader = spark.read.option("header", header).option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path if isinstance(path, str) else list(path))


def country_dim(spark: SparkSession, path: str) -> DataFrame:
    """S3: the country CSV (name,country,region,sub-region,intermediate-region)."""
    return read_csv(spark, path, COUNTRY_SCHEMA)


# Grid-result union schema (S10); recorded files carry subsets of it.
GRID_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("factor_analysis", T.StringType()),
        T.StructField("n_clusters", T.DoubleType()),
        T.StructField("batch_size", T.DoubleType()),
        T.StructField("max_iter", T.DoubleType()),
        T.StructField("n_components", T.DoubleType()),
        T.StructField("covariance_type", T.StringType()),
        T.StructField("eps", T.DoubleType()),
        T.StructField("min_samples", T.DoubleType()),
        T.StructField("n_factors", T.DoubleType()),
        T.StructField("affinity", T.StringType()),
        T.StructField("linkage", T.StringType()),
        T.StructField("calinski_harabasz", T.DoubleType()),
        T.StructField("davies_bouldin", T.DoubleType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("n_clusters_found", T.DoubleType()),
        T.StructField("cluster_entropy", T.DoubleType()),
    ]
)


def read_grid_results(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several recorded metric CSVs with differing headers, unioned by name."""
    out = None
    for p in paths:
        df = spark.read.option("header", True).option("inferSchema", True).csv(p)
        df = df.select(*[F.col(f"`{c}`").cast(GRID_SCHEMA[c].dataType).alias(c) if c in GRID_SCHEMA.names else F.col(f"`{c}`") for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet by default; CSV with header; JSON lines."""
    if fmt == "json":
        # JSON has no NaN: write it as null
        df = df.select(*[F.nanvl(F.col(f"`{f.name}`"), F.lit(None)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema.fields])
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.format(fmt).save(path)


def append_result(df: DataFrame, path: str, key: str = "config_id") -> None:
    """Append-or-create a result log.  The log has one partition per
    ``key`` and a write replaces the partitions it brings: a repeated append
    (a retry, a restart after a crash before the caller heard of success)
    leaves every configuration once.  Files of a write that did not commit lie
    in a staging folder that readers pass over."""
    if key not in df.columns:
        raise ValueError(f"a result log needs the column {key}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def finished_configs(spark: SparkSession, path: str, key: str = "config_id") -> set[str]:
    """Configuration ids already present in a result log (restart skips them).

    The log holds one partition per configuration, so the set is bounded by
    the grid size."""
    from pyspark.errors import AnalysisException

    try:  # the key's type is given: partition names like 12e4 are no numbers
        df = spark.read.schema(T.StructType([T.StructField(key, T.StringType())])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no log yet
            return set()
        raise
    return {r[0] for r in df.select(key).distinct().collect() if r[0] is not None}


def save_model(model, path: str, spark: SparkSession | None = None) -> None:
    """A fitted model at ``path``.  Spark ML models use their own writer.
    The library's dataclasses (scaler, label map, linear model, network,
    nearest centroid, fitted classifier) are one JSON record, with the Spark
    model they wrap, if any, beside it."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
        return
    spark = spark or SparkSession.active()
    state, wrapped = _state(model)
    if wrapped is not None:
        wrapped.write().overwrite().save(f"{path}/spark")
        state["spark_class"] = f"{type(wrapped).__module__}.{type(wrapped).__qualname__}"
    spark.createDataFrame([(json.dumps(state),)], "model string").coalesce(1).write.mode("overwrite").text(f"{path}/state")


def load_model(path: str, spark: SparkSession | None = None):
    """What ``save_model`` wrote."""
    from pyspark.errors import AnalysisException
    from pyspark.ml import PipelineModel

    spark = spark or SparkSession.active()
    try:
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return PipelineModel.load(path)
    return _restored(state, path)


def _models() -> dict:
    from traitlab.operators.classify.forest import ExactForest
    from traitlab.operators.classify.models import FittedModel, LinearModel, NearestCentroid, ReluNet
    from traitlab.operators.classify.network import Network
    from traitlab.operators.features import LabelMap, Scaler

    return {c.__name__: c for c in (ExactForest, FittedModel, LinearModel, NearestCentroid, Network, ReluNet, LabelMap, Scaler)}


def _state(model) -> tuple[dict, object]:
    import dataclasses

    if type(model).__name__ not in _models():
        raise TypeError(f"cannot save a {type(model).__name__}")
    fields, wrapped = {}, None
    for f in dataclasses.fields(model):
        v = getattr(model, f.name)
        if f.name == "model":
            if hasattr(v, "write"):
                wrapped, v = v, None
            else:
                v = _state(v)[0]
        elif isinstance(v, T.DataType):
            v = {"type": v.jsonValue()}
        elif isinstance(v, np.ndarray):
            v = {"array": v.tolist()}
        elif isinstance(v, list) and v and isinstance(v[0], np.ndarray):
            v = {"arrays": [x.tolist() for x in v]}
        elif f.name == "trees":
            v = {"trees": [t.state() for t in v]}
        fields[f.name] = v
    return {"class": type(model).__name__, "fields": fields}, wrapped


def _restored(state: dict, path: str):
    fields = {}
    for name, v in state["fields"].items():
        if name == "model":
            if v is None:
                module, _, cls = state["spark_class"].rpartition(".")
                if module.split(".")[:2] != ["pyspark", "ml"]:
                    raise ValueError(f"not a Spark ML class: {module}.{cls}")
                v = getattr(importlib.import_module(module), cls).load(f"{path}/spark")
            else:
                v = _restored(v, path)
        elif isinstance(v, dict) and set(v) == {"type"}:
            v = T._parse_datatype_json_value(v["type"])
        elif isinstance(v, dict) and set(v) == {"array"}:
            v = np.array(v["array"])
        elif isinstance(v, dict) and set(v) == {"arrays"}:
            v = [np.array(x) for x in v["arrays"]]
        elif isinstance(v, dict) and set(v) == {"trees"}:
            from traitlab.operators.classify.forest import Tree

            v = [Tree.restored(t) for t in v["trees"]]
        fields[name] = v
    return _models()[state["class"]](**fields)
