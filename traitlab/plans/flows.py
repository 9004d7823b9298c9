"""End-to-end flows composed from operators (one lazy plan each where the
algorithm allows; iterative ones run a few small jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlab.operators.clean import drop_null_rows, keep_equal, to_number, trait_scores
from traitlab.operators.cluster.kmeans import assign_nearest, init_first_rows
from traitlab.operators.features import standardize
from traitlab.operators.profile import cluster_profile
from traitlab.sources.dims import ITEMS, SCORES
from traitlab.sources.io import split_tab_lines
from traitlab.sources.survey import RAW_COLUMNS, survey_lines_for

ZSCORES = [f"{s}_z" for s in SCORES]


def parsed_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 on the survey lines: 55 text columns + row_id."""
    return split_tab_lines(survey_lines_for(spark, sf_dir), RAW_COLUMNS)


_NUMERIC: dict = {}


def numeric_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P1: every column but ``country`` as double.

    The coerced table is written once per session as Parquet in
    ``spark.checkpoint.dir``, like the cleaned file of the reference that
    every later step reads: the 55 regex-guarded casts run once, and later
    plans get column pruning and pushed filters at the scan."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _NUMERIC:
        from traitlab.session import checkpoint_dir

        checkpoint_dir(spark)
        from traitlab.session import scratch_table

        _NUMERIC[key] = scratch_table(to_number(parsed_survey(spark, sf_dir), except_cols=["country"], keep=["row_id"]), "survey-numeric")
    return _NUMERIC[key]


def clean_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P1 -> P2 -> P5 -> P3: the cleaned, scored responses."""
    kept = keep_equal(numeric_survey(spark, sf_dir), "IPC", 1)
    return drop_null_rows(trait_scores(kept), ITEMS)


def zscored_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned responses plus standardised scores ``<score>_z`` (F1).

    The scaler is fitted by one aggregation and applied as new columns on
    the same rows, so no join back is needed."""
    clean = clean_survey(spark, sf_dir)
    _, sc = standardize(clean.select(*SCORES), SCORES)
    return sc.transform(clean, suffix="_z")


def traits_by_cluster(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """Minimum slice: how do the five traits differ by cluster?

    clean -> standardise -> nearest of the first k rows by det -> profile.
    One scan for the scaler, one top-k for the start rows, one final
    aggregation with the assignment as a codegen'd expression."""
    zs = zscored_survey(spark, sf_dir)
    centers = init_first_rows(zs, "row_id", ZSCORES, k)
    return cluster_profile(assign_nearest(zs, ZSCORES, centers), SCORES)


def labelled_survey(spark: SparkSession, sf_dir: str, k: int = 5, out: str = "cluster") -> DataFrame:
    """Cleaned responses with the C3 label of the minimum slice (``cluster``)."""
    zs = zscored_survey(spark, sf_dir)
    centers = init_first_rows(zs, "row_id", ZSCORES, k)
    return assign_nearest(zs, ZSCORES, centers, out)


def enriched_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned responses left-joined to the country dimension (broadcast:
    the dimension has a fixed, small size)."""
    from traitlab.operators.enrich import join_country
    from traitlab.sources.dims import country_fixture

    return join_country(clean_survey(spark, sf_dir), country_fixture(spark))


def region_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 -> P15: responses with ``region_label`` (null region -> 'nan')."""
    from traitlab.functions.columns import text_label

    return enriched_survey(spark, sf_dir).withColumn("region_label", text_label("region"))


#: values of a stored vector
N_VALUES = 64


def _value(i: int):
    return F.col("embedding")[i].cast("double")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label and all embedding values as doubles x1..x64."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return emb.select("vec_id", "label", *[_value(i).alias(f"x{i + 1}") for i in range(N_VALUES)])


def walsh_sign(j: int, i: int) -> int:
    """Sign of value ``i`` in feature ``j``: bit ``j`` of ``i``."""
    return -1 if (i >> j) & 1 else 1


def walsh_points(spark: SparkSession, sf_dir: str, dims: int = 2, prefix: str = "x", keep: bool = False) -> DataFrame:
    """vec_id, label and ``dims`` features, each a signed sum of all 64 values
    (Walsh functions, scaled by 1/8), for methods that need few dimensions;
    with ``keep`` beside x1..x64."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    every = [_value(i).alias(f"x{i + 1}") for i in range(N_VALUES)] if keep else []

    def feature(j):
        total = _value(0)
        for i in range(1, N_VALUES):
            total = total + _value(i) if walsh_sign(j, i) > 0 else total - _value(i)
        return (total / 8.0).alias(f"{prefix}{j + 1}")

    return emb.select("vec_id", "label", *every, *[feature(j) for j in range(dims)])


def cluster_model(spark: SparkSession, sf_dir: str, k: int = 5):
    """The scoring model of the minimum slice: scaler fitted on the cleaned
    responses + the first k rows by det (in z space) as centres."""
    from traitlab.streaming.scoring import ClusterScorer

    clean = clean_survey(spark, sf_dir)
    _, sc = standardize(clean.select(*SCORES), SCORES)
    centers = init_first_rows(sc.transform(clean, suffix="_z"), "row_id", ZSCORES, k)
    return ClusterScorer(list(SCORES), sc, centers)


def new_responses(spark: SparkSession, sf_dir: str, complete_only: bool = True) -> DataFrame:
    """Responses not used for training (IPC = 2), scored; complete ones only
    unless ``complete_only`` is off."""
    scored = trait_scores(numeric_survey(spark, sf_dir).filter(F.col("IPC") == 2))
    return drop_null_rows(scored, ITEMS) if complete_only else scored
