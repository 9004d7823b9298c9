"""Deterministic survey view derived from the ``customer`` table.

No questionnaire ships with the test data, so the responses are a pure
function of each customer row (one survey row per customer): every answer,
the IPC flag, the country code and the coordinates.  The same formula is
written once as DataFrame expressions (``survey_view``) and once as DuckDB SQL
(``survey_sql``) for the oracle.  Being row-wise, it scales with ``customer``
and adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlab.sources.dims import ITEMS, PREFIXES

# ISO codes for nation keys 0..24 (NA is Namibia; TW and AQ have
# no region; XX matches nothing).
NATION_CODES = [
    "US", "GB", "CA", "AU", "NA", "DE", "FR", "IN", "PH", "BR", "MX", "SE", "NO",
    "FI", "NL", "NZ", "ZA", "SG", "MY", "ES", "IT", "TW", "AQ", "XX", "IE",
]

# Dirty answers (a, m, text), placed where (custkey * a + item)
# is divisible by m; the last three are no numbers to a plain decimal parse.
DIRTY = [(1, 397, "NULL"), (31, 3989, " 3 "), (37, 4001, "1d"), (41, 4003, "nan"), (43, 4007, "")]

RAW_COLUMNS = ITEMS + ["IPC", "country", "lat", "lon"]
TEXT_COLUMNS = ["country"]


def item_number(name: str) -> int:
    """EXT1 -> 1 ... EXT10 -> 10, EST1 -> 11, ..., OPN10 -> 50."""
    prefix, j = name[:3], int(name[3:])
    return 10 * PREFIXES.index(prefix) + j


def _answer(i: int) -> Column:
    ck = F.col("c_custkey")
    bal = F.floor(F.abs(F.col("c_acctbal")) * F.lit(100)).cast("long")
    value = (F.lit(1) + (ck * F.lit(7) + F.lit(i * 13) + bal * F.lit(i % 9 + 1)) % F.lit(5)).cast("string")
    out = F.when((ck * F.lit(3) + F.lit(i)) % F.lit(211) == 0, F.lit("0")).otherwise(value)
    for a, m, text in reversed(DIRTY):
        out = F.when((ck * F.lit(a) + F.lit(i)) % F.lit(m) == 0, F.lit(text)).otherwise(out)
    return out


def survey_view(customer: DataFrame) -> DataFrame:
    """Typed survey rows: row_id, 50 answers (text), IPC, country, lat, lon."""
    ck = F.col("c_custkey")
    codes = F.array(*[F.lit(c) for c in NATION_CODES])
    return customer.select(
        ck.cast("long").alias("row_id"),
        *[_answer(item_number(n)).alias(n) for n in ITEMS],
        F.when(ck % 10 == 0, F.lit(2)).otherwise(F.lit(1)).alias("IPC"),
        F.when(ck % 97 == 0, F.lit("")).otherwise(F.try_element_at(codes, F.col("c_nationkey") + 1)).alias("country"),
        (F.lit(24) + (ck * 37) % 2600 / F.lit(100.0)).cast("double").alias("lat"),
        (F.lit(-126) + (ck * 91) % 6000 / F.lit(100.0)).cast("double").alias("lon"),
    )


def survey_lines(customer: DataFrame, materialize: bool = True) -> DataFrame:
    """Raw tab-separated lines (row_id, value) in the layout of the raw file.

    With ``materialize`` the lines are written once per session with a
    reliable ``checkpoint()`` into ``spark.checkpoint.dir`` and read back like
    a raw file.  Without that barrier Catalyst would inline the 50-way
    derivation into every pushed-down filter of the cleaning steps."""
    s = survey_view(customer)
    lines = s.select("row_id", F.concat_ws("\t", *[F.col(c).cast("string") for c in RAW_COLUMNS]).alias("value"))
    if not materialize:
        return lines
    from traitlab.session import checkpoint_dir

    spark = lines.sparkSession
    checkpoint_dir(spark)
    from traitlab.session import reliable_checkpoint

    return reliable_checkpoint(lines)


def load_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal")


#: customer rows that one task turns into survey lines, at most (about)
TASK_ROWS = 20_000


def spread(customer: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """The same rows, dealt out in turn: a customer file of one split holds
    millions of rows, and each becomes 55 texts.  A task takes about ``rows``,
    whatever the keys are."""
    tasks = -(-customer.count() // rows)
    return customer.repartition(max(tasks, customer.sparkSession.sparkContext.defaultParallelism)) if tasks > 1 else customer


_LINES: dict[tuple[int, str], DataFrame] = {}


def survey_lines_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialised survey lines of ``sf_dir``, computed once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LINES:
        _LINES[key] = survey_lines(spread(load_customer(spark, sf_dir)))
    return _LINES[key]


# ---------------------------------------------------------------- SQL twins

def _answer_sql(i: int) -> str:
    dirty = " ".join(f"WHEN (c_custkey*{a} + {i}) % {m} = 0 THEN '{text}'" for a, m, text in DIRTY)
    return (
        f"CASE {dirty} WHEN (c_custkey*3 + {i}) % 211 = 0 THEN '0' "
        f"ELSE CAST(1 + (c_custkey*7 + {i * 13} + CAST(floor(abs(c_acctbal)*100) AS BIGINT)*{i % 9 + 1}) % 5 AS VARCHAR) END"
    )


def survey_sql() -> str:
    """DuckDB SELECT producing the same rows as :func:`survey_view`."""
    answers = ",\n  ".join(f"{_answer_sql(item_number(n))} AS {n}" for n in ITEMS)
    codes = " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(NATION_CODES))
    return (
        "SELECT CAST(c_custkey AS BIGINT) AS row_id,\n  "
        + answers
        + ",\n  CASE WHEN c_custkey % 10 = 0 THEN 2 ELSE 1 END AS IPC,"
        + f"\n  CASE WHEN c_custkey % 97 = 0 THEN '' ELSE CASE c_nationkey {codes} END END AS country,"
        + "\n  CAST(24 + (c_custkey*37) % 2600 / 100.0E0 AS DOUBLE) AS lat,"
        + "\n  CAST(-126 + (c_custkey*91) % 6000 / 100.0E0 AS DOUBLE) AS lon"
        + "\nFROM customer"
    )


def survey_lines_sql() -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR)" for c in RAW_COLUMNS)
    return f"SELECT row_id, concat_ws(chr(9), {cols}) AS value FROM ({survey_sql()}) s"
