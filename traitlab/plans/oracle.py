"""DuckDB SQL twins of the survey flows, used by ``oracle_sql()``.

These strings are the independent check: they re-derive every result from
the registered parquet views with plain SQL (no Spark involved)."""

from __future__ import annotations

from collections.abc import Sequence

from traitlab.functions.columns import DET_ADD, DET_MOD, DET_MULT, NUMBER_PATTERN, US_REGION_BOXES, US_REGION_ELSE
from traitlab.sources.dims import COUNTRIES, ITEMS, PREFIXES, SCORE_OF_PREFIX, SCORES
from traitlab.sources.survey import RAW_COLUMNS, survey_lines_sql, survey_sql

ZSCORES = [f"{s}_z" for s in SCORES]


def det_sql(key: str = "row_id", seed: int = 42) -> str:
    return f"((CAST({key} AS BIGINT) * {DET_MULT} + {DET_ADD * seed}) % {DET_MOD})"


def guard_sql(c: str) -> str:
    return f"CASE WHEN regexp_matches(CAST({c} AS VARCHAR), '{NUMBER_PATTERN}') THEN TRY_CAST(trim(CAST({c} AS VARCHAR)) AS DOUBLE) END"


def rnd(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


def parsed_cte() -> str:
    cols = ", ".join(f"string_split(value, chr(9))[{i + 1}] AS {c}" for i, c in enumerate(RAW_COLUMNS))
    return f"parsed AS (SELECT row_id, {cols} FROM ({survey_lines_sql()}) l)"


def numeric_cte() -> str:
    cols = ", ".join(("country" if c == "country" else f"{guard_sql(c)} AS {c}") for c in RAW_COLUMNS)
    return f"num AS (SELECT row_id, {cols} FROM parsed)"


def score_exprs(reverse: dict[str, bool] | None = None) -> str:
    parts = []
    for p in ["OPN", "CSN", "EXT", "AGR", "EST"]:
        terms = []
        for j in range(1, 11):
            item = f"{p}{j}"
            v = f"(6 - {item})" if reverse and reverse.get(item) else item
            terms.append(f"coalesce({v}, 0.0)")
        parts.append(" + ".join(terms) + f" AS {SCORE_OF_PREFIX[p]}")
    return ", ".join(parts)


def clean_cte() -> str:
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in ITEMS)
    return f"clean AS (SELECT *, {score_exprs()} FROM num WHERE IPC = 1 AND {notnull})"


def zs_cte(src: str = "clean", cols: Sequence[str] = SCORES, name: str = "zs") -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    z = ", ".join(f"CASE WHEN s_{c} = 0 THEN 0.0 ELSE ({c} - m_{c}) / s_{c} END AS {c}_z" for c in cols)
    return f"{name}_stats AS (SELECT {stats} FROM {src}), {name} AS (SELECT {src}.*, {z} FROM {src} JOIN {name}_stats ON TRUE)"


def with_clean(*extra: str) -> str:
    ctes = [parsed_cte(), numeric_cte(), clean_cte(), *extra]
    return "WITH " + ",\n".join(ctes) + "\n"


def nearest_first_k_ctes(src: str, cols: Sequence[str], k: int, key: str = "row_id", name: str = "lab") -> str:
    """Centres = first k rows of ``src`` by det; label = nearest (lowest id on ties)."""
    ccols = ", ".join(f"{c} AS c_{c}" for c in cols)
    dist = " + ".join(f"({src}.{c} - {name}_cen.c_{c}) * ({src}.{c} - {name}_cen.c_{c})" for c in cols)
    return (
        f"{name}_cen AS (SELECT row_number() OVER (ORDER BY {det_sql(key)}, {key}) - 1 AS cid, {ccols} FROM {src} ORDER BY {det_sql(key)}, {key} LIMIT {k}),\n"
        f"{name}_d AS (SELECT {src}.{key} AS {key}, {name}_cen.cid, {dist} AS d FROM {src} JOIN {name}_cen ON TRUE),\n"
        f"{name} AS (SELECT {key}, CAST(cid AS INTEGER) AS cluster FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY d, cid) AS rn FROM {name}_d) t WHERE rn = 1)"
    )


def first_rows_sql(src: str, n_expr: str, key: str = "row_id", seed: int = 42) -> str:
    """Rows of ``src`` that are among the first ``n_expr`` by (det, key)."""
    return (
        f"(SELECT * EXCLUDE (_rn, _cnt) FROM (SELECT *, row_number() OVER (ORDER BY {det_sql(key, seed)}, {key}) AS _rn, "
        f"count(*) OVER () AS _cnt FROM {src}) t WHERE _rn <= {n_expr})"
    )


def first_rows_by_sql(src: str, by: str, n_expr: str, key: str = "row_id", seed: int = 42) -> str:
    """Per group ``by``: rows among the first ``n_expr`` (may use _cnt) by (det, key)."""
    return (
        f"(SELECT * EXCLUDE (_rn, _cnt) FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {det_sql(key, seed)}, {key}) AS _rn, "
        f"count(*) OVER (PARTITION BY {by}) AS _cnt FROM {src}) t WHERE _rn <= {n_expr})"
    )


def q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def countries_values() -> str:  # noqa: D103
    rows = ", ".join(f"({q(a)}, {q(b)}, {q(c)}, {q(d)}, {q(e)})" for a, b, c, d, e in COUNTRIES)
    return f"SELECT * FROM (VALUES {rows}) AS t(name, country, region, sub_region, intermediate_region)"


def us_region_sql(lat: str, lon: str) -> str:
    whens = " ".join(
        f"WHEN {lat} BETWEEN {la0} AND {la1} AND {lon} BETWEEN {lo0} AND {lo1} THEN '{n}'" for n, la0, la1, lo0, lo1 in US_REGION_BOXES
    )
    return f"CASE {whens} ELSE '{US_REGION_ELSE}' END"


__all__ = [
    "ITEMS",
    "PREFIXES",
    "SCORES",
    "ZSCORES",
    "det_sql",
    "guard_sql",
    "rnd",
    "with_clean",
    "zs_cte",
    "nearest_first_k_ctes",
    "countries_values",
    "us_region_sql",
    "survey_sql",
]
