"""Data quality: checks over five dimensions, composite score, history, gate.

Every check is one row: check_name, dimension, table_name, total_records,
passed_records, failed_records, score, details.  Rules are data: a `Rules` object says
which checks run on which tables, and all checks of one table that need only a
scan share one aggregate.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from tallyloom import constants as C
from tallyloom.functions.columns import exprs, lit, name


@dataclass
class Rules:
    """Which checks to run; the names refer to keys of the tables dict."""

    required: dict[str, list[str]] = field(default_factory=dict)
    unique: list[tuple[str, str]] = field(default_factory=list)
    in_set: list[tuple[str, str, list[str]]] = field(default_factory=list)
    in_range: list[tuple[str, str, float, float]] = field(default_factory=list)
    fresh: list[tuple[str, str]] = field(default_factory=list)
    references: list[tuple[str, str, str, str]] = field(default_factory=list)


MART_RULES = Rules(
    required={
        "fact_activity": [
            "activity_id",
            "date_key",
            "account_key",
            "activity_type",
            "activity_timestamp",
        ],
        "dim_account": ["account_id", "account_age_tier", "risk_classification"],
        "dim_campaign": ["campaign_id", "campaign_name"],
        "dim_lead": ["lead_id"],
        "fact_daily": ["date_key", "account_key"],
    },
    unique=[
        ("fact_activity", "activity_id"),
        ("dim_campaign", "campaign_id"),
        ("dim_lead", "lead_id"),
        ("dim_date", "full_date"),
    ],
    in_set=[
        ("fact_activity", "activity_type", C.ACTIVITY_TYPES),
        ("dim_account", "risk_classification", C.RISK_CLASSES),
    ],
    in_range=[
        ("fact_daily", rate, 0.0, 1.0)
        for rate in ("acceptance_rate", "reply_rate", "conversion_rate")
    ],
    fresh=[("fact_activity", "activity_timestamp")],
    references=[
        ("fact_activity", "date_key", "dim_date", "date_key"),
        ("fact_activity", "account_key", "dim_account", "account_key"),
        ("fact_daily", "date_key", "dim_date", "date_key"),
        ("fact_daily", "account_key", "dim_account", "account_key"),
    ],
)


def _check(
    check: str, dimension: str, table: str, total: str, failed: str, details: str
) -> str:
    """One check row as a struct; an empty table scores 1."""
    return (
        f"struct({lit(check)} AS check_name, '{dimension}' AS dimension, {lit(table)} AS table_name, "
        f"{total} AS total_records, {total} - {failed} AS passed_records, "
        f"{failed} AS failed_records, "
        f"IF({total} = 0, 1D, try_divide(CAST({total} - {failed} AS DOUBLE), {total})) AS score, "
        f"{details} AS details)"
    )


def _rows(one: DataFrame, checks: list[str]) -> DataFrame:
    return one.selectExpr(f"inline(array({', '.join(checks)}))")


# Checks that one scan of a table answers


def _missing(df: DataFrame, cols: list[str]) -> str:
    """Any of the columns is NULL or, for text, empty."""
    return " OR ".join(
        f"coalesce({name(c)}, '') = ''"
        if isinstance(df.schema[c].dataType, T.StringType)
        else f"{name(c)} IS NULL"
        for c in cols
    )


def _fresh_check(table: str, as_of: dt.datetime) -> str:
    """Age of `newest`: score 1 up to 24 h, 0 from 168 h, linear between; passes
    at 0.5; 0 where there is no time."""
    age = f"((unix_micros({lit(as_of)}) - unix_micros(newest)) / 3.6e9D)"
    span = lit(float(C.STALE_HOURS - C.FRESH_HOURS))
    score = (
        f"IF(newest IS NULL, 0D, greatest(0D, least(1D, 1D - ({age} - {C.FRESH_HOURS}) / {span})))"
    )
    details = (
        "format_string('newest: %s; age in hours: %.1f', "
        f"coalesce(date_format(newest, 'yyyy-MM-dd HH:mm:ss'), 'none'), coalesce({age}, -1D))"
    )
    return (
        "struct('timeliness_latest_activity' AS check_name, 'timeliness' AS dimension, "
        f"'{table}' AS table_name, 1L AS total_records, "
        f"CAST({score} >= 0.5D AS BIGINT) AS passed_records, "
        f"CAST({score} < 0.5D AS BIGINT) AS failed_records, "
        f"{score} AS score, {details} AS details)"
    )


def scan_checks(
    df: DataFrame,
    table: str,
    required: list[str] | None = None,
    in_set: list[tuple[str, list[str]]] = (),
    in_range: list[tuple[str, float, float]] = (),
    fresh: str | None = None,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Completeness, validity and timeliness checks of one table from one aggregate.

    Validity checks give no row for an empty table, and NULL is valid.
    """
    counts, checks = {"total": "count(*)"}, []
    if required:
        counts["required"] = f"count_if({_missing(df, required)})"
        checks.append(
            _check(
                f"completeness_{table}", "completeness", table, "total", "required",
                f"format_string('required: %s; incomplete rows: %d', {lit(', '.join(required))}, required)",
            )
        )
    # Counts are named by rule, so that rules on one column don't meet.
    for i, (column, values) in enumerate(in_set):
        counts[f"other{i}"] = f"count_if({name(column)} NOT IN ({', '.join(map(lit, values))}))"
        checks.append(
            _check(
                f"validity_{column}", "validity", table, "total", f"other{i}",
                f"format_string('allowed: %s; other values: %d', {lit(', '.join(values))}, other{i})",
            )
        )
    for i, (column, low, high) in enumerate(in_range):
        counts[f"outside{i}"] = f"count_if({name(column)} < {lit(low)} OR {name(column)} > {lit(high)})"
        checks.append(
            _check(
                f"validity_{column}", "validity", table, "total", f"outside{i}",
                f"format_string('range [{low:g}, {high:g}]; rows outside: %d', outside{i})",
            )
        )
    if fresh:
        counts["newest"] = f"CAST(max({name(fresh)}) AS TIMESTAMP)"
        checks.append(_fresh_check(table, as_of))
    return _rows(df.agg(*exprs(counts)), checks).filter(
        "total_records > 0 OR dimension = 'completeness'"
    )


def check_completeness(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    return scan_checks(df, table, required=cols)


def check_in_set(df: DataFrame, table: str, column: str, values: list[str]) -> DataFrame:
    return scan_checks(df, table, in_set=[(column, values)])


def check_range(df: DataFrame, table: str, ranges: list[tuple[str, float, float]]) -> DataFrame:
    return scan_checks(df, table, in_range=ranges)


# Checks with their own shape


def check_uniqueness(df: DataFrame, table: str, key: str) -> DataFrame:
    """failed = rows - distinct non-NULL keys.

    Text keys are shuffled as their digest, so a long text is read but not
    moved; copies are reduced on the map side.
    """
    text = isinstance(df.schema[key].dataType, T.StringType)
    groups = (
        df.selectExpr(f"unhex(sha2({name(key)}, 256)) AS k" if text else f"{name(key)} AS k")
        .groupBy("k")
        .agg(F.expr("count(*) AS n"))
    )
    one = groups.agg(
        *exprs(
            {
                "total": "coalesce(sum(n), 0)",
                "failed": "coalesce(sum(n), 0) - count(k)",
                "repeated": "count_if(n > 1)",
            }
        )
    )
    details = (
        f"format_string('key: %s; repeated keys: %d; surplus rows: %d', {lit(key)}, repeated, failed)"
    )
    return _rows(
        one, [_check(f"uniqueness_{table}_{key}", "uniqueness", table, "total", "failed", details)]
    )


def check_timeliness(df: DataFrame, table: str, time: str, as_of: dt.datetime) -> DataFrame:
    return scan_checks(df, table, fresh=time, as_of=as_of)


def check_fks(
    child: DataFrame, table: str, references: list[tuple[str, DataFrame, str]]
) -> DataFrame:
    """failed = rows whose non-NULL key the parent lacks, per (column, parent, parent column).

    The child is counted once by all its keys, so the joins see one row per
    combination and a hot key costs nothing.
    """
    keys = child.groupBy(*[F.col(name(c)) for c in dict.fromkeys(c for c, _, _ in references)]).agg(
        F.expr("count(*) AS _n")
    )
    counts, checks = {"total": "coalesce(sum(_n), 0)"}, []
    for i, (column, parent, parent_column) in enumerate(references):
        known = parent.selectExpr(f"{name(parent_column)} AS _k{i}", f"1 AS _hit{i}").distinct()
        keys = keys.join(known, F.expr(f"{name(column)} = _k{i}"), "left")
        lost = f"{name(column)} IS NOT NULL AND _hit{i} IS NULL"
        counts[f"failed{i}"] = f"coalesce(sum(_n) FILTER (WHERE {lost}), 0)"
        checks.append(
            _check(
                f"ri_{table}_{column}", "referential_integrity", table, "total", f"failed{i}",
                f"format_string('%s without parent: %d', {lit(f'{table}.{column}')}, failed{i})",
            )
        )
    return _rows(keys.agg(*exprs(counts)), checks)


def check_fk(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    return check_fks(child, table, [(column, parent, parent_column)])


def run_checks(tables: dict[str, DataFrame], rules: Rules, as_of: dt.datetime) -> DataFrame:
    """All checks as one set of rows: per table one scan for completeness,
    validity and timeliness, one for all foreign keys, one per unique key."""
    frames, fresh = [], dict(rules.fresh)
    scanned = [*rules.required, *fresh]
    scanned += [t for t, *_ in rules.in_set] + [t for t, *_ in rules.in_range]
    for table in dict.fromkeys(scanned):
        frames.append(
            scan_checks(
                tables[table],
                table,
                rules.required.get(table),
                [(c, v) for t, c, v in rules.in_set if t == table],
                [(c, lo, hi) for t, c, lo, hi in rules.in_range if t == table],
                fresh.get(table),
                as_of,
            )
        )
    frames += [check_uniqueness(tables[t], t, key) for t, key in rules.unique]
    for table in dict.fromkeys(t for t, *_ in rules.references):
        references = [(c, tables[p], pc) for t, c, p, pc in rules.references if t == table]
        frames.append(check_fks(tables[table], table, references))
    return reduce(DataFrame.unionByName, frames)


# Scores


def composite(checks: DataFrame, threshold: float = C.DQ_PASS) -> DataFrame:
    """One row: dimension scores, weighted composite, verdict, threshold.

    A dimension without checks counts as 1.
    """
    means = {d: f"coalesce(avg(score) FILTER (WHERE dimension = '{d}'), 1D)" for d in C.DQ_WEIGHTS}
    weighted = " + ".join(f"{d} * {lit(weight)}" for d, weight in C.DQ_WEIGHTS.items())
    return (
        checks.agg(*exprs({**means, "total_checks": "count(*)"}))
        .selectExpr("*", f"round({weighted}, 4) AS composite_dq_score")
        .selectExpr(
            *[f"round({d}, 4) AS {d}_score" for d in means],
            "composite_dq_score",
            f"IF(composite_dq_score >= {lit(threshold)}, 'PASS', 'FAIL') AS pass_fail",
            f"{lit(threshold)} AS threshold_used",
            "total_checks",
        )
    )


def dq_history_row(
    checks: DataFrame, run_id: str | None, at: str, threshold: float = C.DQ_PASS
) -> DataFrame:
    """The history row of a run, with all check rows (one per rule) as JSON."""
    entry = (
        "struct(check_name, dimension, table_name AS table, round(score, 4) AS score, "
        "total_records AS total, passed_records AS passed, failed_records AS failed, details)"
    )
    details = checks.agg(F.expr(f"to_json(sort_array(collect_list({entry})))")).scalar()
    return (
        composite(checks, threshold)
        .withColumn("details_json", details)
        .selectExpr(
            f"CAST({lit(run_id)} AS STRING) AS run_id",
            f"{at} AS check_timestamp",
            *[f"{d}_score" for d in C.DQ_WEIGHTS],
            "composite_dq_score",
            "pass_fail",
            "threshold_used",
            "details_json",
        )
    )


def dq_grades(checks: DataFrame) -> DataFrame:
    """Grade per check: good from 0.85, weak from 0.5, else bad."""
    return checks.selectExpr(
        "*",
        f"CASE WHEN score >= {C.DQ_PASS}D THEN 'good' WHEN score >= {C.DQ_WEAK}D THEN 'weak' "
        "ELSE 'bad' END AS grade",
    )


class DataQualityFailed(RuntimeError):
    """Raised by `enforce` when the composite score misses the threshold."""


def enforce(score: DataFrame) -> None:
    """Stop the caller if the one-row composite says FAIL."""
    row = score.select("composite_dq_score", "pass_fail", "threshold_used").first()
    if row["pass_fail"] == "FAIL":
        raise DataQualityFailed(
            f"data quality {row['composite_dq_score']:.4f} is below {row['threshold_used']}"
        )
