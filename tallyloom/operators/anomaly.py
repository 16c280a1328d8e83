"""Robust anomaly scores: modified z-score, Tukey fences, composite score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom import constants as C
from tallyloom.functions.columns import lit, ratio
from tallyloom.functions.robust import metric_values, robust_stats, stored

# Groups whose statistics are broadcast, some hundred bytes each.
BROADCAST_GROUPS = 20_000


def _attach_stats(df: DataFrame, metrics: dict[str, str], by: list[str]) -> DataFrame:
    """Add a struct `_stats` with one struct (rows, q1, median, q3, mad) per metric.

    Without `by` the statistics are one row and enter as a scalar subquery;
    with `by` they are joined on the partition columns, so that no task gets all rows of
    a large group: up to `BROADCAST_GROUPS` groups are broadcast, the stored statistics of
    more are joined by a shuffle whose large groups Spark can split.
    """
    values = metric_values(df, by, metrics)
    stats = robust_stats(values, [*by, "metric"], bounded_groups=not by)
    return _with_stats(df, stats, metrics, by)


def _with_stats(df: DataFrame, stats: DataFrame, metrics: dict[str, str], by: list[str]) -> DataFrame:
    parts = ", ".join(
        f"'{m}', max(CASE WHEN metric = '{m}' THEN struct(rows, q1, median, q3, mad) END)"
        for m in metrics
    )
    wide = F.expr(f"named_struct({parts})").alias("_stats")
    if not by:
        return df.select("*", stats.agg(wide).scalar().alias("_stats"))
    grouped = stored(stats.groupBy(*by).agg(wide), "group-stats")
    if grouped.count() <= BROADCAST_GROUPS:
        grouped = F.broadcast(grouped)
    grouped = grouped.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = F.expr(" AND ".join(f"{c} <=> _by_{c}" for c in by))
    return df.join(grouped, same, "left").drop(*[f"_by_{c}" for c in by])


def _z(value: str, stat: str) -> str:
    """0 where the MAD is 0, even if values differ."""
    return (
        f"CASE WHEN {stat}.mad = 0 THEN 0D "
        f"ELSE {lit(C.Z_FACTOR)} * ({value} - {stat}.median) / {stat}.mad END"
    )


def _outside(value: str, stat: str, k: float) -> str:
    reach = f"{lit(float(k))} * ({stat}.q3 - {stat}.q1)"
    return f"({value} < {stat}.q1 - {reach} OR {value} > {stat}.q3 + {reach})"


def with_modified_z(
    df: DataFrame, col: str, partition_by: list[str] | None = None, out: str | None = None
) -> DataFrame:
    """Add the modified z-score of `col`."""
    value = f"CAST({col} AS DOUBLE)"
    scored = _attach_stats(df, {"x": value}, partition_by or [])
    return scored.selectExpr("*", f"{_z(value, '_stats.x')} AS {out or 'z_' + col}").drop("_stats")


def with_iqr_flag(
    df: DataFrame,
    col: str,
    k: float = C.FENCE_K,
    partition_by: list[str] | None = None,
    out: str | None = None,
) -> DataFrame:
    """Add 1/0: `col` lies strictly outside the fences q1 - k*iqr, q3 + k*iqr."""
    value = f"CAST({col} AS DOUBLE)"
    scored = _attach_stats(df, {"x": value}, partition_by or [])
    hit = f"CAST({_outside(value, '_stats.x', k)} AS INT)"
    return scored.selectExpr("*", f"{hit} AS {out or 'iqr_outlier_' + col}").drop("_stats")


def with_ghost_rate(df: DataFrame) -> DataFrame:
    """Add `ghost_rate` = 1 - replies/accepts, 0 without accepts; kept if present."""
    if "ghost_rate" in df.columns:
        return df
    replied = ratio("coalesce(replies_received, 0)", "invites_accepted")
    return df.selectExpr(
        "*", f"CASE WHEN invites_accepted > 0 THEN 1D - {replied} ELSE 0D END AS ghost_rate"
    )


def risk_flag(score: str) -> str:
    """Normal up to and including 2.0, Warning up to and including 3.5, else Critical."""
    return (
        f"CASE WHEN {score} <= {lit(C.WARNING_ABOVE)} THEN 'Normal' "
        f"WHEN {score} <= {lit(C.CRITICAL_ABOVE)} THEN 'Warning' ELSE 'Critical' END"
    )


def _scored_values(
    df: DataFrame, metrics: list[tuple[str, float, str]], null_as: float
) -> dict[str, str]:
    missing = lit(float(null_as))
    return {
        m: f"nanvl(coalesce(CAST({m} AS DOUBLE), {missing}), {missing})"
        for m, *_ in metrics if m in df.columns
    }


def metric_days(
    daily: DataFrame,
    metrics: list[tuple[str, float, str]] = C.ANOMALY_METRICS,
    null_as: float = 0.0,
) -> DataFrame:
    """(date_key, metric, value, n): how often each value that enters the scores occurs on a day.

    Days are merged by putting their rows together, so only touched days need be counted again.
    """
    df = with_ghost_rate(daily)
    return metric_values(df, ["date_key"], _scored_values(df, metrics, null_as))


def pooled_stats(days: DataFrame) -> DataFrame:
    """Statistics of each metric over all days of `metric_days`, equal to those over the rows themselves."""
    return robust_stats(days.select("metric", "value", "n"), ["metric"], bounded_groups=True)


def anomaly_scores(
    daily: DataFrame,
    metrics: list[tuple[str, float, str]] = C.ANOMALY_METRICS,
    partition_by: list[str] | None = None,
    null_as: float = 0.0,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Add per-metric z and fence columns, `anomaly_score` and `risk_flag`.

    Statistics are pooled over all rows unless `partition_by` is given.  A
    metric that is not a column is left out and not weighted; NULL and NaN read
    as `null_as`.  With fewer than five rows every z and the score are 0 and the fence columns are NULL.
    With `stats` (`pooled_stats`) the rows are scored by these, row by row, without a look at other rows.
    """
    df = with_ghost_rate(daily.drop("anomaly_score", "risk_flag"))
    present = [m for m in metrics if m[0] in df.columns]
    if not present:
        return df.selectExpr("*", "0D AS anomaly_score", "'Normal' AS risk_flag")
    values = _scored_values(df, present, null_as)

    zs, columns = [], []
    for name, _, bad in present:
        stat = f"_stats.{name}"
        sign = "-" if bad == "low" else ""
        zs.append(
            f"CASE WHEN {stat}.rows >= {C.MIN_ROWS} "
            f"THEN greatest({sign}({_z(values[name], stat)}), 0D) ELSE 0D END AS _z_{name}"
        )
        columns += [
            f"round(_z_{name}, 4) AS z_{name}",
            f"CASE WHEN {stat}.rows >= {C.MIN_ROWS} THEN "
            f"CAST({_outside(values[name], stat, C.FENCE_K)} AS INT) END AS iqr_outlier_{name}",
        ]
    total = " + ".join(f"_z_{name} * {lit(weight)}" for name, weight, _ in present)
    weights = lit(sum(weight for _, weight, _ in present))
    if stats is None:
        attached = _attach_stats(df, values, partition_by or [])
    else:
        attached = _with_stats(df, stats, values, [])
    return (
        attached.selectExpr("*", *zs)
        .selectExpr(
            *df.columns, *columns, f"round(({total}) / {weights}, 4) AS anomaly_score"
        )
        .selectExpr("*", f"{risk_flag('anomaly_score')} AS risk_flag")
    )


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Rows in total and per raised flag, as one row."""
    return scored.agg(
        F.expr("count(*) AS total_records"),
        F.expr("count_if(risk_flag = 'Warning') AS warnings"),
        F.expr("count_if(risk_flag = 'Critical') AS criticals"),
    )
