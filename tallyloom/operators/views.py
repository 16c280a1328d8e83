"""Dashboard data sets: group-bys a report page reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import divide, exprs
from tallyloom.operators.measures import TYPE_COUNTS, activity_measures


def daily_trend(fact: DataFrame) -> DataFrame:
    """Daily invites and acceptance rate."""
    return activity_measures(fact, ["date_key"]).select(
        "date_key", "invites_sent", "acceptance_rate"
    )


def last_days(fact: DataFrame, days: int = 7) -> DataFrame:
    """Daily KPI rows of the last days that have activity (`days` of them)."""
    recent = fact.select("date_key").distinct().orderBy(F.desc("date_key")).limit(days)
    kept = fact.join(F.broadcast(recent), "date_key", "left_semi")
    return activity_measures(kept, ["date_key"])


def activity_breakdown(fact: DataFrame) -> DataFrame:
    return fact.groupBy("activity_type").agg(F.expr("count(*) AS activities"))


def utilization_bands(daily: DataFrame) -> DataFrame:
    """Mean invite utilization per account with its band: red above 0.90,
    yellow above 0.70."""
    used = "avg_invite_utilization"
    return (
        daily.groupBy("account_key")
        .agg(F.expr(f"avg(invite_utilization) AS {used}"))
        .selectExpr(
            "*", f"CASE WHEN {used} > 0.9D THEN 'red' WHEN {used} > 0.7D THEN 'yellow' "
            "ELSE 'ok' END AS band"
        )
    )


def anomaly_grid(scored: DataFrame) -> DataFrame:
    """Account by day grid of scores: a row per account and month, a column per
    day of the month, so the column list is fixed for any date range."""
    days = {f"d{d:02d}": f"max(IF(date_key % 100 = {d}, anomaly_score, NULL))" for d in range(1, 32)}
    return scored.groupBy(
        "account_key", F.expr("CAST(floor(date_key / 100) AS INT) AS month_key")
    ).agg(*exprs(days))


def funnel(fact: DataFrame) -> DataFrame:
    """Five steps with count, share of the step before and of the first step."""
    steps = ["invites_sent", "invites_accepted", "messages_sent", "replies_received", "conversions"]
    rows = ", ".join(
        f"struct({i} AS step_no, '{name}' AS step, {name} AS n, "
        f"{divide(name, steps[max(i - 2, 0)])} AS of_previous, "
        f"{divide(name, steps[0])} AS of_first)"
        for i, name in enumerate(steps, 1)
    )
    return fact.agg(*exprs({s: TYPE_COUNTS[s] for s in steps})).selectExpr(
        f"inline(array({rows}))"
    )


def campaign_share(measures: DataFrame) -> DataFrame:
    """Campaigns ranked by their exact conversion rate, with their activity share;
    the rate is rounded to four digits in the output only.

    Campaigns are counted per distinct rate, and rates are ranked inside slices
    of a ten-thousandth, of which [0, 1] has 10,001; slice totals give each slice
    its first rank. A NULL rate comes last. Campaigns never meet in one task.
    """
    rated = measures.withColumn("_slice", F.expr("CAST(floor(conversion_rate * 10000) AS INT)"))
    counts = rated.groupBy("_slice", "conversion_rate").agg(F.expr("count(*) AS n"))
    firsts = (
        counts.groupBy("_slice")
        .agg(F.expr("sum(n) AS in_slice"))
        .selectExpr("_slice", "sum(in_slice) OVER (ORDER BY _slice DESC NULLS LAST) - in_slice AS above")
    )
    inside = "sum(n) OVER (PARTITION BY _slice ORDER BY conversion_rate DESC) - n"
    ranks = (
        counts.selectExpr("_slice", "conversion_rate", f"{inside} AS before")
        .alias("c")
        .join(F.broadcast(firsts).alias("f"), F.expr("c._slice <=> f._slice"))
        .selectExpr("conversion_rate AS _rate", "above + before + 1 AS rank")
    )
    total = measures.agg(F.sum("activities")).scalar()
    return (
        rated.join(ranks, F.expr("conversion_rate <=> _rate"))
        .withColumn("total", total)
        .selectExpr(
            "campaign_name", "activities", "round(conversion_rate, 4) AS conversion_rate", "rank",
            f"{divide('activities', 'total')} AS activity_share",
        )
    )


def account_trend(scored: DataFrame) -> DataFrame:
    """Per account and day: utilization, acceptance, score, flag and volume."""
    return scored.selectExpr(
        "account_key",
        "date_key",
        "invite_utilization",
        "message_utilization",
        "acceptance_rate",
        "anomaly_score",
        "risk_flag",
        "invites_sent + messages_sent AS volume",
    )


def risk_table(report: DataFrame) -> DataFrame:
    """Recommended limits against the ceilings."""
    return report.select(
        "account_id",
        "account_name",
        "risk_level",
        "recommended_daily_invites",
        "invite_ceiling",
        "recommended_daily_messages",
        "message_ceiling",
    )
