"""Account risk level, capacity recommendation and the risk report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.functions.columns import exprs, pick, steps, tier_value
from tallyloom.operators.dims import of_accounts

# Points per signal and levels per point total.
ANOMALY_POINTS = [(3.5, 4), (2.0, 2), (1.0, 1)]
ACCEPTANCE_POINTS = [(0.05, 3), (0.10, 2), (0.20, 1)]
REPLY_POINTS = [(0.02, 2), (0.05, 1)]
UTILIZATION_POINTS = [(0.95, 2), (0.80, 1)]
LEVELS = [(7, "Critical"), (5, "High"), (3, "Moderate"), (1, "Low")]
LOWEST_LEVEL = "Healthy"

# Capacity factors per signal, least days per confidence level.
ANOMALY_FACTORS = [(3.5, 0.40), (2.0, 0.65), (1.0, 0.85)]
ACCEPTANCE_FACTORS = [(0.05, 0.50), (0.10, 0.70), (0.20, 0.85)]
REPLY_FACTORS = [(0.02, 0.75), (0.05, 0.90)]
CONFIDENCE_DAYS = [(14, "HIGH"), (7, "MEDIUM"), (3, "LOW")]
NO_CONFIDENCE = "INSUFFICIENT"
CONFIDENCE_FACTORS = {"LOW": 0.80, "MEDIUM": 0.90}


def risk_level(anomaly: str, acceptance: str, reply: str, used: str) -> str:
    """Level from the point total of the four signals."""
    points = " + ".join(
        [
            steps(anomaly, ">", ANOMALY_POINTS, 0),
            steps(acceptance, "<", ACCEPTANCE_POINTS, 0),
            steps(reply, "<", REPLY_POINTS, 0),
            steps(used, ">", UTILIZATION_POINTS, 0),
        ]
    )
    return steps(f"({points})", ">=", LEVELS, LOWEST_LEVEL)


def confidence(days: str) -> str:
    return steps(days, ">=", CONFIDENCE_DAYS, NO_CONFIDENCE)


def with_capacity(
    df: DataFrame,
    tier: str = "account_age_tier",
    acceptance: str = "avg_acceptance_rate",
    reply: str = "avg_reply_rate",
    anomaly: str = "recent_anomaly_score",
    days: str = "days_of_data",
) -> DataFrame:
    """Add recommended limits, ceilings, safety factor, confidence, level, reasoning.

    With too few days the ceilings are recommended and the level is Unknown.
    The level's use of capacity is recommended over ceiling invites.
    """
    enough = f"confidence <> '{NO_CONFIDENCE}'"
    factor = " * ".join(
        [
            steps(anomaly, ">", ANOMALY_FACTORS, 1.0),
            steps(acceptance, "<", ACCEPTANCE_FACTORS, 1.0),
            steps(reply, "<", REPLY_FACTORS, 1.0),
            pick("confidence", CONFIDENCE_FACTORS, 1.0),
        ]
    )

    def recommended(ceiling: str) -> str:
        return f"greatest(1, least({ceiling}, CAST(floor({ceiling} * _factor) AS INT)))"

    level = risk_level(
        anomaly, acceptance, reply, "CAST(recommended_daily_invites AS DOUBLE) / invite_ceiling"
    )
    reason = f"""IF({enough},
        format_string('%s tier (%s), ceilings %d/%d; factor %.2f from anomaly %.2f, '
            || 'acceptance %.2f%%, replies %.2f%%; confidence %s on %d days; level %s',
            coalesce({tier}, 'unknown'), {tier_value(tier, 0)}, invite_ceiling, message_ceiling,
            _factor, {anomaly}, {acceptance} * 100, {reply} * 100, confidence, {days}, risk_level),
        format_string('%d days of data are too few for a recommendation; ceilings %d/%d apply',
            {days}, invite_ceiling, message_ceiling))"""
    return (
        df.selectExpr(
            "*",
            f"{tier_value(tier, 1)} AS invite_ceiling",
            f"{tier_value(tier, 2)} AS message_ceiling",
            f"{confidence(days)} AS confidence",
        )
        .selectExpr("*", f"IF({enough}, {factor}, 1D) AS _factor")
        .selectExpr(
            "*",
            f"{recommended('invite_ceiling')} AS recommended_daily_invites",
            f"{recommended('message_ceiling')} AS recommended_daily_messages",
            "round(_factor, 4) AS safety_factor",
        )
        .selectExpr("*", f"IF({enough}, {level}, 'Unknown') AS risk_level")
        .selectExpr("*", f"{reason} AS reasoning")
        .drop("_factor")
    )


def risk_report(accounts: DataFrame, daily: DataFrame) -> DataFrame:
    """Capacity recommendation for every current, active account.

    Means skip NULL; the score is the latest non-NULL one.  Snapshots count for
    the account over all its versions.  An account without snapshots is kept,
    with NULL averages.  Rounding comes after the rules.
    """
    signals = ["avg_acceptance_rate", "avg_reply_rate", "recent_anomaly_score"]
    per_account = of_accounts(daily, accounts).groupBy("account_id").agg(
        *exprs(
            {
                "days_of_data": "count(*)",
                "avg_acceptance_rate": "avg(acceptance_rate)",
                "avg_reply_rate": "avg(reply_rate)",
                "recent_anomaly_score": "max_by(anomaly_score, date_key) "
                "FILTER (WHERE anomaly_score IS NOT NULL)",
            }
        )
    )
    known = (
        accounts.filter("is_current = 1 AND agent_status = 'Active'")
        .select("account_key", "account_id", "account_name", "account_age_tier")
        .join(per_account, "account_id", "left")
        .fillna(0, ["days_of_data"])
        .fillna(0.0, signals)
    )
    return with_capacity(known).selectExpr(
        "account_id",
        "account_name",
        "account_age_tier AS account_tier",
        "days_of_data",
        *[f"IF(days_of_data > 0, round({c}, 4), NULL) AS {c}" for c in signals],
        "recommended_daily_invites",
        "recommended_daily_messages",
        "invite_ceiling",
        "message_ceiling",
        "safety_factor",
        "confidence",
        "risk_level",
        "reasoning",
    )
