"""BI measures: each takes the rows in context and the columns to group by."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom import constants as C
from tallyloom.functions.columns import count_type, divide, exprs, key_to_date, total
from tallyloom.operators.asof import as_of

INVITES, ACCEPTS = count_type(C.INVITE_SENT), count_type(C.INVITE_ACCEPTED)
MESSAGES, REPLIES = count_type(C.MESSAGE_SENT), count_type(C.REPLY_RECEIVED)
CONVERSIONS = "sum(CAST(is_converted AS BIGINT))"

# Counts per type and conversions of a group of activities.
TYPE_COUNTS = {
    "invites_sent": INVITES,
    "invites_accepted": ACCEPTS,
    "messages_sent": MESSAGES,
    "replies_received": REPLIES,
    "follow_ups_sent": count_type(C.FOLLOW_UP_SENT),
    "conversions": total("is_converted"),
}


def activity_measures(fact: DataFrame, by: list[str]) -> DataFrame:
    """Counts per type, conversions, the three rates and mean response time."""
    measures = {
        **TYPE_COUNTS,
        "acceptance_rate": divide(ACCEPTS, INVITES),
        "reply_rate": divide(REPLIES, MESSAGES),
        "conversion_rate": divide(CONVERSIONS, f"{INVITES} + {MESSAGES}"),
        "avg_response_time": "avg(response_time_hours)",
    }
    return fact.groupBy(*by).agg(*exprs(measures))


def agent_status_counts(accounts: DataFrame) -> DataFrame:
    """One row: current accounts per status."""
    return accounts.agg(
        *exprs(
            {
                f"{s.lower()}_agents": f"count_if(agent_status = '{s}' AND is_current = 1)"
                for s in C.AGENT_STATUSES
            }
        )
    )


def utilization(daily: DataFrame, by: list[str]) -> DataFrame:
    """Mean invite and message utilization."""
    return daily.groupBy(*by).agg(
        F.expr("avg(invite_utilization) AS avg_invite_utilization"),
        F.expr("avg(message_utilization) AS avg_message_utilization"),
    )


def invite_throughput(daily: DataFrame, accounts: DataFrame, by: list[str]) -> DataFrame:
    """Invites over the sum of the account's limit on each of its days.

    The limit of a day is that of the last version that starts on it or before, or of the
    first version where none does, whatever version's key the snapshot row has.  A day
    counts once for an account, also where rows of two versions share it.  Accounts
    without `effective_from` have one version.
    """
    start = "to_date(effective_from)" if "effective_from" in accounts.columns else "DATE '1970-01-01'"
    order = "effective_from" if "effective_from" in accounts.columns else "account_key"
    starts = accounts.groupBy("account_id", F.expr(f"{start} AS _start")).agg(
        F.expr(f"max_by(daily_invite_limit, {order}) AS daily_invite_limit")
    )
    first = starts.groupBy("account_id").agg(F.expr("min_by(daily_invite_limit, _start) AS _first"))
    days = (
        daily.join(accounts.select("account_key", "account_id"), "account_key", "left")
        .groupBy(*dict.fromkeys([*by, "date_key"]), "account_id")
        .agg(F.expr("sum(invites_sent) AS invites"))
        .selectExpr("*", f"{key_to_date('date_key')} AS _day")
    )
    limited = as_of(days, starts, ["account_id"], "_day", "_start", ["daily_invite_limit"], "_valid")
    limit = "coalesce(_valid.daily_invite_limit, _first)"
    measures = {
        "invites_sent": "sum(invites)",
        "invite_capacity": f"sum({limit})",
        "invite_throughput": divide("sum(invites)", f"sum({limit})"),
    }
    return limited.join(first, "account_id", "left").groupBy(*by).agg(*exprs(measures))


def risk_measures(scored: DataFrame, by: list[str]) -> DataFrame:
    """Mean and max score, accounts with a raised day, and the 1-3 risk level.

    Rows are reduced to one per account before accounts are counted, so no
    distinct set is built.
    """
    per_account = scored.groupBy(*dict.fromkeys([*by, "account_key"])).agg(
        *exprs(
            {
                "total": "sum(anomaly_score)",
                "n": "count(anomaly_score)",
                "top": "max(anomaly_score)",
                "warned": "max(CAST(risk_flag = 'Warning' AS INT))",
                "critical": "max(CAST(risk_flag = 'Critical' AS INT))",
            }
        )
    )
    mean = "try_divide(sum(total), sum(n))"
    measures = {
        "avg_anomaly_score": mean,
        "max_anomaly_score": "max(top)",
        "warning_accounts": "count_if(warned = 1)",
        "critical_accounts": "count_if(critical = 1)",
        "risk_score_kpi": f"CASE WHEN {mean} > {C.CRITICAL_ABOVE} THEN 3 "
        f"WHEN {mean} > {C.WARNING_ABOVE} THEN 2 ELSE 1 END",
    }
    return per_account.groupBy(*by).agg(*exprs(measures))


def campaign_measures(
    fact: DataFrame, campaigns: DataFrame, by: list[str], keep: str | None = None
) -> DataFrame:
    """Campaign rates; conversions are set against all activity rows.

    `by` names campaign attributes; `keep` slices the campaigns.  Facts are
    reduced per campaign before the attributes are joined.
    """
    per_campaign = fact.groupBy("campaign_key").agg(
        *exprs(
            {
                "inv": INVITES,
                "acc": ACCEPTS,
                "msg": MESSAGES,
                "rep": REPLIES,
                "conv": CONVERSIONS,
                "rows": "count(*)",
            }
        )
    )
    measures = {
        "activities": "sum(rows)",
        "conversions": "sum(conv)",
        "acceptance_rate": divide("sum(acc)", "sum(inv)"),
        "reply_rate": divide("sum(rep)", "sum(msg)"),
        "conversion_rate": divide("sum(conv)", "sum(rows)"),
    }
    sliced = campaigns.filter(keep) if keep else campaigns
    return per_campaign.join(sliced, "campaign_key").groupBy(*by).agg(*exprs(measures))


def best_campaign(measures: DataFrame) -> DataFrame:
    """The campaigns with the highest conversion rate, ties included."""
    top = measures.agg(F.max("conversion_rate")).scalar()
    return measures.filter(F.col("conversion_rate") == top)


def _by_day(fact: DataFrame, by: list[str]) -> DataFrame:
    """Daily invites and accepts; the windows below run over these rows, whose
    number per group is bounded by the calendar."""
    return (
        fact.groupBy(*by, "date_key")
        .agg(*exprs({"invites_sent": INVITES, "invites_accepted": ACCEPTS}))
        .selectExpr("*", f"unix_date({key_to_date('date_key')}) AS day_no")
    )


def _days(by: list[str], first: int, last: int) -> str:
    """Window over the calendar days from `first` to `last` before the row's own."""
    partition = f"PARTITION BY {', '.join(by)} " if by else ""
    end = f"{last} PRECEDING" if last else "CURRENT ROW"
    return f"OVER ({partition}ORDER BY day_no RANGE BETWEEN {first} PRECEDING AND {end})"


def rolling_7d(fact: DataFrame, by: list[str]) -> DataFrame:
    """Per day: invites and acceptance rate of the 7 calendar days ending there."""
    week = _days(by, 6, 0)
    return (
        _by_day(fact, by)
        .selectExpr(
            *by, "date_key", f"sum(invites_sent) {week} AS invites_7d",
            f"sum(invites_accepted) {week} AS accepts_7d",
        )
        .selectExpr(
            *by, "date_key", "invites_7d",
            f"{divide('accepts_7d', 'invites_7d')} AS acceptance_rate_7d",
        )
    )


def wow_change(fact: DataFrame, by: list[str]) -> DataFrame:
    """Per day: relative change of invites against 7 calendar days earlier."""
    return (
        _by_day(fact, by)
        .selectExpr(
            *by, "date_key", "invites_sent", f"sum(invites_sent) {_days(by, 7, 7)} AS prior"
        )
        .selectExpr(
            *by, "date_key", "invites_sent", "coalesce(prior, 0) AS invites_prior_week",
            f"{divide('invites_sent - prior', 'prior')} AS wow_change",
        )
    )


def dq_latest(history: DataFrame, passing: float = C.DQ_PASS) -> DataFrame:
    """Highest score of the last check day, and its verdict."""
    return (
        history.groupBy(F.expr("to_date(check_timestamp) AS day"))
        .agg(F.expr("max(composite_dq_score) AS top"))
        .agg(F.expr("max(day) AS check_day"), F.expr("max_by(top, day) AS latest_dq_score"))
        .selectExpr(
            "*", f"IF(latest_dq_score >= {passing}D, 'PASS', 'FAIL') AS dq_status"
        )
    )
