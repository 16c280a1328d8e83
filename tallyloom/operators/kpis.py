"""KPI queries over the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import exprs, rate, total
from tallyloom.operators.dims import current_versions, of_accounts
from tallyloom.operators.measures import (
    ACCEPTS,
    CONVERSIONS,
    INVITES,
    MESSAGES,
    REPLIES,
    TYPE_COUNTS,
)


def core_kpis(
    fact: DataFrame,
    dim_date: DataFrame,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
) -> DataFrame:
    """One row of totals and rates over an inclusive date range.

    Facts whose date is not in the calendar drop out.  The range is put on the
    fact's own date key too, so a fact partitioned by date is pruned.  Facts
    are reduced per day before the calendar is joined.
    """
    for bound, test in ((date_from, ">="), (date_to, "<=")):
        if bound is not None:
            fact = fact.filter(f"date_key {test} {bound:%Y%m%d}")
            dim_date = dim_date.filter(f"full_date {test} DATE '{bound:%Y-%m-%d}'")

    by_day = fact.groupBy("date_key").agg(
        *exprs(
            {
                **TYPE_COUNTS,
                "hours": "sum(response_time_hours)",
                "timed": "count(response_time_hours)",
            }
        )
    )
    inv, acc = total("invites_sent"), total("invites_accepted")
    msg, rep, conv = total("messages_sent"), total("replies_received"), total("conversions")
    mean = "coalesce(try_divide(sum(hours), sum(timed)), 0D)"
    kpis = {
        "total_invites_sent": inv,
        "total_invites_accepted": acc,
        "total_messages_sent": msg,
        "total_replies_received": rep,
        "total_follow_ups": total("follow_ups_sent"),
        "total_conversions": conv,
        "acceptance_rate": rate(acc, inv),
        "reply_rate": rate(rep, msg),
        "conversion_rate": rate(conv, f"{inv} + {msg}"),
        "avg_response_time_hours": f"round({mean}, 2)",
    }
    return by_day.join(dim_date.select("date_key"), "date_key").agg(*exprs(kpis))


def account_health(accounts: DataFrame, daily: DataFrame) -> DataFrame:
    """Current accounts with snapshot averages; accounts without days are kept.

    Snapshots count for the account over all its versions and are reduced to one
    row per account before the join.
    """
    measures = {
        "avg_invite_utilization": "avg(invite_utilization)",
        "avg_message_utilization": "avg(message_utilization)",
        "avg_acceptance_rate": "avg(acceptance_rate)",
        "avg_reply_rate": "avg(reply_rate)",
        "max_anomaly_score": "max(anomaly_score)",
        "avg_anomaly_score": "avg(anomaly_score)",
    }
    per_account = of_accounts(daily, accounts).groupBy("account_id").agg(
        *exprs({"days_active": "count(*)", **measures})
    )
    return (
        current_versions(accounts)
        .join(per_account, "account_id", "left")
        .selectExpr(
            "account_id",
            "account_name",
            "agent_status",
            "account_age_tier",
            "daily_invite_limit",
            "daily_message_limit",
            "coalesce(days_active, 0) AS days_active",
            *[f"coalesce({m}, 0D) AS {m}" for m in measures],
        )
    )


def campaign_performance(campaigns: DataFrame, fact: DataFrame) -> DataFrame:
    """Campaigns with counts, conversions, response time and rates, most
    conversions first.  Conversions are NULL for a campaign without facts."""
    counts = {
        "invites_sent": INVITES,
        "invites_accepted": ACCEPTS,
        "messages_sent": MESSAGES,
        "replies_received": REPLIES,
    }
    per_campaign = fact.groupBy("campaign_key").agg(
        *exprs({**counts, "conversions": CONVERSIONS, "hours": "avg(response_time_hours)"})
    )
    return (
        campaigns.join(per_campaign, "campaign_key", "left")
        .selectExpr(
            "campaign_id",
            "campaign_name",
            "target_segment",
            "status",
            *[f"coalesce({c}, 0) AS {c}" for c in counts],
            "conversions",
            "round(coalesce(hours, 0D), 2) AS avg_response_time",
            f"{rate('invites_accepted', 'invites_sent')} AS acceptance_rate",
            f"{rate('replies_received', 'messages_sent')} AS reply_rate",
        )
        .orderBy(F.desc_nulls_last("conversions"), "campaign_id")
    )
