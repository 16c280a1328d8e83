"""The registered queries: every operator applied to the test tables.

Each entry takes (spark, sf_dir) and returns a DataFrame.  Times are given out
as text and means of doubles are rounded, so results do not depend on the
order in which tasks finish.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom import constants as C
from tallyloom.functions.columns import date_key, flag, pick, truthy
from tallyloom.operators import (
    anomaly,
    dims,
    facts,
    increment,
    kpis,
    measures,
    ops,
    quality,
    risk,
    trends,
    views,
)
from tallyloom.schemas import TABLES
from tallyloom.sources import testmart as tm
from tallyloom.sources.key_index import KeyIndex
from tallyloom.sources.locations import work_folder
from tallyloom.sources.tables import MartTables, write_alerts
from tallyloom.streaming import daily_counts, ingest

# Parameters of the registered queries.
WATERMARK = dt.datetime(2024, 1, 15)
AS_OF = dt.datetime(2024, 2, 1)
STAMP = "TIMESTAMP '2024-02-01 06:00:00'"
ORDER_SPLIT = dt.datetime(1997, 1, 1)
ORDER_TIME = "struct(o_orderdate, o_orderkey)"
RUN = "run-1"
EARLY = f"TIMESTAMP_NTZ '{WATERMARK}'"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[tm.TestTables], DataFrame]) -> Callable[[tm.TestTables], DataFrame]:
    """Register a function of the test tables under its name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tm.TestTables(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def text_time(col: str, name: str | None = None) -> str:
    """A time as text."""
    return f"date_format({col}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {name or col}"


def changed(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """The frame with the expressions of some columns replaced."""
    return df.selectExpr(*[f"{texts[c]} AS {c}" if c in texts else c for c in df.columns])


def with_text_times(df: DataFrame, *cols: str) -> DataFrame:
    return df.selectExpr(*[text_time(c) if c in cols else c for c in df.columns])


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return changed(df, {c: f"round({c}, 6)" for c in cols})


def scored(t: tm.TestTables) -> DataFrame:
    return anomaly.anomaly_scores(tm.daily(t))


def orders_as_changes(t: tm.TestTables) -> DataFrame:
    """Orders as dated changes of a customer's priority."""
    return t.orders.selectExpr(
        "o_custkey", "o_orderpriority", "CAST(o_orderdate AS DATE) AS o_orderdate", "o_orderkey"
    )


def connected_accounts(t: tm.TestTables) -> DataFrame:
    return tm.accounts(t).filter("agent_status <> 'Disconnected'")


# Scans and sinks


@query
def scan_since_watermark(t):
    records = increment.scan_since(tm.activity_records(t), "timestamp", WATERMARK)
    return records.selectExpr("id", text_time("timestamp", "event_time"), "agent_id", "type")


@query
def dim_campaign_scd1(t):
    """Segments loaded before meet records that rename some and add the regions."""
    known = tm.campaigns(t).selectExpr(
        "campaign_id AS id",
        "IF(campaign_id = 'MACHINERY', NULL, lower(campaign_id)) AS name",
        "target_segment",
        "IF(campaign_id = 'HOUSEHOLD', NULL, 'Paused') AS status",
    )
    added = t.region.selectExpr(
        "r_name AS id", "initcap(r_name) AS name", "CAST(NULL AS STRING) AS target_segment",
        "CAST(NULL AS STRING) AS status",
    )
    records = known.unionByName(added).selectExpr(
        "*", "CAST(NULL AS STRING) AS description", "CAST(NULL AS STRING) AS created_at"
    )
    updates = dims.to_dim_campaign(records).drop("description", "created_date")
    return dims.scd1_merge(
        tm.campaigns(t), updates, "campaign_id", "1", surrogate="campaign_key"
    )


@query
def dim_lead_incremental(t):
    """Orders as lead updates: the state at the split, then the records after it."""
    time = "coalesce(updated_at, created_at)"
    records = t.orders.selectExpr(
        "CAST(o_custkey AS STRING) AS lead_id",
        "o_orderpriority AS location",
        "IF(o_orderstatus <> 'P', o_orderdate, NULL) AS updated_at",
        "o_orderdate AS created_at",
        "o_orderkey AS seq",
    ).selectExpr("*", f"struct({time} AS at, seq) AS arrival")
    before = records.filter(f"{time} <= TIMESTAMP_NTZ '{ORDER_SPLIT}'")
    old = facts.last_per_key(
        before.select("lead_id", "location", "arrival"), ["lead_id"], "arrival"
    )
    target = dims.assign_keys(old.drop("arrival"), "lead_id", "lead_key")
    news = increment.scan_since(records, time, ORDER_SPLIT)
    return dims.scd1_merge(
        target, news.select("lead_id", "location", "arrival"), "lead_id", "arrival",
        surrogate="lead_key",
    )


def _order_states(t: tm.TestTables, keep: str = "true") -> DataFrame:
    return t.orders.filter(keep).select(
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey"
    )


BEFORE_SPLIT = f"o_orderdate < TIMESTAMP_NTZ '{ORDER_SPLIT}'"
AFTER_SPLIT = f"o_orderdate >= TIMESTAMP_NTZ '{ORDER_SPLIT}'"


@query
def insert_new_only(t):
    target = facts.first_per_key(_order_states(t, BEFORE_SPLIT), ["o_custkey"], ORDER_TIME)
    result = facts.insert_new(target, _order_states(t), ["o_custkey"], ORDER_TIME)
    return result.select("o_custkey", "o_orderkey", "o_orderstatus")


@query
def replace_by_key(t):
    target = facts.last_per_key(_order_states(t, BEFORE_SPLIT), ["o_custkey"], ORDER_TIME)
    rows = facts.last_per_key(_order_states(t, AFTER_SPLIT), ["o_custkey"], ORDER_TIME)
    return facts.replace_by_key(target, rows, ["o_custkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


# Dimensions


@query
def dim_date(t):
    calendar = dims.dim_date_covering(t.orders, "o_orderdate")
    return changed(calendar, {"full_date": "CAST(full_date AS STRING)"})


@query
def scd1_merge(t):
    target = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    updates = t.orders.selectExpr(
        "o_custkey AS c_custkey",
        "IF(o_orderstatus <> 'P', o_orderpriority, NULL) AS c_mktsegment",
        f"{ORDER_TIME} AS arrival",
    )
    return dims.scd1_merge(target, updates, "c_custkey", "arrival")


def _versions_out(versions: DataFrame) -> DataFrame:
    return with_text_times(versions, "effective_from", "effective_to")


HISTORY_OF_ORDERS = (["o_custkey"], ["o_orderpriority"], "o_orderdate", "o_orderkey")


@query
def scd2_history(t):
    return _versions_out(dims.scd2_history(orders_as_changes(t), *HISTORY_OF_ORDERS))


@query
def scd2_history_events(t):
    """Timed changes: the kind of a user's last event."""
    changes = t.events.select("user_id", "event_type", "ts", "event_id")
    return _versions_out(
        dims.scd2_history(changes, ["user_id"], ["event_type"], "ts", "event_id")
    )


@query
def scd2_merge(t):
    changes = orders_as_changes(t)
    split = f"DATE '{ORDER_SPLIT:%Y-%m-%d}'"
    old = dims.scd2_history(changes.filter(f"o_orderdate < {split}"), *HISTORY_OF_ORDERS)
    new = changes.filter(f"o_orderdate >= {split}")
    return _versions_out(dims.scd2_merge(old, new, *HISTORY_OF_ORDERS))


@query
def scd2_stable_keys(t):
    """Three of four orders are a customer's history with keys; the rest come late.

    Every old version's key with the start of the version that covers it now and the
    key that version keeps, both named by the start of their first version.
    """
    changes = orders_as_changes(t)
    old = dims.scd2_history(changes.filter("o_orderkey % 4 <> 0"), *HISTORY_OF_ORDERS)
    old = old.selectExpr("*", "o_custkey * 100000L + datediff(effective_from, DATE '1990-01-01') AS version_key")
    late = changes.filter("o_orderkey % 4 = 0")
    merged = dims.scd2_merge(old.drop("version_key"), late, *HISTORY_OF_ORDERS)
    carried = dims.carried_keys(old, merged, ["o_custkey"], "version_key")
    return carried.selectExpr("o_custkey", "CAST(effective_from AS STRING) AS effective_from", "version_key", "survivor")


@query
def scd2_current(t):
    versions = dims.scd2_history(orders_as_changes(t), *HISTORY_OF_ORDERS)
    return _versions_out(dims.current_versions(versions))


@query
def surrogate_keys(t):
    taken = t.nation.selectExpr("CAST(n_nationkey AS BIGINT) AS lead_key")
    return dims.assign_keys(t.customer.select("c_name"), "c_name", "lead_key", taken)


def _nation_tiers(t: tm.TestTables) -> DataFrame:
    return t.nation.selectExpr("n_nationkey AS c_nationkey", f"{tm.TIER} AS tier")


@query
def tier_limits(t):
    """Customers by the tier of their nation; one segment has an unknown tier."""
    rows = t.customer.join(_nation_tiers(t), "c_nationkey").selectExpr(
        "c_custkey", "IF(c_mktsegment = 'BUILDING', 'unseen', tier) AS account_age_tier"
    )
    return dims.with_tier_limits(rows)


# Fact load


def dirty_records(t: tm.TestTables) -> DataFrame:
    """Records with text times, some of them absent or unreadable, and lost ids."""
    hours = "response_time_hours"
    time = "date_format(timestamp, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    return changed(
        tm.activity_records(t),
        {
            "id": f"IF(type = 'reply_received' AND {hours} > 300, '', id)",
            "timestamp": f"CASE WHEN {hours} > 250 THEN 'not a time' WHEN {hours} < 1 THEN NULL "
            f"WHEN type = 'follow_up_sent' THEN '' ELSE {time} END",
            "created_at": f"IF(type = 'follow_up_sent', {time}, NULL)",
        },
    )


@query
def activity_date_key(t):
    """A date key that stays NULL is given out as -1."""
    return facts.with_event_time(dirty_records(t)).selectExpr(
        "timestamp AS raw_time", "created_at", "type", "coalesce(date_key, -1) AS date_key",
        text_time("event_time"),
    )


def _resolved(t: tm.TestTables, records: DataFrame) -> DataFrame:
    leads = t.customer.filter("c_acctbal >= 0").selectExpr(
        "c_custkey AS lead_key", "CAST(c_custkey AS STRING) AS lead_id"
    )
    return facts.resolve_keys(
        facts.with_event_time(records),
        connected_accounts(t),
        tm.campaigns(t).filter("status <> 'Completed'"),
        leads,
    )


@query
def resolve_keys(t):
    """Keys that stay NULL are given out as -1."""
    return _resolved(t, tm.activity_records(t)).selectExpr(
        "id", "account_key", "coalesce(campaign_key, -1L) AS campaign_key",
        "coalesce(lead_key, -1L) AS lead_key",
    )


@query
def activity_projection(t):
    """Loose source values: NULL flags and a NULL type."""
    records = changed(
        tm.activity_records(t),
        {
            "accepted": "IF(accepted, true, NULL)",
            "type": "IF(type = 'follow_up_sent', NULL, type)",
        },
    )
    segment_key = pick("campaign_id", {s: k for k, s in enumerate(tm.SEGMENTS, 1)})
    ready = facts.with_event_time(records).selectExpr(
        "*",
        "CAST(agent_id AS BIGINT) + 1 AS account_key",
        f"CAST({segment_key} AS BIGINT) AS campaign_key",
        "CAST(lead_id AS BIGINT) AS lead_key",
    )
    return with_text_times(
        facts.to_fact_activity(ready, tm.SOURCE_SYSTEM), "activity_timestamp"
    )


@query
def fact_idempotent_load(t):
    """Half is loaded; the batch brings everything twice with other values."""
    fact = tm.activity(t).select(
        "activity_id", "date_key", "account_key", "activity_type", "is_converted",
        "response_time_hours",
    )
    target = fact.filter(f"date_key < {WATERMARK:%Y%m%d}")
    later = changed(fact, {"response_time_hours": "coalesce(response_time_hours, 0D) + 1D"})
    batch = later.selectExpr("*", "1 AS arrival").unionByName(
        fact.selectExpr("*", "2 AS arrival")
    )
    return target.unionByName(
        facts.insert_facts(target, batch, ["activity_id"], "arrival").drop("arrival")
    )


def _checked(t: tm.TestTables) -> DataFrame:
    return facts.checked(_resolved(t, dirty_records(t)), facts.load_rules())


@query
def reject_split(t):
    accepted, rejected = facts.split_valid(_resolved(t, dirty_records(t)), facts.load_rules())
    accepted = accepted.selectExpr("*", "CAST(NULL AS STRING) AS error_message")
    return accepted.unionByName(rejected).select(
        "lead_id", "type", "response_time_hours", "error_message"
    )


PAYLOAD = ["id", "timestamp", "created_at", "agent_id", "campaign_id", "lead_id", "type",
           "accepted", "replied", "converted", "response_time_hours"]


def _dead_letters(t: tm.TestTables) -> DataFrame:
    """Rejects of records without an account, failed at their own time."""
    records = changed(
        tm.activity_records(t),
        {
            "timestamp": "date_format(timestamp, 'yyyy-MM-dd HH:mm:ss.SSSSSS')",
            "created_at": "CAST(NULL AS STRING)",
        },
    )
    _, rejected = facts.split_valid(_resolved(t, records), facts.load_rules())
    run = f"IF(event_time < {EARLY}, 'run-1', 'run-2')"
    return facts.to_dead_letter(rejected, PAYLOAD, run, "load", "event_time")


@query
def dead_letter_rows(t):
    return with_text_times(_dead_letters(t), "failed_at", "retried_at")


def _half_retried(t: tm.TestTables) -> DataFrame:
    letters = _dead_letters(t)
    ids = letters.filter("record_payload LIKE '%invite_sent%'").select("dlq_id")
    return facts.mark_retried(letters, ids, STAMP)


@query
def dead_letter_mark_retried(t):
    return _half_retried(t).selectExpr("dlq_id", "retried", text_time("retried_at"))


@query
def dead_letter_unretried(t):
    return facts.unretried(_half_retried(t)).selectExpr(
        "dlq_id", "run_id", "record_payload", "error_type", "error_message",
        text_time("failed_at"),
    )


@query
def dead_letter_counts(t):
    return facts.dead_letter_counts(_dead_letters(t))


@query
def load_counts(t):
    return ops.load_counts(_checked(t))


@query
def daily_snapshot(t):
    return tm.daily(t)


@query
def daily_snapshot_dense(t):
    return facts.daily_snapshot(tm.activity(t), tm.accounts(t), dense=True)


# Incremental


@query
def watermark_advance(t):
    """Rejected records do not move the watermark; the other entity keeps its own."""
    seen = t.events.filter(f"ts < {EARLY}").selectExpr("max(ts) AS ts")
    state = (
        seen.selectExpr("'outreach_activity' AS entity_name", "ts")
        .unionByName(t.orders.selectExpr("'leads' AS entity_name", "max(o_orderdate) AS ts"))
        .selectExpr(
            "entity_name", "CAST(ts AS TIMESTAMP) AS last_watermark",
            f"TIMESTAMP '{AS_OF}' AS updated_at",
        )
    )
    records = tm.activity_records(t).filter(F.col("timestamp") > seen.scalar())
    accepted, _ = facts.split_valid(_resolved(t, records), facts.load_rules())
    row = increment.advance(state, accepted, "outreach_activity", "event_time", STAMP)
    return with_text_times(
        increment.put_watermark(state, row), "last_watermark", "updated_at"
    )


@query
def incremental_equals_full(t):
    """Two loads, the second overlapping the first by five days."""
    records = facts.with_event_time(tm.activity_records(t))

    def loaded(part: DataFrame) -> DataFrame:
        resolved = facts.resolve_keys(part, connected_accounts(t), tm.campaigns(t), tm.leads(t))
        ok, _ = facts.split_valid(resolved, facts.load_rules())
        return facts.to_fact_activity(ok, tm.SOURCE_SYSTEM)

    first = loaded(records.filter(f"event_time < {EARLY}"))
    overlap = WATERMARK - dt.timedelta(days=5)
    again = loaded(increment.scan_since(records, "event_time", overlap))
    fact = facts.insert_new(first, again, ["activity_id"], "activity_timestamp")
    return with_text_times(fact, "activity_timestamp")


@query
def snapshot_refresh(t):
    """The snapshot of half the facts, refreshed with the rest."""
    fact, accounts = tm.activity(t), tm.accounts(t)
    noon = f"TIMESTAMP_NTZ '{WATERMARK + dt.timedelta(hours=12)}'"
    old = facts.daily_snapshot(fact.filter(f"activity_timestamp < {noon}"), accounts)
    return facts.snapshot_refresh(
        old, fact, fact.filter(f"activity_timestamp >= {noon}"), accounts
    )


@query
def stream_ingest(t):
    return with_text_times(
        ingest.replay(t.spark, t.sf_dir, tm.event_stream), "activity_timestamp"
    )


@query
def stream_daily_counts(t):
    return daily_counts.replay(t.spark, t.sf_dir)


# KPIs


@query
def core_kpis(t):
    return kpis.core_kpis(tm.activity(t), dims.dim_date_covering(t.events, "ts"))


@query
def core_kpis_range(t):
    calendar = dims.dim_date_covering(t.events, "ts")
    return kpis.core_kpis(
        tm.activity(t), calendar, dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    )


@query
def account_health(t):
    return rounded(
        kpis.account_health(tm.accounts(t), scored(t)),
        "avg_invite_utilization", "avg_message_utilization", "avg_acceptance_rate",
        "avg_reply_rate", "avg_anomaly_score",
    )


@query
def campaign_performance(t):
    return kpis.campaign_performance(tm.campaigns(t), tm.activity(t))


# BI measures


def _rates(df: DataFrame) -> DataFrame:
    return rounded(df, "acceptance_rate", "reply_rate", "conversion_rate", "avg_response_time")


@query
def measures_by_day(t):
    return _rates(measures.activity_measures(tm.activity(t), ["date_key"]))


@query
def measures_by_account(t):
    return _rates(measures.activity_measures(tm.activity(t), ["account_key"]))


@query
def agent_status_counts(t):
    return measures.agent_status_counts(tm.accounts(t))


@query
def utilization_by_account(t):
    return rounded(
        measures.utilization(tm.daily(t), ["account_key"]),
        "avg_invite_utilization", "avg_message_utilization",
    )


@query
def invite_throughput(t):
    return rounded(
        measures.invite_throughput(tm.daily(t), tm.accounts(t), ["date_key"]),
        "invite_throughput",
    )


def account_versions(t: tm.TestTables) -> DataFrame:
    """Accounts whose tier changes on January 10 and, for odd nations, again on January 20."""
    steps = t.nation.selectExpr(
        "*", "explode(filter(array(0, 1, 2), s -> s < 2 OR n_nationkey % 2 = 1)) AS step"
    ).selectExpr(
        "*", "DATE '2023-12-01' + CASE step WHEN 0 THEN 0 WHEN 1 THEN 40 ELSE 50 END AS start",
        f"{pick('(n_regionkey + step) % 5', dict(enumerate(C.TIERS)))} AS account_age_tier",
    )
    return dims.with_tier_limits(steps).selectExpr(
        "CAST(n_nationkey + 1 + 100 * step AS BIGINT) AS account_key",
        "CAST(n_nationkey AS STRING) AS account_id",
        "account_age_tier", "daily_invite_limit", "daily_message_limit",
        "CAST(start AS TIMESTAMP) AS effective_from",
        "CAST(step = 1 + n_nationkey % 2 AS INT) AS is_current",
    )


@query
def invite_throughput_versions(t):
    """Facts of nations divisible by three keep their first version's key; the others have that of the day."""
    day = "to_date(CAST(date_key AS STRING), 'yyyyMMdd')"
    step = (
        f"CASE WHEN (account_key - 1) % 3 = 0 OR {day} < DATE '2024-01-10' THEN 0 "
        f"WHEN (account_key - 1) % 2 = 1 AND {day} >= DATE '2024-01-20' THEN 2 ELSE 1 END"
    )
    fact = changed(tm.activity(t), {"account_key": f"account_key + 100 * ({step})"})
    versions = account_versions(t)
    daily = facts.daily_snapshot(fact, versions)
    return rounded(measures.invite_throughput(daily, versions, ["date_key"]), "invite_throughput")


@query
def risk_measures(t):
    return rounded(measures.risk_measures(scored(t), []), "avg_anomaly_score")


@query
def campaign_measures(t):
    return rounded(
        measures.campaign_measures(tm.activity(t), tm.campaigns(t), ["campaign_name"]),
        "acceptance_rate", "reply_rate", "conversion_rate",
    )


@query
def campaign_measures_sliced(t):
    return rounded(
        measures.campaign_measures(
            tm.activity(t).filter("date_key BETWEEN 20240108 AND 20240121"),
            tm.campaigns(t),
            ["target_segment", "status"],
            "status IN ('Active', 'Paused')",
        ),
        "acceptance_rate", "reply_rate", "conversion_rate",
    )


@query
def best_campaign(t):
    per_campaign = measures.campaign_measures(
        tm.activity(t), tm.campaigns(t), ["campaign_name"]
    )
    return rounded(
        measures.best_campaign(per_campaign).select("campaign_name", "conversion_rate"),
        "conversion_rate",
    )


@query
def rolling_7d(t):
    return rounded(
        measures.rolling_7d(tm.activity(t), ["account_key"]), "acceptance_rate_7d"
    )


@query
def wow_change(t):
    return rounded(measures.wow_change(tm.activity(t), ["account_key"]), "wow_change")


# Dashboard data sets


@query
def daily_trend(t):
    return rounded(views.daily_trend(tm.activity(t)), "acceptance_rate")


@query
def last_days(t):
    return _rates(views.last_days(tm.activity(t)))


@query
def activity_breakdown(t):
    return views.activity_breakdown(tm.activity(t))


@query
def utilization_bands(t):
    return rounded(views.utilization_bands(tm.daily(t)), "avg_invite_utilization")


@query
def anomaly_grid(t):
    return views.anomaly_grid(scored(t))


@query
def funnel(t):
    return rounded(views.funnel(tm.activity(t)), "of_previous", "of_first")


@query
def campaign_share(t):
    per_campaign = measures.campaign_measures(
        tm.activity(t), tm.campaigns(t), ["campaign_name"]
    )
    return rounded(views.campaign_share(per_campaign), "activity_share")


@query
def campaign_rank_exact(t):
    """Parts as campaigns: their rates differ in the fifth digit and beyond."""
    rates = t.lineitem.groupBy("l_partkey").agg(
        F.expr("CAST(l_partkey AS STRING) AS campaign_name"),
        F.expr("count(*) AS activities"),
        F.expr("CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / (count(*) * 53D) AS conversion_rate"),
    )
    return rounded(views.campaign_share(rates), "activity_share")


@query
def account_trend(t):
    return views.account_trend(scored(t))


# Anomaly scores and trends


@query
def anomaly_scores(t):
    return scored(t)


@query
def anomaly_scores_by_account(t):
    return anomaly.anomaly_scores(tm.daily(t), partition_by=["account_key"])


@query
def modified_z(t):
    """Pooled over all order prices."""
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return changed(
        anomaly.with_modified_z(rows, "o_totalprice", out="z"), {"z": "round(z, 4)"}
    )


@query
def modified_z_narrow_band(t):
    """Pooled over order keys as seconds far from zero: one logarithmic range holds them all."""
    rows = t.orders.selectExpr("o_orderkey", "1.7e9D + o_orderkey AS at")
    return changed(anomaly.with_modified_z(rows, "at", out="z"), {"z": "round(z, 4)"})


@query
def modified_z_by_priority(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    scores = anomaly.with_modified_z(rows, "o_totalprice", ["o_orderpriority"], out="z")
    return changed(scores, {"z": "round(z, 4)"})


@query
def iqr_flags(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return anomaly.with_iqr_flag(rows, "l_extendedprice", out="is_outlier")


@query
def iqr_flags_by_flag(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice"
    )
    return anomaly.with_iqr_flag(
        rows, "l_extendedprice", 1.0, ["l_returnflag"], out="is_outlier"
    )


@query
def ghost_rate(t):
    return rounded(
        anomaly.with_ghost_rate(tm.daily(t)).select(
            "date_key", "account_key", "invites_accepted", "replies_received", "ghost_rate"
        ),
        "ghost_rate",
    )


@query
def anomaly_summary(t):
    return anomaly.anomaly_summary(scored(t))


@query
def acceptance_collapse(t):
    return trends.acceptance_collapse(tm.daily(t), ["account_key"]).select(
        "account_key", "date_key", "acceptance_rate", "acceptance_collapse"
    )


@query
def reply_decay(t):
    return trends.reply_decay(tm.daily(t), ["account_key"]).select(
        "account_key", "date_key", "reply_rate", "reply_trend_slope", "reply_decay"
    )


@query
def reply_decay_revenue(t):
    """The same regression over daily revenue per supplier."""
    per_day = t.lineitem.groupBy(
        "l_suppkey", F.expr(date_key("l_shipdate")).alias("date_key")
    ).agg(F.expr("CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue"))
    return changed(
        trends.reply_decay(per_day, ["l_suppkey"], rate="revenue"),
        {"reply_trend_slope": "round(reply_trend_slope, 4)"},
    )


@query
def utilization_spikes(t):
    return trends.utilization_spikes(tm.daily(t)).select(
        "account_key", "date_key", "invite_utilization", "message_utilization"
    )


# Risk


def risk_grid(t: tm.TestTables) -> DataFrame:
    """Customers with derived signals that reach every branch of the rules."""
    return t.customer.join(_nation_tiers(t), "c_nationkey").selectExpr(
        "c_custkey",
        "tier AS account_age_tier",
        "(c_custkey % 45) / 10D AS recent_anomaly_score",
        "(c_custkey % 31) / 100D AS avg_acceptance_rate",
        "(c_custkey % 13) / 100D AS avg_reply_rate",
        "c_custkey % 20 AS days_of_data",
        "(c_custkey % 11) / 10D AS utilization",
    )


@query
def risk_classify(t):
    level = risk.risk_level(
        "recent_anomaly_score", "avg_acceptance_rate", "avg_reply_rate", "utilization"
    )
    return risk_grid(t).selectExpr("c_custkey", f"{level} AS risk_level")


@query
def capacity_limits(t):
    return risk.with_capacity(risk_grid(t)).drop(
        "reasoning", "utilization", "recent_anomaly_score", "avg_acceptance_rate",
        "avg_reply_rate",
    )


@query
def capacity_reasoning(t):
    """The sentence that explains each recommendation."""
    return risk.with_capacity(risk_grid(t)).select("c_custkey", "risk_level", "reasoning")


@query
def risk_report(t):
    return risk.risk_report(tm.accounts(t), scored(t)).drop("reasoning")


@query
def risk_table(t):
    return views.risk_table(risk.risk_report(tm.accounts(t), scored(t)))


# Data quality


@query
def dq_rules_on_one_column(t):
    """Two ranges and two sets on one column each, with quotes and percent signs."""
    return quality.scan_checks(
        t.orders.withColumnRenamed("o_orderpriority", "o total"),
        "orders",
        in_set=[("o total", ["1-URGENT", "O'Brien", "50%"]), ("o total", ["2-HIGH", "3-MEDIUM"])],
        in_range=[("o_totalprice", 0.0, 1000.0), ("o_totalprice", 0.0, 100000.0)],
    )


@query
def source_flag_forms(t):
    """Flags as sources write them: numbers, words, nothing."""
    forms = "element_at(array('1', 'true', 'yes', '0', 'false', '', 'No', NULL, 'TRUE', '0.0'), CAST(event_id % 10 AS INT) + 1)"
    return t.events.selectExpr("event_id", f"{forms} AS form").selectExpr(
        "event_id", f"{flag(truthy('form'))} AS is_set"
    )


@query
def dq_completeness(t):
    fact = quality.check_completeness(
        tm.activity(t), "fact_activity", ["activity_id", "response_time_hours"]
    )
    return fact.unionByName(
        quality.check_completeness(t.documents, "documents", ["doc_id", "text", "lang"])
    )


@query
def dq_uniqueness(t):
    return quality.check_uniqueness(t.documents, "documents", "text").unionByName(
        quality.check_uniqueness(tm.activity(t), "fact_activity", "response_time_hours")
    )


@query
def dq_validity_set(t):
    return quality.check_in_set(
        t.documents, "documents", "lang", ["en", "de"]
    ).unionByName(
        quality.check_in_set(
            tm.activity(t), "fact_activity", "activity_type", ["invite_sent", "message_sent"]
        )
    )


@query
def dq_validity_range(t):
    rates = ("acceptance_rate", "reply_rate", "conversion_rate")
    return quality.check_range(tm.daily(t), "fact_daily", [(r, 0.0, 1.0) for r in rates])


@query
def dq_timeliness(t):
    return quality.check_timeliness(
        tm.activity(t), "fact_activity", "activity_timestamp", AS_OF + dt.timedelta(days=3)
    )


@query
def dq_referential(t):
    return quality.check_fk(
        t.documents, "documents", "doc_id", t.labels, "doc_id"
    ).unionByName(quality.check_fk(t.orders, "orders", "o_custkey", t.customer, "c_custkey"))


def mart_checks(t: tm.TestTables) -> DataFrame:
    tables = {
        "fact_activity": tm.activity(t),
        "dim_account": tm.accounts(t),
        "dim_campaign": tm.campaigns(t),
        "dim_lead": tm.leads(t),
        "fact_daily": tm.daily(t),
        "dim_date": dims.dim_date_covering(t.events, "ts"),
    }
    return quality.run_checks(tables, quality.MART_RULES, AS_OF)


@query
def dq_all_checks(t):
    return rounded(mart_checks(t), "score")


@query
def dq_composite(t):
    return quality.composite(mart_checks(t))


@query
def dq_history_row(t):
    return with_text_times(
        quality.dq_history_row(mart_checks(t), RUN, STAMP), "check_timestamp"
    )


@query
def dq_grades(t):
    return quality.dq_grades(mart_checks(t)).select("check_name", "grade")


def daily_scores(t: tm.TestTables) -> DataFrame:
    """A score history from the data: one check per day, the share of snapshot
    rates in range."""
    ok = "CAST(acceptance_rate BETWEEN 0 AND 1 AS INT) + CAST(reply_rate BETWEEN 0 AND 1 AS INT)"
    return (
        tm.daily(t)
        .groupBy("date_key")
        .agg(F.expr(f"round(sum({ok}) / (2D * count(*)), 4) AS composite_dq_score"))
        .selectExpr(
            "to_timestamp(CAST(date_key AS STRING), 'yyyyMMdd') AS check_timestamp",
            "composite_dq_score",
        )
    )


@query
def dq_latest(t):
    return changed(
        measures.dq_latest(daily_scores(t)), {"check_day": "CAST(check_day AS STRING)"}
    )


# Tables of the mart, written and read back


def scratch_mart(t: tm.TestTables, purpose: str) -> MartTables:
    return MartTables(t.spark, work_folder(t.spark, purpose))


def _stored(fact: DataFrame) -> DataFrame:
    return fact.selectExpr("*", "CAST(NULL AS BIGINT) AS template_key", "CAST(NULL AS TIMESTAMP) AS loaded_at")


FACT_COLUMNS = ["activity_id", "date_key", "account_key", "activity_type", "is_converted"]


@query
def mart_append(t):
    """A version with the facts up to the watermark, and the later ones appended to it."""
    mart, fact = scratch_mart(t, "append"), _stored(tm.activity(t))
    mart.publish("fact_activity", fact.filter(f"activity_timestamp < {EARLY}"))
    mart.append("fact_activity", fact.filter(f"activity_timestamp >= {EARLY}"))
    return mart.read("fact_activity").select(*FACT_COLUMNS)


@query
def key_index_load(t):
    """Three loads through the key index: half, a replay of all, and a load after one that died before its keys were added."""
    mart, fact = scratch_mart(t, "indexed"), _stored(tm.activity(t))
    index = KeyIndex(t.spark, f"{mart.root}/key_index", "activity_id", buckets=64)
    mart.publish("fact_activity", fact.filter("lead_key % 2 = 0"))
    index.repair(mart.read("fact_activity"))
    for part, dies in (("lead_key % 4 = 1", False), ("lead_key % 8 < 4", True), ("true", False)):
        index.repair(mart.read("fact_activity"))
        load = index.open()
        rows = index.absent(fact.filter(part))
        folder = work_folder(t.spark, "rows")
        rows.write.parquet(folder)
        rows = t.spark.read.schema(rows.schema).parquet(folder)
        mart.append("fact_activity", rows)
        if not dies:
            index.add(rows)
            index.close(load)
    return mart.read("fact_activity").select(*FACT_COLUMNS)


@query
def scores_written_back(t):
    """The scored snapshot as a table of the mart."""
    mart = scratch_mart(t, "scores")
    mart.publish("fact_daily", scored(t))
    return mart.read("fact_daily").select("date_key", "account_key", "anomaly_score", "risk_flag")


@query
def scores_by_day_loads(t):
    """The snapshot loaded in three parts of its days, one of them twice; scores by the merged values of all days."""
    mart, daily = scratch_mart(t, "days"), tm.daily(t)
    mart.init(["fact_daily", "metric_days", "score_stats"])
    folder = work_folder(t.spark, "daily")
    daily.write.parquet(folder)
    daily = t.spark.read.schema(daily.schema).parquet(folder)
    for part in (0, 1, 0, 2):
        mart.put_days(daily.filter(f"date_key % 3 = {part}"))
    return mart.read("fact_daily").select("date_key", "account_key", "anomaly_score", "risk_flag")


@query
def csv_export(t):
    """The snapshot exported as CSV and read again."""
    mart = scratch_mart(t, "export")
    mart.publish("fact_daily", tm.daily(t))
    mart.export_csv(f"{mart.root}/csv", ["fact_daily"])
    schema = TABLES["fact_daily"]
    found = t.spark.read.schema(schema).option("header", True).csv(f"{mart.root}/csv/fact_daily")
    return found.drop("anomaly_score", "risk_flag")


@query
def alert_sink(t):
    """Alerts appended as lines of JSON in two writes and read again."""
    folder = work_folder(t.spark, "alerts")
    history = quality.dq_history_row(mart_checks(t), RUN, STAMP, threshold=0.99)
    raised = with_text_times(ops.alerts(history, daily_runs(t), grid_report(t), STAMP), "raised_at")
    write_alerts(raised.filter("alert_type = 'pipeline_failure'"), folder)
    write_alerts(raised.filter("alert_type <> 'pipeline_failure'"), folder)
    return t.spark.read.schema(raised.schema).json(folder)


@query
def dim_template_load(t):
    """Parts as message templates: every third is known, and all of the smaller ones come again with other names."""
    records = t.part.selectExpr(
        "CAST(p_partkey AS STRING) AS id", "p_name AS name", "p_type AS body",
        "IF(p_size % 5 = 0, NULL, p_brand) AS type", "p_partkey", "p_size",
    )
    known = dims.assign_keys(dims.to_dim_template(records.filter("p_partkey % 3 = 0")), "template_id", "template_key")
    again = changed(records, {"name": "concat('new ', name)"}).filter("p_size <= 25")
    updates = dims.to_dim_template(again.unionByName(records.filter("p_size > 25 AND p_partkey % 3 <> 0")))
    return dims.scd1_merge(known, updates, "template_id", "1", "template_key")


# Run log and alerts


def daily_runs(t: tm.TestTables) -> DataFrame:
    """A run log from the data: one run per day of events, failed on days with
    more errors than views."""
    return (
        t.events.groupBy(F.expr("to_date(ts) AS day"))
        .agg(
            F.expr("CAST(min(ts) AS TIMESTAMP) AS started_at"),
            F.expr("CAST(max(ts) AS TIMESTAMP) AS ended_at"),
            F.expr("count_if(event_type = 'error') AS errors"),
            F.expr("count_if(event_type = 'view') AS views"),
        )
        .selectExpr(
            "concat('run-', CAST(day AS STRING)) AS run_id",
            "started_at",
            "ended_at",
            "IF(errors > views, 'failed', 'success') AS status",
            "concat(errors, ' errors') AS error_message",
        )
    )


@query
def run_log_row(t):
    """The log row of a run that loaded the checked records."""
    counts = ops.load_counts(_checked(t)).first().asDict()
    row = ops.run_row(
        t.spark, run_id=RUN, correlation_id="load-1", run_type="full", status="success",
        started_at=AS_OF, ended_at=AS_OF + dt.timedelta(minutes=5), watermark_value=WATERMARK, **counts,
    )
    return with_text_times(row, "started_at", "ended_at", "watermark_value")


@query
def run_log(t):
    return with_text_times(daily_runs(t), "started_at", "ended_at")


def grid_report(t: tm.TestTables) -> DataFrame:
    return risk.with_capacity(risk_grid(t)).selectExpr(
        "CAST(c_custkey AS STRING) AS account_id", "CAST(NULL AS STRING) AS account_name",
        "risk_level",
    )


@query
def alerts(t):
    history = quality.dq_history_row(mart_checks(t), RUN, STAMP, threshold=0.99)
    raised = ops.alerts(history, daily_runs(t), grid_report(t), STAMP)
    return with_text_times(raised, "raised_at")


@query
def critical_accounts(t):
    return with_text_times(ops.critical_accounts(grid_report(t), STAMP), "raised_at")
