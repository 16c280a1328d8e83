"""The mart objects derived from the test tables.

`nation` plays the accounts, customer segments the campaigns, `customer` the
leads, and `events` joined with `customer` the activity records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyloom import constants as C
from tallyloom.functions.columns import date_key, flag, lit, pick, tier_value
from tallyloom.operators import facts

# Fixed values of the mapping.
EVENT_TYPES = {
    "view": C.INVITE_SENT,
    "click": C.INVITE_ACCEPTED,
    "signup": C.MESSAGE_SENT,
    "purchase": C.REPLY_RECEIVED,
    "error": C.FOLLOW_UP_SENT,
}
SEGMENTS = {
    "AUTOMOBILE": "Active",
    "BUILDING": "Active",
    "FURNITURE": "Active",
    "HOUSEHOLD": "Paused",
    "MACHINERY": "Completed",
}
SOURCE_SYSTEM = "outreach_api"


class TestTables:
    """Lazy access to the parquet tables of one scale factor.

    A table's schema is read from its files once per process.
    """

    __test__ = False
    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)


TIER = pick("n_regionkey", dict(enumerate(C.TIERS)))
CAMPAIGN_KEY = f"CAST({pick('c_mktsegment', {s: k for k, s in enumerate(SEGMENTS, 1)})} AS BIGINT)"
ACTIVITY_TYPE = pick("event_type", EVENT_TYPES)
HOURS = "IF(event_type IN ('click', 'purchase'), value, NULL)"
CONVERTED = "event_type = 'purchase' AND value > 100"


def accounts(t: TestTables) -> DataFrame:
    status = "n_nationkey % 10"
    return t.nation.selectExpr("*", f"{TIER} AS account_age_tier").selectExpr(
        "CAST(n_nationkey + 1 AS BIGINT) AS account_key",
        "CAST(n_nationkey AS STRING) AS account_id",
        "n_name AS account_name",
        "account_age_tier",
        f"{pick(status, {0: 'Paused', 1: 'Ghost', 2: 'Disconnected'}, 'Active')} AS agent_status",
        f"{tier_value('account_age_tier', 0)} AS risk_classification",
        f"{tier_value('account_age_tier', 1)} AS daily_invite_limit",
        f"{tier_value('account_age_tier', 2)} AS daily_message_limit",
        "1 AS is_current",
    )


def campaigns(t: TestTables) -> DataFrame:
    return (
        t.customer.select("c_mktsegment")
        .distinct()
        .selectExpr(
            f"{CAMPAIGN_KEY} AS campaign_key",
            "c_mktsegment AS campaign_id",
            "initcap(c_mktsegment) AS campaign_name",
            "c_mktsegment AS target_segment",
            f"{pick('c_mktsegment', SEGMENTS)} AS status",
        )
    )


def leads(t: TestTables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey AS lead_key", "CAST(c_custkey AS STRING) AS lead_id", "c_name AS full_name"
    )


def _owned_events(t: TestTables, events: DataFrame | None = None) -> DataFrame:
    owner = t.customer.selectExpr("c_custkey AS user_id", "c_nationkey", "c_mktsegment")
    return (t.events if events is None else events).join(owner, "user_id")


def activity_records(t: TestTables) -> DataFrame:
    """Raw activity records in the shape the loader reads."""
    return _owned_events(t).selectExpr(
        "CAST(event_id AS STRING) AS id",
        "ts AS timestamp",
        "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
        "CAST(c_nationkey AS STRING) AS agent_id",
        "c_mktsegment AS campaign_id",
        "CAST(user_id AS STRING) AS lead_id",
        f"{ACTIVITY_TYPE} AS type",
        "event_type = 'click' AS accepted",
        "event_type = 'purchase' AS replied",
        f"{CONVERTED} AS converted",
        f"{HOURS} AS response_time_hours",
    )


def activity(t: TestTables, events: DataFrame | None = None) -> DataFrame:
    """The loaded activity fact; `events` may be a stream or a batch of it."""
    clicked, bought = "event_type = 'click'", "event_type = 'purchase'"
    return _owned_events(t, events).selectExpr(
        "CAST(event_id AS STRING) AS activity_id",
        f"{date_key('ts')} AS date_key",
        "CAST(c_nationkey + 1 AS BIGINT) AS account_key",
        f"{CAMPAIGN_KEY} AS campaign_key",
        "user_id AS lead_key",
        f"{ACTIVITY_TYPE} AS activity_type",
        "ts AS activity_timestamp",
        f"{flag(clicked)} AS is_accepted",
        f"{flag(bought)} AS is_replied",
        f"{flag(CONVERTED)} AS is_converted",
        f"{HOURS} AS response_time_hours",
        f"{lit(SOURCE_SYSTEM)} AS source_system",
    )


def event_stream(spark: SparkSession, sf_dir: str):
    """(stream over the event table of a folder, its mapping to fact rows)."""
    t = TestTables(spark, sf_dir)
    # The table may be one file or a folder of part files; only a pattern may name either.
    stream = spark.readStream.schema(t.events.schema).parquet(f"{t.sf_dir}/[e]vents.parquet")
    return stream, lambda events: activity(t, events)


def daily(t: TestTables) -> DataFrame:
    """Daily account snapshot, not scored."""
    return facts.daily_snapshot(activity(t), accounts(t))
