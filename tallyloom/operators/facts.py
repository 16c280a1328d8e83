"""Activity fact: event time, key resolution, rejection, dedupe, dead letters,
and the daily account snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tallyloom.functions.columns import date_key, exprs, flag, key_to_date, lit, rate, truthy
from tallyloom.operators.measures import TYPE_COUNTS


def with_event_time(records: DataFrame) -> DataFrame:
    """Add `event_time` and `date_key` from `timestamp`, else `created_at`.

    Text times are parsed; the date key is the calendar day as written, so an
    offset does not move it.  Both are NULL where no time can be read.
    """
    if isinstance(records.schema["timestamp"].dataType, T.StringType):
        raw = "coalesce(nullif(timestamp, ''), nullif(created_at, ''))"
        time = f"try_to_timestamp({raw})"
        day = f"try_to_date(substring({raw}, 1, 10), 'yyyy-MM-dd')"
    else:
        time = day = "coalesce(timestamp, created_at)"
    return records.selectExpr("*", f"{time} AS event_time", f"{date_key(day)} AS date_key")


def resolve_keys(
    records: DataFrame, accounts: DataFrame, campaigns: DataFrame, leads: DataFrame
) -> DataFrame:
    """Add `account_key` (0 if unresolved), `campaign_key` and `lead_key`.

    Left joins on the natural ids against the current account versions and the
    two overwrite dimensions.  None is hinted: the optimizer broadcasts a
    dimension when its measured size allows, and splits a hot id otherwise.
    """
    current = accounts.filter("is_current = 1").selectExpr("account_id AS agent_id", "account_key")
    return (
        records.join(current, "agent_id", "left")
        .join(campaigns.select("campaign_id", "campaign_key"), "campaign_id", "left")
        .join(leads.select("lead_id", "lead_key"), "lead_id", "left")
        .fillna(0, ["account_key"])
    )


def load_rules(calendar: tuple[int, int] | None = None) -> list[tuple[str, str]]:
    """Rejection rules (condition, message) of the activity load, in order.

    `calendar` gives the first and last date key of the date dimension; it is
    gapless, so membership is a range test.
    """
    rules = [
        ("event_time IS NULL OR date_key IS NULL", "missing or unreadable time"),
        ("coalesce(id, '') = ''", "missing id"),
        ("account_key = 0", "unknown account"),
    ]
    if calendar is not None:
        first, last = calendar
        rules.append(
            (f"NOT date_key BETWEEN {first} AND {last}", "date outside the calendar")
        )
    return rules


def checked(records: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Add `error_message`: the first failed rule of a record, else NULL."""
    arms = " ".join(f"WHEN {cond} THEN {lit(text)}" for cond, text in rules)
    return records.selectExpr("*", f"CASE {arms} END AS error_message")


def split_valid(records: DataFrame, rules: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); a rejected row carries its first failed rule."""
    both = checked(records, rules)
    return (
        both.filter("error_message IS NULL").drop("error_message"),
        both.filter("error_message IS NOT NULL"),
    )


def to_fact_activity(records: DataFrame, source_system: str) -> DataFrame:
    """Project resolved records onto the fact columns."""
    return records.selectExpr(
        "id AS activity_id",
        "date_key",
        "account_key",
        "campaign_key",
        "lead_key",
        "coalesce(type, 'unknown') AS activity_type",
        "event_time AS activity_timestamp",
        f"{flag(truthy('accepted'))} AS is_accepted",
        f"{flag(truthy('replied'))} AS is_replied",
        f"{flag(truthy('converted'))} AS is_converted",
        "response_time_hours",
        f"{lit(source_system)} AS source_system",
    )


def _pick_per_key(rows: DataFrame, keys: list[str], order: str, function: str) -> DataFrame:
    """Rows that agree in `order` are told apart by their values, so the choice
    does not depend on the order in which tasks finish."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.expr(f"{function}(struct({order} AS _order, {', '.join(rest)})) AS _best")
    return rows.groupBy(*keys).agg(best).selectExpr(
        *[c if c in keys else f"_best.{c}" for c in rows.columns]
    )


def first_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row that comes first by `order` for each key.

    An aggregate rather than a window: copies of a hot key are reduced on the
    map side and never meet in one task.
    """
    return _pick_per_key(rows, keys, order, "min")


def last_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row that comes last by `order` for each key."""
    return _pick_per_key(rows, keys, order, "max")


def absent_from(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (unique by `keys`) whose key is not in `target`.

    The target is narrowed to the keys of the batch first, with the batch as
    the build side: a small batch is broadcast into one scan of the target's
    key columns, so the large side is not shuffled.
    """
    present = target.select(*keys).join(rows.select(*keys), keys, "left_semi")
    return rows.join(present, keys, "left_anti")


def insert_facts(target: DataFrame, batch: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """Rows to append: the first arrival of every key not yet loaded."""
    return absent_from(first_per_key(batch, keys, arrival), target, keys)


def insert_new(target: DataFrame, rows: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """The target with the rows of absent keys added."""
    return target.unionByName(insert_facts(target, rows, keys, arrival))


def replace_by_key(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The target with every row replaced whose key occurs in `rows`."""
    return target.join(rows.select(*keys), keys, "left_anti").unionByName(rows)


# Dead letters

# The line of a record as it was written, where the record's own columns don't hold all of it.
RAW = "raw_record"


def to_dead_letter(
    rejected: DataFrame, payload: list[str], run_id: str, error_type: str, failed_at: str
) -> DataFrame:
    """Dead-letter rows for rejected records; `run_id` and `failed_at` are expressions.

    `payload` names the record's own columns; a line kept in `raw_record` is the
    payload as it was written.  The id is a digest of type, message and payload, so the
    same rejected record has the same id in every run.
    """
    text = f"to_json(struct({', '.join(payload)}), map('ignoreNullFields', 'false'))"
    if RAW in rejected.columns:
        text = f"coalesce({RAW}, {text})"
    return rejected.selectExpr(
        "error_message",
        f"{run_id} AS run_id",
        f"{failed_at} AS failed_at",
        f"{text} AS record_payload",
    ).selectExpr(
        f"sha2(concat_ws('|', {lit(error_type)}, error_message, record_payload), 256) AS dlq_id",
        "run_id",
        "record_payload",
        f"{lit(error_type)} AS error_type",
        "error_message",
        "failed_at",
        "0 AS retried",
        "CAST(NULL AS TIMESTAMP) AS retried_at",
    )


def insert_letters(known: DataFrame, letters: DataFrame) -> DataFrame:
    """Rows to append: the first letter of every id that isn't known."""
    return insert_facts(known, letters, ["dlq_id"], "failed_at")


def unretried(dead_letters: DataFrame, limit: int = 100) -> DataFrame:
    """Newest dead letters that were not retried."""
    return (
        dead_letters.filter("retried = 0")
        .orderBy(F.desc("failed_at"), F.desc("dlq_id"))
        .limit(limit)
    )


def mark_retried(dead_letters: DataFrame, ids: DataFrame, at: str) -> DataFrame:
    """Set `retried` and `retried_at` (expression `at`) on the rows named in `ids`."""
    done = ids.select("dlq_id").distinct().selectExpr("dlq_id", "true AS _done")
    changed = {"retried": "IF(_done, 1, retried)", "retried_at": f"IF(_done, {at}, retried_at)"}
    return dead_letters.join(done, "dlq_id", "left").selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in dead_letters.columns]
    )


def dead_letter_counts(dead_letters: DataFrame) -> DataFrame:
    return dead_letters.groupBy("run_id").agg(F.expr("count(*) AS dead_letters"))


# Daily snapshot


def snapshot_rates(counts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add rates and utilizations to daily counts; an account without a
    dimension row has utilization 0."""
    limits = accounts.select("account_key", "daily_invite_limit", "daily_message_limit")
    rates = {
        "acceptance_rate": rate("invites_accepted", "invites_sent"),
        "reply_rate": rate("replies_received", "messages_sent"),
        "conversion_rate": rate("conversions", "invites_sent + messages_sent"),
        "invite_utilization": rate("invites_sent", "daily_invite_limit"),
        "message_utilization": rate("messages_sent", "daily_message_limit"),
    }
    return counts.join(limits, "account_key", "left").selectExpr(
        "date_key", "account_key", *TYPE_COUNTS, *[f"{text} AS {c}" for c, text in rates.items()]
    )


def daily_snapshot(fact: DataFrame, accounts: DataFrame, dense: bool = False) -> DataFrame:
    """One row per account and active day.

    Facts are reduced to (day, account) before the limits are joined.  With
    `dense`, every account seen gets a row, zeros included, for every day
    between its own first and last active day.
    """
    counts = fact.groupBy("date_key", "account_key").agg(*exprs(TYPE_COUNTS))
    if dense:
        day = key_to_date("date_key")
        days = (
            counts.groupBy("account_key")
            .agg(F.expr(f"min({day}) AS a"), F.expr(f"max({day}) AS b"))
            .selectExpr("account_key", "explode(sequence(a, b)) AS day")
            .selectExpr("account_key", f"{date_key('day')} AS date_key")
        )
        counts = days.join(counts, ["date_key", "account_key"], "left").fillna(0)
    return snapshot_rates(counts, accounts)


def touched_days(batch: DataFrame) -> DataFrame:
    """The dates of a batch.  The calendar bounds their number, so they are
    broadcast, and the fact is not shuffled."""
    return F.broadcast(batch.select("date_key").distinct())


def refresh_days(fact: DataFrame, batch: DataFrame, accounts: DataFrame) -> DataFrame:
    """The snapshot rows of the days a batch touches, recomputed from the fact."""
    return daily_snapshot(fact.join(touched_days(batch), "date_key", "left_semi"), accounts)


def snapshot_refresh(
    daily: DataFrame, fact: DataFrame, batch: DataFrame, accounts: DataFrame
) -> DataFrame:
    """The whole snapshot after a batch: untouched days kept, the others redone."""
    fresh = refresh_days(fact, batch, accounts)
    kept = daily.select(*fresh.columns).join(touched_days(batch), "date_key", "left_anti")
    return kept.unionByName(fresh)
