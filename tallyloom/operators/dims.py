"""Dimensions: calendar, overwrite merge (SCD1), version history (SCD2),
surrogate keys and tier attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom import constants as C
from tallyloom.functions.columns import date_key, tier_value
from tallyloom.operators.asof import as_of
from tallyloom.operators.facts import absent_from, last_per_key


# Calendar


def _calendar(years: DataFrame) -> DataFrame:
    """All days of the given years."""
    d = "full_date"
    return years.selectExpr(
        "explode(sequence(make_date(year, 1, 1), make_date(year, 12, 31))) AS full_date"
    ).selectExpr(
        f"{date_key(d)} AS date_key",
        d,
        f"weekday({d}) AS day_of_week",
        f"date_format({d}, 'EEEE') AS day_name",
        f"day({d}) AS day_of_month",
        f"weekofyear({d}) AS week_of_year",
        f"month({d}) AS month_number",
        f"date_format({d}, 'MMMM') AS month_name",
        f"quarter({d}) AS quarter",
        f"year({d}) AS year",
        f"CAST(weekday({d}) >= 5 AS INT) AS is_weekend",
    )


def dim_date(spark: SparkSession, start_year: int = 2024, end_year: int = 2027) -> DataFrame:
    """One row per day of the given years."""
    return _calendar(spark.range(start_year, end_year + 1).selectExpr("CAST(id AS INT) AS year"))


def dim_date_covering(rows: DataFrame, time: str) -> DataFrame:
    """The calendar of all years from the first to the last time in `rows`."""
    bounds = rows.agg(F.expr(f"year(min({time})) AS a"), F.expr(f"year(max({time})) AS b"))
    return _calendar(bounds.selectExpr("explode(sequence(a, b)) AS year"))


# Surrogate keys


def assign_keys(
    new: DataFrame, natural_key: str, out: str, target: DataFrame | None = None
) -> DataFrame:
    """Add dense integer keys to rows of distinct natural keys.

    Keys continue after the largest key of `target`.  Rows are numbered inside
    4096 digest buckets and shifted by the bucket's offset, so no task orders
    more than one bucket; the numbering depends on the data only, and a
    recomputed task gives the same keys.
    """
    placed = new.selectExpr(
        "*", f"substring(md5(CAST({natural_key} AS STRING)), 1, 3) AS _bucket"
    )
    offsets = (
        placed.groupBy("_bucket")
        .agg(F.expr("count(*) AS _n"))
        .selectExpr("_bucket", "sum(_n) OVER (ORDER BY _bucket) - _n AS _offset")
    )
    start = F.lit(0) if target is None else F.coalesce(target.agg(F.max(out)).scalar(), F.lit(0))
    # The broadcast side has at most 4096 rows.
    return (
        placed.selectExpr(
            "*", f"row_number() OVER (PARTITION BY _bucket ORDER BY {natural_key}) AS _row"
        )
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (F.col("_row") + F.col("_offset") + start).cast("bigint"))
        .drop("_bucket", "_row", "_offset")
    )


# Overwrite merge


def scd1_merge(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    order: str,
    surrogate: str | None = None,
    at: str | None = None,
) -> DataFrame:
    """Overwrite matched rows, insert new ones; the last record of a key wins.

    Every column of `updates` that the target has is overwritten, also by
    NULL; the others, and the surrogate key, stay.  The expression `at` fills
    `updated_at` (and `created_at` of new rows) where the target has them.
    """
    supplied = [c for c in updates.columns if c in target.columns and c not in (key, surrogate)]
    latest = last_per_key(updates, [key], order)

    news = latest.selectExpr(key, f"struct({', '.join(supplied)}) AS _new")
    changed = {c: f"IF(_new IS NULL, {c}, _new.{c})" for c in supplied}
    audits = [c for c in ("created_at", "updated_at") if at and c in target.columns]
    if "updated_at" in audits:
        changed["updated_at"] = f"IF(_new IS NULL, updated_at, {at})"
    kept = target.join(news, key, "left").selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in target.columns]
    )

    added = absent_from(latest.select(key, *supplied), target, [key])
    if surrogate is not None:
        added = assign_keys(added, key, surrogate, target)
    if audits:
        added = added.selectExpr("*", *[f"{at} AS {c}" for c in audits if c not in supplied])
    return kept.unionByName(added, allowMissingColumns=True)


def to_dim_campaign(records: DataFrame, *extra: str) -> DataFrame:
    """Campaign records onto dimension columns, and `extra` ones."""
    return records.selectExpr(
        "id AS campaign_id",
        "coalesce(name, 'Unknown') AS campaign_name",
        "target_segment",
        "description",
        "coalesce(status, 'Active') AS status",
        "created_at AS created_date",
        *extra,
    )


def to_dim_lead(records: DataFrame, *extra: str) -> DataFrame:
    """Lead records onto dimension columns, and `extra` ones."""
    return records.selectExpr(
        "id AS lead_id",
        "profile_url",
        "full_name",
        "job_title",
        "company",
        "location",
        "industry",
        *extra,
    )


def to_dim_template(records: DataFrame) -> DataFrame:
    """Template records onto dimension columns."""
    return records.selectExpr(
        "id AS template_id",
        "name AS template_name",
        "body AS template_body",
        "coalesce(type, 'Connection') AS template_type",
    )


def to_account_changes(records: DataFrame) -> DataFrame:
    """Account records onto the change stream of the version history."""
    return with_tier_limits(
        records.selectExpr(
            "id AS account_id",
            "email AS account_email",
            "name AS account_name",
            "age_tier AS account_age_tier",
            "coalesce(status, 'Active') AS agent_status",
            "try_to_timestamp(changed_at) AS changed_at",
        )
    )


# Version history


def _neighbour(
    rows: DataFrame, key: list[str], time: str, value: str, step: int, out: str
) -> DataFrame:
    """`value` of the previous (step -1) or next (step +1) row of the key by time,
    as a struct `out` with field `v`; NULL where there is no such row.

    `rows` is unique by key and time.  With dates the calendar bounds the rows
    of a key, and one window does.  With timestamps a key may have any number
    of rows, so its history is cut into days: neighbours inside a day come from
    a window over (key, day), and a day's outer neighbour from a window over
    one edge row per (key, day).
    """
    keys = ", ".join(key)
    shift, edge = ("lag", "max_by") if step < 0 else ("lead", "min_by")
    if dict(rows.dtypes)[time] == "date":
        return rows.selectExpr(
            "*",
            f"{shift}(struct({value} AS v)) OVER (PARTITION BY {keys} ORDER BY {time}) AS {out}",
        )
    rows = rows.selectExpr("*", f"to_date({time}) AS _day", f"struct({value} AS v) AS _v")
    edges = (
        rows.groupBy(*key, "_day")
        .agg(F.expr(f"{edge}(_v, {time}) AS _edge"))
        .selectExpr(
            *key, "_day", f"{shift}(_edge) OVER (PARTITION BY {keys} ORDER BY _day) AS _outer"
        )
    )
    return (
        rows.selectExpr(
            "*", f"{shift}(_v) OVER (PARTITION BY {keys}, _day ORDER BY {time}) AS _inner"
        )
        .join(edges, [*key, "_day"], "left")
        .selectExpr("*", f"coalesce(_inner, _outer) AS {out}")
        .drop("_day", "_v", "_inner", "_outer")
    )


def scd2_history(
    changes: DataFrame,
    key: list[str],
    tracked: list[str],
    time: str,
    tie: str | None = None,
    open_end: str = C.OPEN_END,
) -> DataFrame:
    """Versions from a change stream: key, tracked, effective_from/to, is_current.

    A version starts where a tracked attribute differs from the state before.
    Of several records at one instant the last by `tie` counts.
    """
    state = f"struct({', '.join(tracked)})"
    states = changes.groupBy(*key, time).agg(
        F.expr(f"max_by({state}, {tie or state}) AS state")
    )
    versions = _neighbour(states, key, time, "state", -1, "before").filter(
        "before IS NULL OR NOT before.v <=> state"
    )
    kind = dict(changes.dtypes)[time]
    return _neighbour(versions.drop("before"), key, time, time, +1, "after").selectExpr(
        *key,
        "state.*",
        f"{time} AS effective_from",
        f"coalesce(after.v, CAST('{open_end}' AS {kind})) AS effective_to",
        "CAST(after IS NULL AS INT) AS is_current",
    )


def scd2_merge(
    target: DataFrame,
    changes: DataFrame,
    key: list[str],
    tracked: list[str],
    time: str,
    tie: str | None = None,
    open_end: str = C.OPEN_END,
) -> DataFrame:
    """The version table after more changes.

    Only keys that occur in the changes are rebuilt, from their versions and
    the changes together, so replaying a batch alters nothing.  A change at
    the instant of an existing version replaces it.
    """
    columns = [*key, *tracked]
    touched = changes.select(*key).distinct()
    tie_kind = dict(changes.dtypes)[tie] if tie else "int"
    old = target.join(touched, key, "left_semi").selectExpr(
        *columns, f"effective_from AS {time}", "0 AS _batch", f"CAST(NULL AS {tie_kind}) AS _tie"
    )
    new = changes.selectExpr(
        *columns, time, "1 AS _batch", f"{tie or 'CAST(NULL AS INT)'} AS _tie"
    )
    stream = old.unionByName(new).selectExpr(
        "*", f"struct(_batch, _tie, {', '.join(tracked)}) AS _order"
    )
    rebuilt = scd2_history(stream, key, tracked, time, "_order", open_end)
    kept = target.select(*rebuilt.columns).join(touched, key, "left_anti")
    return kept.unionByName(rebuilt)


def carried_keys(
    old: DataFrame, versions: DataFrame, key: list[str], surrogate: str
) -> DataFrame:
    """(key, effective_from, surrogate, survivor): for every old version the start of the
    version that now covers its start, its own key, and the key that version keeps.

    A late change may merge versions or move their starts.  Of the old versions whose
    starts a version covers, the first one's key survives; facts of the others are
    to be moved to it (`rekeyed`), so no fact loses its account.
    """
    covered = as_of(
        old.selectExpr(*key, surrogate, "effective_from AS _start"),
        versions.select(*key, "effective_from"),
        key, "_start", "effective_from", ["effective_from"], "_version",
    ).selectExpr(*key, surrogate, "_start", "_version.effective_from")
    first = covered.groupBy(*key, "effective_from").agg(
        F.expr(f"min_by({surrogate}, struct(_start, {surrogate})) AS survivor")
    )
    return covered.drop("_start").join(first, [*key, "effective_from"])


def with_carried_keys(versions: DataFrame, carried: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """Versions with the surrogate key that survives in each; NULL where a version is new."""
    kept = carried.filter(f"{surrogate} = survivor").select(*key, "effective_from", surrogate)
    return versions.join(kept, [*key, "effective_from"], "left")


def moved_keys(carried: DataFrame, surrogate: str) -> DataFrame:
    """(surrogate, survivor) of the keys that don't survive."""
    return carried.filter(f"{surrogate} <> survivor").select(surrogate, "survivor")


def rekeyed(facts: DataFrame, moved: DataFrame, surrogate: str) -> DataFrame:
    """Facts with their keys moved to the survivors."""
    renamed = moved.withColumnRenamed("survivor", "_survivor")
    return facts.join(renamed, surrogate, "left").selectExpr(
        *[f"coalesce(_survivor, {c}) AS {c}" if c == surrogate else c for c in facts.columns]
    )


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.filter("is_current = 1")


def with_tier_limits(df: DataFrame, tier: str = "account_age_tier") -> DataFrame:
    """Add risk class and ceilings of the age tier; unknown tiers get the top tier's."""
    return df.selectExpr(
        "*",
        f"{tier_value(tier, 0)} AS risk_classification",
        f"{tier_value(tier, 1)} AS daily_invite_limit",
        f"{tier_value(tier, 2)} AS daily_message_limit",
    )


def of_accounts(daily: DataFrame, accounts: DataFrame) -> DataFrame:
    """Snapshot rows with the `account_id` of their version's account; versions keep their own keys."""
    return daily.join(accounts.select("account_key", "account_id"), "account_key")
