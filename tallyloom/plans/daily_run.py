"""One scheduled run: load, snapshot, scores, data quality, risk, log, alerts."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyloom.functions.columns import lit
from tallyloom.operators import dims, facts, increment, ops, quality, risk
from tallyloom.schemas import RECORDS
from tallyloom.sources.key_index import KeyIndex
from tallyloom.sources.locations import work_folder
from tallyloom.sources.tables import MartTables, write_alerts

# Entities under which watermarks are kept.
LEADS, ACTIVITIES = "leads", "outreach_activity"

# Order of records in a snapshot source: none but their values.
SNAPSHOT = "1"

NO_ID = [("coalesce(id, '') = ''", "missing id")]


@dataclass
class Run:
    """State of one run."""

    spark: SparkSession
    mart: MartTables
    run_type: str
    now: dt.datetime
    source_system: str
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    correlation_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    counts: dict[str, int] = field(
        default_factory=lambda: dict.fromkeys(ops.LOAD_COUNTERS, 0)
    )

    @property
    def at(self) -> str:
        return lit(self.now)

    def staged(self, checked: DataFrame, extracted: bool = False) -> DataFrame:
        """Write a checked batch to the shared folder and count it on the way;
        the steps after it read the written copy.  Only facts count as extracted."""
        folder = work_folder(self.spark, "batch")
        seen = Observation()
        counters = [F.expr(text).alias(c) for c, text in ops.LOAD_COUNTERS.items()]
        checked.observe(seen, *counters).write.parquet(folder)
        for name, n in seen.get.items():
            if extracted or name != "rows_extracted":
                self.counts[name] += n
        return self.spark.read.schema(checked.schema).parquet(folder)

    def kept(self, df: DataFrame) -> DataFrame:
        """`df` as a table in the shared folder: what is read from it doesn't change with the mart."""
        folder = work_folder(self.spark, "kept")
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def reject(self, staged: DataFrame, entity: str, error_type: str) -> None:
        payload = [f.name for f in RECORDS[entity].fields if f.name in staged.columns]
        rejected = staged.filter("error_message IS NOT NULL")
        letters = facts.to_dead_letter(rejected, payload, lit(self.run_id), error_type, self.at)
        self.mart.append("dead_letter", facts.insert_letters(self.mart.read("dead_letter"), letters))

    def watermark(self, entity: str) -> str | None:
        if self.run_type == "full":
            return None
        return increment.read_watermark(self.mart.read("watermark"), entity)

    def advance(self, accepted: DataFrame, entity: str, time: str) -> None:
        state = self.mart.read("watermark")
        row = increment.advance(state, accepted, entity, time, self.at)
        if not row.isEmpty():
            self.mart.publish("watermark", increment.put_watermark(state, row))

    def log(self, status: str, ended_at: dt.datetime, error: str | None = None) -> None:
        watermark = increment.read_watermark(self.mart.read("watermark"), ACTIVITIES)
        row = ops.run_row(
            self.spark, run_id=self.run_id, correlation_id=self.correlation_id,
            run_type=self.run_type, status=status, started_at=self.now, ended_at=ended_at,
            error_message=error, watermark_value=watermark, **self.counts,
        )
        old = self.mart.read("run_log")
        self.mart.publish("run_log", facts.replace_by_key(old, row, ["run_id"]))


def accepted_of(
    run: Run, records: DataFrame, entity: str, rules: list[tuple[str, str]]
) -> DataFrame:
    """Stage dimension records, send the bad ones away, give the good ones."""
    staged = run.staged(facts.checked(records, rules))
    run.reject(staged, entity, "transformation")
    return staged.filter("error_message IS NULL")


def load_campaigns(run: Run, records: DataFrame) -> None:
    updates = dims.to_dim_campaign(accepted_of(run, records, "campaign", NO_ID))
    target = run.mart.read("dim_campaign")
    run.mart.publish(
        "dim_campaign",
        dims.scd1_merge(target, updates, "campaign_id", SNAPSHOT, "campaign_key", run.at),
    )


def load_templates(run: Run, records: DataFrame) -> None:
    updates = dims.to_dim_template(accepted_of(run, records, "template", NO_ID))
    target = run.mart.read("dim_template")
    run.mart.publish(
        "dim_template",
        dims.scd1_merge(target, updates, "template_id", SNAPSHOT, "template_key", run.at),
    )


def load_accounts(run: Run, records: DataFrame) -> list[int]:
    """Version history of accounts; gives the days whose facts got other keys.

    A version keeps its key, also where a late change moves its start; of versions
    that a change merges the first one's key stays, and facts of the others move to it.
    They move before the versions are published, to a key that is valid before and after,
    so a run that dies in between is repeated without harm.
    """
    tracked = ["account_email", "account_name", "account_age_tier", "agent_status",
               "risk_classification", "daily_invite_limit", "daily_message_limit"]
    rules = [*NO_ID, ("try_to_timestamp(changed_at) IS NULL", "missing or unreadable time")]
    changes = dims.to_account_changes(accepted_of(run, records, "account", rules))
    old = run.mart.read("dim_account")
    merged = dims.scd2_merge(
        old.drop("account_key", "created_at", "updated_at"),
        changes, ["account_id"], tracked, "changed_at",
    )
    carried = run.kept(dims.carried_keys(old, merged, ["account_id"], "account_key"))
    keyed = (
        dims.with_carried_keys(merged, carried, ["account_id"], "account_key")
        .join(old.select("account_key", "created_at"), "account_key", "left")
        .selectExpr("*", f"{run.at} AS updated_at")
    )
    known = keyed.filter("account_key IS NOT NULL")
    fresh = keyed.filter("account_key IS NULL").drop("account_key", "created_at").selectExpr(
        "*", "concat_ws('|', account_id, effective_from) AS _version", f"{run.at} AS created_at"
    )
    added = dims.assign_keys(fresh, "_version", "account_key", old).drop("_version")
    days = move_facts(run, dims.moved_keys(carried, "account_key"))
    run.mart.publish("dim_account", known.unionByName(added))
    return days


def move_facts(run: Run, moved: DataFrame) -> list[int]:
    """Rewrite the days that have facts of moved keys; gives these days."""
    if moved.isEmpty():
        return []
    fact = run.mart.read("fact_activity")
    affected = fact.join(moved, "account_key", "left_semi").select("date_key").distinct()
    days = [r["date_key"] for r in affected.collect()]  # the calendar bounds them
    if days:
        rows = run.kept(dims.rekeyed(fact.filter(F.col("date_key").isin(days)), moved, "account_key"))
        run.mart.overwrite_days("fact_activity", rows)
    return days


def load_leads(run: Run, records: DataFrame) -> None:
    time = "try_to_timestamp(coalesce(nullif(updated_at, ''), nullif(created_at, '')))"
    timed = records.selectExpr("*", f"{time} AS event_time")
    fresh = since_or_timeless(timed, run.watermark(LEADS))
    accepted = accepted_of(run, fresh, "lead", NO_ID)
    batch = dims.to_dim_lead(accepted, "event_time")
    target = run.mart.read("dim_lead")
    run.mart.publish(
        "dim_lead", dims.scd1_merge(target, batch, "lead_id", "event_time", "lead_key", run.at)
    )
    run.advance(accepted, LEADS, "event_time")


def since_or_timeless(records: DataFrame, watermark: str | None) -> DataFrame:
    """Records after the watermark, and those without a time, which must not
    vanish unreported."""
    if watermark is None:
        return records
    bound = f"CAST({lit(watermark)} AS TIMESTAMP)"
    return records.filter(f"event_time > {bound} OR event_time IS NULL")


def load_activities(run: Run, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Load new activities; gives the staged batch as facts and its accepted records.

    The watermark is left to the caller: it may move only when all that follows
    from the batch is stored, so that a run that dies in between is repeated.
    """
    mart = run.mart
    first, last = mart.read("dim_date").selectExpr("min(date_key)", "max(date_key)").first()
    timed = since_or_timeless(facts.with_event_time(records), run.watermark(ACTIVITIES))
    resolved = facts.resolve_keys(
        timed, mart.read("dim_account"), mart.read("dim_campaign"), mart.read("dim_lead")
    )
    rules = facts.load_rules((first, last))
    staged = run.staged(facts.checked(resolved, rules), extracted=True)
    run.reject(staged, "activity", "load")

    accepted = staged.filter("error_message IS NULL")
    batch = facts.to_fact_activity(accepted, run.source_system).selectExpr(
        "*", "CAST(NULL AS BIGINT) AS template_key", f"{run.at} AS loaded_at"
    )
    index = KeyIndex(run.spark, f"{mart.root}/key_index/fact_activity", "activity_id")
    index.repair(mart.read("fact_activity"))
    rows = run.kept(index.absent(facts.first_per_key(batch, ["activity_id"], "activity_timestamp")))
    load = index.open()
    mart.append("fact_activity", rows)
    index.add(rows)
    index.close(load)
    return batch, accepted


def refresh(run: Run, days: list[int]) -> None:
    """Snapshot days and statistics of the scores after the facts of some days have changed."""
    if not days:
        return
    mart = run.mart
    fact = mart.read("fact_activity").filter(F.col("date_key").isin(list(set(days))))
    mart.put_days(run.kept(facts.daily_snapshot(fact, mart.read("dim_account"))))


def raise_alerts(run: Run, report: DataFrame) -> None:
    """Write the alerts of this run from its log row, its data-quality row and
    its risk report."""
    mine = F.col("run_id") == run.run_id
    history, log = run.mart.read("dq_history").filter(mine), run.mart.read("run_log").filter(mine)
    write_alerts(ops.alerts(history, log, report, run.at), f"{run.mart.root}/alerts")
    write_alerts(ops.critical_accounts(report, run.at), f"{run.mart.root}/alert_accounts")


NO_REPORT = "account_id string, account_name string, risk_level string"


def run_daily(
    spark: SparkSession,
    mart: MartTables,
    sources: dict[str, DataFrame],
    now: dt.datetime,
    source_system: str,
    run_type: str = "incremental",
    years: tuple[int, int] = (2024, 2027),
    enforce_quality: bool = False,
    clock=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
) -> dict:
    """Run all stages and give the run's id, counters and data-quality verdict.

    `sources` holds DataFrames of records by entity; entities may be absent.
    `now` stamps the run; `clock` gives its end.  With `enforce_quality` a run
    whose data quality fails is a failed run.
    """
    mart.init()
    run = Run(spark, mart, run_type, now, source_system)
    try:
        calendar = dims.dim_date(spark, *years)
        known = mart.read("dim_date")
        mart.append("dim_date", facts.absent_from(calendar, known, ["full_date"]))

        moved: list[int] = []
        for entity, load in (
            ("account", load_accounts),
            ("template", load_templates),
            ("campaign", load_campaigns),
            ("lead", load_leads),
        ):
            if entity in sources:
                moved += load(run, sources[entity]) or []
        if "activity" in sources:
            batch, accepted = load_activities(run, sources["activity"])
            # The dates of a batch, bounded by the calendar, prune the fact's partitions.
            refresh(run, [r["date_key"] for r in batch.select("date_key").distinct().collect()] + moved)
            run.advance(accepted, ACTIVITIES, "event_time")
        elif moved:
            refresh(run, moved)

        names = {*quality.MART_RULES.required, *[t for t, _ in quality.MART_RULES.unique]}
        tables = {name: mart.read(name) for name in names}
        checks = quality.run_checks(tables, quality.MART_RULES, now)
        mart.append("dq_history", quality.dq_history_row(checks, run.run_id, run.at))
        score = mart.read("dq_history").filter(F.col("run_id") == run.run_id)
        if enforce_quality:
            quality.enforce(score)

        report_path = f"{mart.root}/risk_report/run_id={run.run_id}"
        risk.risk_report(mart.read("dim_account"), mart.read("fact_daily")).write.parquet(
            report_path
        )
        run.log("success", clock())
    except Exception as error:
        run.log("failed", clock(), str(error))
        raise_alerts(run, spark.createDataFrame([], NO_REPORT))
        raise
    raise_alerts(run, spark.read.parquet(report_path))
    verdict = score.select("composite_dq_score", "pass_fail", "threshold_used").first()
    return {"run_id": run.run_id, **run.counts, **verdict.asDict()}
