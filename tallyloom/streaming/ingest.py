"""Continuous form of the incremental load.

Files are taken up exactly once by the checkpoint; inside a batch the fact
insert is the same anti-join as in the batch job, so a replayed batch, a file
delivered twice or a very late record cannot load a key twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.columns import lit
from tallyloom.operators import facts
from tallyloom.sources.locations import work_folder


def ingest_stream(
    source: DataFrame,
    fact_path: str,
    checkpoint: str,
    to_fact: Callable[[DataFrame], DataFrame],
    keys: tuple[str, ...] = ("activity_id",),
    order: str = "activity_timestamp",
    to_rejects: Callable[[DataFrame], DataFrame] | None = None,
    reject_path: str | None = None,
    after: Callable[[DataFrame, DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Load all available files of a streaming source into the fact table.

    `to_fact` maps a batch of source rows to accepted fact rows, `to_rejects`
    to dead letters, which are kept per micro-batch, so a replayed one
    overwrites its own.  `after` is called with the fact, the fact rows of the
    batch and its id once they are loaded.  The fact is partitioned by `date_key`.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # The files of a batch are read again for the rejects: cheaper than
        # keeping a copy of a large first load.
        rows = to_fact(batch)
        target = batch.sparkSession.read.schema(rows.schema).parquet(fact_path)
        fresh = facts.insert_facts(target, rows, list(keys), order)
        fresh.hint("rebalance", "date_key").write.mode("append").partitionBy(
            "date_key"
        ).parquet(fact_path)
        if to_rejects is not None:
            to_rejects(batch).write.mode("overwrite").parquet(
                f"{reject_path}/batch_id={batch_id}"
            )
        if after is not None:
            # Read anew: the listing above doesn't have the files just written.
            fact = batch.sparkSession.read.schema(rows.schema).parquet(fact_path)
            after(fact, rows, batch_id)

    # An empty append creates the table on the first run.
    empty = to_fact(source.sparkSession.createDataFrame([], source.schema))
    empty.write.mode("append").partitionBy("date_key").parquet(fact_path)
    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_records(
    source: DataFrame,
    fact_path: str,
    checkpoint: str,
    reject_path: str,
    accounts: DataFrame,
    campaigns: DataFrame,
    leads: DataFrame,
    source_system: str,
    run_id: str,
    at: str,
) -> StreamingQuery:
    """The whole activity load on a stream of raw records: times, keys, rules,
    facts and dead letters (`at` is the expression of their time)."""
    payload = [c for c in source.columns if c != facts.RAW]

    def checked(batch: DataFrame) -> DataFrame:
        resolved = facts.resolve_keys(facts.with_event_time(batch), accounts, campaigns, leads)
        return facts.checked(resolved, facts.load_rules())

    def to_fact(batch: DataFrame) -> DataFrame:
        accepted = checked(batch).filter("error_message IS NULL")
        return facts.to_fact_activity(accepted, source_system)

    def to_rejects(batch: DataFrame) -> DataFrame:
        rejected = checked(batch).filter("error_message IS NOT NULL")
        return facts.to_dead_letter(rejected, payload, lit(run_id), "load", at)

    return ingest_stream(
        source, fact_path, checkpoint, to_fact, to_rejects=to_rejects, reject_path=reject_path
    )


def replay(
    spark: SparkSession, sf_dir: str, mapper: Callable[[SparkSession, str], tuple]
) -> DataFrame:
    """Stream the event files of a folder into a new fact table and read it."""
    folder = work_folder(spark, "stream-ingest")
    source, to_fact = mapper(spark, sf_dir)
    ingest_stream(source, f"{folder}/fact", f"{folder}/checkpoint", to_fact).awaitTermination()
    return spark.read.parquet(f"{folder}/fact")
