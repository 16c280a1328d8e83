"""Event-time daily counts per account, kept up to date from the stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.columns import exprs
from tallyloom.operators.measures import TYPE_COUNTS
from tallyloom.sources import testmart as tm
from tallyloom.sources.locations import work_folder
from tallyloom.streaming.ingest import ingest_stream


def daily_counts(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Counts per day and account of the days in `days`."""
    touched = fact.join(days, "date_key", "left_semi")
    counts = touched.groupBy("date_key", "account_key").agg(*exprs(TYPE_COUNTS))
    return counts.select("account_key", *TYPE_COUNTS, "date_key")


def start(
    source: DataFrame,
    to_fact: Callable[[DataFrame], DataFrame],
    fact_path: str,
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Load every micro-batch into the fact and replace the counts of its days.

    The days are counted from the whole fact, so rows may come at any time and
    in any order, and a replayed batch writes the same. The table under `path` has
    one folder for each day: it doesn't grow with the number of batches.
    """

    def save(fact: DataFrame, rows: DataFrame, batch_id: int) -> None:
        counts = daily_counts(fact, rows.select("date_key").distinct())
        (
            counts.hint("rebalance", "date_key")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date_key")
            .parquet(path)
        )

    return ingest_stream(source, fact_path, checkpoint, to_fact, after=save)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The current counts, one row for each day and account."""
    return spark.read.parquet(path)


def replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the event table of a folder and read the resulting counts."""
    folder = work_folder(spark, "stream-counts")
    source, to_fact = tm.event_stream(spark, sf_dir)
    query = start(source, to_fact, f"{folder}/fact", f"{folder}/counts", f"{folder}/checkpoint")
    query.awaitTermination()
    return latest(spark, f"{folder}/counts")
