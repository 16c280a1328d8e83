"""The activity load of the scheduled run as a stream: every micro-batch does all that a run does.

A ledger row is the last thing a micro-batch writes. A batch that has one is done and is
skipped when it comes again; a batch without one is done again as a whole. Every
step may be repeated: facts load once by their key, dead letters once by their
content, snapshot days are recomputed from the fact, the watermark only rises. So a
stream that dies anywhere and starts again leaves the tables as if it had not died.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.columns import lit
from tallyloom.plans.daily_run import ACTIVITIES, Run, load_activities, refresh
from tallyloom.sources.tables import MartTables


def load_stream(
    mart: MartTables,
    source: DataFrame,
    checkpoint: str,
    source_system: str,
    stream: str = "activities",
    clock: Callable[[], dt.datetime] = lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
) -> StreamingQuery:
    """Load all available files of a stream of activity records into the mart.

    The mart has its dimensions and calendar. Files are taken up once by the
    checkpoint, so no watermark narrows them and late records load too. `stream` names
    the ledger's rows; one stream or run writes to the mart at a time.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        own = mart.on(batch.sparkSession)
        if not own.read("load_ledger").filter(
            (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
        ).isEmpty():
            return
        run = Run(batch.sparkSession, own, "full", clock(), source_system, f"{stream}-{batch_id}")
        rows, accepted = load_activities(run, batch)
        days = [r["date_key"] for r in rows.select("date_key").distinct().collect()]
        if days:  # bounded by the calendar
            refresh(run, days)
            run.advance(accepted, ACTIVITIES, "event_time")
        counts = ", ".join(f"{n}L AS {c}" for c, n in run.counts.items())
        own.append("load_ledger", run.spark.sql(
            f"SELECT {lit(stream)} AS stream, {batch_id}L AS batch_id, {lit(run.run_id)} AS run_id,"
            f" {run.at} AS committed_at, {counts}"
        ))

    mart.init()
    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
