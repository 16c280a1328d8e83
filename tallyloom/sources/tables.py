"""The mart on a shared file system: Parquet tables under one root.

Parquet has no MERGE, so a table that is rewritten gets a new folder, and a
row in the `_versions` log then makes it the current one; a job that dies
before that row leaves the old state in place.  One job writes at a time.
Facts are partitioned by date and only ever appended to.

Scores of the snapshot depend on statistics over all days, so every batch changes
them all.  They aren't stored: the statistics are, a few rows as a version of their
own, and `read` scores the rows by the current ones.
"""

from __future__ import annotations

import copy
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from tallyloom.operators import anomaly
from tallyloom.schemas import TABLES

PARTITIONED = dict.fromkeys(("fact_activity", "fact_daily", "metric_days"), ["date_key"])
EXPORTED = ["dim_date", "dim_account", "dim_campaign", "dim_lead", "dim_template",
            "fact_activity", "fact_daily", "dq_history"]
_LOG = "table_name string, seq bigint, folder string"


class MartTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def on(self, spark: SparkSession) -> MartTables:
        """The same mart in another session, such as a micro-batch's."""
        other = copy.copy(self)
        other.spark = spark
        return other

    # State

    def _log(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/_versions")

    def _current(self, name: str):
        """(seq, folder) of a table, or None before `init`."""
        try:
            row = (
                self._log()
                .filter(F.col("table_name") == name)
                .agg(F.expr("max(struct(seq, folder)) AS last"))
                .first()
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return row["last"]

    def init(self, names: Iterable[str] = TABLES) -> None:
        """Create the tables that do not exist yet, empty; values of days are counted from the snapshot there is."""
        for name in names:
            if self._current(name) is None:
                counted = name == "metric_days" and self._current("fact_daily")
                self.publish(name, anomaly.metric_days(self.stored("fact_daily")) if counted
                             else self.spark.createDataFrame([], TABLES[name]))

    # Reads and writes

    def path(self, name: str) -> str:
        return f"{self.root}/{self._current(name)['folder']}"

    def stored(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        """A table as it stands; the snapshot with the scores of the current statistics, if there are any."""
        rows = self.stored(name)
        if name != "fact_daily" or not (self._current("score_stats") or {"seq": 1})["seq"] > 1:
            return rows
        scored = anomaly.anomaly_scores(rows, stats=self.stored("score_stats"))
        return scored.select(*[f.name for f in TABLES[name].fields])

    def _write(self, name: str, df: DataFrame, path: str, mode: str = "append") -> None:
        """Missing columns become NULL."""
        absent = [F.lit(None).cast(f.dataType).alias(f.name)
                  for f in TABLES[name].fields if f.name not in df.columns]
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields]
        keys = PARTITIONED.get(name, [])
        rows = df.select("*", *absent).select(*columns)
        # Rows of a date are brought together, so it is not scattered over the
        # files of every task; a date too large for one task is split again.
        rows = rows.hint("rebalance", *keys) if keys else rows
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to the current version."""
        self._write(name, df, self.path(name))

    def publish(self, name: str, df: DataFrame) -> None:
        """Write a new version of a table and make it the current one."""
        folder = f"{name}/v-{uuid.uuid4().hex}"
        self._write(name, df, f"{self.root}/{folder}")
        last = self._current(name)
        entry = [(name, last["seq"] + 1 if last else 1, folder)]
        self.spark.createDataFrame(entry, _LOG).coalesce(1).write.mode("append").parquet(
            f"{self.root}/_versions"
        )

    def overwrite_days(self, name: str, df: DataFrame) -> None:
        """Replace the dates present in `df`, in place."""
        self._write(name, df, self.path(name), "overwrite")

    def put_days(self, daily: DataFrame) -> None:
        """Replace days of the snapshot, count their values and renew the statistics of the scores.

        `daily` is read three times, so it should be a written table. All steps can be
        repeated: a job that dies in between is made good by the same call.
        """
        self.overwrite_days("fact_daily", daily.drop("anomaly_score", "risk_flag"))
        self.overwrite_days("metric_days", anomaly.metric_days(daily))
        self.publish("score_stats", anomaly.pooled_stats(self.stored("metric_days")))

    # Exports

    def export_csv(self, folder: str, names: list[str] = EXPORTED) -> None:
        """Every table as CSV with a header and its columns in order, one folder each."""
        for name in names:
            rows = self.read(name).select(*[f.name for f in TABLES[name].fields])
            rows.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def write_alerts(alerts: DataFrame, folder: str) -> None:
    """Append alerts, one JSON object per line."""
    alerts.write.mode("append").json(folder)
