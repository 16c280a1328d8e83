"""Which keys are loaded: a table of keys in folders by hash, beside the table that holds them.

A batch is compared with the folders of its own hashes only, so a small batch doesn't
read the keys of the whole table.  Keys are added after the rows; a mark that is set before
and cleared after tells a later load that an earlier one died in between, and it
then adds the keys that are missing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.functions.columns import name
from tallyloom.operators.facts import absent_from

#: Folders; a batch of far fewer keys reads a small share of them.
BUCKETS = 1_024
_MARKS = "seq bigint, load string, open boolean"


class KeyIndex:
    """Keys of one table (`key`, a text) under `root`; one job writes at a time."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.bucket = f"CAST(pmod(xxhash64({name(key)}), {buckets}) AS INT)"
        self.schema = f"{name(key)} string, bucket int"

    def _table(self, folder: str, schema: str) -> DataFrame:
        path = f"{self.root}/{folder}"
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def keys(self, buckets: list[int] | None = None) -> DataFrame:
        """All keys, or those of some folders; the others aren't read."""
        known = self._table("keys", self.schema)
        return known if buckets is None else known.filter(F.col("bucket").isin(buckets))

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The folders that can hold keys of these rows: at most as many as there are."""
        found = rows.selectExpr(f"{self.bucket} AS bucket").distinct().collect()
        return sorted(r["bucket"] for r in found)

    def absent(self, rows: DataFrame) -> DataFrame:
        """The rows (unique by key) whose key isn't loaded."""
        return absent_from(rows, self.keys(self.buckets_of(rows)), [self.key])

    def add(self, rows: DataFrame) -> None:
        """Add the keys of loaded rows."""
        placed = rows.selectExpr(name(self.key), f"{self.bucket} AS bucket").hint("rebalance", "bucket")
        placed.write.mode("append").partitionBy("bucket").parquet(f"{self.root}/keys")

    # Marks

    def _last(self):
        return self._table("marks", _MARKS).agg(F.expr("max(struct(seq, load, open)) AS last")).first()["last"]

    def _mark(self, load: str, open_: bool) -> None:
        last = self._last()
        row = [(last["seq"] + 1 if last else 1, load, open_)]
        self.spark.createDataFrame(row, _MARKS).coalesce(1).write.mode("append").parquet(f"{self.root}/marks")

    def open(self) -> str:
        """Call before rows are added to the table."""
        load = uuid.uuid4().hex
        self._mark(load, True)
        return load

    def close(self, load: str) -> None:
        """Call after their keys are added."""
        self._mark(load, False)

    def repair(self, table: DataFrame) -> bool:
        """Add the keys of `table` that a load that died left out, or all where there is no index yet; True if it had to look."""
        last = self._last()
        if last is not None and not last["open"]:
            return False
        missing = table.select(name(self.key)).distinct().join(self.keys(), self.key, "left_anti")
        self.add(missing)
        self.close(last["load"] if last else "first")
        return True
