"""Incremental load: scan since a watermark, watermark state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import lit
from tallyloom.operators.facts import replace_by_key


def scan_since(records: DataFrame, time: str, watermark: dt.datetime | str | None) -> DataFrame:
    """Records whose time expression is after the watermark; all where it is None.

    The watermark is a literal of the column's type, so the test is pushed
    into the scan.
    """
    if watermark is None:
        return records
    kind = records.select(F.expr(time).alias("t")).dtypes[0][1]
    return records.filter(f"{time} > CAST({lit(str(watermark))} AS {kind})")


def read_watermark(state: DataFrame, entity: str) -> str | None:
    """The stored watermark of an entity as text in the session zone, or None."""
    row = (
        state.filter(F.col("entity_name") == entity)
        .selectExpr("CAST(last_watermark AS STRING) AS mark")
        .first()
    )
    return row["mark"] if row else None


def advance(state: DataFrame, accepted: DataFrame, entity: str, time: str, at: str) -> DataFrame:
    """The watermark row an accepted batch gives: the later of the stored value
    and the newest accepted time.  Empty if that leaves the value unchanged."""
    old = state.filter(F.col("entity_name") == entity).agg(F.max("last_watermark")).scalar()
    return (
        accepted.agg(F.expr(f"CAST(max({time}) AS TIMESTAMP) AS newest"), old.alias("old"))
        .selectExpr(
            f"{lit(entity)} AS entity_name",
            "greatest(newest, old) AS last_watermark",
            f"{at} AS updated_at",
            "old",
        )
        .filter("last_watermark IS NOT NULL AND NOT last_watermark <=> old")
        .drop("old")
    )


def put_watermark(state: DataFrame, row: DataFrame) -> DataFrame:
    """The state table with the row of its entity replaced."""
    return replace_by_key(state, row, ["entity_name"])
