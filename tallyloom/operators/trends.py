"""Rolling trends over daily snapshots.

The windows are partitioned by account (or another key): a partition has one
row per day, so its size is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyloom.functions.columns import lit


def _trailing(partition_by: list[str], window: int) -> str:
    return (
        f"OVER (PARTITION BY {', '.join(partition_by)} ORDER BY date_key "
        f"ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)"
    )


def acceptance_collapse(
    daily: DataFrame,
    partition_by: list[str],
    window: int = 7,
    threshold: float = 0.3,
    rate: str = "acceptance_rate",
) -> DataFrame:
    """Add `acceptance_collapse`: the rate lies more than `threshold` below the
    mean of the trailing rows (current one included, at least 3 non-NULL)."""
    trailing = _trailing(partition_by, window)
    drop = f"(_mean - {rate}) / greatest(_mean, 0.01D)"
    return (
        daily.selectExpr(
            "*", f"IF(count({rate}) {trailing} >= 3, avg({rate}) {trailing}, NULL) AS _mean"
        )
        .selectExpr("*", f"coalesce({drop} > {lit(threshold)}, false) AS acceptance_collapse")
        .drop("_mean")
    )


def reply_decay(
    daily: DataFrame, partition_by: list[str], window: int = 7, rate: str = "reply_rate"
) -> DataFrame:
    """Add `reply_trend_slope` and `reply_decay` (falling with r² above 0.5).

    Regression of the rate (NULL as 0) on the row position over the trailing
    rows; 0 / false for fewer than `window` rows or a constant window.
    """
    trailing = _trailing(partition_by, window)
    keys = ", ".join(partition_by)
    return (
        daily.selectExpr(
            "*",
            f"coalesce(CAST({rate} AS DOUBLE), 0D) AS _y",
            f"CAST(row_number() OVER (PARTITION BY {keys} ORDER BY date_key) AS DOUBLE) AS _x",
        )
        .selectExpr(
            "*",
            f"count(*) {trailing} = {window} AND min(_y) {trailing} <> max(_y) {trailing} AS _ok",
            f"regr_slope(_y, _x) {trailing} AS _slope",
            f"regr_r2(_y, _x) {trailing} AS _r2",
        )
        .selectExpr(
            "*",
            "IF(_ok, round(_slope, 6), 0D) AS reply_trend_slope",
            "IF(_ok, _slope < 0 AND _r2 > 0.5D, false) AS reply_decay",
        )
        .drop("_x", "_y", "_ok", "_slope", "_r2")
    )


def utilization_spikes(daily: DataFrame, at: float = 0.95) -> DataFrame:
    """Snapshot rows at or above the given share of a daily limit."""
    return daily.filter(f"greatest(invite_utilization, message_utilization) >= {lit(at)}")
