"""Run log rows, load counters and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom import constants as C
from tallyloom.functions.columns import lit
from tallyloom.schemas import TABLES


def run_row(spark: SparkSession, **values) -> DataFrame:
    """One run-log row; columns not given are NULL, status defaults to running."""
    row = {"status": "running", **values}
    return spark.range(1).selectExpr(
        *[
            f"CAST({lit(row.get(f.name))} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in TABLES["run_log"].fields
        ]
    )


# Counters of a checked batch (`error_message` per row): as an aggregate, or
# observed while the batch is written.
LOAD_COUNTERS = {
    "rows_extracted": "count(*)",
    "rows_loaded": "count_if(error_message IS NULL)",
    "rows_rejected": "count_if(error_message IS NOT NULL)",
}


def load_counts(checked: DataFrame) -> DataFrame:
    """extracted / loaded / rejected of a checked batch, as one row."""
    return checked.agg(*[F.expr(f"{text} AS {c}") for c, text in LOAD_COUNTERS.items()])


def _alert(df: DataFrame, at: str, kind: str, severity: str, message: str, details: str):
    return df.selectExpr(
        f"{at} AS raised_at",
        f"'{kind}' AS alert_type",
        f"'{severity}' AS severity",
        f"{message} AS message",
        f"to_json(struct({details})) AS details",
    )


def alerts(
    dq_history: DataFrame, run_log: DataFrame, risk_report: DataFrame, at: str
) -> DataFrame:
    """Alert rows for failed runs, failed data quality, slow runs and critical accounts.

    The accounts behind the last kind are the rows of `critical_accounts`; the
    alert carries their number, so no list is gathered.
    """
    slow = C.SLOW_RUN_SECONDS
    seconds = "unix_timestamp(ended_at) - unix_timestamp(started_at)"
    scores = ", ".join(f"{d}_score AS {d}" for d in C.DQ_WEIGHTS)
    frames = [
        _alert(
            run_log.filter("status = 'failed'"), at, "pipeline_failure", "CRITICAL",
            "format_string('run %s failed: %s', run_id, coalesce(error_message, ''))",
            "run_id, error_message",
        ),
        _alert(
            dq_history.filter("pass_fail = 'FAIL'"), at, "dq_breach", "WARNING",
            "format_string('data quality %.4f is below %.2f', composite_dq_score, threshold_used)",
            scores,
        ),
        _alert(
            run_log.selectExpr("*", f"{seconds} AS seconds").filter(f"seconds > {slow}"),
            at, "anomalous_duration", "WARNING",
            f"format_string('run %s took %d s, more than {slow}', run_id, seconds)",
            "seconds AS duration_seconds",
        ),
        _alert(
            risk_report.agg(F.expr("count_if(risk_level = 'Critical') AS accounts"))
            .filter("accounts > 0"),
            at, "risk_critical", "CRITICAL",
            "format_string('accounts at critical risk: %d', accounts)",
            "accounts",
        ),
    ]
    return reduce(DataFrame.unionByName, frames)


def critical_accounts(risk_report: DataFrame, at: str) -> DataFrame:
    """The accounts behind a `risk_critical` alert, one row each."""
    return risk_report.filter("risk_level = 'Critical'").selectExpr(
        f"{at} AS raised_at", "'risk_critical' AS alert_type", "account_id", "account_name"
    )
