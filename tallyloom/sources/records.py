"""Source records: JSON lines or Parquet files with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.columns import lit
from tallyloom.operators.facts import RAW
from tallyloom.schemas import RECORDS

_BROKEN = "_broken"


def parse_lines(lines: DataFrame, entity: str) -> DataFrame:
    """Records of JSON lines (column `value`).

    `raw_record` is the line as it was written where the schema doesn't hold all of it:
    where it is no JSON object, a field can't be read as its type, or a field is unknown.
    Else it is NULL.  Empty lines are no records.
    """
    fields = RECORDS[entity].fields
    schema = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    record = F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    )
    known = ", ".join(lit(f.name) for f in fields)
    lost = (
        f"record IS NULL OR record.{_BROKEN} IS NOT NULL OR json_object_keys(value) IS NULL"
        f" OR size(array_except(json_object_keys(value), array({known}))) > 0"
    )
    return (
        lines.filter("trim(value) != ''")
        .select("value", record.alias("record"))
        .selectExpr(*[f"record.{f.name}" for f in fields], f"IF({lost}, value, NULL) AS {RAW}")
    )


def read_records(spark: SparkSession, path: str, entity: str, form: str = "json") -> DataFrame:
    """Records of an entity (campaign, lead, template, account, activity).

    Fields a record does not have are NULL.  JSON records have `raw_record` (`parse_lines`).
    """
    if form == "json":
        return parse_lines(spark.read.text(path), entity)
    return spark.read.schema(RECORDS[entity]).format(form).load(path)


def stream_records(spark: SparkSession, path: str, entity: str, form: str = "json") -> DataFrame:
    """The same records as a stream over the files that arrive in a folder."""
    if form == "json":
        return parse_lines(spark.readStream.text(path), entity)
    return spark.readStream.schema(RECORDS[entity]).format(form).load(path)
