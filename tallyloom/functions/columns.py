"""SQL expressions used across the mart.

The helpers take and give expression text, for `expr`, `selectExpr` and `agg`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from tallyloom import constants as C


def lit(value) -> str:
    """A literal; floats are doubles, not decimals, and times are in the session zone."""
    if value is None:
        return "NULL"
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def exprs(columns: dict[str, str]) -> list[Column]:
    """Aliased columns from {name: expression}."""
    return [F.expr(text).alias(name) for name, text in columns.items()]


def ratio(num: str, den: str) -> str:
    """num / den as double, 0 where the denominator is zero, negative or NULL."""
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / ({den}) ELSE 0D END"


def rate(num: str, den: str) -> str:
    """`ratio` rounded to four digits, as stored in the mart."""
    return f"round({ratio(num, den)}, 4)"


def divide(num: str, den: str) -> str:
    """BI division: 0 where the denominator is zero or either side is NULL."""
    return f"coalesce(try_divide(CAST({num} AS DOUBLE), CAST({den} AS DOUBLE)), 0D)"


def date_key(day: str) -> str:
    """YYYYMMDD as int."""
    return f"year({day}) * 10000 + month({day}) * 100 + day({day})"


def key_to_date(key: str) -> str:
    """The date of a YYYYMMDD key; NULL where the key is no calendar date."""
    return f"try_to_date(CAST({key} AS STRING), 'yyyyMMdd')"


def count_type(kind: str) -> str:
    """Number of activities of a type."""
    return f"count_if(activity_type = {lit(kind)})"


def total(column: str) -> str:
    """Sum of an integer column as bigint, 0 for no rows."""
    return f"coalesce(sum(CAST({column} AS BIGINT)), 0)"


def name(column: str) -> str:
    """A column name, quoted."""
    return "`" + column.replace("`", "``") + "`"


def truthy(column: str) -> str:
    """A flag of the source is set: true, a number but 0, or a text but an empty one, 0, false, no, off or null."""
    text = f"lower(trim(CAST({column} AS STRING)))"
    return f"coalesce({text} NOT IN ('', '0', '0.0', 'false', 'no', 'n', 'f', 'off', 'null', 'none'), false)"


def flag(cond: str) -> str:
    """1 where the condition holds, 0 where it is false or NULL."""
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def pick(column: str, mapping: dict, default=None) -> str:
    """The mapped literal of a column's value."""
    arms = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {lit(default)} END"


def tier_value(tier: str, position: int) -> str:
    """One attribute of an age tier (0 risk class, 1 invites, 2 messages).

    Literal branches, so no lookup join; an unknown or NULL tier gets the top
    tier's value.
    """
    values = {name: attributes[position] for name, attributes in C.TIERS.items()}
    return pick(tier, values, values[C.TOP_TIER])


def steps(column: str, test: str, bounds: list[tuple], default) -> str:
    """Value of the first (bound, value) for which `column test bound` holds."""
    arms = " ".join(f"WHEN {column} {test} {lit(b)} THEN {lit(v)}" for b, v in bounds)
    return f"CASE {arms} ELSE {lit(default)} END"
