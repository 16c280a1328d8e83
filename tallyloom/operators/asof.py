"""As-of join: the state that held at the time of a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import name


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    time: str,
    right_time: str,
    value: list[str],
    out: str,
) -> DataFrame:
    """Every row of `left` with a struct `out` of the `value` columns of the last
    row of `right` with its key at or before its time; NULL where there is none.

    `right` is unique by key and time.  Rows with a NULL key or time match nothing.
    Both times are dates, or both timestamps.  The rows of both sides are
    ordered inside a day of a key; a day's state before its first row comes from
    one row per (key, day).  So a key may have any number of rows on either
    side, and no row meets more than the rows of its own day.
    """
    columns = {f"_k{i}": name(k) for i, k in enumerate(key)}
    keys = ", ".join(columns)
    state = right.selectExpr(f"struct({', '.join(map(name, value))}) AS v").schema["v"].dataType
    row = left.selectExpr("struct(*) AS v").schema["v"].dataType
    known = " AND ".join(f"{k} IS NOT NULL" for k in (*columns, "_t"))
    named = [f"{k} AS {c}" for c, k in columns.items()]
    none = F.lit(None)
    lefts = left.select(
        *map(F.expr, named), F.expr(time).alias("_t"), F.expr("struct(*)").alias("_row"),
        none.cast(state).alias("_v"), F.lit(1).alias("_side"),
    )
    rights = right.select(
        *map(F.expr, named), F.expr(right_time).alias("_t"), none.cast(row).alias("_row"),
        F.expr(f"struct({', '.join(map(name, value))})").alias("_v"), F.lit(0).alias("_side"),
    )
    both = lefts.unionByName(rights.filter(known)).selectExpr("*", "to_date(_t) AS _day")
    edges = (
        both.filter(known)
        .groupBy(*columns, "_day")
        .agg(F.expr("max_by(_v, _t) FILTER (WHERE _side = 0) AS _edge"))
        .selectExpr(
            *columns, "_day",
            f"last(_edge, true) OVER (PARTITION BY {keys} ORDER BY _day "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _outer",
        )
    )
    return (
        both.selectExpr(
            "*",
            f"last(_v, true) OVER (PARTITION BY {keys}, _day ORDER BY _t, _side "
            "ROWS UNBOUNDED PRECEDING) AS _inner",
        )
        .filter("_side = 1")
        .join(edges, [*columns, "_day"], "left")
        .selectExpr(
            "_row.*", f"CASE WHEN {known} THEN coalesce(_inner, _outer) END AS {name(out)}"
        )
    )
