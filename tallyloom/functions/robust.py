"""Exact quartiles, median and MAD at any size.

The built-in exact percentile keeps all distinct values of a group in one task.
Here a coarse histogram, a plain partial aggregate, first tells which narrow
value ranges can hold the wanted order statistics.  Ranges that still hold many
values are cut into slices of their observed width, level by level, until those
that are left hold at most a set number; only these values are put in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.sources.locations import work_folder

# Logarithmic buckets of both signs: 0.4 % wide, so their number per group
# depends on the range of a metric and not on its rows.
STEPS = 256
BUCKET = (
    "CAST(CASE WHEN value = 0 THEN 0 ELSE signum(value) * "
    f"least(ceil((ln(abs(value)) + 745) * {STEPS}), 1000000) END AS INT) AS bucket"
)
# Values of a group that one task may put in order, slices of a range at a
# level, and levels; a level parts at least the least from the greatest value.
MOST_VALUES = 200_000
SLICES = 1_024
LEVELS = 64

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def metric_values(df: DataFrame, by: list[str], metrics: dict[str, str]) -> DataFrame:
    """(by..., metric, value, n) for several metric expressions from one scan.

    With `by` the values are counted per group first, since the ranges of many
    groups are joined by shuffle.  Without, they stay as they are (n = 1): the
    few ranges are broadcast, and all values outside them are never moved.
    """
    pairs = ", ".join(f"'{name}', CAST({text} AS DOUBLE)" for name, text in metrics.items())
    rows = df.selectExpr(*by, f"stack({len(metrics)}, {pairs}) AS (metric, value)").filter(
        "value IS NOT NULL AND NOT isnan(value)"
    )
    if not by:
        return rows.selectExpr("*", "1L AS n")
    return rows.groupBy(*by, "metric", "value").agg(F.expr("count(*) AS n"))


def _first(p: float) -> str:
    return f"floor({p}D * (rows - 1))"


def _second(p: float) -> str:
    return f"ceil({p}D * (rows - 1))"


def _holds(p: float) -> str:
    """The bucket holds one of the two order statistics of the quantile."""
    return f"(before <= {_second(p)} AND through > {_first(p)})"


def _at(k: str, end: str, n: str, value: str) -> str:
    """The value whose run of `n` places up to `end` contains place k."""
    return f"max(CASE WHEN {end} - {n} <= {k} AND {k} < {end} THEN {value} END)"


def _narrowed(cells: DataFrame, by: list[str], parent: list[str]) -> DataFrame:
    """The cells of a histogram that can hold a wanted order statistic of the values or of the deviations.

    `cells` has w values in [lo, hi]; `base` values of the group come before the
    cell's parent, `mad_base` deviations surely before those of all cells with
    `mad_open`.  The median lies in [m_lo, m_hi], so the deviations in a cell lie
    in [near, far], and the MAD lies in [r_lo, r_hi], the medians of both bounds.
    """
    keys = ", ".join(by)

    def over(order: str = "") -> str:
        return f"OVER (PARTITION BY {keys}{' ORDER BY ' + order if order else ''})"

    inside = f"OVER (PARTITION BY {', '.join([*by, *parent])} ORDER BY lo)"
    open_w = "CASE WHEN mad_open THEN w ELSE 0 END"
    return (
        cells.selectExpr("*", f"base + sum(w) {inside} AS through")
        .selectExpr("*", "through - w AS before")
        .selectExpr(
            "*",
            f"min(CASE WHEN {_holds(0.5)} THEN lo END) {over()} AS m_lo",
            f"max(CASE WHEN {_holds(0.5)} THEN hi END) {over()} AS m_hi",
        )
        .selectExpr(
            "*",
            "greatest(0D, lo - m_hi, m_lo - hi) AS near",
            "greatest(hi - m_lo, m_hi - lo) AS far",
        )
        .selectExpr(
            "*",
            f"mad_base + sum({open_w}) {over('near')} AS n_near",
            f"mad_base + sum({open_w}) {over('far')} AS n_far",
        )
        .selectExpr(
            "*",
            f"min(CASE WHEN mad_open AND n_near > {_first(0.5)} THEN near END) {over()} AS r_lo",
            f"min(CASE WHEN mad_open AND n_far > {_second(0.5)} THEN far END) {over()} AS r_hi",
        )
        .selectExpr(
            *by, "bucket", "lo", "hi", "w", "rows", "before", "through",
            "mad_open AND far >= r_lo AND near <= r_hi AS in_mad",
            f"mad_base + sum(CASE WHEN mad_open AND far < r_lo THEN w ELSE 0 END) {over()} "
            "AS mad_before",
        )
        .filter(" OR ".join(["in_mad", *map(_holds, PROBS.values())]))
        .drop("through")
    )


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the shared folder."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _kept(ranges: DataFrame, bounded_groups: bool) -> DataFrame:
    """The ranges as a small table: local rows, or written where there may be many groups."""
    spark = ranges.sparkSession
    if bounded_groups:
        return spark.createDataFrame(ranges.collect(), ranges.schema)
    return stored(ranges, "ranges")


def _inside(
    placed: DataFrame, ranges: DataFrame, by: list[str], bounded_groups: bool
) -> DataFrame:
    """The values that lie in a range, with its columns.  A group may be NULL."""
    named = ranges.withColumnsRenamed({c: f"_at_{c}" for c in (*by, "bucket")})
    same = [f"{c} <=> _at_{c}" for c in (*by, "bucket")] + ["value BETWEEN lo AND hi"]
    joined = placed.join(F.broadcast(named) if bounded_groups else named, F.expr(" AND ".join(same)))
    return joined.drop(*[f"_at_{c}" for c in (*by, "bucket")])


def value_ranges(
    placed: DataFrame, by: list[str], bounded_groups: bool, most: int = MOST_VALUES
) -> DataFrame:
    """Ranges of values (with their bucket) that hold all wanted order statistics.

    Those of a group that hold different values hold at most `most` of them
    together.  `placed` has `by`, value, n and bucket.
    """
    sums = [*map(F.expr, ("sum(n) AS w", "min(value) AS lo", "max(value) AS hi"))]
    cells = (
        placed.groupBy(*by, "bucket")
        .agg(*sums)
        .selectExpr(
            "*", f"sum(w) OVER (PARTITION BY {', '.join(by)}) AS rows",
            "0L AS base", "0L AS mad_base", "true AS mad_open",
        )
    )
    ranges = _kept(_narrowed(cells, by, []), bounded_groups)
    for _ in range(LEVELS):
        largest = (
            ranges.filter("lo < hi").groupBy(*by).agg(F.expr("sum(w) AS w"))
            .agg(F.expr("max(w)")).first()[0]
        )
        if largest is None or largest <= most:
            break
        slice_ = (
            f"CASE WHEN lo < hi THEN CAST(floor((value / 2 - lo / 2) / (hi / 2 - lo / 2) * {SLICES}) "
            "AS INT) ELSE 0 END AS slice"
        )
        parent = {"lo": "from", "before": "base", "mad_before": "mad_base", "in_mad": "mad_open"}
        sliced = (
            _inside(placed, ranges, by, bounded_groups)
            .selectExpr("*", slice_)
            .drop("w", "hi")
            .withColumnsRenamed(parent)
        )
        cells = sliced.groupBy(
            *by, "bucket", "from", "slice", "rows", "base", "mad_base", "mad_open"
        ).agg(*sums)
        ranges = _kept(_narrowed(cells, by, ["bucket", "from"]), bounded_groups)
    return ranges


def robust_stats(
    values: DataFrame, by: list[str], bounded_groups: bool, most: int = MOST_VALUES
) -> DataFrame:
    """rows, q1, median, q3 and mad per group of `values` (`by`, value, n).

    Quantiles interpolate linearly between neighbouring order statistics.
    `bounded_groups` says that the number of groups is fixed by the query; the
    list of ranges is then short whatever the data, and is broadcast.  The ranges are
    computed at once (`value_ranges`); a task orders at most `most` values of a group.
    """
    keys = ", ".join(by)

    def over() -> str:
        return f"OVER (PARTITION BY {keys})"

    def quantile(p: float) -> str:
        a = f"{_at(_first(p), 'upto', 'n', 'value')} {over()}"
        b = f"{_at(_second(p), 'upto', 'n', 'value')} {over()}"
        return f"least({a} + ({b} - {a}) * ({p}D * (rows - 1) - {_first(p)}), {b})"

    placed = values.selectExpr("*", BUCKET)
    ranges = value_ranges(placed, by, bounded_groups, most).drop("w")
    known = ("rows", "before", "in_mad", "mad_before")
    ranked = (
        _inside(placed, ranges, by, bounded_groups)
        .groupBy(*by, "bucket", "lo", "value", *known)
        .agg(F.expr("sum(n) AS n"))
        .repartition(*by)
        .selectExpr(
            "*", f"before + sum(n) OVER (PARTITION BY {keys}, bucket, lo ORDER BY value) AS upto"
        )
        .selectExpr("*", *[f"{quantile(p)} AS {name}" for name, p in PROBS.items()])
        .selectExpr(
            "*", "abs(value - median) AS deviation", "CASE WHEN in_mad THEN n ELSE 0 END AS m"
        )
        .selectExpr(
            "*",
            f"mad_before + sum(m) OVER (PARTITION BY {keys} ORDER BY deviation "
            "ROWS UNBOUNDED PRECEDING) AS mad_end",
        )
    )
    return (
        ranked.groupBy(*by)
        .agg(
            *[F.expr(f"max({c}) AS {c}") for c in ("rows", *PROBS)],
            F.expr(f"{_at(_first(0.5), 'mad_end', 'm', 'deviation')} AS a"),
            F.expr(f"{_at(_second(0.5), 'mad_end', 'm', 'deviation')} AS b"),
        )
        .selectExpr(
            *by, "rows", *PROBS, f"a + (b - a) * (0.5D * (rows - 1) - {_first(0.5)}) AS mad"
        )
    )
