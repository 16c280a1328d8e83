"""Rendezvous hashing of record keys over weighted shards, by DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh, with_columns

#: Rows that one numbering task should hold at most, when keys are spread evenly.
ROWS_PER_BUCKET = 200_000
BUCKETS_LEAST = 16


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (its index in `weights`) that wins the draw for a key.

    Every shard draws u in (0, 1) from MD5 of "key/shard" and the smallest
    -ln(u) / weight wins, so a shard wins with a probability in proportion to
    its weight, and a draw never depends on the other shards: one more shard
    takes rows only into itself. A NULL key is the key "" with its own mark.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    name = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))

    def draw(s: Column) -> Column:
        digest = F.md5(F.concat(name, F.lit("/"), s.cast("string")).cast("binary"))
        bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
        return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52)))

    table = F.array(*(F.struct(F.lit(i).alias("s"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)))
    scored = F.transform(table, lambda x: F.struct((draw(x["s"]) / x["w"]).alias("score"), x["s"].alias("s")))
    return F.array_min(scored)["s"]


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    grown: Sequence[float] | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Add `shard`, and `grown_shard` for the weights `grown` where given.

    No shuffle. Equal keys, NULL keys included, share a shard; the other
    columns don't matter. Input columns named like the new ones are replaced.
    An empty table gives an empty one.
    """
    new = {"shard": rendezvous(col(key), weights)}
    if grown is not None:
        new["grown_shard"] = rendezvous(col(key), grown)
    return with_columns(docs, new)


def number_in_shards(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add `slot`, gapless from 0 inside every `shard`, for rows that have a `shard`.

    A shard is cut into hash buckets of its rows, as many as the row count asks
    for. Bucket counts give each bucket its offset, and rows are numbered inside
    their bucket, so no task holds a shard. `rows` is read more than once: pass
    a written table. Equal rows (in the columns `by`)
    are counted first and numbered together: a repeated row is one row with a
    count until its numbers are laid out. Order in a bucket is by `by`.
    """
    keep = ["shard", *by]
    bucket, copies, before, offset = fresh(rows.select(*map(col, keep)), "__bucket", "__copies", "__before", "__offset")
    distinct = rows.groupBy(*map(col, keep)).agg(F.count(F.lit(1)).alias(copies))
    n = rows.count()
    buckets = max(BUCKETS_LEAST, -(-n // ROWS_PER_BUCKET))
    digest = F.md5(F.concat_ws("/", *(F.coalesce(col(c).cast("string"), F.lit("")) for c in by)).cast("binary"))
    distinct = distinct.withColumn(bucket, (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int"))
    inside = Window.partitionBy("shard", bucket).orderBy(*(col(c).asc_nulls_first() for c in by))
    numbered = distinct.withColumn(before, F.sum(copies).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(copies))
    totals = distinct.groupBy("shard", bucket).agg(F.sum(copies).alias(offset))
    # One row per bucket of a shard: 24 shards of 100,000 buckets at 5e11 rows.
    ordered = Window.partitionBy("shard").orderBy(bucket)
    offsets = totals.withColumn(offset, F.sum(offset).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col(offset))
    first = F.col(offset) + F.col(before)
    return (
        numbered.join(offsets, ["shard", bucket])
        .withColumn("slot", F.explode(F.sequence(first, first + F.col(copies) - 1)))
        .select(*map(col, keep), "slot")
    )
