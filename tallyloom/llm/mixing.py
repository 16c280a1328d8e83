"""Mixing sources to target weights by Poisson replication and a global shuffle.

Native: everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh

#: A mean above this is drawn as a sum of independent draws with means up to it.
PART_MEAN = 16.0
#: P(X > 96) is below 1e-37 for a mean of 16, far below the step of a draw (2^-52).
PART_MOST = 96
#: Rows of the rate table up to which it is broadcast; beyond, the join is salted.
BROADCAST_SOURCES = 10_000
SALTS = 64
ROWS_PER_BUCKET = 10_000
BUCKETS_LEAST = 64


def equal_targets(docs: DataFrame, source: str = "source") -> DataFrame:
    """(source, weight) with one weight for every source present, NULL among them."""
    return docs.select(col(source).alias("source")).distinct().withColumn("weight", F.lit(1.0))


def repetition_rates(docs: DataFrame, targets: DataFrame, total: int | None = None, source: str = "source") -> DataFrame:
    """(source, rate): how often a document of each source is wanted on average.

    `targets` has (source, weight), one row for each source; weights need not
    sum to 1. A source's rate is its share of `total` rows (default: the row
    count) over its row count. Sources without rows take no share; sources
    without a target, or with a weight that is NULL or not positive, have rate 0.
    Counts cover all rows and are reduced before any shuffle.
    """
    counts = docs.groupBy(col(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    wanted = targets.select("source", F.when(F.col("weight") > 0, F.col("weight").cast("double")).alias("weight"))
    both = counts.alias("c").join(wanted.alias("t"), F.expr("c.source <=> t.source"), "left")
    both = both.select("c.source", "n", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = both.agg(F.sum("weight").alias("w"), F.sum("n").alias("rows")).first()
    rows = total if total is not None else (sums["rows"] or 0)
    share = F.col("weight") / F.lit(sums["w"] or 1.0)
    return both.select("source", (share * F.lit(float(rows)) / F.col("n")).alias("rate"))


def poisson_table(rates: DataFrame) -> DataFrame:
    """Add `parts` and the distribution function `cdf` (array, k from 0) of one part's draw."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int")
    mean = F.col("rate") / F.col("parts")
    first = F.exp(-F.col("mean"))
    state = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("cdf"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * F.col("mean") / k
        return F.struct(p.alias("p"), (s["sum"] + p).alias("sum"), F.concat(s["cdf"], F.array(s["sum"] + p)).alias("cdf"))

    steps = F.sequence(F.lit(1), F.lit(PART_MOST))
    return rates.withColumn("parts", parts).withColumn("mean", mean).withColumn("cdf", F.aggregate(steps, state, step)["cdf"])


def _bits(*parts: Column) -> Column:
    """52 bits of MD5 as a long."""
    text = F.concat_ws("/", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")


def mix(
    docs: DataFrame,
    targets: DataFrame,
    total: int | None = None,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Repeat each document a Poisson number of times and shuffle all copies globally.

    The count inverts the Poisson distribution function at a uniform number
    made from MD5 of (seed, key), so a document's count depends on its key and
    its source's rate alone, not on partitions or retries. Rows of the same key
    and source, NULL keys too, share a count. Adds `copy` (from 1) and
    `position` (from 0 without gaps): the order by MD5 of (seed, key, copy). Copies
    are dealt by that hash into buckets, counted to give each bucket its first
    position, and sorted inside, so no task depends on a source's size. Input
    columns named like new ones are replaced. An empty table gives an empty one.
    """
    base = [c for c in docs.columns if c.lower() not in {"copy", "position"}]
    row, k, s, n, order, bucket, offset, salt = fresh(
        docs.select(*map(col, base)), "__row", "__key", "__source", "__n", "__order", "__bucket", "__offset", "__salt"
    )
    rates = repetition_rates(docs, targets, total, source)
    many = rates.count()
    rates = poisson_table(rates).select(F.col("source").alias(s), "parts", "cdf", "rate")
    packed = docs.select(F.struct(*map(col, base)).alias(row), col(key).alias(k), col(source).alias("source"))
    same = packed["source"].eqNullSafe(rates[s])
    if many <= BROADCAST_SOURCES:
        joined = packed.join(F.broadcast(rates), same)
    else:
        packed = packed.withColumn(salt, F.pmod(F.xxhash64(k), F.lit(SALTS)).cast("int"))
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = packed.join(salted, packed["source"].eqNullSafe(salted[s]) & (packed[salt] == salted["salt"]))

    def draw(j: Column) -> Column:
        u = (_bits(F.lit(seed), F.col(k), j).cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.size(F.filter("cdf", lambda c: c <= u)).cast("bigint")

    drawn = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("parts")), draw), F.lit(0).cast("bigint"), lambda a, x: a + x)
    copies = joined.withColumn(n, drawn).where(F.col(n) > 0)
    copies = copies.select(row, k, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n))).alias("copy"))
    copies = copies.withColumn(order, _bits(F.lit(seed), F.lit("order"), F.col(k), F.col("copy")))
    size = docs.count() if total is None else total
    buckets = max(BUCKETS_LEAST, -(-size // ROWS_PER_BUCKET))
    # The bucket is the leading part of the order, so buckets in turn are the whole order.
    copies = copies.withColumn(bucket, F.floor(F.col(order) / F.lit((1 << 52) / buckets)).cast("bigint"))
    counts = copies.groupBy(bucket).agg(F.count(F.lit(1)).alias(offset))
    # One row per 10,000 output rows.
    running = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.withColumn(offset, F.sum(offset).over(running) - F.col(offset))
    inside = Window.partitionBy(bucket).orderBy(order, F.col(k).asc_nulls_first(), "copy")
    placed = copies.withColumn("position", F.row_number().over(inside).cast("bigint") - 1).join(offsets, bucket)
    return placed.select(*(F.col(row)[c].alias(c) for c in base), "copy", (F.col("position") + F.col(offset)).alias("position"))
