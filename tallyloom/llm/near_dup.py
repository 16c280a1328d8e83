"""Near-duplicates by DartMinHash signatures, a banded join and exact comparison.

Every element (word shingle) of a text owns a region as wide as its weight, and
hashed darts fall on the plane of weight and time: the same darts for every
text. Of the darts inside a text's regions, the earliest of each of `DARTS`
coordinates is its signature; two texts agree in a coordinate with a chance
equal to their weighted Jaccard similarity. Darts are thrown in bands of time
until every coordinate has one, so the work hardly depends on the number of
elements.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import exp, lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tallyloom.llm.common import col, fresh, slices, written
from tallyloom.llm.words import Words, mixed

SHINGLE = 5
THRESHOLD = 0.8
#: Coordinates of a signature, and how many of them make a band: 32 bands of 4.
DARTS, ROWS = 128, 4
BANDS = DARTS // ROWS
#: First band of time; each further band ends `GROWTH` times later.
FIRST_TIME, GROWTH = 0.25, 2**0.5
#: Coordinates of the finer signatures of texts in crowded buckets.
FINE_DARTS = 512
#: A pair is left out of the exact comparison if the share of equal coordinates is so many standard
#: deviations below the threshold; one true pair in 30,000 at the very threshold is lost by that.
SLACK = 4.0
#: Rounds in which texts are compared with their likeliest partner in another component only.
PARTNER_ROUNDS = 2
#: Buckets up to this size are compared in one task; larger ones in blocks of about this size.
BUCKET_ROWS = 4096
#: Node ids up to this number are broadcast (16 MB); more are joined by a shuffle.
BROADCAST_NODES = 2_000_000
SLICE_BYTES = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=256)
def _poisson(mean: float) -> np.ndarray:
    """Distribution function of a Poisson number, as far as 2^-60."""
    most = int(mean + 12 * mean**0.5 + 24)
    return np.cumsum([exp(k * log(mean) - mean - lgamma(k + 1)) for k in range(most)])


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(n: int, owner: np.ndarray, element: np.ndarray, weight: np.ndarray | None = None, darts: int = DARTS) -> np.ndarray:
    """The earliest dart of each coordinate (n x darts, uint64) of n texts.

    `owner` is the text of each element, `element` its hash, `weight` its weight
    (None: 1 each; equal elements of a text then count once). Texts without
    elements have a row of the largest number.
    """
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * darts, none)
    start, end, band = 0.0, FIRST_TIME, 0
    while len(owner):
        best = np.full(n * darts, none)
        layer, low, high = 0, 0.0, 1.0
        own, elements, w = owner, element, weight
        while len(own):
            cell = mixed(elements * _GOLDEN + np.uint64(band * 64 + layer + 1))
            count = np.searchsorted(_poisson((end - start) * (high - low)), _uniform(cell))
            which = np.repeat(np.arange(len(own)), count)
            number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            dart = mixed(mixed(cell[which] + (number.astype(np.uint64) + np.uint64(1)) * _GOLDEN))
            slot = own[which] * darts + (dart % np.uint64(darts)).astype(np.int64)
            inside = out[slot] == none
            if w is not None:
                inside &= low + (high - low) * _uniform(mixed(dart + _GOLDEN)) < w[which]
            np.minimum.at(best, slot[inside], dart[inside])
            if w is None:
                break
            layer, low, high = layer + 1, high, 2 * high
            wider = w > low
            own, elements, w = own[wider], elements[wider], w[wider]
        # Within a band of time the order of darts is that of their hashes; earlier bands come first.
        out = np.where(out == none, best, out)
        open_texts = (out.reshape(n, darts) == none).any(axis=1)
        left = open_texts[owner]
        owner, element, weight = owner[left], element[left], None if weight is None else weight[left]
        start, end, band = end, end * GROWTH, band + 1
    return out.reshape(n, darts)


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every shingle; a text of fewer than k words, but not none, is one shingle."""
    at, hashes = words.shingles(k)
    owner, n = words.doc[at], np.diff(words.first)
    for size in range(1, k):
        short = np.flatnonzero(n == size)
        if len(short):
            first, whole = words.shingles(size)
            own = np.isin(first, words.first[short])
            owner, hashes = np.concatenate([owner, words.doc[first[own]]]), np.concatenate([hashes, whole[own]])
    return owner, hashes


def weights(owner: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text with their counts."""
    order = np.lexsort((element, owner))
    owner, element = owner[order], element[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])])) if len(owner) else order
    return owner[first], element[first], np.diff(np.append(first, len(owner))).astype(float)


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash for each band of rows of a signature."""
    parts = signature.reshape(len(signature), signature.shape[1] // ROWS, ROWS)
    total = np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * _GOLDEN
    for j in range(ROWS):
        total = mixed(total ^ parts[:, :, j])
    return total.view(np.int64)


_SKETCH_ARROW = pa.schema([("node", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])


def sketches(texts: DataFrame, by_count: bool = False, shingle: int = SHINGLE, darts: int = DARTS) -> DataFrame:
    """(node, bands, sketch) for each distinct (node, text) with words; the sketch is a byte of each coordinate.

    `by_count` weighs shingles by how often they occur. A copy that follows in
    the same task is skipped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, node in enumerate(batch.column(0).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    new.append(i)
            if len(seen) > 100_000:
                seen.clear()
            batch = batch.take(pa.array(new, pa.int64()))
            nodes, at = batch.column(0), 0
            for part in slices(batch.column(1), SLICE_BYTES):
                words = Words(part)
                owner, element = shingles(words, shingle)
                w = None
                if by_count:
                    owner, element, w = weights(owner, element)
                signature = signatures(len(part), owner, element, w, darts)
                some = np.flatnonzero(np.diff(words.first))
                signature = signature[some]
                keys = bands(signature)
                low = (signature >> np.uint64(8)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        nodes.slice(at, len(part)).take(pa.array(some)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel())),
                        pa.array([r.tobytes() for r in low], pa.binary()),
                    ],
                    schema=_SKETCH_ARROW,
                )
                at += len(part)

    return texts.mapInArrow(run, "node long, bands array<long>, sketch binary").dropDuplicates(["node"])


def _agreement():
    """Equal bytes of two sketches."""

    @F.arrow_udf(IntegerType())
    def agreement(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.int32())
        x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint8).reshape(len(v), -1) for v in (a, b))
        return pa.array((x == y).sum(axis=1), pa.int32())

    return agreement


def _least(threshold: float, darts: int = DARTS) -> int:
    """Equal sketch bytes that a pair needs to be compared."""
    return int(darts * threshold - SLACK * (darts * threshold * (1 - threshold)) ** 0.5)


def jaccard(a: list[str], b: list[str], by_count: bool = False, shingle: int = SHINGLE) -> np.ndarray:
    """Exact similarity of pairs of texts: shared shingles over all, or with counts the sums of least over greatest."""
    n = len(a)
    words = Words(pa.array([*a, *b], pa.string()))
    owner, element, count = weights(*shingles(words, shingle))
    if not by_count:
        count = np.ones(len(count))
    total = np.bincount(owner, weights=count, minlength=2 * n)
    pair = owner % n
    order = np.lexsort((element, pair))
    pair, element, count = pair[order], element[order], count[order]
    both = np.flatnonzero((pair[1:] == pair[:-1]) & (element[1:] == element[:-1])) if len(pair) > 1 else np.zeros(0, np.int64)
    shared = np.bincount(pair[both], weights=np.minimum(count[both], count[both + 1]), minlength=n)
    union = total[:n] + total[n:] - shared
    return np.divide(shared, union, out=np.zeros(n), where=union > 0)


def _similarity(by_count: bool, shingle: int):
    @F.arrow_udf("double")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        out, at = [np.zeros(0)], 0
        for part in slices(a, SLICE_BYTES // 2):
            out.append(jaccard(part.to_pylist(), b.slice(at, len(part)).to_pylist(), by_count, shingle))
            at += len(part)
        return pa.array(np.concatenate(out))

    return similarity


def _estimated(pairs: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sketches agree enough."""
    one, two = (known.select(F.col("node").alias(x), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    both = pairs.join(one, "a").join(two, "b")
    return both.where(_agreement()("sketch_a", "sketch_b") >= _least(threshold)).select("a", "b")


def _small(df: DataFrame, n: int) -> DataFrame:
    """Broadcast a table of node ids whose checked size is small; larger ones are joined by a shuffle."""
    return F.broadcast(df) if n <= BROADCAST_NODES else df


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float, by_count: bool, shingle: int) -> DataFrame:
    """Pairs (a, b) whose texts are similar enough, compared exactly. `pairs` is a written table."""
    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")).join(_small(pairs, pairs.count()), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.where(_similarity(by_count, shingle)("text_a", "text_b") >= threshold).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each connected component, for nodes with an edge.

    Each round every node takes the least label among its neighbours' and its
    own, and then the label of its label, so long chains shrink by halves. Rounds
    are written tables; they end when no label changes.
    """
    both = written(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        mine = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = mine.join(jump, "label", "left").select("node", "old", F.least("label", "further").alias("label"))
        new = written(new, "labels")
        if new.where("label < old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


_PAIR_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("agree", pa.int64())])


def _bucket_pairs(
    bucket: np.ndarray, node: np.ndarray, label: np.ndarray, sketch: np.ndarray, side: np.ndarray, threshold: float, used: np.ndarray | None = None, band: np.ndarray | None = None
) -> np.ndarray:
    """(row, partner, agreement) of different labels in buckets (sorted by bucket) whose sketches agree enough.

    Where `side` is 0 the rows outside the bucket's largest label are compared with
    all of it, elsewhere the rows of side 1 with those of side 2. Without `band` only
    the likeliest partner of each row comes up. With it all pairs do, in the first of
    their common bands alone, so that a pair comes up once; the first `DARTS` bytes of
    the sketches decide which pairs the others are compared for.
    """
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    out = [np.zeros((0, 3), np.int64)]
    columns = sketch.T[:DARTS].copy()
    for s, e in zip(starts, np.append(starts[1:], len(bucket)), strict=True):
        names, place = np.unique(label[s:e], return_inverse=True)
        if side[s:e].any():
            others, facing = np.flatnonzero(side[s:e] == 1), np.flatnonzero(side[s:e] == 2)
        else:
            others, facing = np.flatnonzero(place != np.bincount(place).argmax()), np.arange(e - s)
        if not len(facing):
            continue
        shown = columns[:, s + facing]
        for i in range(0, len(others), 64):
            rows = others[i : i + 64]
            agree = np.zeros((len(rows), len(facing)), np.int16)
            for c, d in zip(columns, shown, strict=True):
                agree += c[s + rows][:, None] == d
            agree[place[rows][:, None] == place[facing]] = 0
            x, y = np.nonzero(agree >= _least(threshold))
            if band is None:
                best = agree.argmax(axis=1)
                x = np.flatnonzero(agree[np.arange(len(rows)), best] >= _least(threshold))
                y = best[x]
            else:
                chosen = [np.zeros(0, bool)]
                for k in range(0, len(x), 8192):
                    one, two = s + rows[x[k : k + 8192]], s + facing[y[k : k + 8192]]
                    here = np.left_shift(1, (band[one] == band[two]).argmax(axis=1)) == used[s]
                    here[here] = (sketch[one[here]] == sketch[two[here]]).sum(axis=1) >= _least(threshold, sketch.shape[1])
                    chosen.append(here)
                x, y = x[np.concatenate(chosen)], y[np.concatenate(chosen)]
            out.append(np.stack([node[s + rows[x]], node[s + facing[y]], agree[x, y]], axis=1))
    return np.concatenate(out)


def _compared(rows: DataFrame, threshold: float, blocks: bool = False) -> DataFrame:
    """Pairs (a, b) of different labels within the buckets of (bucket, node, label, sketch), with (used, bands) all pairs.

    With `blocks` the buckets are pairs of blocks with a `side`, and a row that is to
    get its likeliest partner only gets that of all its blocks.
    """
    every = "bands" in rows.columns
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(parts)
            bucket, node, label = (t.column(c).to_numpy() for c in ("bucket", "node", "label"))
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(t), -1)
            side = t.column("side").to_numpy() if blocks else np.zeros(len(t), np.int32)
            more = ()
            if every:
                more = t.column("used").to_numpy(), np.concatenate([c.flatten().to_numpy() for c in t.column("bands").chunks]).reshape(len(t), -1)
            found = _bucket_pairs(bucket, node, label, sketch, side, threshold, *more)
            if every or not blocks:
                found = np.unique(np.sort(found[:, :2], axis=1), axis=0)
            agree = found[:, 2] if found.shape[1] > 2 else np.zeros(len(found), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(agree)], schema=_PAIR_ARROW)

        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            cut = int(np.searchsorted(own, own[-1]))
            if cut:
                yield from flush([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from flush(held)

    found = dealt.mapInArrow(run, "a long, b long, agree long")
    if blocks and not every:
        found = found.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _facing(large: DataFrame, shown: DataFrame) -> DataFrame:
    """Rows of crowded buckets (bucket, used, node, label, n) with columns of `shown`, dealt to pairs of blocks.

    The rows outside a bucket's largest label are hashed into blocks of about
    `BUCKET_ROWS`, those of the largest label into further ones. Every block of the
    former faces itself, each later one of the former and all of the latter: all pairs
    of different labels, each in one task.
    """
    counts = large.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("m"))
    largest = counts.groupBy("bucket").agg(F.max_by("label", F.struct("m", "label")).alias("major"), F.max("m").alias("m"))
    salt = F.xxhash64("node", F.lit(BUCKET_ROWS))
    own = large.join(largest, "bucket").withColumns({"others": F.expr(f"CAST(ceil((n - m) / {BUCKET_ROWS}) AS LONG)"), "rest": F.expr(f"CAST(ceil(m / {BUCKET_ROWS}) AS LONG)")})
    own = own.withColumn("block", F.when(F.col("label") == F.col("major"), F.col("others") + F.pmod(salt, "rest")).otherwise(F.pmod(salt, "others")))
    last = F.when(F.col("label") == F.col("major"), F.col("others") - 1).otherwise(F.col("others") + F.col("rest") - 1)
    both = own.withColumn("last", last).join(shown, "node").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    key = F.xxhash64("bucket", F.least("block", "to"), F.greatest("block", "to"))
    side = F.when(F.col("block") == F.col("to"), 0).when(F.col("block") < F.col("to"), 1).otherwise(2)
    kept = [c for c in both.columns if c not in {"bucket", "n", "m", "major", "others", "rest", "block", "last", "to"}]
    return both.select(key.alias("bucket"), side.alias("side"), *kept)


def _across(active: DataFrame, labels: DataFrame, known: DataFrame, threshold: float, finer: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Pairs that share a bucket, are not in one component yet and whose sketches agree enough.

    `active` has (bucket, used, node), `used` the band of the bucket's key as a bit. Only
    buckets with several labels matter. One of more than `BUCKET_ROWS` rows is compared
    block by block in several tasks; none is left out. `finer` gives finer sketches for
    some nodes; without it only the likeliest partner of each row in a bucket counts.
    """
    rows = active.join(labels, "node", "left").select("bucket", "used", "node", F.coalesce("label", "node").alias("label"))
    rows = written(rows, "bucket-rows")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    rows = rows.join(sizes.where("lo <> hi").select("bucket", "n"), "bucket")
    columns = ["bucket", "node", "label", "sketch"]
    shown = known.select("node", "sketch")
    if finer:
        columns += ["used", "bands"]
        shown = finer(rows.select("node").distinct()).join(known.select("node", "bands"), "node")
    fit, large = rows.where(F.col("n") <= BUCKET_ROWS), rows.where(F.col("n") > BUCKET_ROWS)
    found = written(_compared(fit.join(shown, "node").select(*columns), threshold), "pairs")
    if large.isEmpty():
        return found
    blocks = _facing(large, shown).select(*columns, "side")
    return found.unionAll(written(_compared(blocks, threshold, blocks=True), "pairs")).distinct()


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, by_count: bool = False, shingle: int = SHINGLE) -> DataFrame:
    """(node, label) for distinct texts that are linked to another one; see `near_duplicates`."""
    texts = docs.select(F.xxhash64(col(text)).alias("node"), col(text).alias("text")).where(col(text).isNotNull())
    known = written(sketches(texts, by_count, shingle), "sketches")
    rows = known.select("node", F.posexplode("bands").alias("i", "bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    active = rows.join(buckets, "bucket").select("bucket", F.expr("shiftleft(1L, i)").alias("used"), "node", "least")
    active = written(active, "buckets")
    star = active.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    star = written(_estimated(star, known, threshold), "star")
    # Texts that may still be compared, copies once.
    wanted = written(active.select("node").distinct(), "wanted")
    picked = texts.join(_small(wanted, wanted.count()), "node", "left_semi")
    picked = written(picked.groupBy("node").agg(F.first("text").alias("text")), "texts")
    edges = written(_verified(star, picked, threshold, by_count, shingle), "links")
    labels = components(edges)
    buckets = active.select("bucket", "used", "node")

    def finer(nodes: DataFrame) -> DataFrame:
        return written(sketches(picked.join(nodes, "node", "left_semi"), by_count, shingle, FINE_DARTS).select("node", "sketch"), "fine")

    for last in (*[False] * PARTNER_ROUNDS, True):
        across = written(_across(buckets, labels, known, threshold, finer if last else None), "across")
        if across.isEmpty():
            break
        edges = written(edges.unionAll(_verified(across, picked, threshold, by_count, shingle)), "links")
        labels = components(edges)
    return labels


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, by_count: bool = False, shingle: int = SHINGLE
) -> DataFrame:
    """(key, node, class_id, class_size): one row for each row of `docs`.

    A class is a connected component of links: equal texts, and texts whose sets of
    word shingles (lower-cased words; `by_count`: with counts) have a Jaccard
    similarity of at least `threshold`. Its id is the least key in it. A text of
    fewer than `shingle` words is one shingle; a text without words links to equal
    texts only; a NULL text is a class of its own, with its own key as id.
    `node` is the 64-bit hash that stands for a distinct text.

    How it finds links: texts that share a band of the signature are in a bucket.
    First every text is compared with the least of each of its buckets, which
    joins most of a group of any size by links in proportion to its texts. Then,
    in buckets that still hold several components, each text is compared with
    its likeliest partner in another component, and at last all pairs across
    components are compared whose finer sketches agree enough. All links are exact.
    Keys may repeat or be NULL.
    """
    found = classes(docs, text, key, threshold, by_count, shingle)
    rows = docs.select(col(key).alias("key"), F.when(col(text).isNotNull(), F.xxhash64(col(text))).alias("node"))
    labelled = written(rows.join(found, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label")), "labelled")
    named = labelled.where("label IS NOT NULL")
    groups = named.groupBy("label").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    alone = labelled.where("label IS NULL").select("key", "node", F.col("key").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    out = named.join(groups, "label").select("key", "node", "class_id", "class_size").unionAll(alone)
    return out.select(F.col("key").alias(key), "node", "class_id", "class_size")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The rows of `docs` without near-duplicates: one row of each class stays, that with the least key.

    Among rows of one class and key the one with the least digest of all columns
    stays; of fully equal rows one. Rows with a NULL text all stay.
    """
    found = classes(docs, text, key, **settings)
    name, node, order = fresh(docs, "__label", "__node", "__order")
    digest = F.md5(F.to_json(F.struct(*map(col, docs.columns)), {"ignoreNullFields": "false"}).cast("binary"))
    marked = docs.withColumn(node, F.xxhash64(col(text))).withColumn(order, F.struct(col(key).isNull(), col(key), digest))
    labels = found.select(F.col("node").alias(node), F.col("label").alias(name))
    slim = marked.where(col(text).isNotNull()).select(node, order).join(labels, node, "left").select(F.coalesce(name, node).alias(name), order)
    best = written(slim.groupBy(name).agg(F.min(order).alias(order)).select(order), "kept")
    kept = marked.where(col(text).isNotNull()).join(best, order, "left_semi").dropDuplicates([order])
    return kept.unionByName(marked.where(col(text).isNull())).select(*map(col, docs.columns))
