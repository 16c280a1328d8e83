"""Source divergence audit: how the words of each source differ from those of its language and of other sources.

Terms are counted by 64-bit digests. Of each digest only the least and the greatest
term are kept; where they differ, several terms share the digest, and these are
counted again by their texts. Scores, ranks of sources and the choice of terms work
on digests alone; texts join the few terms that may be reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col, slices, written

# Fixed values of the contract.
#: A term is kept if at least so many documents of the language have it.
LEAST_DOCUMENTS = 10
#: Terms that are reported of each group.
TOP_TERMS = 10
SCALE = 1_000_000_000

#: Sources of a language whose pairs one task sums at once, and rows of terms' hash buckets.
BLOCK, BUCKETS = 256, 32
#: Parts in which a group's terms are ranked first.
_SALTS = 64
#: Bytes of text that are split in terms at once.
_SLICE = 8 << 20
#: Cells of a product that are held at once.
_CELLS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


class Terms:
    """The distinct terms of some texts and how often each (text, term) occurs."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, size = int(offsets[0]), int(offsets[-1] - offsets[0])
        lower = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[first : first + size]] if size else np.zeros(0, np.uint8)
        letter = _LETTER[lower]
        cut = np.zeros(size + 1, bool)
        cut[offsets - first] = True
        starts = np.flatnonzero(letter & (cut[:-1] | ~np.concatenate([[False], letter[:-1]])))
        ends = np.flatnonzero(letter & (cut[1:] | ~np.concatenate([letter[1:], [False]]))) + 1
        places = np.concatenate([[0], np.cumsum(ends - starts)])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places.astype(np.int64)), pa.py_buffer(lower[letter]))
        coded = words.dictionary_encode()
        self.terms: pa.Array = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets - first)))
        pairs, self.count = np.unique(text * max(1, len(self.terms)) + codes, return_counts=True)
        self.text, self.code = np.divmod(pairs, max(1, len(self.terms)))


def _counts(docs: DataFrame, bits: int, texts: bool) -> DataFrame:
    """Rows (group, digest, term, count, docs) of `docs` (group, text), summed within some megabytes.

    Without `texts` the terms come as rows of their own with a NULL group, each once;
    with it every row has its term.
    """
    mask = (1 << bits) - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(1), _SLICE):
                groups, own = np.unique(batch.column(0).slice(at, len(part)).to_numpy(zero_copy_only=False), return_inverse=True)
                at += len(part)
                found = Terms(part)
                n = len(found.terms)
                if not n:
                    continue
                digests = np.array([xxhash.xxh3_64_intdigest(t) & mask for t in found.terms.cast(pa.large_binary()).to_pylist()], np.uint64).view(np.int64)
                cells, where, times = np.unique(own[found.text] * n + found.code, return_inverse=True, return_counts=True)
                total = np.zeros(len(cells), np.int64)
                np.add.at(total, where, found.count)
                group, code = np.divmod(cells, n)
                terms = found.terms.cast(pa.string())
                rows = [pa.array(groups[group]), pa.array(digests[code]), terms.take(pa.array(code)) if texts else pa.nulls(len(cells), pa.string()), pa.array(total), pa.array(times.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(rows, ["group", "digest", "term", "count", "docs"])
                if not texts:
                    none = pa.array(np.zeros(n, np.int64))
                    yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.array(digests), terms, none, none], ["group", "digest", "term", "count", "docs"])

    return docs.select("group", "text").mapInArrow(count, "group long, digest long, term string, count long, docs long")


def _groups(docs: DataFrame) -> tuple[DataFrame, int]:
    """(group, language, lang, source, place) of each (lang, source), and the salt that keeps their digests apart.

    `place` numbers the sources of a language from 0.
    """
    own = written(docs.select("lang", "source").distinct(), "divergence-groups")
    for salt in range(1_000):
        keyed = own.select(F.xxhash64(F.lit(salt), "lang", "source").alias("group"), F.xxhash64(F.lit(salt), "lang").alias("language"), "lang", "source")
        n, groups, languages, named = keyed.agg(F.count("*"), F.count_distinct("group"), F.count_distinct("language"), F.count_distinct("lang")).first()
        if n == groups and languages == named:
            break
    numbered = keyed.withColumn("place", F.row_number().over(Window.partitionBy("language").orderBy("source")) - 1)
    return written(numbered, "divergence-groups"), salt


def term_counts(docs: DataFrame, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """((group, digest, twin, count, docs), (digest, twin, term)) of `docs` (group, text).

    (digest, twin) stands for one term: twin is 0 where a digest has one term only, and
    numbers the terms of a shared digest from 1. `bits` cuts digests, for tests.
    """
    sums = _counts(docs, bits, texts=False).groupBy("group", "digest")
    found = written(sums.agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"), F.min("term").alias("least"), F.max("term").alias("greatest")), "divergence-counts")
    counts = found.where("group IS NOT NULL").select("group", "digest", F.lit(0).alias("twin"), "count", "docs")
    terms = found.where("group IS NULL")
    shared = terms.where("least != greatest").select("digest")
    single = terms.where("least = greatest").select("digest", F.lit(0).alias("twin"), F.col("least").alias("term"))
    if shared.isEmpty():
        return counts, single
    again = _counts(docs, bits, texts=True).join(shared, "digest", "left_semi")
    exact = written(again.groupBy("group", "digest", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "divergence-twins")
    twins = exact.select("digest", "term").distinct().withColumn("twin", F.row_number().over(Window.partitionBy("digest").orderBy("term")))
    split = exact.join(twins, ["digest", "term"]).select("group", "digest", "twin", "count", "docs")
    alone = counts.join(shared, "digest", "left_anti").select("group", "digest", "twin", "count", "docs")
    return written(alone.unionByName(split), "divergence-split"), single.unionByName(twins.select("digest", "twin", "term"))


def _share(count: str, total: str, kept: str) -> str:
    """p of a term, as a long; the product doesn't fit one."""
    return f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0)) DIV CAST({total} + 2 * {kept} AS DECIMAL(20,0))"


def _differs(p: str, q: str) -> str:
    return f"({p} - {q}) * ({p} - {q}) DIV ({p} + {q})"


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Block:
    """Sums over terms of f(p_i, p_j) - f(p_i of an absent term, p_j of an absent term) for the sources of one or two blocks."""

    def __init__(self, absent: np.ndarray):
        n = len(absent)
        self.absent, self.zero = absent, _f(absent[:, None], absent[None, :])
        self.one, self.both = np.zeros((n, n), np.int64), np.zeros(n * n, np.int64)

    def add(self, sizes: np.ndarray, at: np.ndarray, p: np.ndarray) -> None:
        """Terms with `sizes` sources each; at and p: these sources and p there, term after term."""
        n = len(self.absent)
        # What a term adds where only source i has it; equal (i, p) add the same.
        same, times = np.unique(np.stack([at, p]), axis=1, return_counts=True)
        step = max(1, _CELLS // max(1, n))
        for k in range(0, len(times), step):
            i, q = same[0, k : k + step], same[1, k : k + step]
            np.add.at(self.one, i, (_f(q[:, None], self.absent[None, :]) - self.zero[i]) * times[k : k + step, None])
        # What it adds to that where both have it.
        first = np.cumsum(sizes) - sizes
        for size in np.unique(sizes[sizes > 1]):
            rows = first[sizes == size]
            step = max(1, _CELLS // int(size * size))
            for k in range(0, len(rows), step):
                where = rows[k : k + step, None] + np.arange(size)
                i, q = at[where], p[where]
                x, y, a, b = q[:, :, None], q[:, None, :], self.absent[i][:, :, None], self.absent[i][:, None, :]
                np.add.at(self.both, (i[:, :, None] * n + i[:, None, :]).ravel(), (_f(x, y) - _f(x, b) - _f(a, y) + _f(a, b)).ravel())

    def sums(self) -> np.ndarray:
        return self.one + self.one.T + self.both.reshape(self.one.shape)


def _pair_sums(terms: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(language, i, j, extra) for i < j, places of sources: the sum over kept terms that i or j has of f minus f of an absent term.

    terms: (language, digest, twin, places: array of (place, p)), a row for each kept term; groups: (language, place, absent).
    Sources are taken in blocks, and for each two blocks the terms in hash buckets; ahead of each
    bucket a row brings p of absent terms.
    """
    blocks = groups.groupBy("language", F.expr(f"place DIV {block}").alias("block")).agg(F.array_sort(F.collect_list(F.struct("place", F.col("absent").alias("p")))).alias("places"))
    a, b = (blocks.select("language", F.col("block").alias(x), F.col("places").alias(f"of_{x}")) for x in "ab")
    tiles = a.join(b, "language").where("a <= b").select("language", "a", "b", F.when(F.expr("a = b"), F.col("of_a")).otherwise(F.concat("of_a", "of_b")).alias("places"))
    heads = tiles.select("*", F.explode(F.sequence(F.lit(0), F.lit(BUCKETS - 1))).alias("bucket"), F.lit(0).alias("kind"))
    own = terms.select("language", "places", F.expr(f"CAST(pmod(digest, {BUCKETS}) AS INT)").alias("bucket"), F.expr(f"array_distinct(transform(places, x -> x.place DIV {block}))").alias("blocks"))
    last = groups.groupBy("language").agg(F.max(F.expr(f"place DIV {block}")).alias("last"))
    # A term goes to every two blocks of which one has it.
    spread = own.join(last, "language").select("*", F.explode("blocks").alias("here")).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("there"))
    spread = spread.where(~F.array_contains("blocks", F.col("there")) | (F.col("here") <= F.col("there")))
    rows = spread.select("language", F.least("here", "there").alias("a"), F.greatest("here", "there").alias("b"), "bucket", "places").select(
        "language", "a", "b", "bucket", F.lit(1).alias("kind"), F.expr(f"filter(places, x -> x.place DIV {block} IN (a, b))").alias("places")
    )
    dealt = heads.select("language", "a", "b", "bucket", "kind", "places").unionByName(rows).repartition("language", "a", "b", "bucket").sortWithinPartitions("language", "a", "b", "bucket", "kind")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, places = None, None, np.zeros(0, np.int64)

        def result() -> Iterator[pa.RecordBatch]:
            if held is not None:
                total = np.triu(held.sums(), 1)
                if key[1] != key[2]:  # the pairs within each block are summed where both blocks are that one
                    total *= (places[:, None] // block) != (places[None, :] // block)
                i, j = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), key[0])), pa.array(places[i]), pa.array(places[j]), pa.array(total[i, j])], ["language", "i", "j", "extra"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tile = np.stack([batch.column(c).to_numpy() for c in (0, 1, 2)])
            kind = batch.column(4).to_numpy()
            lists = batch.column(5)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            place, p = flat.field("place").to_numpy().astype(np.int64), flat.field("p").to_numpy()
            first = np.concatenate([[0], np.cumsum(sizes)])
            new = np.flatnonzero((kind == 0) | np.concatenate([[True], (tile[:, 1:] != tile[:, :-1]).any(axis=0)]))
            for start, end in zip(new, [*new[1:], batch.num_rows], strict=True):
                if kind[start] == 0:
                    if key != (k := tuple(tile[:, start].tolist())):
                        yield from result()
                        places, absent = place[first[start] : first[start + 1]], p[first[start] : first[start + 1]]
                        key, held = k, Block(absent)
                    start += 1
                if start < end:
                    cells = slice(first[start], first[end])
                    held.add(sizes[start:end], np.searchsorted(places, place[cells]), p[cells])
        yield from result()

    return dealt.mapInArrow(add, "language long, i long, j long, extra long")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, bits: int = 64, block: int = BLOCK) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each (lang, source) that occurs.

    Part `pair`: each other source of the language and the summed difference of all kept terms' shares.
    Part `term`: the `top` kept terms whose share is above the language's, by the difference. Ranks
    count from 1 by falling value, then by the item's bytes. NULL text, lang and source are read as
    empty texts; repeated rows are documents of their own; an empty table gives no rows; other columns
    don't matter. `bits` cuts digests and `block` sets how many sources are compared at once, for tests.
    """
    named = docs.select(*(F.coalesce(col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))))
    groups, salt = _groups(named)
    counts, terms = term_counts(named.select(F.xxhash64(F.lit(salt), "lang", "source").alias("group"), "text"), bits)
    per = counts.join(groups.select("group", "language"), "group")
    kept = per.groupBy("language", "digest", "twin").agg(F.sum("count").alias("of_language"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    own = written(per.drop("docs").join(kept, ["language", "digest", "twin"]), "divergence-kept")

    # Every language's kept terms and every group's total, also where there are none.
    vocabulary = own.select("language", "digest", "twin", "of_language").distinct().groupBy("language").agg(F.count("*").alias("kept"), F.sum("of_language").alias("language_total"))
    totals = own.groupBy("group").agg(F.sum("count").alias("total"))
    sized = groups.join(vocabulary, "language", "left").join(totals, "group", "left").fillna(0, ["kept", "language_total", "total"])
    sized = written(sized.withColumn("absent", F.when(F.col("kept") > 0, F.expr(_share("0L", "total", "kept"))).otherwise(F.lit(1).cast("bigint"))), "divergence-groups")
    shares = own.join(sized.select("group", "place", "kept", "total", "language_total"), "group").select(
        "group", "language", "digest", "twin", "place", F.expr(_share("count", "total", "kept")).alias("p"), F.expr(_share("of_language", "language_total", "kept")).alias("q")
    )

    # Terms: the best of each part of a group, ties included; then their texts, then the best of the group.
    above = shares.where("p > q").select("group", "digest", "twin", F.expr(_differs("p", "q")).alias("value"))
    ranked = above.withColumn("salt", F.expr(f"pmod(digest, {_SALTS})"))
    ranked = ranked.withColumn("rank", F.rank().over(Window.partitionBy("group", "salt").orderBy(F.desc("value")))).where(F.col("rank") <= top)
    spelled = ranked.select("group", "digest", "twin", "value").join(terms, ["digest", "twin"])
    best = spelled.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(F.desc("value"), "term"))).where(F.col("rank") <= top)
    part_term = best.join(groups.select("group", "lang", "source"), "group").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    # Pairs: what two sources have if no term occurs in them, and what the terms in either add.
    arrays = shares.groupBy("language", "digest", "twin").agg(F.array_sort(F.collect_list(F.struct("place", "p"))).alias("places"))
    extra = _pair_sums(arrays, sized.select("language", "place", "absent"), block).groupBy("language", "i", "j").agg(F.sum("extra").alias("extra"))
    left = sized.select("language", "lang", "source", "kept", F.col("absent").alias("p"), F.col("place").alias("here"))
    blocks = sized.groupBy("language").agg(F.max(F.expr(f"place DIV {block}")).alias("last"))
    left = left.join(blocks, "language").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("block")).drop("last")
    right = sized.select("language", F.expr(f"place DIV {block}").alias("block"), F.col("source").alias("item"), F.col("absent").alias("q"), F.col("place").alias("there"))
    pairs = left.join(right, ["language", "block"]).where("here != there")
    pairs = pairs.withColumns({"i": F.least("here", "there").cast("bigint"), "j": F.greatest("here", "there").cast("bigint")}).join(extra, ["language", "i", "j"], "left")
    value = F.when(F.col("kept") > 0, F.col("kept") * F.expr(_differs("p", "q")) + F.coalesce("extra", F.lit(0))).otherwise(0)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    part_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("bigint").alias("value")).withColumn("rank", F.row_number().over(by_value))
    return part_pair.unionByName(part_term)
