"""One registered query for each operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from public_tokenizers import path as vocabulary
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, divergence, language_id, mixing, near_dup, personal_data, quality_cascade, secrets, separators, sharding, token_files, url_filter, whitening
from tallyloom.llm.common import table, written

SHARDS = 24
MIX_SEED = 20240501
VOCABULARY = "byte_bpe_50k.json"
#: The end-of-text id of that vocabulary.
END_OF_TEXT = 50256


def op1_secret_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.train(docs))
    base = F.col("base_spans")
    counts = [secrets.of_kind(base, k).alias(f"n_{k}") for k in secrets.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.spelled(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spelled(F.col("secret_spans")).alias("spans"),
    )


def op2_seekable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, vocabulary(VOCABULARY), end_id=0)
    index = token_files.document_index(manifest)
    read = token_files.read_documents(index, digest_only=True)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source at an equal share of as many rows as there are."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.equal_targets(docs), seed=MIX_SEED)
    return mixed.select("doc_id", "source", "copy", "position")


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_cascade.quality(table(spark, sf_dir, "documents").select("doc_id", "text"), metrics=True)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    known = docs.where(fold != 2).select("doc_id", "text", "lang")
    predicted = language_id.languages(docs.select("doc_id", "text"), language_id.train(known), spans=False)
    return predicted.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = [1.0] * SHARDS
    sharded = sharding.assign_shards(docs, even, grown=[*even, 1.0])
    text = F.col("text").cast("binary")
    sized = sharded.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "grown_shard",
    )
    rows = written(sized, "op7")
    slots = sharding.number_in_shards(rows, ["doc_id", "size", "text_crc32", "law", "grown_shard"])
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat files of all documents, scanned for their ends; documents are named by their place in a file."""
    docs = table(spark, sf_dir, "documents")
    names = separators.write_flat_files(docs, vocabulary(VOCABULARY), END_OF_TEXT)
    found = written(separators.scan_blocks(names.where("ordinal = -1"), END_OF_TEXT), "op8-ends")
    lengths = separators.document_lengths(found)
    named = names.where("ordinal >= 0").select("part", "ordinal", "doc_id")
    return lengths.join(named, ["part", "ordinal"], "left").select("doc_id", "part", "ordinal", "start", "n_tokens", "complete")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dup.near_duplicates(docs).select("doc_id", "class_id", "class_size")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trees learn from the URLs that a rule decides and judge the others."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hit = url_filter.rule_for(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")), url_filter.RULES)
    labelled = pages.select("url", (hit["verdict"] == "block").cast("double").alias("label"))
    judged = url_filter.filter_urls(pages, url_filter.train(labelled))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find_personal_data(docs, personal_data.train(docs))
    base = F.col("base_spans")
    return found.select(
        "doc_id",
        *(secrets.of_kind(base, k).alias(f"n_{k}") for k in personal_data.KINDS),
        F.sha2(secrets.spelled(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spelled(F.col("personal_spans")).alias("spans"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fit list is all rows; one row for each vector and component."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.components(vectors, whitening.fit(vectors, "embedding"), "embedding", ["vec_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_tagger": op1_secret_tagger,
    "op2_seekable_tokens": op2_seekable_tokens,
    "op3_decontamination": op3_decontamination,
    "op4_poisson_mix": op4_poisson_mix,
    "op5_quality_cascade": op5_quality_cascade,
    "op6_language_id": op6_language_id,
    "op7_rendezvous_shards": op7_rendezvous_shards,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_url_filter": op10_url_filter,
    "op11_personal_data": op11_personal_data,
    "op12_source_divergence": op12_source_divergence,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op3_decontamination": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT item_id, least(13, len(w)) AS size, w[i : i + least(13, len(w)) - 1] AS win
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, i, size, w[i : i + size - 1] AS win FROM words, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
), hits AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON p.size = v.size AND p.win = v.win),
hit_words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, size)) AS t(j) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hits GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",
    "op4_poisson_mix": f"""
WITH rates AS (
  SELECT source, sum(count(*)) OVER () / CAST(count(*) OVER () AS DOUBLE) / count(*) AS rate FROM documents GROUP BY source
), split AS (SELECT source, rate, greatest(1, CAST(ceil(rate / 16) AS BIGINT)) AS parts FROM rates),
chances AS (
  SELECT source, parts, k, sum(exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM split, range(0, 97) AS g(k)
), draws AS (
  SELECT doc_id, d.source, part,
    (CAST('0x' || substr(md5('{MIX_SEED}/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || part), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496 AS u
  FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source, unnest(range(1, parts + 1)) AS p(part)
), counted AS (
  SELECT doc_id, w.source, count(c.k) AS n FROM draws w
  JOIN chances c ON w.source IS NOT DISTINCT FROM c.source AND c.cdf <= w.u GROUP BY ALL
), copies AS (SELECT doc_id, source, unnest(range(1, n + 1)) AS copy FROM counted)
SELECT doc_id, source, copy, row_number() OVER (ORDER BY
  substr(md5('{MIX_SEED}/order/' || coalesce(CAST(doc_id AS VARCHAR), '') || '/' || copy), 1, 13), doc_id, copy) - 1 AS position
FROM copies
""",
    "op12_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
kept AS (SELECT lang, term, count(*) AS n FROM docs GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM docs SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + CAST(1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // CAST(coalesce(s.total, 0) + 2 * v AS HUGEINT) AS BIGINT) AS p,
    1 + CAST(1000000000 * CAST(k.n + 2 AS HUGEINT) // CAST(l.total + 2 * v AS HUGEINT) AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN sums s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
""",
}
