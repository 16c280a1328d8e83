"""From raw documents to sharded training data: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows of `docs`; all but
the last return the columns of documents. Stages may run on any table with these
columns; rows with NULLs, repeated rows and empty tables pass through as each
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, language_id, mixing, near_dup, sharding
from tallyloom.llm.common import col, ship, table, written

#: A text whose language is less sure than this, or that has none, is rejected.
LEAST_SCORE = 0.25
SHARDS = 24
MIX_SEED = 20240501

#: Draws, tagged words and similarities can't be stated in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def _packed(docs: DataFrame, *needed: str) -> DataFrame:
    """`row`, a struct of all columns, and those that an operator needs: what it adds can't clash with a column of the input."""
    return docs.select(F.struct(*map(col, docs.columns)).alias("row"), *map(col, needed))


def _unpacked(found: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of `docs` back from `row`, but for changed ones."""
    return found.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language, which becomes their `lang`; letterless and hopelessly mixed ones go.

    Learned from the documents that have a `lang` already; without one nothing is known, and all go. NULL
    and empty texts go. Repeated rows are judged alike, an empty table stays empty, other columns pass as they are.
    """
    ship(spark)
    predicted = language_id.languages(_packed(docs, "text"), language_id.train(docs), spans=False)
    kept = predicted.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE))
    return _unpacked(kept, docs, lang=F.col("lang_pred"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates, that with the least doc_id.

    Of fully equal rows one stays. NULL texts all stay, texts without words are alike only if equal,
    an empty table stays empty, and other columns pass as they are.
    """
    ship(spark)
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark windows cover a twentieth of the words or more.

    NULL and empty texts have no words and stay; repeated rows go or stay together, other columns pass as they are.
    """
    judged = decontaminate.decontaminate(_packed(docs, "text"), table(spark, sf_dir, "benchmark"))
    return _unpacked(judged.where(~F.col("contaminated")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source at an equal share of as many rows as there are, shuffled globally.

    NULL is a source of its own. Rows of one doc_id, NULL included, share one draw of their number of
    copies. An empty table stays empty, other columns pass as they are.
    """
    mixed = mixing.mix(_packed(docs, "doc_id", "source"), mixing.equal_targets(docs), seed=MIX_SEED)
    return _unpacked(mixed, docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the `shard` of each row by its doc_id; rows of one doc_id, NULL included, share a shard. An own column `shard` is replaced."""
    return sharding.assign_shards(docs, [1.0] * SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
