"""The pipeline, stage by stage, and the registered queries with SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tallyloom.llm import queries
from tallyloom.llm.common import written


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    junk = docs.limit(1).select((F.col("doc_id") + 10**6).alias("doc_id"), F.lit("12345 !!! 678").alias("text"), "lang", "source", "n_chars")
    copy = docs.limit(1).withColumn("doc_id", F.col("doc_id") + 2 * 10**6)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(1)
    item = bench.select(F.lit(3 * 10**6).cast("bigint").alias("doc_id"), "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.length("text").cast("bigint").alias("n_chars"))
    docs = docs.unionByName(junk).unionByName(copy).unionByName(item)
    seen = {}
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, sf_dir), name)
        if name != "sharding":
            assert out.columns == docs.columns
        seen[name] = [r["doc_id"] for r in out.select("doc_id").collect()]
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert set(seen[name]) <= before
        docs = out
    assert 10**6 not in seen["language_id"] and 2 * 10**6 in seen["language_id"]
    assert 2 * 10**6 not in seen["near_dedup"] and 3 * 10**6 in seen["near_dedup"]
    assert 3 * 10**6 not in seen["decontamination"]
    assert len(set(seen["decontamination"])) == len(seen["decontamination"]) > 100
    assert sorted(seen["sharding"]) == sorted(seen["mixing"])
    assert docs.where("shard < 0 OR shard > 23").isEmpty()


def test_odd_rows_and_none(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            docs = written(stage(spark, docs, sf_dir), name)
        assert "shard" in docs.columns


def test_own_columns_pass_as_they_are(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for c in ("items", "position", "copy", "lang_pred", "n_words", "row", "a.b"):
        docs = docs.withColumn(c, F.lit(f"mine {c}"))
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns
        for c in docs.columns[5:]:
            assert [r[0] for r in out.select(f"`{c}`").distinct().collect()] == [f"mine {c}"], (name, c)
        docs = out


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_equal_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_have_a_row_for_each_input_row(spark, sf_dir, name):
    out = queries.QUERIES[name](spark, sf_dir)
    rows = out.count()
    if name.startswith("op12"):
        assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and rows
        return
    if name.startswith("op13"):
        vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        assert out.columns[:2] == ["vec_id", "component"] and rows == 32 * vectors.count()
        return
    pages = name.startswith("op10")
    n = spark.read.parquet(f"{sf_dir}/{'pages' if pages else 'documents'}.parquet").count()
    assert out.columns[0] == ("page_id" if pages else "doc_id")
    assert rows == n or name.startswith("op4") and 0.5 * n < rows < 1.5 * n


def test_languages_are_predicted_once(spark, odd_docs, sf_dir):
    """The filter on the language doesn't have its own copy of the prediction."""
    kept = P.identify_language(spark, odd_docs, sf_dir)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert not kept.isEmpty()
