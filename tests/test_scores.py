"""Scores of the snapshot from the merged values of its days."""

import random
from pathlib import Path

from tallyloom.operators import anomaly
from tallyloom.schemas import TABLES
from tallyloom.sources.tables import MartTables

DAYS = [20240101, 20240102, 20240103]
COUNTS = ("invites_sent", "invites_accepted", "messages_sent", "replies_received", "follow_ups_sent", "conversions")


def snapshot(spark, days, seed, accounts=40):
    """Rows of some days, with NULL, NaN and repeated rates."""
    rng = random.Random(seed)
    rate = lambda: rng.choice([None, float("nan"), 0.0, 0.5, rng.random()])
    rows = [
        (d, a, *(rng.randrange(9) for _ in COUNTS), *(rate() for _ in range(5)), None, None)
        for d in days for a in range(accounts)
    ]
    return spark.createDataFrame(rows, TABLES["fact_daily"])


def scores(df):
    return sorted((r.date_key, r.account_key, r.anomaly_score, r.risk_flag) for r in df.collect())


def files(mart, name):
    return {str(p) for p in Path(mart.path(name)).rglob("date_key=*/*.parquet")}


def test_scores_over_loads_equal_those_of_the_whole(spark, tmp_path):
    mart = MartTables(spark, str(tmp_path))
    mart.init()
    assert mart.read("fact_daily").count() == 0
    mart.put_days(snapshot(spark, DAYS[:2], 1))
    before = {t: (mart.path(t), files(mart, t)) for t in ("fact_daily", "metric_days")}
    whole = snapshot(spark, DAYS[:1], 1).unionByName(snapshot(spark, DAYS[1:], 2))
    mart.put_days(snapshot(spark, DAYS[1:], 2))
    expected = scores(anomaly.anomaly_scores(whole))
    assert scores(mart.read("fact_daily")) == expected and len({s for *_, s, _ in expected}) > 9
    # Only the touched days are written again.
    for table, (path, old) in before.items():
        kept = {f for f in old if f"date_key={DAYS[0]}" in f}
        assert mart.path(table) == path and kept and files(mart, table) & old == kept
    mart.put_days(snapshot(spark, DAYS[1:], 2))
    assert scores(mart.read("fact_daily")) == expected


def test_reading_scores_shuffles_no_rows_of_the_snapshot(spark, tmp_path):
    mart = MartTables(spark, str(tmp_path))
    mart.init()
    mart.put_days(snapshot(spark, DAYS, 3))
    plan = mart.read("fact_daily")._jdf.queryExecution().executedPlan().toString()
    # Lines of subqueries, which hold the statistics, start with a colon.
    main = "\n".join(x for x in plan.splitlines() if not x.strip().startswith(":"))
    assert "FileScan" in main and "Exchange" not in main and "Window" not in main


def test_few_rows_and_none_score_zero(spark, tmp_path):
    mart = MartTables(spark, str(tmp_path))
    mart.init()
    mart.put_days(snapshot(spark, [], 4))
    assert mart.read("fact_daily").count() == 0
    mart.put_days(snapshot(spark, DAYS[:1], 4, accounts=4))
    assert {(s, f) for *_, s, f in scores(mart.read("fact_daily"))} == {(0.0, "Normal")}


def test_a_mart_without_counted_days_counts_them_once(spark, tmp_path):
    mart = MartTables(spark, str(tmp_path))
    old = snapshot(spark, DAYS[:2], 5)
    mart.publish("fact_daily", anomaly.anomaly_scores(old))
    mart.init()
    assert scores(mart.read("fact_daily")) == scores(anomaly.anomaly_scores(old))
    mart.put_days(snapshot(spark, DAYS[2:], 6))
    whole = old.unionByName(snapshot(spark, DAYS[2:], 6))
    assert scores(mart.read("fact_daily")) == scores(anomaly.anomaly_scores(whole))


def test_rows_of_a_large_group_are_not_dealt_by_group(spark, monkeypatch):
    """Few groups' statistics are broadcast whatever Spark's own limit; more are joined as a stored table. Groups may be NULL."""
    rows = [(i, None if i % 50 == 0 else "a" if i % 10 else "b", float(i * i % 101)) for i in range(2000)]
    df = spark.createDataFrame(rows, "i long, flag string, x double")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = anomaly.with_iqr_flag(df, "x", 0.2, ["flag"], out="hit")
        assert "SortMergeJoin" not in few._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(anomaly, "BROADCAST_GROUPS", 1)
        many = anomaly.with_iqr_flag(df, "x", 0.2, ["flag"], out="hit")
        plan = many._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Aggregate" not in plan
        found = sorted(map(tuple, few.collect()), key=lambda r: r[0])
        assert found == sorted(map(tuple, many.collect()), key=lambda r: r[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r[3] for r in found} == {0, 1} and len(found) == 2000
