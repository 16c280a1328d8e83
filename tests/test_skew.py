"""One key holds half of all rows: results stay whole and plans stay split."""

from tallyloom.operators import anomaly, dims, facts, measures, quality


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=40_000):
    return spark.range(n).selectExpr(
        "IF(id % 2 = 0, 0L, id) AS k", "id AS v",
        "timestamp_micros(1704067200000000 + id * 7000000) AS ts",
        "CAST(floor(id / 3) % 2 AS INT) AS state",
    )


def test_dedupe_of_a_hot_key_is_an_aggregate(spark):
    df = facts.first_per_key(hot(spark), ["k"], "v")
    assert "Window" not in plan(df) and "partial_min" in plan(df)
    got = {r.k: r.v for r in df.filter("k < 10").collect()}
    assert got == {0: 0, 1: 1, 3: 3, 5: 5, 7: 7, 9: 9}


def test_versions_of_a_hot_key(spark):
    rows = hot(spark)
    got = dims.scd2_history(rows, ["k"], ["state"], "ts").filter("k = 0")
    # brute force: the even rows in order, cut where the state changes
    states = [(i // 3) % 2 for i in range(0, 40_000, 2)]
    want = 1 + sum(a != b for a, b in zip(states, states[1:]))
    assert got.count() == want
    assert got.filter("is_current = 1").count() == 1
    gaps = got.selectExpr(
        "effective_to", "lead(effective_from) OVER (ORDER BY effective_from) AS next")
    assert gaps.filter("next IS NOT NULL AND next <> effective_to").count() == 0


def test_statistics_with_a_hot_value(spark):
    df = spark.range(30_001).selectExpr("IF(id % 3 = 0, 0D, CAST(id AS DOUBLE)) AS x")
    got = anomaly.with_modified_z(df, "x").filter("x = 20000").first()
    x = sorted(0.0 if i % 3 == 0 else float(i) for i in range(30_001))
    med = x[15_000]
    mad = sorted(abs(v - med) for v in x)[15_000]
    assert abs(got.z_x - 0.6745 * (20000 - med) / mad) < 1e-9


def test_no_cross_joins_and_no_unbounded_windows(spark):
    daily = spark.range(100).selectExpr(
        "20240101 + CAST(id % 28 AS INT) AS date_key", "id AS account_key",
        "id / 200 AS acceptance_rate", "id / 300 AS reply_rate",
        "id / 100 AS invite_utilization", "id / 150 AS message_utilization",
        "id AS invites_accepted", "id AS replies_received", "id AS invites_sent")
    text = plan(anomaly.anomaly_scores(daily))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    orphans = plan(quality.check_fk(daily, "d", "account_key", daily, "account_key"))
    assert "NestedLoop" not in orphans
    fact = daily.selectExpr("date_key", "account_key", "'invite_sent' AS activity_type",
                            "0 AS is_converted", "NULL AS response_time_hours")
    rates = plan(measures.activity_measures(fact, ["date_key"]))
    assert "partial_count" in rates


def test_large_target_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(100_000).selectExpr("id AS k", "id AS v").write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.range(5).selectExpr("id AS k", "-id AS v")
    text = plan(facts.absent_from(batch, target, ["k"]))
    semi = text.index("LeftSemi")
    assert "BroadcastHashJoin" in text[:semi]
    scan = text[semi:].split("\n")
    assert not any("Exchange hashpartitioning" in line for line in scan[:4])
    assert facts.absent_from(batch, target, ["k"]).count() == 0


def test_date_filter_reaches_the_scan(spark, tmp_path):
    import datetime as dt

    from tallyloom.operators import kpis

    path = str(tmp_path / "fact")
    spark.range(100).selectExpr(
        "20240101 + CAST(id % 20 AS INT) AS date_key", "'invite_sent' AS activity_type",
        "0 AS is_converted", "CAST(NULL AS DOUBLE) AS response_time_hours", "id AS account_key",
    ).write.partitionBy("date_key").parquet(path)
    calendar = dims.dim_date(spark, 2024, 2024)
    df = kpis.core_kpis(spark.read.parquet(path), calendar, dt.date(2024, 1, 5),
                        dt.date(2024, 1, 6))
    text = plan(df)
    assert "PartitionFilters" in text and "date_key" in text.split("PartitionFilters")[1][:200]
    assert "account_key" not in text.split("ReadSchema")[1][:200]
    assert df.first().total_invites_sent == 10


def test_watermark_reaches_the_scan(spark, sf_dir):
    from tallyloom.plans.registry import QUERIES

    text = plan(QUERIES["scan_since_watermark"](spark, sf_dir))
    pushed = [line for line in text.split("\n") if "events.parquet" in line][0]
    assert "GreaterThan(ts,2024-01-15T00:00)" in pushed
    assert "props" not in pushed.split("ReadSchema")[1]


def test_foreign_keys_of_a_hot_child(spark):
    child = hot(spark).selectExpr("IF(k = 0, NULL, k) AS a", "k AS b")
    parent = spark.range(1, 100).selectExpr("id")
    both = quality.check_fks(child, "c", [("a", parent, "id"), ("b", parent, "id")])
    got = {r.check_name: (r.total_records, r.failed_records) for r in both.collect()}
    # 20,000 rows of key 0, and one row for every odd key below 40,000
    assert got == {"ri_c_a": (40_000, 19_950), "ri_c_b": (40_000, 39_950)}


def test_refresh_does_not_shuffle_the_fact(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(1000).selectExpr(
        "20240101 + CAST(id % 20 AS INT) AS date_key", "id % 3 AS account_key",
        "'invite_sent' AS activity_type", "0 AS is_converted",
    ).write.partitionBy("date_key").parquet(path)
    fact = spark.read.parquet(path)
    batch = spark.range(3).selectExpr("20240105 + CAST(id % 1 AS INT) AS date_key")
    accounts = spark.sql("SELECT 1L AS account_key, 9 AS daily_invite_limit, "
                         "9 AS daily_message_limit")
    fresh = facts.refresh_days(fact, batch, accounts)
    text = plan(fresh)
    semi = [i for i, line in enumerate(text.split("\n")) if "LeftSemi" in line]
    assert len(semi) == 1 and "BroadcastHashJoin" in text.split("\n")[semi[0]]
    below = text.split("\n")[semi[0] + 1:semi[0] + 4]
    assert not any("hashpartitioning" in line for line in below)
    assert {r.date_key for r in fresh.collect()} == {20240105}
