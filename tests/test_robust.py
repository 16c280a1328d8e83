"""Exact statistics against brute force, scores against hand-worked values."""

import numpy as np
import pytest

from tallyloom.functions.robust import BUCKET, metric_values, robust_stats, value_ranges
from tallyloom.operators import anomaly


def frame(spark, values, group=None):
    rows = [(i, float(v), group[i] if group else "g") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id int, x double, g string")


def numpy_stats(x):
    x = np.asarray(x, float)
    median = np.median(x)
    return [len(x), np.percentile(x, 25), median, np.percentile(x, 75),
            np.median(np.abs(x - median))]


RNG = np.random.default_rng(7)
SAMPLES = {
    "one": [3.5],
    "two": [1.0, 2.0],
    "constant": [5.0] * 5,
    "signs": list(RNG.normal(0, 3, 501)),
    "even": list(RNG.normal(1e6, 10, 400)),
    "tail": list(np.exp(RNG.normal(0, 4, 333))),
    "atom": [0.0] * 200 + list(RNG.uniform(0, 1, 301)),
    "half_atom": [0.25] * 150 + list(RNG.uniform(-1, 1, 150)),
    "tiny": list(RNG.uniform(-1e-9, 1e-9, 64)),
    "grid": list(np.round(RNG.uniform(0, 2, 1000), 2)),
}


def test_grouped_statistics_equal_numpy(spark):
    values, group = [], []
    for name, x in SAMPLES.items():
        values += x
        group += [name] * len(x)
    df = frame(spark, values, group)
    stats = robust_stats(metric_values(df, ["g"], {"x": "x"}), ["g", "metric"], False)
    got = {r.g: [r.rows, r.q1, r["median"], r.q3, r.mad] for r in stats.collect()}
    assert set(got) == set(SAMPLES)
    for name, x in SAMPLES.items():
        np.testing.assert_allclose(got[name], numpy_stats(x), rtol=1e-12, atol=1e-18, err_msg=name)


HARD = {
    "band": 1.7e9 + np.arange(6_000),
    "below 1e-7": RNG.permutation(np.exp(RNG.uniform(-600, -17, 6_000))),
    "one decade": RNG.uniform(1, 10, 6_000),
    "two values": np.array([1.0, np.nextafter(1.0, 2)] * 3_000),
    "band with far ends": np.concatenate([1e6 + RNG.uniform(0, 1e-6, 5_998), [1e6 - 900, 1e6 + 900]]),
    "zeros and subnormals": np.concatenate([np.zeros(3_000), np.arange(3_000) * 5e-324]),
}


@pytest.mark.parametrize("pooled", [True, False])
@pytest.mark.parametrize("name", HARD)
def test_a_task_orders_few_values_wherever_they_lie(spark, name, pooled):
    """Equal to numpy with at most 300 of 6,000 values in the ranges that are put in order."""
    x = HARD[name]
    by = ["metric"] if pooled else ["g", "metric"]
    df = frame(spark, list(x), None if pooled else [None if i % 2 else "h" for i in range(len(x))])
    values = metric_values(df, by[:-1], {"x": "x"})
    placed = values.selectExpr("*", BUCKET)
    ranges = value_ranges(placed, by, pooled, most=300)
    within = ranges.filter("lo < hi").groupBy(*by).agg({"w": "sum"}).collect()
    assert all(r["sum(w)"] <= 300 for r in within)
    for r in robust_stats(values, by, pooled, most=300).collect():
        own = x if pooled else x[1::2] if r["g"] is None else x[::2]
        got = [r["rows"], r["q1"], r["median"], r["q3"], r["mad"]]
        np.testing.assert_allclose(got, numpy_stats(own), rtol=1e-12, atol=0, err_msg=name)


def test_pooled_statistics_of_two_metrics_with_null(spark):
    df = frame(spark, SAMPLES["signs"]).selectExpr(
        "x", "IF(x > 1, NULL, x * x) AS y"
    )
    stats = robust_stats(metric_values(df, [], {"x": "x", "y": "y"}), ["metric"], True)
    got = {r.metric: [r.rows, r.q1, r["median"], r.q3, r.mad] for r in stats.collect()}
    x = np.array(SAMPLES["signs"])
    np.testing.assert_allclose(got["x"], numpy_stats(x), rtol=1e-12)
    np.testing.assert_allclose(got["y"], numpy_stats(x[x <= 1] ** 2), rtol=1e-12)


@pytest.mark.parametrize(
    "values, want",
    [
        ([5.0] * 5, [0.0] * 5),
        ([10, 11, 9, 10, 12, 10, 11, 9, 10, 100], {9: 60.705, 4: 1.349}),
        ([10] * 10 + [100], {10: 0.0}),
    ],
)
def test_modified_z(spark, values, want):
    got = {r.id: r.z_x for r in anomaly.with_modified_z(frame(spark, values), "x").collect()}
    want = dict(enumerate(want)) if isinstance(want, list) else want
    for i, z in want.items():
        assert got[i] == pytest.approx(z)


def test_fences(spark):
    even = anomaly.with_iqr_flag(frame(spark, range(10, 16)), "x").collect()
    assert not any(r.iqr_outlier_x for r in even)
    one = {r.id: r.iqr_outlier_x
           for r in anomaly.with_iqr_flag(frame(spark, [10] * 10 + [100]), "x").collect()}
    assert one[10] == 1 and sum(one.values()) == 1


SNAPSHOT = ("date_key int, account_key bigint, acceptance_rate double, reply_rate double, "
            "invite_utilization double, message_utilization double, invites_sent bigint, "
            "invites_accepted bigint, messages_sent bigint, replies_received bigint")


def snapshots(spark, n=30, low=0):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        bad = i >= n - low
        rows.append((20240101 + i, 1, 0.02 if bad else float(rng.uniform(0.2, 0.35)),
                     0.01 if bad else float(rng.uniform(0.08, 0.2)),
                     float(rng.uniform(0.4, 0.8)), float(rng.uniform(0.3, 0.7)),
                     int(rng.integers(10, 20)), int(rng.integers(2, 6)),
                     int(rng.integers(10, 30)), int(rng.integers(1, 5))))
    return spark.createDataFrame(rows, SNAPSHOT)


def score_by_definition(pdf):
    """The composite from its definition, with numpy."""
    pdf = pdf.copy()
    pdf["ghost_rate"] = 1 - pdf.replies_received / pdf.invites_accepted
    total = 0
    for name, weight, bad in [("acceptance_rate", .3, -1), ("reply_rate", .25, -1),
                              ("invite_utilization", .2, 1), ("message_utilization", .15, 1),
                              ("ghost_rate", .1, 1)]:
        x = pdf[name].fillna(0).to_numpy(float)
        med = np.median(x)
        mad = np.median(np.abs(x - med))
        z = np.zeros(len(x)) if mad == 0 else bad * 0.6745 * (x - med) / mad
        total = total + np.clip(z, 0, None) * weight
    return total


def test_composite_score_and_injected_anomalies(spark):
    plain, injected = snapshots(spark), snapshots(spark, low=3)
    scored = anomaly.anomaly_scores(injected).toPandas().sort_values("date_key")
    want = score_by_definition(injected.toPandas().sort_values("date_key"))
    np.testing.assert_allclose(scored.anomaly_score, want, atol=6e-5)
    assert len(scored) == 30
    assert {"z_ghost_rate", "iqr_outlier_reply_rate", "risk_flag"} <= set(scored.columns)
    flagged = (scored.risk_flag != "Normal").sum()
    base = anomaly.anomaly_scores(plain).toPandas()
    assert flagged >= (base.risk_flag != "Normal").sum()
    top = scored.sort_values("anomaly_score").tail(3)
    assert set(top.date_key) == {20240128, 20240129, 20240130}


def test_few_rows_missing_metric_and_null(spark):
    few = anomaly.anomaly_scores(snapshots(spark, 4)).collect()
    assert {(r.anomaly_score, r.risk_flag) for r in few} == {(0.0, "Normal")}
    assert all(r.iqr_outlier_reply_rate is None and r.z_reply_rate == 0 for r in few)

    nulls = snapshots(spark, 20).selectExpr(
        *["CASE date_key % 4 WHEN 0 THEN NULL WHEN 1 THEN double('NaN') ELSE reply_rate END "
          "AS reply_rate" if c == "reply_rate" else c
          for c in snapshots(spark, 1).columns])
    got = anomaly.anomaly_scores(nulls).toPandas().sort_values("date_key")
    want = score_by_definition(nulls.toPandas().sort_values("date_key"))
    np.testing.assert_allclose(got.anomaly_score, want, atol=6e-5)

    part = snapshots(spark, 20).drop("reply_rate")
    got = anomaly.anomaly_scores(part).toPandas().sort_values("date_key")
    zs = got[[c for c in got if c.startswith("z_")]]
    weights = {"z_acceptance_rate": .3, "z_invite_utilization": .2,
               "z_message_utilization": .15, "z_ghost_rate": .1}
    want = sum(zs[c] * w for c, w in weights.items()) / 0.75
    np.testing.assert_allclose(got.anomaly_score, want, atol=2e-4)


def test_empty_and_flag_bounds(spark):
    assert anomaly.anomaly_scores(snapshots(spark, 1).limit(0)).count() == 0
    rows = spark.sql("SELECT explode(array(2.0D, 2.0001D, 3.5D, 3.5001D)) AS s")
    flags = [r.f for r in rows.selectExpr("s", f"{anomaly.risk_flag('s')} AS f")
             .orderBy("s").collect()]
    assert flags == ["Normal", "Warning", "Warning", "Critical"]


def test_scores_per_account_equal_each_account_alone(spark):
    a = snapshots(spark, 20, low=2)
    other = {"account_key": "2L", "acceptance_rate": "acceptance_rate * 2"}
    b = snapshots(spark, 25).selectExpr(*[f"{other.get(c, c)} AS {c}" for c in a.columns])
    both = a.unionByName(b)
    got = anomaly.anomaly_scores(both, partition_by=["account_key"]).toPandas()
    for key, alone in ((1, a), (2, b)):
        one = anomaly.anomaly_scores(alone).toPandas().sort_values("date_key")
        mine = got[got.account_key == key].sort_values("date_key")
        np.testing.assert_array_equal(mine.anomaly_score, one.anomaly_score)
