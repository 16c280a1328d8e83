"""As-of joins, carried version keys and throughput over versions."""

import datetime as dt
import random

import pytest

from tallyloom.operators import dims, measures
from tallyloom.operators.asof import as_of


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


@pytest.mark.parametrize("kind", ["timestamp", "date"])
def test_as_of_equals_brute_force(spark, kind):
    r = random.Random(5)
    when = lambda: at(r.randint(1, 6), r.randint(0, 5) if kind == "timestamp" else 0)
    cut = (lambda t: t) if kind == "timestamp" else (lambda t: t and t.date())
    left = [(i, r.choice(["a", "b", "c", None]), r.choice([when(), None]) if i % 9 == 0 else when()) for i in range(300)]
    right = {(r.choice(["a", "b", None]), when()): i for i in range(60)}
    rights = [(k, cut(t), v) for (k, t), v in right.items()]
    lefts = [(i, k, cut(t)) for i, k, t in left]
    out = as_of(
        spark.createDataFrame(lefts, f"id int, `k.1` string, t {kind}").repartition(4),
        spark.createDataFrame(rights, f"`k.1` string, t {kind}, v int"),
        ["k.1"], "t", "t", ["v"], "found",
    )
    got = {x["id"]: x["found"] and x["found"]["v"] for x in out.collect()}
    for i, k, t in lefts:
        own = [(u, v) for q, u, v in rights if k is not None and t is not None and q == k and u <= t]
        assert got[i] == (max(own)[1] if own else None)
    assert len(got) == 300 and out.columns == ["id", "k.1", "t", "found"]


VERSION = "id string, tier string, t timestamp"


def history(spark, rows):
    return dims.scd2_history(spark.createDataFrame(rows, VERSION), ["id"], ["tier"], "t")


def test_a_version_keeps_its_key_when_a_late_change_moves_its_start(spark):
    old = history(spark, [("a", "x", at(1)), ("a", "y", at(10)), ("b", "x", at(3))])
    old = old.selectExpr("*", "CASE WHEN id = 'b' THEN 3L WHEN tier = 'x' THEN 1L ELSE 2L END AS key")
    late = spark.createDataFrame([("a", "y", at(5))], VERSION)
    merged = dims.scd2_merge(old.drop("key"), late, ["id"], ["tier"], "t")
    carried = dims.carried_keys(old, merged, ["id"], "key")
    keyed = dims.with_carried_keys(merged, carried, ["id"], "key")
    assert {(r.id, r.tier, r.effective_from, r.key) for r in keyed.collect()} == {
        ("a", "x", at(1), 1), ("a", "y", at(5), 2), ("b", "x", at(3), 3)}
    assert dims.moved_keys(carried, "key").collect() == []


def test_merged_versions_give_their_facts_to_the_first(spark):
    old = history(spark, [("a", "x", at(1)), ("a", "y", at(10)), ("a", "x", at(20))])
    old = old.selectExpr("*", "CASE day(effective_from) WHEN 1 THEN 7L WHEN 10 THEN 8L ELSE 9L END AS key")
    late = spark.createDataFrame([("a", "x", at(10)), ("a", "z", at(12))], VERSION)
    merged = dims.scd2_merge(old.drop("key"), late, ["id"], ["tier"], "t")
    carried = dims.carried_keys(old, merged, ["id"], "key")
    keyed = {(r.effective_from, r.key) for r in dims.with_carried_keys(merged, carried, ["id"], "key").collect()}
    assert keyed == {(at(1), 7), (at(12), None), (at(20), 9)}
    moved = dims.moved_keys(carried, "key")
    facts = spark.createDataFrame([(i, k) for i, k in enumerate([7, 8, 8, 9, 0, None])], "n int, key long")
    assert [r.key for r in dims.rekeyed(facts, moved, "key").orderBy("n").collect()] == [7, 7, 7, 9, 0, None]


def test_throughput_counts_the_limit_of_the_day_once(spark):
    accounts = spark.createDataFrame(
        [(1, "a", 10, at(5), 0), (2, "a", 30, at(10), 1), (3, "b", 20, at(1), 1)],
        "account_key long, account_id string, daily_invite_limit int, effective_from timestamp, is_current int",
    )
    daily = spark.createDataFrame(
        [(20240104, 1, 5), (20240109, 1, 4), (20240110, 1, 6), (20240110, 2, 9), (20240111, 1, 30), (20240110, 3, 1), (20240110, 77, 2)],
        "date_key int, account_key long, invites_sent long",
    )
    got = {r.date_key: (r.invites_sent, r.invite_capacity, r.invite_throughput) for r in measures.invite_throughput(daily, accounts, ["date_key"]).collect()}
    assert got == {20240104: (5, 10, 0.5), 20240109: (4, 10, 0.4), 20240110: (18, 50, 0.36), 20240111: (30, 30, 1.0)}
    (total,) = measures.invite_throughput(daily, accounts, []).collect()
    assert (total.invites_sent, total.invite_capacity) == (57, 100)
