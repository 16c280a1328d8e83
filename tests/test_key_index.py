"""The index of loaded keys: what it reads, replays, and loads that died."""

import re

from tallyloom.sources.key_index import KeyIndex


def rows(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "activity_id string, n int")


def test_a_batch_reads_the_folders_of_its_own_hashes_only(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "activity_id", buckets=32)
    every = rows(spark, [f"k{i}" for i in range(400)])
    index.add(every)
    batch = rows(spark, ["k1", "k2", "new"])
    buckets = index.buckets_of(batch)
    assert 1 <= len(buckets) <= 3
    read = index.keys(buckets)
    folders = {re.search(r"bucket=(\d+)", f)[1] for f in read.selectExpr("input_file_name() AS f").distinct().toPandas().f}
    assert folders <= set(map(str, buckets))
    assert [r.activity_id for r in index.absent(batch).collect()] == ["new"]
    assert index.absent(every).collect() == []


def test_loads_and_a_load_that_died(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "activity_id", buckets=8)
    table = rows(spark, ["a", "b"])
    assert index.repair(table)  # no index yet: all keys of the table go in
    assert not index.repair(table)
    load = index.open()
    table = table.union(index.absent(rows(spark, ["b", "c"])))
    assert sorted(r.activity_id for r in table.collect()) == ["a", "b", "c"]  # dies before its keys are added
    again = KeyIndex(spark, str(tmp_path), "activity_id", buckets=8)
    assert again.repair(table) and not again.repair(table)
    assert again.absent(rows(spark, ["a", "b", "c"])).collect() == []
    load = again.open()
    again.add(rows(spark, ["d"]))
    again.close(load)
    assert sorted(r.activity_id for r in again.keys().collect()) == ["a", "b", "c", "d"]


def test_an_empty_batch_and_an_empty_index(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), "activity_id")
    assert index.absent(rows(spark, ["x"])).count() == 1
    assert index.absent(rows(spark, ["x"]).limit(0)).count() == 0
