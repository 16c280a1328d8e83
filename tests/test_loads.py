"""Merges, keys, versions, dedupe and streams on small inputs."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallyloom.operators import dims, facts, increment
from tallyloom.sources import testmart as tm
from tallyloom.streaming import daily_counts, ingest


def test_calendar(spark):
    days = {str(r.full_date): r for r in dims.dim_date(spark).collect()}
    assert len(days) == 1461
    leap = days["2024-02-29"]
    assert (leap.date_key, leap.day_name, leap.day_of_week, leap.quarter) == (
        20240229, "Thursday", 3, 1)
    # ISO week beside the calendar year
    assert (days["2024-12-30"].week_of_year, days["2024-12-30"].year) == (1, 2024)
    assert days["2027-01-02"].is_weekend == 1
    one = dims.dim_date(spark, 2024, 2024)
    again = facts.absent_from(dims.dim_date(spark, 2024, 2024), one, ["full_date"])
    assert one.count() == 366 and again.count() == 0


CAMPAIGN = "campaign_key bigint, campaign_id string, campaign_name string, status string"


def test_scd1_overwrites_and_keeps_keys(spark):
    target = spark.createDataFrame([(7, "c1", "old", "Active"), (9, "c2", "same", "Paused")],
                                   CAMPAIGN)
    updates = spark.createDataFrame(
        [("c1", "first", "x", 1), ("c1", "last", None, 2), ("c3", "new", "Active", 1),
         ("c4", "new", "Active", 1)],
        "campaign_id string, campaign_name string, status string, seq int")
    got = {r.campaign_id: r for r in dims.scd1_merge(
        target, updates, "campaign_id", "seq", "campaign_key").collect()}
    assert (got["c1"].campaign_key, got["c1"].campaign_name, got["c1"].status) == (7, "last", None)
    assert got["c2"].campaign_name == "same"
    assert sorted([got["c3"].campaign_key, got["c4"].campaign_key]) == [10, 11]


def test_scd1_into_empty_target_and_audit(spark):
    empty = spark.createDataFrame([], CAMPAIGN + ", created_at timestamp, updated_at timestamp")
    updates = spark.createDataFrame([("c1", "n")], "campaign_id string, campaign_name string")
    at = "TIMESTAMP '2024-01-01 00:00:00'"
    first = dims.scd1_merge(empty, updates, "campaign_id", "1", "campaign_key", at)
    row = first.first()
    assert row.campaign_key == 1 and row.created_at == row.updated_at
    later = dims.scd1_merge(first, updates, "campaign_id", "1", "campaign_key",
                            "TIMESTAMP '2024-01-02 00:00:00'").first()
    assert later.updated_at > later.created_at and later.campaign_key == 1


def test_templates(spark):
    records = spark.createDataFrame(
        [("t1", "Hello", "Hi {name}", None), ("t1", "Hello", "Hi {name}!", "Follow-Up"),
         ("t2", None, None, None)], "id string, name string, body string, type string")
    empty = spark.createDataFrame([], "template_key bigint, template_id string, "
                                      "template_name string, template_body string, "
                                      "template_type string")
    merged = dims.scd1_merge(empty, dims.to_dim_template(records), "template_id",
                             "template_type", "template_key")
    got = {r.template_id: (r.template_body, r.template_type) for r in merged.collect()}
    assert got == {"t1": ("Hi {name}!", "Follow-Up"), "t2": (None, "Connection")}


def test_keys_are_dense_and_repeatable(spark):
    new = spark.range(5000).selectExpr("concat('n', id) AS name")
    taken = spark.sql("SELECT 40L AS k")
    first = {r.name: r.k for r in dims.assign_keys(new, "name", "k", taken).collect()}
    assert sorted(first.values()) == list(range(41, 5041))
    again = dims.assign_keys(new.repartition(3, "name"), "name", "k", taken).collect()
    assert {r.name: r.k for r in again} == first


CHANGES = "id string, tier string, ts timestamp, seq int"


def brute_versions(rows):
    out = []
    for key in {r[0] for r in rows}:
        at = {}
        for _, tier, ts, seq in sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[3])):
            at[ts] = tier
        kept = []
        for ts in sorted(at):
            if not kept or kept[-1][0] != at[ts]:
                kept.append((at[ts], ts))
        for i, (tier, ts) in enumerate(kept):
            end = kept[i + 1][1] if i + 1 < len(kept) else dt.datetime(9999, 12, 31, 23, 59, 59)
            out.append((key, tier, ts, end, int(i + 1 == len(kept))))
    return sorted(out)


T0 = dt.datetime(2024, 1, 1)
change = st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.integers(0, 60))


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25))
def test_versions_equal_brute_force_in_one_or_two_batches(spark, changes):
    rows = [(k, tier, T0 + dt.timedelta(hours=7 * h), i)
            for i, (k, tier, h) in enumerate(changes)]
    args = ["id"], ["tier"], "ts", "seq"
    whole = dims.scd2_history(spark.createDataFrame(rows, CHANGES), *args)
    want = brute_versions(rows)
    assert sorted(tuple(r) for r in whole.collect()) == want
    cut = sorted(r[2] for r in rows)[len(rows) // 2]
    old = dims.scd2_history(
        spark.createDataFrame([r for r in rows if r[2] < cut], CHANGES), *args)
    new = spark.createDataFrame([r for r in rows if r[2] >= cut], CHANGES)
    merged = dims.scd2_merge(old, new, *args)
    assert sorted(tuple(r) for r in merged.collect()) == want


def test_replayed_change_alters_nothing(spark):
    rows = spark.createDataFrame([("a", "x", T0, 1), ("a", "y", T0 + dt.timedelta(days=40), 2)],
                                 CHANGES)
    args = ["id"], ["tier"], "ts", "seq"
    once = dims.scd2_history(rows, *args)
    twice = dims.scd2_merge(once, rows, *args)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert dims.current_versions(twice).first().tier == "y"


def test_first_write_wins_in_and_across_batches(spark):
    target = spark.sql("SELECT 'e1' AS k, 1 AS v")
    batch = spark.sql("SELECT * FROM VALUES ('e1', 9, 1), ('e2', 5, 2), ('e2', 4, 1), ('e3', 3, 1) "
                      "AS t(k, v, arrival)")
    got = facts.insert_facts(target, batch, ["k"], "arrival").collect()
    assert sorted((r.k, r.v) for r in got) == [("e2", 4), ("e3", 3)]


def test_event_time_from_text(spark):
    rows = spark.createDataFrame(
        [("2024-01-15T23:30:00-05:00", None), ("", "2024-01-16 01:00:00"), (None, None),
         ("soon", "2024-01-16"), ("2024-01-17", None)], "timestamp string, created_at string")
    got = [(r.date_key, r.event_time) for r in facts.with_event_time(rows).collect()]
    assert got[0] == (20240115, dt.datetime(2024, 1, 16, 4, 30))
    assert got[1][0] == 20240116 and got[2] == (None, None) and got[3] == (None, None)
    assert got[4][0] == 20240117


def test_watermark(spark):
    state = spark.createDataFrame([], "entity_name string, last_watermark timestamp, "
                                      "updated_at timestamp")
    at = "TIMESTAMP '2024-02-01 00:00:00'"
    batch = spark.sql("SELECT TIMESTAMP '2024-01-05 00:00:00' AS t")
    assert increment.read_watermark(state, "x") is None
    row = increment.advance(state, batch, "x", "t", at)
    state = increment.put_watermark(state, row)
    assert increment.read_watermark(state, "x") == "2024-01-05 00:00:00"
    older = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS t")
    assert increment.advance(state, older, "x", "t", at).isEmpty()
    assert increment.advance(state, older.limit(0), "x", "t", at).isEmpty()
    assert increment.scan_since(batch, "t", "2024-01-05 00:00:00").isEmpty()
    assert increment.scan_since(batch, "t", None).count() == 1


def test_dense_snapshot_fills_days(spark):
    fact = spark.sql("SELECT * FROM VALUES (20240130, 1L), (20240202, 1L), (20240101, 2L) "
                     "AS t(date_key, account_key)").selectExpr(
        "*", "'invite_sent' AS activity_type", "0 AS is_converted")
    accounts = spark.sql("SELECT 1L AS account_key, 10 AS daily_invite_limit, "
                         "20 AS daily_message_limit")
    got = {(r.date_key, r.account_key): (r.invites_sent, r.invite_utilization)
           for r in facts.daily_snapshot(fact, accounts, dense=True).collect()}
    assert got == {(20240130, 1): (1, .1), (20240131, 1): (0, 0.0), (20240201, 1): (0, 0.0),
                   (20240202, 1): (1, .1), (20240101, 2): (1, 0.0)}


def test_stream_takes_replays_and_late_files_once(spark, tmp_path):
    """Three files: most rows, the same rows again, then the oldest rows."""
    schema = "k string, date_key int, t timestamp, v int"
    rows = [(f"e{i}", 20240101 + i % 3, T0 + dt.timedelta(hours=i), i) for i in range(30)]
    src, fact, check = (str(tmp_path / p) for p in ("src", "fact", "check"))
    spark.createDataFrame(rows[5:], schema).coalesce(1).write.parquet(src)

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        ingest.ingest_stream(stream, fact, check, lambda df: df, ("k",), "t").awaitTermination()
        return sorted((r.k, r.v) for r in spark.read.parquet(fact).collect())

    assert len(run()) == 25
    changed = [(k, d, t, v + 100) for k, d, t, v in rows[5:]]
    spark.createDataFrame(changed, schema).coalesce(1).write.mode("append").parquet(src)
    assert len(run()) == 25
    spark.createDataFrame(rows[:5], schema).coalesce(1).write.mode("append").parquet(src)
    assert run() == sorted((k, v) for k, _, _, v in rows)


def test_stream_of_raw_records(spark, tmp_path):
    import json

    from tallyloom.sources.records import stream_records

    src, fact, check, bad = (str(tmp_path / p) for p in ("src", "fact", "check", "bad"))
    (tmp_path / "src").mkdir()
    accounts = spark.sql("SELECT 5L AS account_key, 'a1' AS account_id, 1 AS is_current")
    campaigns = spark.sql("SELECT 3L AS campaign_key, 'c1' AS campaign_id")
    leads = spark.sql("SELECT 8L AS lead_key, 'l1' AS lead_id")

    def deliver(name, rows):
        (tmp_path / "src" / name).write_text("\n".join(json.dumps(r) for r in rows))
        ingest.ingest_records(
            stream_records(spark, src, "activity"), fact, check, bad, accounts, campaigns, leads,
            "unit", "r1", "TIMESTAMP '2024-01-01 00:00:00'",
        ).awaitTermination()

    good = {"id": "e1", "timestamp": "2024-01-05T01:00:00", "agent_id": "a1", "lead_id": "l1",
            "campaign_id": "c1", "type": "invite_sent"}
    deliver("1.json", [good, {**good, "id": "e2", "agent_id": "zz"}, {"id": "e3"}])
    deliver("2.json", [good, {**good, "id": "e4", "lead_id": None}])
    rows = {r.activity_id: (r.account_key, r.campaign_key, r.lead_key)
            for r in spark.read.parquet(fact).collect()}
    assert rows == {"e1": (5, 3, 8), "e4": (5, 3, None)}
    letters = {r.error_message for r in spark.read.parquet(bad).collect()}
    assert letters == {"unknown account", "missing or unreadable time"}


def test_streamed_counts_equal_batch(spark, sf_dir):
    t = tm.TestTables(spark, sf_dir)
    batch = tm.daily(t)
    stream = daily_counts.replay(spark, sf_dir)
    columns = stream.columns
    assert sorted(map(tuple, stream.collect())) == sorted(
        map(tuple, batch.select(*columns).collect()))


def test_streams_count_late_events_of_a_folder_of_part_files(spark, sf_dir, tmp_path):
    """Part files in reverse order of time, each a micro-batch, and one file twice."""
    t = tm.TestTables(spark, sf_dir)
    for name in ("nation", "customer"):
        getattr(t, name).write.parquet(f"{tmp_path}/{name}.parquet")
    events = t.events
    events.sort(events["ts"].desc()).coalesce(1).write.option("maxRecordsPerFile", 300).parquet(
        f"{tmp_path}/events.parquet")
    events.limit(50).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    source, to_fact = tm.event_stream(spark, str(tmp_path))
    wanted = tm.daily(tm.TestTables(spark, sf_dir))
    one = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1)
    source = one.parquet(f"{tmp_path}/[e]vents.parquet")
    query = daily_counts.start(
        source, to_fact, f"{tmp_path}/f", f"{tmp_path}/counts", f"{tmp_path}/check")
    query.awaitTermination()
    for counts in (daily_counts.latest(spark, f"{tmp_path}/counts"),
                   daily_counts.replay(spark, str(tmp_path))):
        assert sorted(map(tuple, counts.collect())) == sorted(
            map(tuple, wanted.select(*counts.columns).collect()))
