"""The streamed activity load with its ledger, and records that the schema doesn't hold."""

import datetime as dt
import json

import pytest

from tallyloom.plans import daily_run
from tallyloom.sources.key_index import KeyIndex
from tallyloom.sources.records import read_records, stream_records
from tallyloom.sources.tables import MartTables
from tallyloom.streaming.mart_load import load_stream
from tests.test_daily_run import ACCOUNTS, ACTIVITIES, CAMPAIGNS, LEADS, act, lines

NOW = dt.datetime(2024, 1, 16, 6)
BROKEN = '{"id": "e20", "timestamp": '
UNKNOWN = json.dumps({**act("e21", 12, account="nobody"), "extra": [1, 2]})
MISTYPED = json.dumps({**act("e22", 12, account="nobody"), "response_time_hours": "soon"})


def test_lines_that_the_schema_does_not_hold_are_kept(spark, tmp_path):
    whole = json.dumps(act("e1", 10, response_time_hours=2))
    text = [whole, "", "  ", BROKEN, UNKNOWN, MISTYPED, "5", "no json"]
    (tmp_path / "a.json").write_text("\n".join(text))
    rows = read_records(spark, str(tmp_path), "activity").collect()
    assert sorted(r.raw_record or "" for r in rows) == sorted(
        ["", BROKEN, UNKNOWN, MISTYPED, "5", "no json"])
    by_id = {r.id: r for r in rows}
    assert by_id["e1"].response_time_hours == 2.0 and by_id["e1"].raw_record is None
    assert by_id["e21"].agent_id == "nobody" and by_id["e22"].response_time_hours is None


class Killed(Exception):
    pass


class FragileMart(MartTables):
    """Dies before its n-th write."""

    def __init__(self, spark, root, left):
        super().__init__(spark, root)
        self.left = [left]  # shared by copies of the mart in other sessions

    def _write(self, name, df, path, *mode):
        self.left[0] -= 1
        if self.left[0] < 0:
            raise Killed(name)
        super()._write(name, df, path, *mode)


def dimensions(spark, folder):
    mart = MartTables(spark, str(folder / "mart"))
    sources = {}
    for name, rows in (("account", ACCOUNTS), ("campaign", CAMPAIGNS), ("lead", LEADS)):
        lines(folder / name, rows)
        sources[name] = read_records(spark, str(folder / name), name)
    daily_run.run_daily(spark, mart, sources, NOW, "unit", years=(2024, 2024), clock=lambda: NOW)
    return mart


def deliver(folder, n):
    folder.mkdir(parents=True, exist_ok=True)
    text = {
        1: [*map(json.dumps, ACTIVITIES), BROKEN, UNKNOWN],
        2: [json.dumps(act("e1", 10)), json.dumps(act("e30", 9)), json.dumps(act("e31", 14)), BROKEN, MISTYPED],
    }[n]
    (folder / f"{n}.json").write_text("\n".join(text))


def state(mart):
    """Every table that the load writes, without the times and ids of runs."""
    columns = {
        "fact_activity": ["activity_id", "date_key", "account_key", "campaign_key", "lead_key",
                          "template_key", "activity_type", "activity_timestamp", "is_accepted"],
        "dead_letter": ["dlq_id", "record_payload", "error_message"],
        "fact_daily": ["date_key", "account_key", "invites_sent", "acceptance_rate", "anomaly_score", "risk_flag"],
        "watermark": ["entity_name", "last_watermark"],
    }
    return {t: sorted(map(str, mart.read(t).select(*c).collect())) for t, c in columns.items()}


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("batch")
    mart = dimensions(spark, folder)
    for n in (1, 2):
        deliver(folder / "in", n)
        source = {"activity": read_records(spark, str(folder / "in" / f"{n}.json"), "activity")}
        daily_run.run_daily(spark, mart, source, NOW, "unit", run_type="full", years=(2024, 2024), clock=lambda: NOW)
    return state(mart)


def stream(mart, folder):
    source = stream_records(mart.spark, str(folder / "in"), "activity")
    load_stream(mart, source, str(folder / "checkpoint"), "unit", clock=lambda: NOW).awaitTermination()


def test_stream_equals_batch_wherever_it_dies(spark, tmp_path, batch, monkeypatch):
    assert len(batch["fact_activity"]) == 6
    # One letter for each rejected record, though the broken line came twice.
    assert sum(BROKEN in x for x in batch["dead_letter"]) == 1
    assert sum(UNKNOWN in x or MISTYPED in x for x in batch["dead_letter"]) == 2
    mart = dimensions(spark, tmp_path)
    fail = {"add": 0}
    add = KeyIndex.add

    def fragile_add(self, rows):
        fail["add"] -= 1
        if fail["add"] == 0:
            raise Killed("key index")
        add(self, rows)

    monkeypatch.setattr(KeyIndex, "add", fragile_add)
    # Letters, facts, snapshot, its values, statistics, watermark, ledger: died before each of these,
    # and before the key index.
    for n in (1, 2):
        deliver(tmp_path / "in", n)
        for left in (0, 2, 3, 6) if n == 1 else (1, 4, 5):
            with pytest.raises(Exception, match="Killed"):
                stream(FragileMart(spark, mart.root, left), tmp_path)
        if n == 2:
            assert mart.read("load_ledger").count() == 1
        fail["add"] = 1
        try:
            stream(mart, tmp_path)
        except Exception as error:
            assert "Killed" in str(error)
            stream(mart, tmp_path)
    assert state(mart) == batch
    done = mart.read("load_ledger").orderBy("batch_id").collect()
    assert [r.batch_id for r in done] == [0, 1]
    assert [(r.rows_extracted, r.rows_rejected) for r in done] == [(12, 7), (5, 2)]


def test_a_batch_in_the_ledger_is_skipped(spark, tmp_path):
    mart = dimensions(spark, tmp_path)
    deliver(tmp_path / "in", 1)
    stream(mart, tmp_path)
    before = state(mart)
    # The checkpoint is lost after the ledger was written: batch 0 comes again.
    source = stream_records(spark, str(tmp_path / "in"), "activity")
    load_stream(mart, source, str(tmp_path / "other"), "unit", clock=lambda: NOW).awaitTermination()
    assert state(mart) == before and mart.read("load_ledger").count() == 1
