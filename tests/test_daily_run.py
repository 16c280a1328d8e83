"""The scheduled run over JSON records: first load, replay, later load."""

import datetime as dt
import json

import pytest

from tallyloom.plans import daily_run
from tallyloom.sources.records import read_records
from tallyloom.sources.tables import MartTables

NOW = dt.datetime(2024, 1, 16, 6)
CLOCK = dt.datetime(2024, 1, 16, 6, 1)


def lines(path, rows):
    path.mkdir(parents=True, exist_ok=True)
    (path / f"part-{len(list(path.iterdir()))}.json").write_text(
        "\n".join(json.dumps(r) for r in rows)
    )


ACCOUNTS = [
    {"id": "a1", "name": "One", "age_tier": "1+ Year", "changed_at": "2023-06-01 00:00:00"},
    {"id": "a2", "name": "Two", "age_tier": "1 Month", "changed_at": "2024-01-01 00:00:00"},
    {"id": "a2", "name": "Two", "age_tier": "1 Month", "changed_at": "2024-01-05 00:00:00"},
    {"id": "a2", "name": "Two", "age_tier": "2-6 Months", "changed_at": "2024-01-09 00:00:00"},
    {"id": "a3", "name": "Never", "age_tier": "1 Month"},
]
CAMPAIGNS = [{"id": "c1", "name": "Spring", "status": "Paused"}, {"id": "c2"}, {"name": "no id"}]
LEADS = [
    {"id": "l1", "full_name": "Old", "updated_at": "2024-01-02T00:00:00"},
    {"id": "l1", "full_name": "New", "updated_at": "2024-01-03T00:00:00"},
    {"id": "l2", "full_name": "Timeless"},
]


def act(key, day, kind="invite_sent", account="a1", **more):
    return {"id": key, "timestamp": f"2024-01-{day:02d}T10:00:00", "agent_id": account,
            "campaign_id": "c1", "lead_id": "l1", "type": kind, **more}


ACTIVITIES = [
    act("e1", 10),
    act("e1", 10),
    act("e2", 10, "invite_accepted", accepted=True),
    act("e3", 11, "message_sent", account="a2"),
    act("e4", 11, account="nobody"),
    {"id": "e5", "agent_id": "a1", "type": "invite_sent"},
    {**act("e6", 12), "timestamp": "yesterday"},
    {**act("e7", 12), "id": None},
    {"id": "e8", "created_at": "2024-01-12T23:30:00-05:00", "agent_id": "a1"},
    {**act("e9", 12), "timestamp": "2031-01-01T00:00:00"},
]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("mart")
    src = root / "src"
    for name, rows in (("account", ACCOUNTS), ("campaign", CAMPAIGNS), ("lead", LEADS),
                       ("activity", ACTIVITIES)):
        lines(src / name, rows)
    mart = MartTables(spark, str(root / "mart"))

    def run(now=NOW):
        sources = {e: read_records(spark, str(src / e), e)
                   for e in ("account", "campaign", "lead", "activity")}
        return daily_run.run_daily(
            spark, mart, sources, now, "unit", years=(2024, 2024),
            clock=lambda: CLOCK,
        )

    first = run()
    state = {
        "facts": mart.read("fact_activity").collect(),
        "letters": mart.read("dead_letter").collect(),
    }
    second = run(NOW + dt.timedelta(hours=1))
    lines(src / "activity", [act("e10", 14, "reply_received", replied=True, converted=True)])
    third = run(NOW + dt.timedelta(hours=2))
    return mart, first, state, second, third, root


def test_counters_and_rejects(loaded):
    _, first, state, _, _, _ = loaded
    assert first["rows_extracted"] == 10
    # five bad activities, a campaign without id, an account without time
    reasons = sorted(r.error_message for r in state["letters"])
    assert reasons == sorted(
        ["missing or unreadable time"] * 3 + ["missing id"] * 2
        + ["unknown account", "date outside the calendar"]
    )
    assert first["rows_rejected"] == 7
    payload = json.loads(
        next(r.record_payload for r in state["letters"] if r.error_message == "unknown account")
    )
    assert payload["id"] == "e4" and payload["agent_id"] == "nobody"


def test_facts_first_write_wins(loaded):
    _, _, state, _, _, _ = loaded
    facts = {r.activity_id: r for r in state["facts"]}
    assert sorted(facts) == ["e1", "e2", "e3", "e8"]
    assert facts["e8"].date_key == 20240112  # the day as written
    assert facts["e8"].activity_type == "unknown"
    assert (facts["e2"].is_accepted, facts["e1"].is_accepted) == (1, 0)


def test_dimensions(loaded):
    mart = loaded[0]
    accounts = mart.read("dim_account").orderBy("account_id", "effective_from").collect()
    assert [(a.account_id, a.account_age_tier, a.is_current) for a in accounts] == [
        ("a1", "1+ Year", 1), ("a2", "1 Month", 0), ("a2", "2-6 Months", 1)]
    assert accounts[1].effective_to == accounts[2].effective_from
    assert sorted(a.account_key for a in accounts) == [1, 2, 3]
    campaigns = {c.campaign_id: c for c in mart.read("dim_campaign").collect()}
    assert campaigns["c2"].campaign_name == "Unknown" and campaigns["c2"].status == "Active"
    leads = {r.lead_id: r.full_name for r in mart.read("dim_lead").collect()}
    assert leads == {"l1": "New", "l2": "Timeless"}
    assert mart.read("dim_date").count() == 366


def test_replay_adds_nothing_and_later_load_only_the_new(loaded):
    mart, _, state, second, third, _ = loaded
    assert second["rows_loaded"] < 10
    ids = sorted(r.activity_id for r in mart.read("fact_activity").collect())
    assert ids == sorted([r.activity_id for r in state["facts"]] + ["e10"])
    marks = {r.entity_name: str(r.last_watermark) for r in mart.read("watermark").collect()}
    assert marks["outreach_activity"] == "2024-01-14 10:00:00"
    assert marks["leads"] == "2024-01-03 00:00:00"


def test_snapshot_log_history(loaded):
    mart, first, _, _, third, root = loaded
    assert third["rows_loaded"] >= 1
    days = {(r.date_key, r.invites_sent, r.conversions)
            for r in mart.read("fact_daily").collect()}
    assert (20240110, 1, 0) in days and (20240114, 0, 1) in days
    assert {r.risk_flag for r in mart.read("fact_daily").collect()} == {"Normal"}
    log = mart.read("run_log").collect()
    assert len(log) == 3 and {r.status for r in log} == {"success"}
    assert mart.read("dq_history").count() == 3
    assert 0 <= first["composite_dq_score"] <= 1
    mart.export_csv(str(root / "csv"))
    head = next((root / "csv" / "fact_daily").glob("*.csv")).read_text().splitlines()[0]
    assert "account_key" in head and "anomaly_score" in head
    alerts = mart.spark.read.json(str(root / "mart" / "alerts")).collect()
    assert {r.alert_type for r in alerts} <= {"dq_breach", "risk_critical"}


def test_failed_run_is_logged(spark, tmp_path):
    mart = MartTables(spark, str(tmp_path / "mart"))
    broken = spark.range(1).selectExpr("CAST(raise_error('boom') AS STRING) AS id")
    broken = broken.selectExpr("id", *[f"CAST(NULL AS STRING) AS {c}" for c in (
        "name", "target_segment", "description", "status", "created_at")])
    with pytest.raises(Exception):
        daily_run.run_daily(spark, mart, {"campaign": broken}, NOW, "unit",
                            clock=lambda: CLOCK)
    rows = mart.read("run_log").collect()
    assert [r.status for r in rows] == ["failed"] and "boom" in rows[0].error_message
    raised = spark.read.json(f"{mart.root}/alerts").collect()
    assert [r.alert_type for r in raised] == ["pipeline_failure"]
    assert rows[0].run_id in raised[0].message


def test_days_are_replaced_in_place(spark, tmp_path):
    mart = MartTables(spark, str(tmp_path / "mart"))
    mart.init()
    mart.init()
    cols = "CAST(%d AS INT) AS date_key, 1L AS account_key, %dL AS invites_sent"
    rows = spark.sql("SELECT " + cols % (20240101, 1) + " UNION ALL SELECT " + cols % (20240102, 1))
    mart.publish("fact_daily", rows)
    fresh = mart.read("fact_daily").filter("date_key = 20240102").selectExpr(
        *["9L AS invites_sent" if c == "invites_sent" else c
          for c in mart.read("fact_daily").columns]).collect()
    mart.overwrite_days("fact_daily", spark.createDataFrame(fresh, mart.read("fact_daily").schema))
    got = {(r.date_key, r.invites_sent) for r in mart.read("fact_daily").collect()}
    assert got == {(20240101, 1), (20240102, 9)}


@pytest.mark.parametrize("step", ["append_activity", "overwrite_days_daily", "publish_stats", "report"])
def test_a_run_that_dies_is_made_good_by_the_next(spark, tmp_path, monkeypatch, step):
    """Whatever the step, facts, snapshot and watermark end as after one clean run."""
    lines(tmp_path / "account", ACCOUNTS[:3])
    lines(tmp_path / "activity", ACTIVITIES[:4])
    sources = {e: read_records(spark, str(tmp_path / e), e) for e in ("account", "activity")}

    def run(root):
        return daily_run.run_daily(spark, MartTables(spark, str(root)), sources, NOW, "crm", clock=lambda: CLOCK)

    def state(root):
        mart = MartTables(spark, str(root))
        keep = {"fact_activity": ["activity_id", "date_key"], "fact_daily": ["date_key", "account_key", "invites_sent", "anomaly_score"], "watermark": ["entity_name", "last_watermark"]}
        return {t: sorted(map(str, mart.read(t).select(*[c for c in cols if c in mart.read(t).columns]).collect())) for t, cols in keep.items()}

    MartTables(spark, str(tmp_path / "mart")).init()
    with monkeypatch.context() as m:
        if step != "report":
            method, table = step.rsplit("_", 1)
            real = getattr(MartTables, method)

            def fail(self, name, df):
                if name.startswith(("fact", "score")) and name.endswith(table):
                    raise RuntimeError("lost " + "x" * 2000)
                return real(self, name, df)

            m.setattr(MartTables, method, fail)
        else:

            def lost(*_):
                raise RuntimeError("lost " + "x" * 2000)

            m.setattr(daily_run.risk, "risk_report", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run(tmp_path / "mart")
    log = MartTables(spark, str(tmp_path / "mart")).read("run_log").where("status = 'failed'").first()
    assert len(log["error_message"]) > 2000
    run(tmp_path / "mart")
    run(tmp_path / "clean")
    assert state(tmp_path / "mart") == state(tmp_path / "clean")


def test_only_a_missing_path_means_no_table(spark, tmp_path, monkeypatch):
    from pyspark.errors import AnalysisException

    mart = MartTables(spark, str(tmp_path))
    mart.init()

    def broken(self):
        raise AnalysisException("[PATH_ALREADY_EXISTS] Path x already exists.")

    monkeypatch.setattr(MartTables, "_log", broken)
    with pytest.raises(AnalysisException):
        mart.init()


def test_a_late_account_change_leaves_no_fact_without_account(spark, tmp_path):
    """Two versions each, facts on both, then changes that move a start (a1) and merge two versions (a2)."""
    mart = MartTables(spark, str(tmp_path / "mart"))

    def run(day, **entities):
        sources = {}
        for e, rows in entities.items():
            lines(tmp_path / f"{e}-{day}", rows)
            sources[e] = read_records(spark, str(tmp_path / f"{e}-{day}"), e)
        daily_run.run_daily(spark, mart, sources, dt.datetime(2024, 1, day, 6), "crm", clock=lambda: CLOCK)

    def account(name, tier, day):
        return {"id": name, "name": name, "age_tier": tier, "changed_at": f"2024-01-{day:02d} 00:00:00"}

    def state(name):
        accounts = {r.account_key: (r.account_age_tier, r.effective_from.day) for r in mart.read("dim_account").collect() if r.account_id == name}
        facts = sorted((r.date_key, accounts.get(r.account_key)) for r in mart.read("fact_activity").collect() if r.activity_id.startswith(name))
        days = {r.date_key: accounts[r.account_key] for r in mart.read("fact_daily").collect() if r.account_key in accounts}
        return accounts, facts, days

    both = ("a1", "a2")
    acts = lambda days: [act(f"{n}-{d}", d, account=n) for n in both for d in days]
    run(9, account=[account(n, "1 Month", 1) for n in both], activity=acts(range(2, 6)))
    run(16, account=[account(n, "2-6 Months", 10) for n in both], activity=acts(range(11, 15)))
    keys = {n: state(n)[0].keys() for n in both}
    run(17, account=[account("a1", "2-6 Months", 5), account("a2", "2-6 Months", 1)])
    accounts, facts, days = state("a1")
    assert accounts.keys() == keys["a1"] and sorted(accounts.values()) == [("1 Month", 1), ("2-6 Months", 5)]
    assert len(facts) == len(days) == 8 and None not in [a for _, a in facts]
    accounts, facts, days = state("a2")
    assert accounts == {min(keys["a2"]): ("2-6 Months", 1)}
    assert len(facts) == len(days) == 8 and {a for _, a in facts} == set(days.values()) == {("2-6 Months", 1)}
