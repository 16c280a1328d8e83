"""Risk, trend, KPI and data-quality rules on hand-worked rows."""

import datetime as dt

import pytest

from tallyloom.operators import kpis, measures, ops, quality, risk, trends, views

CAP = ("account_age_tier string, avg_acceptance_rate double, avg_reply_rate double, "
       "recent_anomaly_score double, days_of_data int")


@pytest.mark.parametrize(
    "row, factor, invites, messages, confidence, level",
    [
        (("1+ Year", .30, .15, .5, 30), 1.0, 30, 60, "HIGH", "Low"),
        (("1+ Year", .03, .01, 4.0, 30), .15, 4, 9, "HIGH", "Critical"),
        (("1+ Year", .30, .15, 0.0, 1), 1.0, 30, 60, "INSUFFICIENT", "Unknown"),
        (("< 1 Month", .50, .30, 0.0, 30), 1.0, 5, 10, "HIGH", "Low"),
        (("1 Month", .50, .30, 0.0, 30), 1.0, 10, 15, "HIGH", "Low"),
        (("2-6 Months", .50, .30, 0.0, 30), 1.0, 15, 25, "HIGH", "Low"),
        (("6-12 Months", .50, .30, 0.0, 30), 1.0, 25, 40, "HIGH", "Low"),
        (("who knows", .50, .30, 0.0, 7), .9, 27, 54, "MEDIUM", "Low"),
        (("< 1 Month", .01, .01, 9.0, 3), .12, 1, 1, "LOW", "Critical"),
        ((None, .50, .30, 0.0, 14), 1.0, 30, 60, "HIGH", "Low"),
    ],
)
def test_capacity(spark, row, factor, invites, messages, confidence, level):
    got = risk.with_capacity(spark.createDataFrame([row], CAP)).first()
    assert got.safety_factor == pytest.approx(factor)
    assert (got.recommended_daily_invites, got.recommended_daily_messages) == (invites, messages)
    assert (got.confidence, got.risk_level) == (confidence, level)
    assert got.recommended_daily_invites <= got.invite_ceiling and got.reasoning


def test_risk_levels(spark):
    rows = [(.5, .30, .15, .50), (4.0, .03, .01, .95), (1.5, .15, .03, .85), (2.5, .07, .03, .99)]
    df = spark.createDataFrame(rows, "a double, c double, r double, u double")
    level = risk.risk_level("a", "c", "r", "u")
    assert [r.l for r in df.selectExpr(f"{level} AS l").collect()] == [
        "Healthy", "Critical", "Moderate", "Critical"]


def test_risk_report_keeps_accounts_without_days(spark):
    accounts = spark.createDataFrame(
        [(1, "a", "A", "1+ Year", "Active", 1), (2, "b", "B", "1 Month", "Active", 1),
         (3, "c", "C", "1 Month", "Paused", 1), (4, "d", "D", "1 Month", "Active", 0)],
        "account_key bigint, account_id string, account_name string, account_age_tier string, "
        "agent_status string, is_current int")
    daily = spark.createDataFrame(
        [(20240100 + d, 1, .2 if d < 3 else None, .1, 1.5 if d == 2 else None)
         for d in range(1, 5)],
        "date_key int, account_key bigint, acceptance_rate double, reply_rate double, "
        "anomaly_score double")
    got = {r.account_id: r for r in risk.risk_report(accounts, daily).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].days_of_data, got["a"].avg_acceptance_rate) == (4, .2)
    assert got["a"].recent_anomaly_score == 1.5  # the latest that is known
    assert got["b"].days_of_data == 0 and got["b"].avg_acceptance_rate is None
    assert got["b"].risk_level == "Unknown"


def series(spark, name, values, account=1):
    return spark.createDataFrame(
        [(account, d, v) for d, v in enumerate(values)],
        f"account_key int, date_key int, {name} double")


def test_acceptance_collapse(spark):
    falling = series(spark, "acceptance_rate", [.30] * 15 + [.05, .04, .03, .06, .04])
    other = series(spark, "acceptance_rate", [.5, None, .5, .1, None], 2)
    got = trends.acceptance_collapse(falling.unionByName(other), ["account_key"]).collect()
    hits = {(r.account_key, r.date_key) for r in got if r.acceptance_collapse}
    assert hits == {(1, d) for d in range(15, 20)} | {(2, 3)}


def test_reply_decay(spark):
    line = series(spark, "reply_rate", [.7, .6, .5, .4, .3, .2, .1])
    flat = series(spark, "reply_rate", [.2] * 8, 2)
    got = {(r.account_key, r.date_key): (r.reply_trend_slope, r.reply_decay)
           for r in trends.reply_decay(line.unionByName(flat), ["account_key"]).collect()}
    assert got[1, 6] == (-.1, True)
    assert all(got[1, d] == (0.0, False) for d in range(6))
    assert all(got[2, d] == (0.0, False) for d in range(8))


def test_utilization_spikes(spark):
    df = spark.sql("SELECT * FROM VALUES (0.95D, 0.1D), (0.2D, 0.99D), (0.94D, 0.94D) "
                   "AS t(invite_utilization, message_utilization)")
    assert trends.utilization_spikes(df).count() == 2


FACT = ("date_key int, account_key bigint, campaign_key bigint, activity_type string, "
        "is_converted int, response_time_hours double")


def test_kpis_without_rows_and_unknown_dates(spark):
    calendar = spark.sql("SELECT 20240101 AS date_key, DATE '2024-01-01' AS full_date")
    empty = kpis.core_kpis(spark.createDataFrame([], FACT), calendar).first()
    assert all(v == 0 for v in empty.asDict().values())
    fact = spark.createDataFrame(
        [(20240101, 1, 1, "invite_sent", 0, None), (20240101, 1, 1, "invite_accepted", 1, 2.0),
         (20990101, 1, 1, "invite_sent", 0, None)], FACT)
    got = kpis.core_kpis(fact, calendar).first()
    assert (got.total_invites_sent, got.acceptance_rate, got.conversion_rate) == (1, 1.0, 1.0)
    outside = kpis.core_kpis(fact, calendar, dt.date(2024, 1, 2)).first()
    assert outside.total_invites_sent == 0


def test_campaign_without_facts_keeps_null_conversions(spark):
    campaigns = spark.sql("SELECT * FROM VALUES (1L, 'a', 'A', 's', 'Active'), "
                          "(2L, 'b', 'B', 's', 'Active') AS "
                          "t(campaign_key, campaign_id, campaign_name, target_segment, status)")
    fact = spark.createDataFrame([(20240101, 1, 1, "invite_sent", 0, None)], FACT)
    rows = kpis.campaign_performance(campaigns, fact).collect()
    assert [(r.campaign_id, r.conversions, r.invites_sent) for r in rows] == [
        ("a", 0, 1), ("b", None, 0)]
    assert rows[1].acceptance_rate == 0.0


def test_week_windows_count_calendar_days(spark):
    fact = spark.createDataFrame(
        [(d, 1, 1, "invite_sent", 0, None) for d in (20240101, 20240106, 20240108, 20240108)],
        FACT)
    rolling = {r.date_key: r.invites_7d for r in measures.rolling_7d(fact, []).collect()}
    assert rolling == {20240101: 1, 20240106: 2, 20240108: 3}
    wow = {r.date_key: r.wow_change for r in measures.wow_change(fact, []).collect()}
    assert wow == {20240101: 0.0, 20240106: 0.0, 20240108: 1.0}


def test_best_campaign_and_rank_keep_ties(spark):
    rates = spark.sql("SELECT * FROM VALUES ('a', 10L, 0.5D), ('b', 20L, 0.5D), ('c', 10L, 0.1D) "
                      "AS t(campaign_name, activities, conversion_rate)")
    assert {r.campaign_name for r in measures.best_campaign(rates).collect()} == {"a", "b"}
    ranks = {r.campaign_name: (r["rank"], r.activity_share)
             for r in views.campaign_share(rates).collect()}
    assert ranks == {"a": (1, .25), "b": (1, .5), "c": (3, .25)}


# Data quality


def test_small_mart_scores_exactly_the_threshold(spark):
    """One account, one campaign, ten activities: sixteen checks, exactly 0.85."""
    day = spark.sql("SELECT CAST(date_format(d, 'yyyyMMdd') AS INT) AS date_key, d AS full_date "
                    "FROM (SELECT explode(sequence(DATE '2024-01-01', DATE '2024-12-31')) AS d)")
    tables = {
        "dim_date": day,
        "dim_account": spark.sql("SELECT 1L AS account_key, 'a' AS account_id, '1+ Year' AS "
                                 "account_age_tier, 'Minimal Risk' AS risk_classification"),
        "dim_campaign": spark.sql("SELECT 'c' AS campaign_id, 'C' AS campaign_name"),
        "dim_lead": spark.sql("SELECT 'l' AS lead_id").limit(0),
        "fact_activity": spark.range(10).selectExpr(
            "CAST(id AS STRING) AS activity_id", "20240115 AS date_key", "1L AS account_key",
            "'invite_sent' AS activity_type",
            "TIMESTAMP '2024-01-15 10:00:00' AS activity_timestamp"),
        "fact_daily": spark.sql("SELECT 1 AS date_key, 1L AS account_key, 0D AS acceptance_rate, "
                                "0D AS reply_rate, 0D AS conversion_rate").limit(0),
    }
    checks = quality.run_checks(tables, quality.MART_RULES, dt.datetime(2024, 1, 22, 10))
    rows = checks.collect()
    per = {}
    for r in rows:
        per[r.dimension] = per.get(r.dimension, 0) + 1
        assert r.score == (0.0 if r.dimension == "timeliness" else 1.0)
    assert per == {"completeness": 5, "uniqueness": 4, "validity": 2, "timeliness": 1,
                   "referential_integrity": 4}
    score = quality.composite(checks).first()
    assert (score.composite_dq_score, score.pass_fail, score.total_checks) == (.85, "PASS", 16)
    quality.enforce(quality.composite(checks))
    with pytest.raises(quality.DataQualityFailed):
        quality.enforce(quality.composite(checks, 0.9))


def test_null_rules_of_checks(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 'x', 1.1D, 1L), ('', 'y', -0.1D, NULL), "
                   "(NULL, NULL, NULL, 9L), ('a', 'z', 0.5D, 9L) AS t(k, kind, rate, fk)")
    one = lambda frame: frame.first()
    assert one(quality.check_completeness(df, "t", ["k"])).failed_records == 2
    unique = one(quality.check_uniqueness(df, "t", "k"))
    # one surplus copy and one NULL
    assert (unique.failed_records, unique.total_records) == (2, 4)
    assert one(quality.check_in_set(df, "t", "kind", ["x", "y"])).failed_records == 1
    assert one(quality.check_range(df, "t", [("rate", 0.0, 1.0)])).failed_records == 2
    parent = spark.sql("SELECT * FROM VALUES (1L), (NULL) AS p(id)")
    assert one(quality.check_fk(df, "t", "fk", parent, "id")).failed_records == 2
    empty = df.limit(0)
    assert quality.check_range(empty, "t", [("rate", 0.0, 1.0)]).count() == 0
    assert one(quality.check_uniqueness(empty, "t", "k")).score == 1.0


@pytest.mark.parametrize("hours, score, passed",
                         [(-5, 1.0, 1), (24, 1.0, 1), (96, .5, 1), (97, 71 / 144, 0),
                          (168, 0.0, 0), (900, 0.0, 0)])
def test_timeliness(spark, hours, score, passed):
    now = dt.datetime(2024, 3, 1)
    time = (now - dt.timedelta(hours=hours)).isoformat(sep=" ")
    df = spark.sql(f"SELECT TIMESTAMP '{time}' AS ts")
    got = quality.check_timeliness(df, "t", "ts", now).first()
    assert got.score == pytest.approx(score) and got.passed_records == passed


def test_timeliness_of_nothing_is_zero(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS ts")
    assert quality.check_timeliness(df, "t", "ts", dt.datetime(2024, 3, 1)).first().score == 0.0


def test_alerts(spark):
    stamp = "TIMESTAMP '2024-03-01 00:00:00'"
    log = ops.run_row(spark, run_id="r1", status="failed", error_message="disk full",
                      started_at=dt.datetime(2024, 1, 1), ended_at=dt.datetime(2024, 1, 1, 0, 10, 1))
    log = log.unionByName(ops.run_row(spark, run_id="r2", status="success",
                                      started_at=dt.datetime(2024, 1, 1)))
    history = spark.sql("SELECT 0.8D AS composite_dq_score, 'FAIL' AS pass_fail, 0.85D AS "
                        "threshold_used, 1D AS completeness_score, 1D AS uniqueness_score, "
                        "1D AS validity_score, 0D AS timeliness_score, "
                        "0D AS referential_integrity_score")
    report = spark.sql("SELECT * FROM VALUES ('a', 'A', 'Critical'), ('b', 'B', 'Low') "
                       "AS t(account_id, account_name, risk_level)")
    got = ops.alerts(history, log, report, stamp).collect()
    assert sorted((r.alert_type, r.severity) for r in got) == [
        ("anomalous_duration", "WARNING"), ("dq_breach", "WARNING"),
        ("pipeline_failure", "CRITICAL"), ("risk_critical", "CRITICAL")]
    assert [r.account_id for r in ops.critical_accounts(report, stamp).collect()] == ["a"]
    calm = ops.alerts(history.limit(0), log.limit(0), report.filter("risk_level = 'Low'"), stamp)
    assert calm.count() == 0


def test_days_count_for_all_versions_of_an_account(spark):
    """A change of tier starts a new version; the account keeps its history."""
    from tallyloom.operators import kpis, risk

    accounts = spark.createDataFrame(
        [(1, "a", "A", "1 Month", "Active", 5, 10, 0), (2, "a", "A", "1+ Year", "Active", 30, 60, 1)],
        "account_key long, account_id string, account_name string, account_age_tier string, agent_status string, "
        "daily_invite_limit int, daily_message_limit int, is_current int",
    )
    daily = spark.createDataFrame(
        [(20240100 + d, 1 if d < 6 else 2, 0.02, 0.01, 0.5, 0.5, 4.0) for d in range(1, 8)],
        "date_key int, account_key long, acceptance_rate double, reply_rate double, "
        "invite_utilization double, message_utilization double, anomaly_score double",
    )
    assert risk.risk_report(accounts, daily).first()["days_of_data"] == 7
    assert kpis.account_health(accounts, daily).first()["days_active"] == 7


def test_a_null_group_is_scored(spark):
    from tallyloom.operators import anomaly

    rows = [(None if i % 2 else "g", float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, v double")
    stats = anomaly._attach_stats(df, {"v": "v"}, ["g"])
    assert stats.count() == 40 and stats.where("_stats.v.median IS NULL").isEmpty()
