"""The registered queries in SQL, run by DuckDB on the same tables."""

from __future__ import annotations

import re

SQL: dict[str, str] = {}

# Shared table expressions, in order of dependence.
CTE = {
    "tiers": """SELECT * FROM (VALUES
        (0, '< 1 Month', 'Very High Risk', 5, 10),
        (1, '1 Month', 'High Risk', 10, 15),
        (2, '2-6 Months', 'Moderate Risk', 15, 25),
        (3, '6-12 Months', 'Low Risk', 25, 40),
        (4, '1+ Year', 'Minimal Risk', 30, 60)) v(region, tier, risk, inv_limit, msg_limit)""",
    "account": """SELECT CAST(n_nationkey + 1 AS BIGINT) AS account_key,
        CAST(n_nationkey AS VARCHAR) AS account_id, n_name AS account_name,
        tier AS account_age_tier, risk AS risk_classification,
        CAST(inv_limit AS INTEGER) AS daily_invite_limit,
        CAST(msg_limit AS INTEGER) AS daily_message_limit,
        CASE n_nationkey % 10 WHEN 0 THEN 'Paused' WHEN 1 THEN 'Ghost'
             WHEN 2 THEN 'Disconnected' ELSE 'Active' END AS agent_status
        FROM nation JOIN tiers ON n_regionkey = region""",
    "campaign": """SELECT DISTINCT c_mktsegment AS campaign_id,
        CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
             WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END
             AS BIGINT) AS campaign_key,
        upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS campaign_name,
        c_mktsegment AS target_segment,
        CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Paused'
             WHEN c_mktsegment = 'MACHINERY' THEN 'Completed'
             WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'Active'
             END AS status
        FROM customer""",
    "act": """SELECT CAST(event_id AS VARCHAR) AS activity_id,
        CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(c_nationkey + 1 AS BIGINT) AS account_key,
        CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
             WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END
             AS BIGINT) AS campaign_key,
        user_id AS lead_key,
        CASE event_type WHEN 'view' THEN 'invite_sent' WHEN 'click' THEN 'invite_accepted'
             WHEN 'signup' THEN 'message_sent' WHEN 'purchase' THEN 'reply_received'
             WHEN 'error' THEN 'follow_up_sent' END AS activity_type,
        ts,
        CAST(event_type = 'click' AS INTEGER) AS is_accepted,
        CAST(event_type = 'purchase' AS INTEGER) AS is_replied,
        CAST(event_type = 'purchase' AND value > 100 AS INTEGER) AS is_converted,
        CASE WHEN event_type IN ('click', 'purchase') THEN value END AS response_time_hours,
        CAST(c_nationkey AS VARCHAR) AS agent_id, c_mktsegment AS campaign_id,
        CAST(user_id AS VARCHAR) AS lead_id, c_acctbal
        FROM events JOIN customer ON user_id = c_custkey""",
    "counted": """SELECT date_key, account_key,
        count(*) FILTER (activity_type = 'invite_sent') AS invites_sent,
        count(*) FILTER (activity_type = 'invite_accepted') AS invites_accepted,
        count(*) FILTER (activity_type = 'message_sent') AS messages_sent,
        count(*) FILTER (activity_type = 'reply_received') AS replies_received,
        count(*) FILTER (activity_type = 'follow_up_sent') AS follow_ups_sent,
        CAST(sum(is_converted) AS BIGINT) AS conversions
        FROM act GROUP BY ALL""",
    "daily": """SELECT c.*,
        CASE WHEN invites_sent > 0
             THEN round(invites_accepted::DOUBLE / invites_sent, 4) ELSE 0 END AS acceptance_rate,
        CASE WHEN messages_sent > 0
             THEN round(replies_received::DOUBLE / messages_sent, 4) ELSE 0 END AS reply_rate,
        CASE WHEN invites_sent + messages_sent > 0
             THEN round(conversions::DOUBLE / (invites_sent + messages_sent), 4) ELSE 0
             END AS conversion_rate,
        round(invites_sent::DOUBLE / daily_invite_limit, 4) AS invite_utilization,
        round(messages_sent::DOUBLE / daily_message_limit, 4) AS message_utilization
        FROM counted c JOIN account USING (account_key)""",
    "ghosted": """SELECT *, CASE WHEN invites_accepted > 0
        THEN 1.0::DOUBLE - replies_received::DOUBLE / invites_accepted ELSE 0 END AS ghost_rate
        FROM daily""",
}

METRICS = {
    "acceptance_rate": (0.30, "low"),
    "reply_rate": (0.25, "low"),
    "invite_utilization": (0.20, "high"),
    "message_utilization": (0.15, "high"),
    "ghost_rate": (0.10, "high"),
}


def _round4(x: str) -> str:
    """Half-up rounding of the shortest decimal form of a double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), 4) AS DOUBLE)"


def _score_ctes(key: str) -> dict[str, str]:
    """Statistics and scores over the snapshot, pooled or per `key`."""
    by = f"GROUP BY {key}" if key else ""
    lead = f"{key}, " if key else ""
    using = f"JOIN stats USING ({key})" if key else ", stats"
    stats = ", ".join(
        f"median({m}) AS {m}_med, mad({m}) AS {m}_mad, quantile_cont({m}, 0.25) AS {m}_q1, "
        f"quantile_cont({m}, 0.75) AS {m}_q3"
        for m in METRICS
    )
    raw = ", ".join(
        f"CASE WHEN stat_rows < 5 OR {m}_mad = 0 THEN 0::DOUBLE ELSE greatest(0, "
        f"{'-' if bad == 'low' else ''}0.6745::DOUBLE * ({m} - {m}_med) / {m}_mad) END AS raw_{m}, "
        f"CASE WHEN stat_rows >= 5 THEN CAST({m} < {m}_q1 - 1.5 * ({m}_q3 - {m}_q1) OR "
        f"{m} > {m}_q3 + 1.5 * ({m}_q3 - {m}_q1) AS INTEGER) END AS iqr_outlier_{m}"
        for m, (_, bad) in METRICS.items()
    )
    total = " + ".join(f"raw_{m} * {w}::DOUBLE" for m, (w, _) in METRICS.items())
    zs = ", ".join(f"{_round4(f'raw_{m}')} AS z_{m}" for m in METRICS)
    score = _round4(f"({total})")
    drop = ", ".join(
        [f"raw_{m}" for m in METRICS]
        + [f"{m}_{s}" for m in METRICS for s in ("med", "mad", "q1", "q3")]
        + ["stat_rows"]
    )
    return {
        "stats": f"SELECT {lead}count(*) AS stat_rows, {stats} FROM ghosted {by}",
        "raws": f"SELECT ghosted.*, stats.* {'EXCLUDE (' + key + ')' if key else ''}, {raw} "
        f"FROM ghosted {using}",
        "scored": f"""SELECT * EXCLUDE ({drop}), {zs},
            {score} AS anomaly_score,
            CASE WHEN {score} <= 2 THEN 'Normal' WHEN {score} <= 3.5 THEN 'Warning'
                 ELSE 'Critical' END AS risk_flag
            FROM raws""",
    }


CTE.update(_score_ctes(""))

CTE["spans"] = """SELECT account_key, count(*) AS days_of_data,
    avg(acceptance_rate) AS acc, avg(reply_rate) AS rep,
    arg_max(anomaly_score, date_key) AS recent FROM scored GROUP BY ALL"""
CTE["grid"] = """SELECT c_custkey, tier AS account_age_tier, inv_limit AS invite_ceiling,
    msg_limit AS message_ceiling, (c_custkey % 45) / 10.0::DOUBLE AS a,
    (c_custkey % 31) / 100.0::DOUBLE AS c, (c_custkey % 13) / 100.0::DOUBLE AS r,
    c_custkey % 20 AS days_of_data, (c_custkey % 11) / 10.0::DOUBLE AS used
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN tiers ON n_regionkey = region"""
CTE["report_in"] = """SELECT account_id, account_name, account_age_tier,
    daily_invite_limit AS invite_ceiling, daily_message_limit AS message_ceiling,
    coalesce(days_of_data, 0) AS days_of_data, acc, rep, recent, coalesce(recent, 0) AS a,
    coalesce(acc, 0) AS c, coalesce(rep, 0) AS r
    FROM account LEFT JOIN spans USING (account_key) WHERE agent_status = 'Active'"""


def _capacity(source: str) -> dict[str, str]:
    points = """CASE WHEN a > 3.5 THEN 4 WHEN a > 2.0 THEN 2 WHEN a > 1.0 THEN 1 ELSE 0 END
        + CASE WHEN c < 0.05::DOUBLE THEN 3 WHEN c < 0.1::DOUBLE THEN 2
               WHEN c < 0.2::DOUBLE THEN 1 ELSE 0 END
        + CASE WHEN r < 0.02::DOUBLE THEN 2 WHEN r < 0.05::DOUBLE THEN 1 ELSE 0 END
        + CASE WHEN used > 0.95::DOUBLE THEN 2 WHEN used > 0.8::DOUBLE THEN 1 ELSE 0 END"""
    return {
        f"{source}_f": f"""SELECT *,
            CASE WHEN days_of_data >= 14 THEN 'HIGH' WHEN days_of_data >= 7 THEN 'MEDIUM'
                 WHEN days_of_data >= 3 THEN 'LOW' ELSE 'INSUFFICIENT' END AS confidence,
            CASE WHEN days_of_data < 3 THEN 1.0::DOUBLE ELSE
              (CASE WHEN a > 3.5 THEN 0.4::DOUBLE WHEN a > 2.0 THEN 0.65::DOUBLE
                    WHEN a > 1.0 THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END)
              * (CASE WHEN c < 0.05::DOUBLE THEN 0.5::DOUBLE WHEN c < 0.1::DOUBLE THEN 0.7::DOUBLE
                      WHEN c < 0.2::DOUBLE THEN 0.85::DOUBLE ELSE 1.0::DOUBLE END)
              * (CASE WHEN r < 0.02::DOUBLE THEN 0.75::DOUBLE
                      WHEN r < 0.05::DOUBLE THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END)
              * (CASE WHEN days_of_data >= 14 THEN 1.0::DOUBLE
                      WHEN days_of_data >= 7 THEN 0.9::DOUBLE ELSE 0.8::DOUBLE END)
            END AS factor FROM {source}""",
        f"{source}_l": f"""SELECT *,
            CAST(greatest(1, least(invite_ceiling, floor(invite_ceiling * factor))) AS INTEGER)
              AS recommended_daily_invites,
            CAST(greatest(1, least(message_ceiling, floor(message_ceiling * factor))) AS INTEGER)
              AS recommended_daily_messages,
            round(factor, 4) AS safety_factor FROM {source}_f""",
        f"{source}_p": f"""SELECT *, {points} AS points FROM (
            SELECT * {'EXCLUDE (used)' if source == 'grid' else ''},
                   recommended_daily_invites::DOUBLE / invite_ceiling AS used
            FROM {source}_l)""",
        f"{source}_r": f"""SELECT *, CASE WHEN days_of_data < 3 THEN 'Unknown'
            WHEN points >= 7 THEN 'Critical' WHEN points >= 5 THEN 'High'
            WHEN points >= 3 THEN 'Moderate' WHEN points >= 1 THEN 'Low' ELSE 'Healthy'
            END AS risk_level FROM {source}_p""",
    }


CTE.update(_capacity("grid"))
CTE.update(_capacity("report_in"))

# The dirty records and what the load makes of them.
CTE["dirty"] = """SELECT
    CASE WHEN activity_type = 'reply_received' AND response_time_hours > 300 THEN ''
         ELSE activity_id END AS id,
    CASE WHEN response_time_hours > 250 THEN 'not a time'
         WHEN response_time_hours < 1 THEN NULL
         WHEN activity_type = 'follow_up_sent' THEN ''
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS raw_time,
    CASE WHEN activity_type = 'follow_up_sent'
         THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS created_at,
    lead_id, activity_type AS type, response_time_hours, agent_id FROM act"""
CTE["timed"] = """SELECT *, try_cast(coalesce(nullif(raw_time, ''), nullif(created_at, ''))
    AS TIMESTAMP) AS event_time FROM dirty"""
CTE["connected"] = "SELECT * FROM account WHERE agent_status <> 'Disconnected'"
CTE["checked"] = """SELECT lead_id, type, response_time_hours,
    CASE WHEN event_time IS NULL THEN 'missing or unreadable time'
         WHEN id = '' THEN 'missing id'
         WHEN c.account_key IS NULL THEN 'unknown account' END AS error_message
    FROM timed LEFT JOIN connected c ON agent_id = account_id"""
CTE["letters"] = """SELECT
    sha256('load|unknown account|' || payload) AS dlq_id,
    CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'run-1' ELSE 'run-2' END AS run_id,
    payload AS record_payload, 'load' AS error_type, 'unknown account' AS error_message,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS failed_at
    FROM (SELECT ts, CAST(json_object(
            'id', activity_id, 'timestamp', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
            'created_at', NULL, 'agent_id', agent_id, 'campaign_id', campaign_id,
            'lead_id', lead_id, 'type', activity_type,
            'accepted', activity_type = 'invite_accepted',
            'replied', activity_type = 'reply_received', 'converted', is_converted = 1,
            'response_time_hours', response_time_hours) AS VARCHAR) AS payload
          FROM act WHERE agent_id NOT IN (SELECT account_id FROM connected))"""
CTE["retried"] = """SELECT * EXCLUDE (again), CAST(again AS INTEGER) AS retried,
    CASE WHEN again THEN '2024-02-01 06:00:00.000000' END AS retried_at
    FROM (SELECT *, record_payload LIKE '%invite_sent%' AS again FROM letters)"""
CTE["day"] = """SELECT CAST(d AS DATE) AS full_date,
    CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key
    FROM generate_series(
        (SELECT date_trunc('year', min(ts)) FROM events),
        (SELECT date_trunc('year', max(ts)) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM events),
        INTERVAL 1 DAY) g(d)"""
CTE["invited"] = """SELECT account_key, date_key, strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS d,
    invites_sent, invites_accepted FROM counted"""
CTE["camp_m"] = """SELECT campaign_name, count(*) AS activities,
    CAST(sum(is_converted) AS BIGINT) AS conversions,
    coalesce(count(*) FILTER (activity_type = 'invite_accepted')::DOUBLE
        / nullif(count(*) FILTER (activity_type = 'invite_sent'), 0), 0) AS acceptance_rate,
    coalesce(count(*) FILTER (activity_type = 'reply_received')::DOUBLE
        / nullif(count(*) FILTER (activity_type = 'message_sent'), 0), 0) AS reply_rate,
    sum(is_converted)::DOUBLE / count(*) AS conversion_rate
    FROM act JOIN campaign USING (campaign_key) GROUP BY ALL"""


def _tables_used(sql: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in known if name in words]


def oracle(name: str, sql: str, extra: dict[str, str] | None = None) -> None:
    """Register `sql`, preceded by the table expressions it needs."""
    known = {**CTE, **(extra or {})}
    needed: set[str] = set()
    queue = _tables_used(sql, known)
    while queue:
        cte = queue.pop()
        if cte not in needed:
            needed.add(cte)
            queue += [n for n in _tables_used(known[cte], known) if n != cte]
    parts = [f"{n} AS ({known[n]})" for n in known if n in needed]
    SQL[name] = (f"WITH {', '.join(parts)} " if parts else "") + sql


TS = "'%Y-%m-%d %H:%M:%S.%f'"

# Scans and sinks

oracle("scan_since_watermark", f"""SELECT activity_id AS id, strftime(ts, {TS}) AS event_time,
    agent_id, activity_type AS type FROM act WHERE ts > TIMESTAMP '2024-01-15'""")

oracle("dim_campaign_scd1", """
    SELECT campaign_key, campaign_id,
        CASE WHEN campaign_id = 'MACHINERY' THEN 'Unknown' ELSE lower(campaign_id) END
            AS campaign_name,
        target_segment,
        CASE WHEN campaign_id = 'HOUSEHOLD' THEN 'Active' ELSE 'Paused' END AS status
    FROM campaign
    UNION ALL
    SELECT CAST((SELECT max(campaign_key) FROM campaign) + k AS BIGINT), r_name,
        CASE WHEN r_name = 'MIDDLE EAST' THEN 'Middle East'
             ELSE upper(r_name[1]) || lower(r_name[2:]) END, NULL, 'Active'
    FROM (SELECT r_name, row_number() OVER (ORDER BY substr(md5(r_name), 1, 3), r_name) AS k
          FROM region)""")

oracle("dim_lead_incremental", """
    SELECT lead_id, location, CAST(CASE WHEN old THEN k ELSE n_old + k END AS BIGINT) AS lead_key
    FROM (
        SELECT *, count(*) FILTER (old) OVER () AS n_old,
            row_number() OVER (PARTITION BY old ORDER BY substr(md5(lead_id), 1, 3), lead_id) AS k
        FROM (SELECT CAST(o_custkey AS VARCHAR) AS lead_id,
                arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS location,
                min(o_orderdate) <= TIMESTAMP '1997-01-01' AS old
              FROM orders GROUP BY o_custkey))""")

oracle("insert_new_only", """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey))
        AS o_orderkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus
    FROM orders GROUP BY o_custkey""")

oracle("replace_by_key", """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey))
        AS o_orderkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus
    FROM orders GROUP BY o_custkey""")

# Dimensions

oracle("dim_template_load", """SELECT CAST(p_partkey AS VARCHAR) AS template_id,
        CASE WHEN p_size <= 25 THEN 'new ' || p_name ELSE p_name END AS template_name, p_type AS template_body,
        CASE WHEN p_size % 5 = 0 THEN 'Connection' ELSE p_brand END AS template_type,
        CAST(CASE WHEN known THEN k ELSE n_known + k END AS BIGINT) AS template_key
    FROM (SELECT *, count(*) FILTER (known) OVER () AS n_known,
            row_number() OVER (PARTITION BY known ORDER BY substr(md5(CAST(p_partkey AS VARCHAR)), 1, 3), CAST(p_partkey AS VARCHAR)) AS k
        FROM (SELECT *, p_partkey % 3 = 0 AS known FROM part))""")

oracle("dim_date", """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(d AS VARCHAR) AS full_date, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
        dayname(d) AS day_name, CAST(day(d) AS INTEGER) AS day_of_month,
        CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
        CAST(isodow(d) >= 6 AS INTEGER) AS is_weekend
    FROM (SELECT CAST(x AS DATE) AS d FROM generate_series(
        (SELECT date_trunc('year', min(o_orderdate)) FROM orders),
        (SELECT date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY
         FROM orders), INTERVAL 1 DAY) g(x))""")

oracle("scd1_merge", """
    SELECT c_custkey, c_name,
        CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE seg.v END AS c_mktsegment, c_acctbal
    FROM customer LEFT JOIN (
        SELECT o_custkey, arg_max({'v': CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END},
            (o_orderdate, o_orderkey)) AS seg FROM orders GROUP BY o_custkey) u
    ON c_custkey = o_custkey""")

VERSIONS = {
    "state": """SELECT o_custkey, o_orderdate,
        arg_max(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY ALL""",
    "lagged": """SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate) AS was FROM state""",
    "version": """SELECT o_custkey, o_orderpriority, o_orderdate,
        lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS until
        FROM lagged WHERE was IS DISTINCT FROM o_orderpriority""",
}
_VERSION_OUT = f"""SELECT o_custkey, o_orderpriority, strftime(o_orderdate, {TS})
    AS effective_from, coalesce(strftime(until, {TS}), '9999-12-31 00:00:00.000000')
    AS effective_to, CAST(until IS NULL AS INTEGER) AS is_current FROM version"""
oracle("scd2_history_events", f"""
    SELECT user_id, event_type, strftime(ts, {TS}) AS effective_from,
        coalesce(strftime(until, {TS}), '9999-12-31 23:59:59.000000') AS effective_to,
        CAST(until IS NULL AS INTEGER) AS is_current
    FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS was
            FROM (SELECT user_id, ts, arg_max(event_type, event_id) AS event_type
                  FROM events GROUP BY ALL))
        WHERE was IS DISTINCT FROM event_type)""")
oracle("scd2_history", _VERSION_OUT, VERSIONS)
oracle("scd2_merge", _VERSION_OUT, VERSIONS)
oracle("scd2_current", _VERSION_OUT + " WHERE until IS NULL", VERSIONS)

oracle("scd2_stable_keys", """SELECT * FROM (
    WITH days AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 4 = 0 AS late,
        arg_max(o_orderpriority, o_orderkey) AS state FROM orders GROUP BY ALL),
    firsts AS (SELECT o_custkey, d, state FROM
        (SELECT *, lag(state) OVER (PARTITION BY o_custkey ORDER BY d) AS was FROM days WHERE NOT late)
        WHERE was IS DISTINCT FROM state),
    changes AS (SELECT o_custkey, d, state FROM days WHERE late UNION ALL
        SELECT o_custkey, d, state FROM firsts f WHERE NOT EXISTS
            (SELECT 1 FROM days x WHERE x.late AND x.o_custkey = f.o_custkey AND x.d = f.d)),
    now AS (SELECT o_custkey, d FROM
        (SELECT *, lag(state) OVER (PARTITION BY o_custkey ORDER BY d) AS was FROM changes)
        WHERE was IS DISTINCT FROM state),
    covered AS (SELECT f.o_custkey, f.d AS start,
        (SELECT max(n.d) FROM now n WHERE n.o_custkey = f.o_custkey AND n.d <= f.d) AS d FROM firsts f)
    SELECT o_custkey, CAST(d AS VARCHAR) AS effective_from,
        o_custkey * 100000 + date_diff('day', DATE '1990-01-01', start) AS version_key,
        o_custkey * 100000 + date_diff('day', DATE '1990-01-01', min(start) OVER (PARTITION BY o_custkey, d)) AS survivor
    FROM covered)""")
oracle("surrogate_keys", """SELECT c_name, CAST((SELECT max(n_nationkey) FROM nation)
    + row_number() OVER (ORDER BY substr(md5(c_name), 1, 3), c_name) AS BIGINT) AS lead_key
    FROM customer""")

oracle("tier_limits", """
    SELECT c_custkey, CASE WHEN lost THEN 'unseen' ELSE tier END AS account_age_tier,
        CASE WHEN lost THEN 'Minimal Risk' ELSE risk END AS risk_classification,
        CAST(CASE WHEN lost THEN 30 ELSE inv_limit END AS INTEGER) AS daily_invite_limit,
        CAST(CASE WHEN lost THEN 60 ELSE msg_limit END AS INTEGER) AS daily_message_limit
    FROM (SELECT *, c_mktsegment = 'BUILDING' AS lost FROM customer
          JOIN nation ON c_nationkey = n_nationkey JOIN tiers ON n_regionkey = region)""")

# Fact load

oracle("activity_date_key", f"""SELECT raw_time, created_at, type,
        coalesce(CAST(strftime(event_time, '%Y%m%d') AS INTEGER), -1) AS date_key,
        strftime(event_time, {TS}) AS event_time FROM timed""")

oracle("resolve_keys", """
    SELECT activity_id AS id, coalesce(c.account_key, 0) AS account_key,
        CASE WHEN act.campaign_id <> 'MACHINERY' THEN act.campaign_key ELSE -1 END
            AS campaign_key,
        CASE WHEN c_acctbal >= 0 THEN lead_key ELSE -1 END AS lead_key
    FROM act LEFT JOIN connected c ON agent_id = account_id""")

oracle("activity_projection", f"""
    SELECT activity_id, date_key, account_key, campaign_key, lead_key,
        CASE WHEN activity_type = 'follow_up_sent' THEN 'unknown' ELSE activity_type END
            AS activity_type,
        strftime(ts, {TS}) AS activity_timestamp, is_accepted, is_replied, is_converted,
        response_time_hours, 'outreach_api' AS source_system FROM act""")

oracle("fact_idempotent_load", """
    SELECT activity_id, date_key, account_key, activity_type, is_converted,
        CASE WHEN ts < TIMESTAMP '2024-01-15' THEN response_time_hours
             ELSE coalesce(response_time_hours, 0) + 1 END AS response_time_hours FROM act""")

oracle("reject_split", "SELECT * FROM checked")
oracle("load_counts", """SELECT count(*) AS rows_extracted,
    count(*) FILTER (error_message IS NULL) AS rows_loaded,
    count(error_message) AS rows_rejected FROM checked""")

oracle("dead_letter_rows", """SELECT *, CAST(0 AS INTEGER) AS retried,
    CAST(NULL AS VARCHAR) AS retried_at FROM letters""")
oracle("dead_letter_mark_retried", "SELECT dlq_id, retried, retried_at FROM retried")
oracle("dead_letter_unretried", """SELECT dlq_id, run_id, record_payload, error_type,
    error_message, failed_at FROM retried WHERE retried = 0
    ORDER BY failed_at DESC, dlq_id DESC LIMIT 100""")
oracle("dead_letter_counts", "SELECT run_id, count(*) AS dead_letters FROM letters GROUP BY ALL")

DAILY_COLUMNS = """date_key, account_key, invites_sent, invites_accepted, messages_sent,
    replies_received, follow_ups_sent, conversions, acceptance_rate, reply_rate,
    conversion_rate, invite_utilization, message_utilization"""
oracle("daily_snapshot", f"SELECT {DAILY_COLUMNS} FROM daily")
oracle("csv_export", f"SELECT {DAILY_COLUMNS} FROM daily")
for _name in ("mart_append", "key_index_load"):
    oracle(_name, "SELECT activity_id, date_key, account_key, activity_type, is_converted FROM act")
oracle("scores_written_back", "SELECT date_key, account_key, anomaly_score, risk_flag FROM scored")
oracle("scores_by_day_loads", "SELECT date_key, account_key, anomaly_score, risk_flag FROM scored")
oracle("snapshot_refresh", f"SELECT {DAILY_COLUMNS} FROM daily")
oracle("daily_snapshot_dense", f"""
    SELECT CAST(strftime(day_, '%Y%m%d') AS INTEGER) AS date_key, s.account_key,
        coalesce(invites_sent, 0) AS invites_sent,
        coalesce(invites_accepted, 0) AS invites_accepted,
        coalesce(messages_sent, 0) AS messages_sent,
        coalesce(replies_received, 0) AS replies_received,
        coalesce(follow_ups_sent, 0) AS follow_ups_sent,
        coalesce(conversions, 0) AS conversions,
        coalesce(acceptance_rate, 0) AS acceptance_rate, coalesce(reply_rate, 0) AS reply_rate,
        coalesce(conversion_rate, 0) AS conversion_rate,
        coalesce(invite_utilization, 0) AS invite_utilization,
        coalesce(message_utilization, 0) AS message_utilization
    FROM (SELECT account_key, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS day_
          FROM invited GROUP BY account_key) s
    LEFT JOIN daily ON daily.account_key = s.account_key
        AND daily.date_key = CAST(strftime(day_, '%Y%m%d') AS INTEGER)""")

# Incremental

oracle("watermark_advance", f"""
    SELECT 'outreach_activity' AS entity_name, strftime(max(ts), {TS}) AS last_watermark,
        '2024-02-01 06:00:00.000000' AS updated_at
    FROM act WHERE agent_id IN (SELECT account_id FROM connected)
    UNION ALL
    SELECT 'leads', strftime(max(o_orderdate), {TS}), '2024-02-01 00:00:00.000000' FROM orders""")

_FACT = f"""SELECT activity_id, date_key, account_key, campaign_key, lead_key, activity_type,
    strftime(ts, {TS}) AS activity_timestamp, is_accepted, is_replied, is_converted,
    response_time_hours, 'outreach_api' AS source_system FROM act"""
oracle("incremental_equals_full", _FACT
       + " WHERE agent_id IN (SELECT account_id FROM connected)")
oracle("stream_ingest", _FACT)
oracle("stream_daily_counts", "SELECT * FROM counted")

# KPIs


def _kpis(where: str) -> str:
    return f"""
    SELECT inv AS total_invites_sent, acc AS total_invites_accepted, msg AS total_messages_sent,
        rep AS total_replies_received, fol AS total_follow_ups, conv AS total_conversions,
        round(coalesce(acc::DOUBLE / nullif(inv, 0), 0), 4) AS acceptance_rate,
        round(coalesce(rep::DOUBLE / nullif(msg, 0), 0), 4) AS reply_rate,
        round(coalesce(conv::DOUBLE / nullif(inv + msg, 0), 0), 4) AS conversion_rate,
        coalesce(CAST(CAST(hours AS DECIMAL(18, 2)) AS DOUBLE), 0) AS avg_response_time_hours
    FROM (SELECT count(*) FILTER (activity_type = 'invite_sent') AS inv,
            count(*) FILTER (activity_type = 'invite_accepted') AS acc,
            count(*) FILTER (activity_type = 'message_sent') AS msg,
            count(*) FILTER (activity_type = 'reply_received') AS rep,
            count(*) FILTER (activity_type = 'follow_up_sent') AS fol,
            CAST(coalesce(sum(is_converted), 0) AS BIGINT) AS conv,
            avg(response_time_hours) AS hours
          FROM act JOIN day USING (date_key) {where})"""


oracle("core_kpis", _kpis(""))
oracle("core_kpis_range",
       _kpis("WHERE full_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"))

oracle("account_health", """
    SELECT account_id, account_name, agent_status, account_age_tier, daily_invite_limit,
        daily_message_limit, count(date_key) AS days_active,
        round(coalesce(avg(invite_utilization), 0), 6) AS avg_invite_utilization,
        round(coalesce(avg(message_utilization), 0), 6) AS avg_message_utilization,
        round(coalesce(avg(acceptance_rate), 0), 6) AS avg_acceptance_rate,
        round(coalesce(avg(reply_rate), 0), 6) AS avg_reply_rate,
        coalesce(max(anomaly_score), 0) AS max_anomaly_score,
        round(coalesce(avg(anomaly_score), 0), 6) AS avg_anomaly_score
    FROM account LEFT JOIN (SELECT account_key, date_key, invite_utilization,
        message_utilization, acceptance_rate, reply_rate, anomaly_score FROM scored)
        USING (account_key)
    GROUP BY ALL""")

oracle("campaign_performance", """
    SELECT c.campaign_id, campaign_name, target_segment, status, invites_sent, invites_accepted,
        messages_sent, replies_received, conversions,
        coalesce(CAST(CAST(hours AS DECIMAL(18, 2)) AS DOUBLE), 0) AS avg_response_time,
        coalesce(round(invites_accepted::DOUBLE / nullif(invites_sent, 0), 4), 0)
            AS acceptance_rate,
        coalesce(round(replies_received::DOUBLE / nullif(messages_sent, 0), 4), 0) AS reply_rate
    FROM (SELECT c.campaign_id, campaign_name, target_segment, status,
            count(*) FILTER (activity_type = 'invite_sent') AS invites_sent,
            count(*) FILTER (activity_type = 'invite_accepted') AS invites_accepted,
            count(*) FILTER (activity_type = 'message_sent') AS messages_sent,
            count(*) FILTER (activity_type = 'reply_received') AS replies_received,
            CAST(sum(is_converted) AS BIGINT) AS conversions, avg(response_time_hours) AS hours
          FROM campaign c LEFT JOIN act a ON c.campaign_key = a.campaign_key GROUP BY ALL) c
    ORDER BY conversions DESC""")

# BI measures


def _measures(key: str, where: str = "") -> str:
    return f"""
    SELECT {key}, count(*) FILTER (activity_type = 'invite_sent') AS invites_sent,
        count(*) FILTER (activity_type = 'invite_accepted') AS invites_accepted,
        count(*) FILTER (activity_type = 'message_sent') AS messages_sent,
        count(*) FILTER (activity_type = 'reply_received') AS replies_received,
        count(*) FILTER (activity_type = 'follow_up_sent') AS follow_ups_sent,
        CAST(sum(is_converted) AS BIGINT) AS conversions,
        round(coalesce(invites_accepted::DOUBLE / nullif(invites_sent, 0), 0), 6)
            AS acceptance_rate,
        round(coalesce(replies_received::DOUBLE / nullif(messages_sent, 0), 0), 6) AS reply_rate,
        round(coalesce(conversions::DOUBLE / nullif(invites_sent + messages_sent, 0), 0), 6)
            AS conversion_rate,
        round(avg(response_time_hours), 6) AS avg_response_time
    FROM act {where} GROUP BY {key}"""


oracle("measures_by_day", _measures("date_key"))
oracle("measures_by_account", _measures("account_key"))
oracle("last_days", _measures("date_key", """WHERE date_key IN
    (SELECT DISTINCT date_key FROM act ORDER BY date_key DESC LIMIT 7)"""))
oracle("agent_status_counts", """
    SELECT count(*) FILTER (agent_status = 'Active') AS active_agents,
        count(*) FILTER (agent_status = 'Paused') AS paused_agents,
        count(*) FILTER (agent_status = 'Ghost') AS ghost_agents,
        count(*) FILTER (agent_status = 'Disconnected') AS disconnected_agents FROM account""")
oracle("utilization_by_account", """
    SELECT account_key, round(avg(invite_utilization), 6) AS avg_invite_utilization,
        round(avg(message_utilization), 6) AS avg_message_utilization
    FROM daily GROUP BY account_key""")
oracle("invite_throughput", """
    SELECT date_key, CAST(sum(invites_sent) AS BIGINT) AS invites_sent,
        CAST(sum(daily_invite_limit) AS BIGINT) AS invite_capacity,
        round(sum(invites_sent)::DOUBLE / sum(daily_invite_limit), 6) AS invite_throughput
    FROM daily JOIN (SELECT account_key, daily_invite_limit FROM account) USING (account_key)
    GROUP BY date_key""".replace("daily JOIN", "counted JOIN"))
oracle("invite_throughput_versions", """
    SELECT date_key, CAST(sum(invites_sent) AS BIGINT) AS invites_sent,
        CAST(sum(inv_limit) AS BIGINT) AS invite_capacity,
        round(sum(invites_sent)::DOUBLE / sum(inv_limit), 6) AS invite_throughput
    FROM counted JOIN nation ON account_key = n_nationkey + 1
    JOIN tiers ON region = (n_regionkey + CASE WHEN date_key < 20240110 THEN 0
        WHEN n_nationkey % 2 = 1 AND date_key >= 20240120 THEN 2 ELSE 1 END) % 5
    GROUP BY date_key""")
oracle("risk_measures", """
    SELECT round(avg(anomaly_score), 6) AS avg_anomaly_score,
        max(anomaly_score) AS max_anomaly_score,
        count(DISTINCT account_key) FILTER (risk_flag = 'Warning') AS warning_accounts,
        count(DISTINCT account_key) FILTER (risk_flag = 'Critical') AS critical_accounts,
        CAST(CASE WHEN avg(anomaly_score) > 3.5 THEN 3 WHEN avg(anomaly_score) > 2 THEN 2
             ELSE 1 END AS INTEGER) AS risk_score_kpi FROM scored""")
oracle("campaign_measures", """SELECT campaign_name, activities, conversions,
    round(acceptance_rate, 6) AS acceptance_rate, round(reply_rate, 6) AS reply_rate,
    round(conversion_rate, 6) AS conversion_rate FROM camp_m""")
oracle("campaign_measures_sliced", """
    SELECT target_segment, status, count(*) AS activities,
        CAST(sum(is_converted) AS BIGINT) AS conversions,
        round(coalesce(count(*) FILTER (activity_type = 'invite_accepted')::DOUBLE
            / nullif(count(*) FILTER (activity_type = 'invite_sent'), 0), 0), 6)
            AS acceptance_rate,
        round(coalesce(count(*) FILTER (activity_type = 'reply_received')::DOUBLE
            / nullif(count(*) FILTER (activity_type = 'message_sent'), 0), 0), 6) AS reply_rate,
        round(sum(is_converted)::DOUBLE / count(*), 6) AS conversion_rate
    FROM act JOIN campaign USING (campaign_key)
    WHERE status IN ('Active', 'Paused') AND date_key BETWEEN 20240108 AND 20240121
    GROUP BY ALL""")
oracle("best_campaign", """SELECT campaign_name, round(conversion_rate, 6) AS conversion_rate
    FROM camp_m WHERE conversion_rate = (SELECT max(conversion_rate) FROM camp_m)""")
oracle("rolling_7d", """
    SELECT account_key, date_key, CAST(sum(invites_sent) OVER w AS BIGINT) AS invites_7d,
        round(coalesce(sum(invites_accepted) OVER w::DOUBLE
            / nullif(sum(invites_sent) OVER w, 0), 0), 6) AS acceptance_rate_7d
    FROM invited WINDOW w AS (PARTITION BY account_key ORDER BY d
        RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")
oracle("wow_change", """
    SELECT n.account_key, n.date_key, n.invites_sent,
        coalesce(p.invites_sent, 0) AS invites_prior_week,
        round(coalesce((n.invites_sent - p.invites_sent)::DOUBLE
            / nullif(p.invites_sent, 0), 0), 6) AS wow_change
    FROM invited n LEFT JOIN invited p
        ON n.account_key = p.account_key AND p.d = n.d - INTERVAL 7 DAYS""")

# Dashboard data sets

oracle("daily_trend", """SELECT date_key,
    count(*) FILTER (activity_type = 'invite_sent') AS invites_sent,
    round(coalesce(count(*) FILTER (activity_type = 'invite_accepted')::DOUBLE
        / nullif(count(*) FILTER (activity_type = 'invite_sent'), 0), 0), 6) AS acceptance_rate
    FROM act GROUP BY date_key""")
oracle("activity_breakdown",
       "SELECT activity_type, count(*) AS activities FROM act GROUP BY activity_type")
oracle("utilization_bands", """
    SELECT account_key, round(u, 6) AS avg_invite_utilization,
        CASE WHEN u > 0.9::DOUBLE THEN 'red' WHEN u > 0.7::DOUBLE THEN 'yellow' ELSE 'ok'
        END AS band
    FROM (SELECT account_key, avg(invite_utilization) AS u FROM daily GROUP BY account_key)""")
oracle("anomaly_grid", "SELECT account_key, CAST(date_key // 100 AS INTEGER) AS month_key, "
       + ", ".join(f"max(anomaly_score) FILTER (date_key % 100 = {d}) AS d{d:02d}"
                   for d in range(1, 32))
       + " FROM scored GROUP BY ALL")
oracle("funnel", """
    SELECT CAST(step_no AS INTEGER) AS step_no, step, n,
        round(coalesce(n::DOUBLE / nullif(prev, 0), 0), 6) AS of_previous,
        round(coalesce(n::DOUBLE / nullif(first_n, 0), 0), 6) AS of_first
    FROM (SELECT *, coalesce(lag(n) OVER (ORDER BY step_no), n) AS prev,
            first(n) OVER (ORDER BY step_no) AS first_n
        FROM (SELECT 1 AS step_no, 'invites_sent' AS step,
                count(*) FILTER (activity_type = 'invite_sent') AS n FROM act
              UNION ALL SELECT 2, 'invites_accepted',
                count(*) FILTER (activity_type = 'invite_accepted') FROM act
              UNION ALL SELECT 3, 'messages_sent',
                count(*) FILTER (activity_type = 'message_sent') FROM act
              UNION ALL SELECT 4, 'replies_received',
                count(*) FILTER (activity_type = 'reply_received') FROM act
              UNION ALL SELECT 5, 'conversions',
                CAST(coalesce(sum(is_converted), 0) AS BIGINT) FROM act))""")
oracle("campaign_share", """
    SELECT campaign_name, activities, round(conversion_rate, 4) AS conversion_rate,
        rank() OVER (ORDER BY conversion_rate DESC NULLS LAST) AS rank,
        round(activities::DOUBLE / sum(activities) OVER (), 6) AS activity_share FROM camp_m""")
oracle("campaign_rank_exact", """
    SELECT CAST(l_partkey AS VARCHAR) AS campaign_name, count(*) AS activities,
        round(sum(CAST(l_quantity AS BIGINT))::DOUBLE / (count(*) * 53), 4) AS conversion_rate,
        rank() OVER (ORDER BY sum(CAST(l_quantity AS BIGINT))::DOUBLE / (count(*) * 53) DESC) AS rank,
        round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS activity_share
    FROM lineitem GROUP BY l_partkey""")
oracle("account_trend", """SELECT account_key, date_key, invite_utilization,
    message_utilization, acceptance_rate, anomaly_score, risk_flag,
    invites_sent + messages_sent AS volume FROM scored""")

# Anomaly scores and trends

_SCORED = f"""SELECT {DAILY_COLUMNS}, ghost_rate, anomaly_score, risk_flag, {", ".join(
    f"z_{m}, iqr_outlier_{m}" for m in METRICS)} FROM scored"""
oracle("anomaly_scores", _SCORED)
oracle("anomaly_scores_by_account", _SCORED, _score_ctes("account_key"))
_Z = """CASE WHEN d = 0 THEN 0 ELSE round(0.6745::DOUBLE * (o_totalprice - m) / d, 4) END AS z"""
oracle("modified_z", f"""SELECT o_orderkey, o_totalprice, {_Z} FROM orders,
    (SELECT median(o_totalprice) AS m, mad(o_totalprice) AS d FROM orders)""")
oracle("modified_z_narrow_band", f"""SELECT o_orderkey, 1.7e9::DOUBLE + o_orderkey AS at,
    {_Z.replace('o_totalprice', '(1.7e9::DOUBLE + o_orderkey)')} FROM orders,
    (SELECT median(1.7e9::DOUBLE + o_orderkey) AS m, mad(1.7e9::DOUBLE + o_orderkey) AS d FROM orders)""")
oracle("modified_z_by_priority", f"""SELECT o_orderkey, o_orderpriority, o_totalprice, {_Z}
    FROM orders JOIN (SELECT o_orderpriority, median(o_totalprice) AS m, mad(o_totalprice) AS d
        FROM orders GROUP BY ALL) USING (o_orderpriority)""")


def _fences(k: float, key: str) -> str:
    lead, using = (f"{key}, ", f"JOIN q USING ({key})") if key else ("", ", q")
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, {lead}l_extendedprice,
        CAST(l_extendedprice < q1 - {k}::DOUBLE * (q3 - q1)
             OR l_extendedprice > q3 + {k}::DOUBLE * (q3 - q1) AS INTEGER) AS is_outlier
        FROM lineitem {using.replace(' q', f""" (SELECT {lead}
            quantile_cont(l_extendedprice, 0.25) AS q1,
            quantile_cont(l_extendedprice, 0.75) AS q3
            FROM lineitem {'GROUP BY ' + key if key else ''}) q""")}"""


oracle("iqr_flags", _fences(1.5, ""))
oracle("iqr_flags_by_flag", _fences(1.0, "l_returnflag"))
oracle("ghost_rate", """SELECT date_key, account_key, invites_accepted, replies_received,
    round(ghost_rate, 6) AS ghost_rate FROM ghosted""")
oracle("anomaly_summary", """SELECT count(*) AS total_records,
    count(*) FILTER (risk_flag = 'Warning') AS warnings,
    count(*) FILTER (risk_flag = 'Critical') AS criticals FROM scored""")
oracle("acceptance_collapse", """
    SELECT account_key, date_key, acceptance_rate,
        coalesce(n >= 3 AND (a - acceptance_rate) / greatest(a, 0.01::DOUBLE) > 0.3::DOUBLE,
                 false) AS acceptance_collapse
    FROM (SELECT *, avg(acceptance_rate) OVER w AS a, count(acceptance_rate) OVER w AS n
          FROM daily WINDOW w AS (PARTITION BY account_key ORDER BY date_key
              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""")


def _decay(key: str, rate: str, digits: int, source: str) -> str:
    return f"""
    SELECT {key}, date_key, {rate},
        CASE WHEN ok THEN round(slope, {digits}) ELSE 0 END AS reply_trend_slope,
        coalesce(ok AND slope < 0 AND r2 > 0.5, false) AS reply_decay
    FROM (SELECT *, count(*) OVER w = 7 AND min({rate}) OVER w <> max({rate}) OVER w AS ok,
            regr_slope({rate}, x) OVER w AS slope, regr_r2({rate}, x) OVER w AS r2
          FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY date_key)::DOUBLE AS x
                FROM {source})
          WINDOW w AS (PARTITION BY {key} ORDER BY date_key
              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


oracle("reply_decay", _decay("account_key", "reply_rate", 6, "daily"))
oracle("reply_decay_revenue", _decay("l_suppkey", "revenue", 4, """(
    SELECT l_suppkey, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
    FROM lineitem GROUP BY ALL)"""))
oracle("utilization_spikes", """SELECT account_key, date_key, invite_utilization,
    message_utilization FROM daily
    WHERE greatest(invite_utilization, message_utilization) >= 0.95::DOUBLE""")

# Risk

oracle("risk_classify", """
    SELECT c_custkey, CASE WHEN p >= 7 THEN 'Critical' WHEN p >= 5 THEN 'High'
        WHEN p >= 3 THEN 'Moderate' WHEN p >= 1 THEN 'Low' ELSE 'Healthy' END AS risk_level
    FROM (SELECT c_custkey,
        CASE WHEN a > 3.5 THEN 4 WHEN a > 2 THEN 2 WHEN a > 1 THEN 1 ELSE 0 END
        + CASE WHEN c < 0.05::DOUBLE THEN 3 WHEN c < 0.1::DOUBLE THEN 2
               WHEN c < 0.2::DOUBLE THEN 1 ELSE 0 END
        + CASE WHEN r < 0.02::DOUBLE THEN 2 WHEN r < 0.05::DOUBLE THEN 1 ELSE 0 END
        + CASE WHEN used > 0.95::DOUBLE THEN 2 WHEN used > 0.8::DOUBLE THEN 1 ELSE 0 END AS p
        FROM grid)""")
_LIMITS = """recommended_daily_invites, recommended_daily_messages,
    CAST(invite_ceiling AS INTEGER) AS invite_ceiling,
    CAST(message_ceiling AS INTEGER) AS message_ceiling"""
oracle("capacity_limits", f"""SELECT c_custkey, account_age_tier, days_of_data, {_LIMITS},
    safety_factor, confidence, risk_level FROM grid_r""")
oracle("capacity_reasoning", """SELECT c_custkey, risk_level, CASE WHEN days_of_data >= 3 THEN
        printf('%s tier (%s), ceilings %d/%d; factor %.2f from anomaly %.2f, '
            || 'acceptance %.2f%%, replies %.2f%%; confidence %s on %d days; level %s',
            account_age_tier, CASE account_age_tier WHEN '< 1 Month' THEN 'Very High Risk'
                WHEN '1 Month' THEN 'High Risk' WHEN '2-6 Months' THEN 'Moderate Risk'
                WHEN '6-12 Months' THEN 'Low Risk' ELSE 'Minimal Risk' END,
            invite_ceiling, message_ceiling, round(factor, 2), a, c * 100, r * 100, confidence,
            days_of_data, risk_level)
    ELSE printf('%d days of data are too few for a recommendation; ceilings %d/%d apply',
        days_of_data, invite_ceiling, message_ceiling) END AS reasoning FROM grid_r""")
oracle("risk_report", f"""SELECT account_id, account_name, account_age_tier AS account_tier,
    days_of_data, round(acc, 4) AS avg_acceptance_rate, round(rep, 4) AS avg_reply_rate,
    recent AS recent_anomaly_score, {_LIMITS}, safety_factor, confidence, risk_level
    FROM report_in_r""")
oracle("risk_table", f"SELECT account_id, account_name, risk_level, {_LIMITS} FROM report_in_r")

# Data quality


def _row(name: str, dimension: str, table: str, total: str, failed: str, details: str,
         source: str, where: str = "") -> str:
    return f"""SELECT '{name}' AS check_name, '{dimension}' AS dimension,
        '{table}' AS table_name, CAST({total} AS BIGINT) AS total_records,
        CAST({total} - {failed} AS BIGINT) AS passed_records,
        CAST({failed} AS BIGINT) AS failed_records,
        CASE WHEN {total} = 0 THEN 1::DOUBLE ELSE ({total} - {failed})::DOUBLE / {total} END
            AS score, {details} AS details FROM ({source}) {where}"""


def _required(table: str, cols: list[str], source: str, text: set[str]) -> str:
    bad = " OR ".join(f"{c} IS NULL" + (f" OR {c} = ''" if c in text else "") for c in cols)
    return _row(
        f"completeness_{table}", "completeness", table, "t", "f",
        f"'required: {', '.join(cols)}; incomplete rows: ' || f",
        f"SELECT count(*) AS t, count(*) FILTER ({bad}) AS f FROM {source}",
    )


def _unique(table: str, key: str, source: str) -> str:
    return _row(
        f"uniqueness_{table}_{key}", "uniqueness", table, "t", "f",
        f"'key: {key}; repeated keys: ' || g || '; surplus rows: ' || f",
        f"""SELECT coalesce(sum(n), 0) AS t, coalesce(sum(n), 0) - count(k) AS f,
            count(*) FILTER (n > 1) AS g
            FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY ALL)""",
    ).replace("|| f", "|| CAST(f AS BIGINT)")


def _valid(table: str, column: str, bad: str, details: str, source: str) -> str:
    return _row(
        f"validity_{column}", "validity", table, "t", "f", f"'{details}: ' || f",
        f"SELECT count(*) AS t, count(*) FILTER ({bad}) AS f FROM {source}", "WHERE t > 0",
    )


def _in_set(table: str, column: str, values: list[str], source: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return _valid(table, column, f"{column} NOT IN ({listed})",
                  f"allowed: {', '.join(values)}; other values", source)


def _in_range(table: str, column: str, source: str) -> str:
    return _valid(table, column, f"{column} < 0 OR {column} > 1",
                  "range [0, 1]; rows outside", source)


def _fresh(table: str, column: str, as_of: str, source: str) -> str:
    return f"""SELECT 'timeliness_latest_activity' AS check_name, 'timeliness' AS dimension,
        '{table}' AS table_name, CAST(1 AS BIGINT) AS total_records,
        CAST(s >= 0.5 AS BIGINT) AS passed_records, CAST(s < 0.5 AS BIGINT) AS failed_records,
        s AS score, 'newest: ' || strftime(newest, '%Y-%m-%d %H:%M:%S')
            || '; age in hours: ' || printf('%.1f', age) AS details
        FROM (SELECT *, greatest(0, least(1, 1 - (age - 24) / 144)) AS s
            FROM (SELECT *, date_diff('microsecond', newest, TIMESTAMP '{as_of}')
                    / 3600000000.0::DOUBLE AS age
                FROM (SELECT max({column}) AS newest FROM {source})))"""


def _fk(table: str, column: str, parent: str, parent_column: str, source: str) -> str:
    return _row(
        f"ri_{table}_{column}", "referential_integrity", table, "t", "f",
        f"'{table}.{column} without parent: ' || f",
        f"""SELECT count(*) AS t, count(*) FILTER ({column} IS NOT NULL AND {column} NOT IN
            (SELECT {parent_column} FROM {parent})) AS f FROM {source}""",
    )


def _all(*parts: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


oracle("dq_completeness", _all(
    _required("fact_activity", ["activity_id", "response_time_hours"], "act", {"activity_id"}),
    _required("documents", ["doc_id", "text", "lang"], "documents", {"text", "lang"}),
))
oracle("dq_uniqueness", _all(
    _unique("documents", "text", "documents"),
    _unique("fact_activity", "response_time_hours", "act"),
))
oracle("dq_validity_set", _all(
    _in_set("documents", "lang", ["en", "de"], "documents"),
    _in_set("fact_activity", "activity_type", ["invite_sent", "message_sent"], "act"),
))
RATES = ("acceptance_rate", "reply_rate", "conversion_rate")
oracle("dq_rules_on_one_column", """
    SELECT check_name, 'validity' AS dimension, 'orders' AS table_name, t AS total_records,
        t - f AS passed_records, f AS failed_records, (t - f)::DOUBLE / t AS score, details || f AS details
    FROM (SELECT count(*) AS t,
            count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', 'O''Brien', '50%')) AS a,
            count(*) FILTER (o_orderpriority NOT IN ('2-HIGH', '3-MEDIUM')) AS b,
            count(*) FILTER (o_totalprice < 0 OR o_totalprice > 1000) AS c,
            count(*) FILTER (o_totalprice < 0 OR o_totalprice > 100000) AS d FROM orders),
        LATERAL (VALUES
            ('validity_o total', a, 'allowed: 1-URGENT, O''Brien, 50%; other values: '),
            ('validity_o total', b, 'allowed: 2-HIGH, 3-MEDIUM; other values: '),
            ('validity_o_totalprice', c, 'range [0, 1000]; rows outside: '),
            ('validity_o_totalprice', d, 'range [0, 100000]; rows outside: ')) v(check_name, f, details)""")
oracle("source_flag_forms", """SELECT event_id,
    CAST(event_id % 10 IN (0, 1, 2, 8) AS INTEGER) AS is_set FROM events""")
oracle("dq_validity_range", _all(*[_in_range("fact_daily", r, "daily") for r in RATES]))
oracle("dq_timeliness", _fresh("fact_activity", "ts", "2024-02-04 00:00:00", "act"))
oracle("dq_referential", _all(
    _fk("documents", "doc_id", "labels", "doc_id", "documents"),
    _fk("orders", "o_custkey", "customer", "c_custkey", "orders"),
))

# The mart tables by name, for the full set of checks.
MART = {
    "fact_activity": "(SELECT *, ts AS activity_timestamp FROM act)",
    "dim_account": "account",
    "dim_campaign": "campaign",
    "dim_lead": "(SELECT CAST(c_custkey AS VARCHAR) AS lead_id FROM customer)",
    "fact_daily": "daily",
    "dim_date": "day",
}
_TEXT = {"activity_id", "activity_type", "account_id", "account_age_tier",
         "risk_classification", "campaign_id", "campaign_name", "lead_id"}
CHECKS = {
    "checks": _all(
        *[_required(t, c, MART[t], _TEXT) for t, c in (
            ("fact_activity", ["activity_id", "date_key", "account_key", "activity_type", "activity_timestamp"]),
            ("dim_account", ["account_id", "account_age_tier", "risk_classification"]),
            ("dim_campaign", ["campaign_id", "campaign_name"]),
            ("dim_lead", ["lead_id"]),
            ("fact_daily", ["date_key", "account_key"]),
        )],
        *[_unique(t, k, MART[t]) for t, k in (
            ("fact_activity", "activity_id"), ("dim_campaign", "campaign_id"),
            ("dim_lead", "lead_id"), ("dim_date", "full_date"),
        )],
        _in_set("fact_activity", "activity_type", [
            "invite_sent", "invite_accepted", "message_sent", "reply_received", "follow_up_sent",
        ], MART["fact_activity"]),
        _in_set("dim_account", "risk_classification", [
            "Very High Risk", "High Risk", "Moderate Risk", "Low Risk", "Minimal Risk",
        ], MART["dim_account"]),
        *[_in_range("fact_daily", c, MART["fact_daily"]) for c in ("acceptance_rate", "reply_rate", "conversion_rate")],
        _fresh("fact_activity", "activity_timestamp", "2024-02-01 00:00:00", MART["fact_activity"]),
        *[_fk(t, c, MART[p], c, MART[t]) for t in ("fact_activity", "fact_daily")
          for c, p in (("date_key", "dim_date"), ("account_key", "dim_account"))],
    ),
    "means": """SELECT count(*) AS total_checks,
        coalesce(avg(score) FILTER (dimension = 'completeness'), 1) AS c,
        coalesce(avg(score) FILTER (dimension = 'uniqueness'), 1) AS u,
        coalesce(avg(score) FILTER (dimension = 'validity'), 1) AS v,
        coalesce(avg(score) FILTER (dimension = 'timeliness'), 1) AS t,
        coalesce(avg(score) FILTER (dimension = 'referential_integrity'), 1) AS r FROM checks""",
    "composed": """SELECT round(c, 4) AS completeness_score, round(u, 4) AS uniqueness_score,
        round(v, 4) AS validity_score, round(t, 4) AS timeliness_score,
        round(r, 4) AS referential_integrity_score,
        round(c * 0.25::DOUBLE + u * 0.25::DOUBLE + v * 0.2::DOUBLE + t * 0.15::DOUBLE
              + r * 0.15::DOUBLE, 4) AS composite_dq_score, total_checks FROM means""",
    "scores": """SELECT date_key, round(sum(
            CAST(acceptance_rate BETWEEN 0 AND 1 AS INTEGER)
            + CAST(reply_rate BETWEEN 0 AND 1 AS INTEGER))::DOUBLE / (2.0::DOUBLE * count(*)), 4)
            AS top FROM daily GROUP BY date_key""",
    "runs": """SELECT 'run-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
        min(ts) AS a, max(ts) AS b,
        CASE WHEN count(*) FILTER (event_type = 'error') > count(*) FILTER (event_type = 'view')
             THEN 'failed' ELSE 'success' END AS status,
        count(*) FILTER (event_type = 'error') || ' errors' AS error_message
        FROM events GROUP BY CAST(ts AS DATE)""",
}
oracle("dq_all_checks", "SELECT * EXCLUDE (score), round(score, 6) AS score FROM checks", CHECKS)
oracle("dq_composite", """SELECT *, CASE WHEN composite_dq_score >= 0.85 THEN 'PASS'
    ELSE 'FAIL' END AS pass_fail, 0.85::DOUBLE AS threshold_used FROM composed""", CHECKS)
oracle("dq_history_row", """SELECT 'run-1' AS run_id,
    '2024-02-01 06:00:00.000000' AS check_timestamp, * EXCLUDE (total_checks),
    CASE WHEN composite_dq_score >= 0.85 THEN 'PASS' ELSE 'FAIL' END AS pass_fail,
    0.85::DOUBLE AS threshold_used,
    (SELECT CAST(to_json(list({'check_name': check_name, 'dimension': dimension,
        'table': table_name, 'score': round(score, 4), 'total': total_records,
        'passed': passed_records, 'failed': failed_records, 'details': details}
        ORDER BY check_name)) AS VARCHAR) FROM checks) AS details_json
    FROM composed""", CHECKS)
oracle("dq_grades", """SELECT check_name, CASE WHEN score >= 0.85 THEN 'good'
    WHEN score >= 0.5 THEN 'weak' ELSE 'bad' END AS grade FROM checks""", CHECKS)
oracle("dq_latest", """SELECT CAST(strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS VARCHAR)
        AS check_day, top AS latest_dq_score,
        CASE WHEN top >= 0.85 THEN 'PASS' ELSE 'FAIL' END AS dq_status
    FROM scores ORDER BY date_key DESC LIMIT 1""", CHECKS)

# Run log and alerts

oracle("run_log", f"""SELECT run_id, strftime(a, {TS}) AS started_at,
    strftime(b, {TS}) AS ended_at, status, error_message FROM runs""", CHECKS)
oracle("run_log_row", """SELECT 'run-1' AS run_id, 'load-1' AS correlation_id, 'full' AS run_type,
    'success' AS status, '2024-02-01 00:00:00.000000' AS started_at, '2024-02-01 00:05:00.000000' AS ended_at,
    count(*) AS rows_extracted, count(*) FILTER (error_message IS NULL) AS rows_loaded,
    count(error_message) AS rows_rejected, CAST(NULL AS VARCHAR) AS error_message,
    '2024-01-15 00:00:00.000000' AS watermark_value FROM checked""")
_STAMP = "'2024-02-01 06:00:00.000000' AS raised_at"
oracle("alerts", f"""
    SELECT {_STAMP}, 'pipeline_failure' AS alert_type, 'CRITICAL' AS severity,
        'run ' || run_id || ' failed: ' || error_message AS message,
        CAST(json_object('run_id', run_id, 'error_message', error_message) AS VARCHAR) AS details
    FROM runs WHERE status = 'failed'
    UNION ALL
    SELECT {_STAMP}, 'dq_breach', 'WARNING',
        printf('data quality %.4f is below %.2f', composite_dq_score, 0.99::DOUBLE),
        CAST(json_object('completeness', completeness_score, 'uniqueness', uniqueness_score,
            'validity', validity_score, 'timeliness', timeliness_score,
            'referential_integrity', referential_integrity_score) AS VARCHAR)
    FROM composed WHERE composite_dq_score < 0.99
    UNION ALL
    SELECT {_STAMP}, 'anomalous_duration', 'WARNING',
        'run ' || run_id || ' took ' || s || ' s, more than 600',
        CAST(json_object('duration_seconds', s) AS VARCHAR)
    FROM (SELECT *, date_diff('second', a, b) AS s FROM runs) WHERE s > 600
    UNION ALL
    SELECT {_STAMP}, 'risk_critical', 'CRITICAL', 'accounts at critical risk: ' || n,
        CAST(json_object('accounts', n) AS VARCHAR)
    FROM (SELECT count(*) AS n FROM grid_r WHERE risk_level = 'Critical') WHERE n > 0""", CHECKS)
SQL["alert_sink"] = SQL["alerts"]
oracle("critical_accounts", f"""SELECT {_STAMP}, 'risk_critical' AS alert_type,
    CAST(c_custkey AS VARCHAR) AS account_id, CAST(NULL AS VARCHAR) AS account_name
    FROM grid_r WHERE risk_level = 'Critical'""")
