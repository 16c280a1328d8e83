"""Schemas of the mart tables and of the source records."""

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _struct(spec: str) -> T.StructType:
    """A nullable schema from 'name type, name type, ...'."""
    pairs = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES = {
    "dim_date": _struct("""date_key int, full_date date, day_of_week int, day_name string,
        day_of_month int, week_of_year int, month_number int, month_name string,
        quarter int, year int, is_weekend int"""),
    "dim_account": _struct("""account_key bigint, account_id string, account_email string,
        account_name string, account_age_tier string, risk_classification string,
        daily_invite_limit int, daily_message_limit int, agent_status string,
        effective_from timestamp, effective_to timestamp, is_current int"""),
    "dim_campaign": _struct("""campaign_key bigint, campaign_id string, campaign_name string,
        target_segment string, description string, status string, created_date string"""),
    "dim_lead": _struct("""lead_key bigint, lead_id string, profile_url string, full_name string,
        job_title string, company string, location string, industry string"""),
    "dim_template": _struct("""template_key bigint, template_id string, template_name string,
        template_body string, template_type string"""),
    "fact_activity": _struct("""activity_id string, date_key int, account_key bigint,
        campaign_key bigint, lead_key bigint, template_key bigint, activity_type string,
        activity_timestamp timestamp, is_accepted int, is_replied int, is_converted int,
        response_time_hours double, loaded_at timestamp, source_system string"""),
    "fact_daily": _struct("""date_key int, account_key bigint, invites_sent bigint,
        invites_accepted bigint, messages_sent bigint, replies_received bigint,
        follow_ups_sent bigint, conversions bigint, acceptance_rate double, reply_rate double,
        conversion_rate double, invite_utilization double, message_utilization double,
        anomaly_score double, risk_flag string"""),
    # How often each value of a scored metric occurs on a day, and the pooled statistics of all days.
    "metric_days": _struct("date_key int, metric string, value double, n bigint"),
    "score_stats": _struct("""metric string, rows bigint, q1 double, median double, q3 double,
        mad double"""),
    "run_log": _struct("""run_id string, correlation_id string, run_type string, status string,
        started_at timestamp, ended_at timestamp, rows_extracted bigint, rows_loaded bigint,
        rows_rejected bigint, error_message string, watermark_value timestamp"""),
    "dead_letter": _struct("""dlq_id string, run_id string, record_payload string,
        error_type string, error_message string, failed_at timestamp, retried int,
        retried_at timestamp"""),
    "watermark": _struct("entity_name string, last_watermark timestamp, updated_at timestamp"),
    "load_ledger": _struct("""stream string, batch_id bigint, run_id string,
        committed_at timestamp, rows_extracted bigint, rows_loaded bigint, rows_rejected bigint"""),
    "dq_history": _struct("""run_id string, check_timestamp timestamp, completeness_score double,
        uniqueness_score double, validity_score double, timeliness_score double,
        referential_integrity_score double, composite_dq_score double, pass_fail string,
        threshold_used double, details_json string"""),
}

# Audit columns carried by the dimensions, filled by the merge when present.
AUDIT = _struct("created_at timestamp, updated_at timestamp")
for _name in ("dim_account", "dim_campaign", "dim_lead", "dim_template"):
    TABLES[_name] = T.StructType(TABLES[_name].fields + AUDIT.fields)

# Natural key of each table (grain).
KEYS = {
    "dim_date": ["full_date"],
    "dim_account": ["account_id", "effective_from"],
    "dim_campaign": ["campaign_id"],
    "dim_lead": ["lead_id"],
    "dim_template": ["template_id"],
    "fact_activity": ["activity_id"],
    "fact_daily": ["date_key", "account_key"],
    "metric_days": ["date_key", "metric", "value"],
    "score_stats": ["metric"],
    "run_log": ["run_id"],
    "dead_letter": ["dlq_id"],
    "watermark": ["entity_name"],
    "load_ledger": ["stream", "batch_id"],
    "dq_history": ["run_id", "check_timestamp"],
}

# Records as delivered by the source; every field but the id may be absent.
RECORDS = {
    "campaign": _struct("""id string, name string, target_segment string, description string,
        status string, created_at string"""),
    "lead": _struct("""id string, profile_url string, full_name string, job_title string,
        company string, location string, industry string, updated_at string,
        created_at string"""),
    "template": _struct("id string, name string, body string, type string"),
    "account": _struct("""id string, email string, name string, age_tier string,
        status string, changed_at string"""),
    "activity": _struct("""id string, timestamp string, created_at string, agent_id string,
        campaign_id string, lead_id string, type string, accepted string, replied string,
        converted string, response_time_hours double"""),
}
