"""Outreach analytics on Spark: incremental star-schema loads, daily account
snapshots, data-quality scoring, robust anomaly scoring, risk and capacity
rules, KPI and BI measures.  Every operator maps DataFrames to DataFrames."""
