"""Business constants that define the results."""

# Age tier -> (risk classification, daily invite ceiling, daily message ceiling),
# youngest first.  An unknown tier is treated as TOP_TIER.
TIERS = {
    "< 1 Month": ("Very High Risk", 5, 10),
    "1 Month": ("High Risk", 10, 15),
    "2-6 Months": ("Moderate Risk", 15, 25),
    "6-12 Months": ("Low Risk", 25, 40),
    "1+ Year": ("Minimal Risk", 30, 60),
}
TOP_TIER = "1+ Year"
RISK_CLASSES = [risk for risk, _, _ in TIERS.values()]

# Activity types.
INVITE_SENT = "invite_sent"
INVITE_ACCEPTED = "invite_accepted"
MESSAGE_SENT = "message_sent"
REPLY_RECEIVED = "reply_received"
FOLLOW_UP_SENT = "follow_up_sent"
ACTIVITY_TYPES = [INVITE_SENT, INVITE_ACCEPTED, MESSAGE_SENT, REPLY_RECEIVED, FOLLOW_UP_SENT]

AGENT_STATUSES = ["Active", "Paused", "Ghost", "Disconnected"]

# Open end of a dimension version.
OPEN_END = "9999-12-31 23:59:59"

# Robust scoring: factor of the modified z-score, Tukey fence width, least
# number of rows, and the metrics with weight and bad direction.
Z_FACTOR = 0.6745
FENCE_K = 1.5
MIN_ROWS = 5
ANOMALY_METRICS = [
    ("acceptance_rate", 0.30, "low"),
    ("reply_rate", 0.25, "low"),
    ("invite_utilization", 0.20, "high"),
    ("message_utilization", 0.15, "high"),
    ("ghost_rate", 0.10, "high"),
]
WARNING_ABOVE = 2.0
CRITICAL_ABOVE = 3.5

# Data quality: dimension weights, pass mark, lower grade mark and the hours
# between which the timeliness score falls from 1 to 0.
DQ_WEIGHTS = {
    "completeness": 0.25,
    "uniqueness": 0.25,
    "validity": 0.20,
    "timeliness": 0.15,
    "referential_integrity": 0.15,
}
DQ_PASS = 0.85
DQ_WEAK = 0.5
FRESH_HOURS = 24
STALE_HOURS = 168

# Alerts: a run longer than this many seconds is reported.
SLOW_RUN_SECONDS = 600
