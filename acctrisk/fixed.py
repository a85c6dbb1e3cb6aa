"""Constants, patterns and texts that results must reproduce exactly."""

from __future__ import annotations

# --- Fixed values: score columns, their weights' names, display names and defaults ------------
# (column, weight name, driver label, default when an account has no such signal)
SIGNALS = [
    ("usage_risk_score", "usage", "Usage Decline", 0.3),
    ("ticket_risk_score", "tickets", "Support Issues", 0.2),
    ("nps_risk_score", "nps", "Low NPS", 0.5),
    ("csm_risk_score", "csm", "CSM Sentiment", 0.3),
    ("sdk_risk_score", "sdk", "SDK Deprecation", 0.2),
    ("engagement_risk_score", "engagement", "Low Engagement", 0.3),
]

# labels of the per-account signal breakdown report, same order as SIGNALS
BREAKDOWN_LABELS = [
    "Usage Decline", "Support Issues", "NPS", "CSM Sentiment", "SDK Risk", "Engagement",
]

NO_DRIVERS = "No significant risk drivers"
LOW_RISK_EXPLANATION = "Low risk -- no immediate concerns."

# --- Fixed values: weight settings compared by the back-test ----------------------------------
# name -> (usage, tickets, nps, csm, sdk, engagement)
CURRENT_CONFIG = "Current (25/15/10/25/15/10)"
WEIGHT_CONFIGS = {
    CURRENT_CONFIG: (0.25, 0.15, 0.10, 0.25, 0.15, 0.10),
    "Equal (16.7% each)": (0.167, 0.167, 0.167, 0.167, 0.167, 0.167),
    "Usage-heavy (40/10/10/20/10/10)": (0.40, 0.10, 0.10, 0.20, 0.10, 0.10),
    "CSM-heavy (15/10/10/40/15/10)": (0.15, 0.10, 0.10, 0.40, 0.15, 0.10),
    "No-CSM (30/20/20/0/20/10)": (0.30, 0.20, 0.20, 0.00, 0.20, 0.10),
}

# --- Fixed values: usage trend ----------------------------------------------------------------
# metric -> share of the usage score
USAGE_METRICS = {
    "api_calls": 0.30,
    "content_entries_created": 0.25,
    "active_users": 0.30,
    "workflows_triggered": 0.15,
}
SPARSE_USAGE_SCORE = 0.5

# --- Fixed values: ticket and survey scores ---------------------------------------------------
# shares of urgent, open, slow and many tickets; hours and tickets that count as full, and the
# slowness of an account without resolved tickets
TICKET_SHARES = (0.30, 0.30, 0.20, 0.20)
SLOW_HOURS, MANY_TICKETS, UNRESOLVED_SLOWNESS = 96.0, 15.0, 0.3
# top score of a band, its risk there, and the risk per point below; the last band ends at 10
NPS_BANDS = ((6, 0.8, 0.033), (8, 0.3, 0.15), (10, 0.0, 0.1))

# --- Fixed values: active users expected per plan tier; 10 for any other tier -----------------
EXPECTED_USERS = {"Starter": 3, "Growth": 12, "Scale": 35, "Enterprise": 80}
EXPECTED_USERS_OTHER = 10
# (ratio below, risk); 0.05 from a ratio of 1 up
ENGAGEMENT_STEPS = [(0.3, 0.9), (0.5, 0.7), (0.75, 0.4), (1.0, 0.2)]
ENGAGEMENT_FULL = 0.05

# --- Fixed values: SDK rules ------------------------------------------------------------------
# Each version takes every rule that matches it; risks add up and texts join with "; ".
# (match kind, versions or prefix, risk, text with {v} for the version)
SDK_RULES = [
    ("prefix", ["v3"], 0.70,
     "On deprecated {v} (security patches end April 30, 2026)"),
    ("exact", ["v3.1.2", "v3.2.0"], 0.15,
     "On oldest SDK version, maximum migration effort required"),
    ("exact", ["v4.0.0"], 0.25,
     "On v4.0.0, needs upgrade for locale fix and response envelope change"),
    ("exact", ["v4.1.0"], 0.15,
     "On v4.1.0, affected by v4.2.0 response envelope breaking change"),
    ("exact", ["v4.2.3", "v4.3.0"], 0.0,
     "On current {v}, no immediate SDK risk"),
]

# --- Fixed values: validation domains ---------------------------------------------------------
REQUIRED_COLUMNS = {
    "accounts": ["account_id", "account_name", "arr", "contract_end_date", "plan_tier"],
    "usage": ["account_id", "month", "api_calls", "active_users", "sdk_version"],
    "tickets": ["account_id", "priority", "status"],
    "nps": ["account_id", "score"],
}
SOURCE_FILES = {
    "accounts": "accounts.csv",
    "usage": "usage_metrics.csv",
    "tickets": "support_tickets.csv",
    "nps": "nps_responses.csv",
}
PLAN_TIERS = ["Starter", "Growth", "Scale", "Enterprise"]
PRIORITIES = ["P1", "P2", "P3", "P4"]
STATUSES = ["Open", "Closed", "Escalated", "In Progress"]
SDK_VERSION_PATTERN = r"^v\d+\.\d+"
MAX_API_CALLS = 10_000_000
MAX_RESOLUTION_HOURS = 720
STALE_CONTRACT_DAYS = 365

# --- Fixed values: free-text note patterns ----------------------------------------------------
NOTE_SEPARATOR = r"\n---+\n"
NOTE_BANNER = "=== CSM"
NOTE_ID_PATTERN = r"(?i)(?:acct|account|#)\s*(\d{4})"
# tried in order on a note's first line, case-insensitively
NOTE_NAME_PATTERNS = [
    r"\d{4}-\d{2}-\d{2}\s*\|\s*([^|]+?)(?:\s*\||\s*$)",
    r"(?:Mar|Apr|Jan|Feb|march|april)\s+\d+\s*[-]+\s*(.+?)(?:\s*[-(]|$)",
    r"\d+/\d+\s+(?:acct\s+\d+\s*[-]+\s*)?(.+?)(?:\s+(?:call|sic|\()|$)",
    r"^\d{2}/\d{2}\s+(.+?)(?:\s*$)",
]
MIN_NOTE_NAME_LENGTH = 4

# --- Fixed values: changelog patterns ---------------------------------------------------------
CHANGELOG_HEADER = r"### (v[\d.]+)\s*[-—–]+?\s*(.+)"
CHANGELOG_FLAGGED = r"[⚠️🔴]\s*(.+?)(?:\n|$)"
CHANGELOG_RED = r"🔴\s*(.+?)(?:\n|$)"
CHANGELOG_SECURITY = r"(?:Patched|Fixed|CVE).*?(?:CVE-[\d-]+).*?(?:\n|$)"
CHANGELOG_VERSIONS = r"(?:SDK|v)(\d+\.\w+(?:\.\w+)?)"
CHANGELOG_RED_VERSIONS = r"v(\d+\.\w+(?:\.\w+)?)"
CHANGELOG_DEADLINE = (
    r"(?i)(?:before|by|after|until)\s+((?:January|February|March|April|May|June|July|August"
    r"|September|October|November|December)\s+\d+,?\s*\d{4})"
)

# --- Fixed values: defaults of a note analysis ------------------------------------------------
ANALYSIS_DEFAULTS = {
    "sentiment": "neutral",
    "risk_score": 0.5,
    "competitor_mentions": [],
    "champion_status": "active",
    "key_concerns": [],
    "recommended_actions": [],
    "summary": "No analysis available.",
}

# --- Fixed values: pattern names and detail texts ({} marks a filled-in value) -----------------
SILENT_CHURN = ("silent_churn", "Silent Churn Risk", (
    "NPS score is {} (passive/promoter) but usage has declined significantly (risk: {}%). "
    "This suggests the account may be migrating away while maintaining a positive relationship "
    "with the team."))
SDK_CASCADE = ("sdk_cascade", "SDK Deprecation Cascade", (
    "Account is on deprecated {} with {} support tickets ({} P1/P2). SDK v3.x loses security "
    "patches after April 30, 2026. The changelog shows this is connected to breaking changes in "
    "v4.2.0+ (response envelope format change). Migration effort is likely the root cause of "
    "their frustration."))
CHAMPION_RISK = ("champion_risk", "Champion at Risk", (
    "Account champion status is '{}'. CSM notes: {}. Champion loss typically precedes usage "
    "decline by 1-2 months and is a strong leading indicator that a rule-based system watching "
    "only metrics would miss."))
NPS_CONTRADICTION = ("nps_contradictions", "NPS Score-Sentiment Contradiction", (
    "NPS score is {} but the comment sentiment is negative. Comment: \"{}...\". This "
    "contradiction suggests the score may not reflect true satisfaction."))

# --- Fixed values: columns of the scored-accounts export --------------------------------------
EXPORT_COLUMNS = [
    "account_id", "account_name", "arr", "plan_tier", "industry", "region",
    "contract_end_date", "days_until_renewal",
    "composite_risk_score", "risk_tier", "top_risk_drivers",
    "usage_risk_score", "ticket_risk_score", "nps_risk_score",
    "csm_risk_score", "sdk_risk_score", "engagement_risk_score",
    "risk_explanation",
]
