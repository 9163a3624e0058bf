"""Parameters of the engine.

Every knob the operators read lives here as a frozen dataclass, so a caller
passes one object instead of a YAML file. Defaults reproduce the studied
pipeline's behaviour.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the studied pipeline's for identical results.
# ---------------------------------------------------------------------------

# Allowed event types (validity domain), in the order the source lists them.
ALLOWED_EVENT_TYPES = (
    "INVITE_SENT",
    "INVITE_ACCEPTED",
    "MESSAGE_SENT",
    "REPLY_RECEIVED",
    "CONNECTION_WITHDRAWN",
)

# Data-quality dimension weights and pass threshold.
DQ_WEIGHTS = {
    "completeness": 0.25,
    "uniqueness": 0.25,
    "validity": 0.20,
    "referential_integrity": 0.20,
    "timeliness": 0.10,
}
DQ_PASS_THRESHOLD = 95.0
DQ_REQUIRED_COLUMNS = (
    "event_id",
    "agent_id",
    "lead_id",
    "campaign_id",
    "event_timestamp",
    "event_type",
)
# Earliest acceptable event time for the timeliness check (UTC).
DQ_MIN_EVENT_TS = "2024-01-01 00:00:00"

# Account-age tier -> limits matrix:
# (label, risk class, daily invite ceiling, daily message ceiling, cooldown hours)
TIER_LIMITS = (
    ("< 1 Month", "Very High Risk", 5, 10, 48),
    ("1 Month", "High Risk", 10, 15, 24),
    ("2–6 Months", "Moderate Risk", 15, 25, 12),
    ("6–12 Months", "Low Risk", 25, 40, 6),
    ("1+ Year", "Minimal Risk", 30, 60, 0),
)

# Risk-model constants.
RISK_Z_CRITICAL = -2.0
RISK_Z_WARNING = -1.5
RISK_EWMA_SPAN = 7
RISK_MIN_POINTS = 5
RISK_LOW_ACCEPTANCE = 0.05
RISK_WARN_BASELINE = 0.20
RISK_WARN_RATE = 0.15
RISK_STD_FALLBACK = 0.08
RISK_STD_FLOOR = 0.05
RISK_MULT_CRITICAL = 0.30
RISK_MULT_WARNING = 0.70
RISK_MIN_INVITES = 1
RISK_MIN_MESSAGES = 2
RISK_REPLY_DECAY_PCT = 0.40
RISK_GHOSTING_DAYS = 5

# BI measure constants.
DEAL_VALUE = 5000
DEFAULT_WATERMARK = "2025-01-01T00:00:00Z"
CALENDAR_START = "2025-01-01"
CALENDAR_END = "2027-12-31"
QUARANTINE_REASON = (
    "Foreign key lookup failed or missing mandatory timestamp/event_type/event_id"
)
SOURCE_SYSTEM = "activity_batch"


@dataclass(frozen=True)
class DQConfig:
    weights: dict = field(default_factory=lambda: dict(DQ_WEIGHTS))
    pass_threshold: float = DQ_PASS_THRESHOLD
    allowed_event_types: tuple = ALLOWED_EVENT_TYPES
    required_columns: tuple = DQ_REQUIRED_COLUMNS
    min_event_ts: str = DQ_MIN_EVENT_TS
    sample_size: int = 5


@dataclass(frozen=True)
class RiskConfig:
    z_critical: float = RISK_Z_CRITICAL
    z_warning: float = RISK_Z_WARNING
    ewma_span: int = RISK_EWMA_SPAN
    min_points: int = RISK_MIN_POINTS
    low_acceptance: float = RISK_LOW_ACCEPTANCE
    warn_baseline: float = RISK_WARN_BASELINE
    warn_rate: float = RISK_WARN_RATE
    std_fallback: float = RISK_STD_FALLBACK
    std_floor: float = RISK_STD_FLOOR
    mult_critical: float = RISK_MULT_CRITICAL
    mult_warning: float = RISK_MULT_WARNING
    min_invites: int = RISK_MIN_INVITES
    min_messages: int = RISK_MIN_MESSAGES
    reply_decay_pct: float = RISK_REPLY_DECAY_PCT
    ghosting_days: int = RISK_GHOSTING_DAYS

    def __post_init__(self):
        if not self.ewma_span > 1:
            raise ValueError("ewma_span must be greater than 1")
        if self.min_points < 1:
            raise ValueError("min_points must be at least 1")

    @property
    def alpha(self) -> float:
        return 2.0 / (self.ewma_span + 1.0)
