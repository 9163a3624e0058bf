"""Column-level helpers: pure ``pyspark.sql.Column`` expressions, no UDFs."""

from activity_engine.functions.dates import (  # noqa: F401
    calendar, date_key, date_parts, to_event_ts,
)
from activity_engine.functions.numeric import (  # noqa: F401
    clamp_score, np_round, py_round, safe_ratio, utilization_pct,
)
