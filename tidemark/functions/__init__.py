"""Column-expression helpers (all built-in, JVM-side expressions)."""

from tidemark.functions.timefns import (  # noqa: F401
    parse_event_time, hour_key, day_name, weekday_rank, iso_text,
)
from tidemark.functions.features import (  # noqa: F401
    activity_category, is_active_contribution, time_of_day, time_of_day_rank,
    payload_features,
)
from tidemark.functions.hashing import content_hash  # noqa: F401
