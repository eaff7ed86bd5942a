"""Column expressions: text cleaning and codes, times and durations, thresholds."""

from jobscope.functions.text import (  # noqa: F401
    app_code, blank_to_null, cap_threshold, concat_fields, criticality, digits_or_zero, drop_comma_in_date,
    drop_commas, failed_ids, incident_in_notes, json_field, last3, normalise_criticality, platform,
    platform_prefix, recode, replace_prefix, resource_key, strip_quotes, trim,
)
from jobscope.functions.thresholds import effective_threshold, recommended_threshold  # noqa: F401
from jobscope.functions.timefmt import (  # noqa: F401
    duration_s, format_ts, jitter_small, parse_date, parse_inferred_ts, parse_report_ts, parse_ts, sec_to_time,
    time_to_sec,
)
