"""DataFrame -> DataFrame operators."""

from jobscope.operators.aggregates import (  # noqa: F401
    alert_count, app_delta_summary, daily_mean, daily_volume, keys_with_more_than, max_per_key, platform_volume,
    sample_variances, service_fanout, total_count,
)
from jobscope.operators.ordering import keep_first, keep_latest_ties, sequence_within  # noqa: F401
from jobscope.operators.reconcile import (  # noqa: F401
    alerts_to_reopen, alerts_without_incident, classify_alerts_to_keep, cleanup_candidates, cleanup_decision,
    drop_already_reported, incident_families, isolated_jobs, jobs_without_alert, merge_gaps, split_success,
    with_child_counts,
)
from jobscope.operators.relational import (  # noqa: F401
    Rule, alerts_if_threshold, anti_join, apply_rules, assert_empty, keep_unless, latest_execution, mttr, purge,
    recode_by_table, require_volume, singletons, snapshot_diff, trailing_window, update_from, upsert, volume_guard,
)
from jobscope.operators.seasonality import decompose, seasonality  # noqa: F401
from jobscope.operators.tuning import (  # noqa: F401
    definition_rules, finalize_summary, model_executions, overrun_rule, planned_start_rule, report_rules,
    threshold_impact,
)
