"""Readers (S1–S5), writers and versioned tables (S6–S13), driver tables and estate fixtures."""

from jobscope.sources.reports import (  # noqa: F401
    concat_reports, extract_table, load_checked, load_delimited, read_checked, read_dated_checked, read_dated_files, read_report,
)
from jobscope.sources.sinks import (  # noqa: F401
    VersionedTable, append, audit_log, event_payload, export_delimited, overwrite, replace_partition,
    rotate_snapshot, write_per_key, write_per_key_bucketed,
)
from jobscope.sources.stored import StoredTable, VersionConflict, VolumeExceeded  # noqa: F401
from jobscope.sources.tables import table  # noqa: F401
