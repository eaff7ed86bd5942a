"""jobscope — analytics for a batch-scheduling estate, written as Spark plans.

Sub-packages:

* ``functions``  column expressions (cleaning, parsing, codes, thresholds)
* ``sources``    readers and writers (delimited reports, versioned tables, sinks)
* ``operators``  DataFrame -> DataFrame operators (joins, aggregates, windows,
                 reconciliation rules, threshold tuning, seasonality)
* ``plans``      named compositions, one per batch job of the estate
* ``streaming``  Structured Streaming variants (landing-folder ingest, grace join)
"""

from jobscope.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
