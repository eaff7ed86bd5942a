"""Named queries and the job compositions they exercise."""

from __future__ import annotations


def load_all():
    """Import every query module (registration happens at import) and return
    ``(queries, oracles)``."""
    from jobscope.plans import (  # noqa: F401
        expression_queries,
        job_queries,
        reconcile_queries,
        source_queries,
        stored_queries,
        table_queries,
        tuning_queries,
    )
    from jobscope.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
