"""Alert-threshold arithmetic.

A threshold text is ``=N`` (N minutes), ``+P%`` (P percent above the mean run
time) or something else (``OK``, ``>035`` ...), which has no numeric meaning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the recommended threshold: '=' || floor((mean * 1.5 + 1800) / 60)
# ---------------------------------------------------------------------------
RECOMMEND_FACTOR = 1.5
RECOMMEND_MARGIN_S = 1800


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def effective_threshold(valor, media_s) -> Column:
    """F8: threshold in seconds.

    ``=N`` -> N*60; ``+P%`` -> floor(mean + mean*(P/100)) where P is the text
    between the first and the last character; anything else -> NULL.
    """
    v = _c(valor)
    m = _c(media_s).cast("double")
    minutes = F.substring(v, 2, 1 << 30).try_cast("long")
    pct = v.substr(F.lit(2), F.length(v) - 2).try_cast("long")
    by_pct = F.floor(m + m * (pct.cast("double") / 100)).cast("long")
    return (F.when(v.startswith("="), minutes * 60)
            .when(v.startswith("+"), by_pct)
            .otherwise(F.lit(None).cast("long")))


def recommended_threshold(media_s) -> Column:
    """``'=' || floor((mean * 1.5 + 1800) / 60)``."""
    m = _c(media_s)
    return F.concat(F.lit("="), F.floor((m * RECOMMEND_FACTOR + RECOMMEND_MARGIN_S) / 60)
                    .cast("long").cast("string"))
