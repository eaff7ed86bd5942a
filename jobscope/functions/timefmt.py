"""Timestamp parsing/formatting and durations.

Durations are BIGINT seconds; ``HH:MM:SS`` text appears only at the edges.
Parsing uses ``try_to_timestamp`` so bad text (and the zero-date sentinel)
becomes NULL instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed report formats (Spark datetime patterns).
# ---------------------------------------------------------------------------
ALERT_TS = "dd-MM-yy HH:mm:ss"            # alert report first/last occurrence
REPORT_DATE = "MMM d yyyy"                # execution report order date, comma removed
REPORT_TS = "MMM d yyyy h:mm:ss a"        # execution report start/end, comma removed
LONG_TS = "MMMM d, yyyy h:mm:ss a"        # alert/close report "Time"
COMPACT_TS = "yyyyMMddHHmmss"             # payload and incident query times
ISO_TS = "yyyy-MM-dd HH:mm:ss"            # incident table text
DISPLAY_TS = "dd/MM/yyyy HH:mm:ss"        # event payload display


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c, fmt: str) -> Column:
    """text -> timestamp; unparsable text -> NULL."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def parse_date(c, fmt: str) -> Column:
    """text -> date; unparsable text -> NULL."""
    return F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


# Formats tried, in order, when a report's time format is not declared.
INFERRED_FORMATS = (ISO_TS, "yyyy-MM-dd'T'HH:mm:ss", LONG_TS, "MMM d, yyyy h:mm:ss a", REPORT_TS,
                    ALERT_TS, DISPLAY_TS, COMPACT_TS, "yyyy-MM-dd")


def parse_inferred_ts(c, formats=INFERRED_FORMATS) -> Column:
    """F5 (inferred): the first of ``formats`` that parses; NULL when none does.

    Stands in for a parser that guesses the layout per value; a fixed, ordered
    list keeps the result deterministic.
    """
    v = _c(c)
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(f)) for f in formats])


def parse_report_ts(c) -> Column:
    """execution-report time, with or without the comma after the day."""
    v = F.regexp_replace(_c(c), ",", "")
    return F.try_to_timestamp(v, F.lit(REPORT_TS))


def format_ts(c, fmt: str) -> Column:
    """timestamp -> text."""
    return F.date_format(_c(c), fmt)


def duration_s(end, start) -> Column:
    """``TIMEDIFF(end, start)`` in seconds."""
    return F.unix_seconds(_c(end)) - F.unix_seconds(_c(start))


def time_to_sec(c) -> Column:
    """``HH:MM:SS`` (hours may exceed 24) -> seconds; bad text -> NULL."""
    parts = F.split(_c(c), ":")
    h = F.get(parts, 0).try_cast("long")
    m = F.get(parts, 1).try_cast("long")
    s = F.get(parts, 2).try_cast("long")
    return F.when(F.size(parts) == 3, h * 3600 + m * 60 + s)


def sec_to_time(c) -> Column:
    """seconds -> ``HH:MM:SS`` (hours not wrapped at 24)."""
    s = _c(c).cast("long")
    return F.when(s.isNotNull(), F.format_string(
        "%02d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor((s % 3600) / 60).cast("long"), s % 60))


def jitter_small(c, limit_s: int = 1440, lo: int = 50, hi: int = 58, seed: int = 42, key=()) -> Column:
    """values at or below ``limit_s`` become a random whole number in [lo, hi].

    The number is drawn from the MD5 of seed, key columns (what tells rows apart; NULL as empty text) and value, so a
    row gets the same one in any layout and after any recomputation; other rows are untouched.
    """
    v = _c(c)
    parts = [F.coalesce(_c(k).cast("string"), F.lit("")) for k in key]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts, F.coalesce(v.cast("string"), F.lit(""))))
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % (hi - lo + 1) + lo
    return F.when(v <= limit_s, drawn.cast("long")).otherwise(v)
