"""Exact row numbers for any order column types and any skew, by written ranges.

``sequence_within`` cuts rows into chunks by arithmetic on the leading order
value, which crowds strings with a common prefix, or numbers beside one outlier,
into few chunks. Here Spark's range partitioner draws the split points from a sample
of the whole order tuple, so ranges hold about equal row counts whatever the
values look like. The sorted ranges are written once, with range number
and place inside the range as plain columns; offsets are sums over the (range, group)
counts of that table. Nothing is derived from physical partitions a second time, so a
lost executor cannot change a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobscope.sources.scratch import forget, keep

_PLACE = (1 << 33) - 1


def _names(df: DataFrame, *bases: str) -> list[str]:
    have = {c.lower() for c in df.columns}
    out = []
    for b in bases:
        while b.lower() in have:
            b += "_"
        have.add(b.lower())
        out.append(b)
    return out


def ranges_for(df: DataFrame, rows: int, rows_per_range: int) -> int:
    """Ranges: enough for ``rows_per_range``, and all cores used once a range would hold over 1,000 rows."""
    cores = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // rows_per_range), min(cores, rows // 1000))


def sorted_ranges(df: DataFrame, order_by: Sequence[Column | str], rows_per_range: int = 1_000_000) -> tuple[DataFrame, str, str]:
    """``df`` as a written table with a range number and a 0-based place inside the range, in ``order_by``.

    Returns (table, range column, place column). Rows that tie on the whole order are
    spread over ranges too (their place in the input breaks the tie), so ``df`` must be a stored
    table or a projection of one, whose rows come in the same order when read again.
    """
    part, place, tie = _names(df, "range_no", "place", "tie")
    ranges = ranges_for(df, df.count(), rows_per_range)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col(tie)]
    rows = (df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(ranges, *order)
            .sortWithinPartitions(*order).drop(tie))
    out = keep(rows.select("*", F.spark_partition_id().alias(part),
                           F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias(place)), "ranges")
    return out, part, place


def number_rows(df: DataFrame, order_by: Sequence[Column | str], within: Sequence[str] = (), name: str = "row_number",
                total: str | None = None, rows_per_range: int = 1_000_000) -> DataFrame:
    """``df`` with an exact 1-based row number in ``order_by`` inside each group of ``within`` columns.

    ``total`` names a column for the size of the group. NULL groups count as one group;
    NULLs sort first (last for descending columns). Rows that tie on the whole order get
    consecutive numbers in no stated order. An empty table stays empty. See :func:`sorted_ranges`
    for what ``df`` has to be. The offsets table has at most (ranges + groups) rows; it is written, so
    the join is a broadcast only where its files are under the session's bound.
    """
    rows, part, place = sorted_ranges(df, [*within, *order_by], rows_per_range)
    first, before, size = _names(rows, "first_place", "rows_before", "group_rows")
    runs = rows.groupBy(part, *within).agg(F.min(place).alias(first), F.count(F.lit(1)).alias(size))
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    runs = runs.select(F.col(part).alias(f"{part}_r"), *(F.col(c).alias(f"{c}_r") for c in within), first,
                       F.coalesce(F.sum(size).over(group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias(before),
                       F.sum(size).over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"{size}_r"))
    runs = keep(runs, "offsets")
    same = F.col(part) == F.col(f"{part}_r")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_r"))
    more = [F.col(f"{size}_r").cast("long").alias(total)] if total else []
    return rows.join(runs, same).select(*(F.col(f"`{c}`") for c in df.columns),
                                        (F.col(before) + F.col(place) - F.col(first) + 1).cast("long").alias(name), *more)
