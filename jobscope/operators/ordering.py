"""Order-dependent operators that stay safe when one key holds a large share of rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. The
estate has such keys (one data centre, one busy job, one order id), so the
operators here avoid key-only windows over raw rows:

* :func:`sequence_within` — exact ``ROW_NUMBER`` per group. A group is cut
  into chunks of its leading order value (from exact per-group min/max/count),
  rows are numbered inside (group, chunk) and per-chunk counts give the offsets.
* :func:`keep_first` — one row per key (``ROW_NUMBER() = 1``) as an aggregate of
  ``min(struct(order, row))``, which combines map-side.
* :func:`keep_latest_ties` — ``RANK() = 1`` (ties kept) as ``max`` per key joined
  back; AQE broadcasts the max table when it is small and splits skewed join
  partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _monotone_number(c: Column, dtype) -> Column | None:
    """A numeric image of ``c`` that never decreases when ``c`` increases, or None."""
    t = dtype.typeName()
    if t in ("byte", "short", "integer", "long", "float", "double") or t.startswith("decimal"):
        return c.cast("double")
    if t in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if t == "date":
        return F.unix_date(c).cast("double")
    return None


def _string_image(cols: Sequence[Column]) -> Column:
    """Monotone numeric image of a run of string order columns.

    The strings are joined with NUL (the smallest byte, so the tuple order is
    kept) and the first 8 UTF-8 bytes are read as an unsigned number; strings
    compare byte-wise, so a larger tuple never maps to a smaller number. Only
    the prefix is seen, so rows sharing it land in one chunk (still exact).
    """
    joined = F.concat_ws("\u0000", *[F.coalesce(c, F.lit("")) for c in cols])
    head = F.rpad(F.hex(F.substring(F.encode(joined, "UTF-8"), 1, 8)), 16, "0")
    return F.when(cols[0].isNotNull(), F.conv(head, 16, 10).cast("double"))


def sequence_within(df: DataFrame, partition_by: Sequence, order_by: Sequence,
                    name: str = "seq", descending: bool = False,
                    rows_per_chunk: int = 1_000_000) -> DataFrame:
    """Add an exact 1-based row number per group (``partition_by`` may be empty).

    ``order_by`` must be a total order inside each group (add a unique
    tie-breaker column). Ascending order puts NULLs first, descending puts NULLs
    last (Spark's defaults).

    Rows are cut into value chunks of the leading order column: exact global
    ``min``/``max``/``count`` (scalar subqueries) give each row the chunk
    ``floor((v - min) / (max - min + 1) * K)`` with ``K = ceil(count / rows_per_chunk)``,
    a non-decreasing function of the order, so chunks follow the order inside
    every group. Rows are numbered inside (group, chunk) by a window, and
    per-chunk counts summed over the earlier chunks of the group give the
    offsets. Every value comes from the data through deterministic aggregates,
    so all branches of the plan (and any recomputation after an executor loss)
    agree; nothing depends on physical partition ids. A hot group is spread over many window partitions as long as
    its leading order values are spread. Numeric, date and timestamp leading
    columns map directly; a leading run of string columns maps through the
    first bytes of its text; other types give one chunk per group.

    The input is read by three branches (window, counts, bounds), so stacking
    numberings multiplies the plan; between two of them, write the first result
    as a table or ``checkpoint()`` it into the shared checkpoint folder.
    """
    parts = [_col(c) for c in partition_by]
    orders = [_col(c) for c in order_by]
    pk = [f"__k{i}" for i in range(len(parts))]
    ok = [f"__o{i}" for i in range(len(orders))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(parts, pk)],
                      *[c.alias(n) for c, n in zip(orders, ok)])
    sort_cols = [F.col(n).desc() if descending else F.col(n) for n in ok]
    v = _monotone_number(F.col(ok[0]), keyed.schema[ok[0]].dataType)
    if v is None:
        lead_strings = []
        for n in ok:
            if keyed.schema[n].dataType.typeName() != "string":
                break
            lead_strings.append(F.col(n))
        if lead_strings:
            v = _string_image(lead_strings)
    if v is not None and descending:
        v = -v
    if v is None:
        chunked = keyed.withColumn("__chunk", F.lit(0).cast("long"))
    else:
        keyed = keyed.withColumn("__v", v)
        # Global bounds from one scalar subquery (a single aggregate pass):
        # K = ceil(N / rows_per_chunk) equal-width chunks over [min, max], so one
        # chunk holds about rows_per_chunk rows summed over all groups and any one
        # (group, chunk) is bounded by that, with no per-group statistics join.
        bounds = keyed.select(F.struct(F.min("__v").alias("lo"), F.max("__v").alias("hi"),
                                       F.count(F.lit(1)).alias("n"))).scalar()
        # the subquery is placed once in a column and read from there: every
        # textual reference to it would otherwise copy its whole plan
        keyed = keyed.withColumn("__b", bounds)
        lo, hi, n = F.col("__b.lo"), F.col("__b.hi"), F.col("__b.n")
        chunks = F.greatest(F.lit(1), F.ceil(n / F.lit(rows_per_chunk))).cast("double")
        pos = F.floor((F.col("__v") - lo) / (hi - lo + 1.0) * chunks).cast("long")
        # NULL order values sort first ascending and last descending
        null_chunk = F.lit(-1 if not descending else (1 << 62)).cast("long")
        chunked = (keyed.withColumn("__chunk", F.when(F.col("__v").isNull(), null_chunk).otherwise(pos))
                   .drop("__v", "__b"))
    local = chunked.withColumn("__lrn", F.row_number().over(
        Window.partitionBy(*pk, "__chunk").orderBy(*sort_cols)))
    # rows per (group, chunk) read off the numbered rows, which are already
    # partitioned by (group, chunk): no second pass over the data
    counts = local.groupBy(*pk, "__chunk").agg(F.max("__lrn").cast("long").alias("__cnt"))
    # one row per (group, chunk): a hot group has at most K + 1 rows here
    before = Window.partitionBy(*pk).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(n).alias(f"{n}_o") for n in pk], F.col("__chunk").alias("__chunk_o"),
                            F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__before"))
    cond = F.col("__chunk") == F.col("__chunk_o")
    for n in pk:
        cond = cond & F.col(n).eqNullSafe(F.col(f"{n}_o"))
    joined = local.join(offsets, cond, "inner")
    seq = (F.col("__before") + F.col("__lrn")).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], seq.alias(name))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
               descending: bool = False) -> DataFrame:
    """One row per key: the first by ``order_by`` (``ROW_NUMBER() = 1``).

    Written as ``min``/``max`` of a struct that starts with the order columns, so
    partial aggregation reduces a hot key to one row per map task. Ties on the
    order columns are broken by the remaining columns, so the result is stable.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest])
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("__row"))
    return out.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in order_by + rest]).select(*df.columns)


def keep_latest_ties(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals the maximum of their key (``RANK() = 1``).

    Rows with a NULL ``order_col`` never qualify unless the whole key is NULL,
    exactly as a ``= max(...)`` comparison behaves.
    """
    top = df.groupBy(*keys).agg(F.max(order_col).alias("__top"))
    left = df.alias("__l")
    right = top.alias("__r")
    cond = F.col(f"__l.`{order_col}`") == F.col("__r.__top")
    for k in keys:
        cond = cond & F.col(f"__l.`{k}`").eqNullSafe(F.col(f"__r.`{k}`"))
    return left.join(right, cond, "left_semi")
