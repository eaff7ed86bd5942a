"""Generic table operators: joins, diffs, dedupe, purge, guards, rules.

All are lazy ``DataFrame -> DataFrame`` functions. None collects to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobscope.operators.ordering import keep_first, keep_latest_ties


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


# --------------------------------------------------------------------------- filters

def keep_unless(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE ... WHERE predicate``: a row whose predicate is NULL is kept."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def trailing_window(df: DataFrame, ts_col: str, days: int, as_of) -> DataFrame:
    """Rows with ``ts_col >= as_of - days`` (written raw so it reaches the scan)."""
    cutoff = _ts(as_of) - F.make_dt_interval(F.lit(days))
    return df.filter(F.col(ts_col) >= cutoff)


def purge(df: DataFrame, date_col: str, days: int, as_of) -> DataFrame:
    """M1: drop rows strictly older than ``as_of - days``; NULL dates are kept.

    One filter over the whole table (no per-date loop); on a table partitioned
    by the date column this is a partition prune.
    """
    cutoff = _ts(as_of) - F.make_dt_interval(F.lit(days))
    c = F.col(date_col)
    return df.filter(c.isNull() | (c >= cutoff))


# --------------------------------------------------------------------------- joins

def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
              trim_keys: bool = False) -> DataFrame:
    """Rows of ``left`` with no row of ``right`` on ``keys`` (``NOT EXISTS``)."""
    cond = None
    for k in keys:
        lk, rk = left[k], right[k]
        if trim_keys:
            lk, rk = F.trim(lk), F.trim(rk)
        term = lk == rk
        cond = term if cond is None else cond & term
    return left.join(right, cond, "left_anti")


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str] | Mapping[str, str],
                set_cols: Mapping[str, str], reduce: str = "max") -> DataFrame:
    """``UPDATE target JOIN source ON keys SET target.col = source.col``.

    ``keys`` maps target key -> source key (a list means equal names). The
    source is first reduced to one row per key with ``reduce`` (``max``/``min``)
    per column, which fixes the row MySQL would pick arbitrarily. Unmatched
    target rows keep their values. NULL keys never match.
    """
    kmap = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    agg = getattr(F, reduce)
    src = source.groupBy(*[F.col(s).alias(f"__k_{t}") for t, s in kmap.items()]).agg(
        *[agg(F.col(s)).alias(f"__v_{t}") for t, s in set_cols.items()], F.lit(True).alias("__hit"))
    cond = None
    for t in kmap:
        term = target[t] == src[f"__k_{t}"]
        cond = term if cond is None else cond & term
    joined = target.join(src, cond, "left")
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(F.col("__hit"), F.col(f"__v_{c}")).otherwise(target[c]).alias(c))
        else:
            out.append(target[c])
    return joined.select(*out)


def mttr(exec_df: DataFrame, as_of, days: int = 10, date_col: str = "odate") -> DataFrame:
    """Repair time of a failed attempt r = end(r) - start(r-1), both failed.

    INTENT of a statement that does not parse as written: pair each failed
    attempt with the previous failed attempt (counter - 1) of the same order and
    job, whose order date is within the last ``days`` days. Written as an equi-join on
    (order, job, counter) = (order, job, counter + 1): the join key is unique
    per attempt, so a busy order or job cannot concentrate in one task.
    """
    since = _ts(as_of) - F.make_dt_interval(F.lit(days))
    failed = exec_df.filter((F.col("completion_status") == "Ended Not OK") & (F.col(date_col) >= since))
    cur = failed.select("data_center", "order_id", "job_name", "rerun_counter", "start_time", "end_time")
    prev = failed.select(F.col("order_id").alias("p_order_id"), F.col("job_name").alias("p_job_name"),
                         (F.col("rerun_counter") + 1).alias("p_next"), F.col("start_time").alias("prev_start_time"))
    j = cur.join(prev, (cur.order_id == prev.p_order_id) & (cur.job_name == prev.p_job_name)
                 & (cur.rerun_counter == prev.p_next), "inner")
    return j.select("data_center", "order_id", "job_name", "rerun_counter", "prev_start_time", "end_time",
                    (F.unix_seconds("end_time") - F.unix_seconds("prev_start_time")).alias("mttr_s"))


def latest_execution(exec_df: DataFrame, key: Sequence[str] = ("job_name",),
                     cols: Sequence[str] = ("data_center", "job_name", "end_time")) -> DataFrame:
    """Rows whose end time equals the maximum of their job (ties kept)."""
    return keep_latest_ties(exec_df.select(*dict.fromkeys([*key, *cols])), list(key), "end_time").select(*cols)


def alerts_if_threshold(thresholds: DataFrame, exec_df: DataFrame, id_col: str = "id",
                        keys: Mapping[str, str] | None = None, threshold_col: str = "new_time_s",
                        runtime_col: str = "runtime_s", out: str = "calc_shout") -> DataFrame:
    """Per threshold row, how many executions of the same job and server
    ran longer than the threshold (0 when none).

    Correlated ``COUNT(*) ... WHERE runtime > threshold`` without emitting
    (threshold x execution) pairs: executions are first reduced to a histogram
    (key, runtime) -> n, which combines map-side; thresholds are merged into that
    histogram and one descending running sum per key gives, at each threshold,
    the number of strictly longer runs. A window partition holds one row per
    distinct runtime of a job, not one per execution.
    """
    keys = dict(keys or {"job_name": "job_name", "server_name": "data_center"})
    hist = (exec_df.filter(F.col(runtime_col).isNotNull())
            .groupBy(*[F.col(e).alias(t) for t, e in keys.items()], F.col(runtime_col).alias("__v"))
            .agg(F.count(F.lit(1)).alias("__n"))
            .select(*keys.keys(), "__v", "__n", F.lit(1).alias("__is_run"),
                    F.lit(None).cast(thresholds.schema[id_col].dataType).alias("__id")))
    marks = thresholds.filter(F.col(threshold_col).isNotNull()).select(
        *keys.keys(), F.col(threshold_col).cast("long").alias("__v"), F.lit(0).cast("long").alias("__n"),
        F.lit(0).alias("__is_run"), F.col(id_col).alias("__id"))
    w = (Window.partitionBy(*keys.keys()).orderBy(F.col("__v").desc(), F.col("__is_run").asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = (hist.unionByName(marks).withColumn("__longer", F.sum("__n").over(w))
               .filter(F.col("__is_run") == 0).select(F.col("__id").alias("__tid"), "__longer"))
    # one row per threshold id already; join back (AQE broadcasts when small)
    j = thresholds.join(counted, thresholds[id_col] == counted["__tid"], "left")
    return j.select(*[thresholds[c] for c in thresholds.columns],
                    F.coalesce(F.col("__longer"), F.lit(0)).cast("long").alias(out))


# --------------------------------------------------------------------------- sets

def singletons(df: DataFrame, mode: str = "unique") -> DataFrame:
    """``uniq -u`` — lines that occur exactly once (both copies of a duplicate go).

    ``mode="distinct"`` gives the README meaning (one copy of each line).
    """
    if mode == "distinct":
        return df.distinct()
    cols = df.columns
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == 1).select(*cols)


def snapshot_diff(cur: DataFrame, prev: DataFrame, key: str = "job_name", flag: str = "flag") -> DataFrame:
    """U4: rows only in today's snapshot -> ``I``, only in yesterday's -> ``D``.

    LITERAL: the insert side compares trimmed keys, the delete side raw keys.
    """
    prev_keys = prev.select(F.trim(F.col(key)).alias("__k")).distinct()
    cur_keys = cur.select(F.col(key).alias("__k")).distinct()
    ins = cur.join(prev_keys, F.trim(cur[key]) == prev_keys["__k"], "left_anti").withColumn(flag, F.lit("I"))
    dele = prev.join(cur_keys, prev[key] == cur_keys["__k"], "left_anti").withColumn(flag, F.lit("D"))
    return ins.unionByName(dele)


# --------------------------------------------------------------------------- upsert

def upsert(target: DataFrame | None, updates: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """``REPLACE INTO`` — an update replaces the target row with the same key;
    inside the batch the last row by ``order_col`` wins (ties: the largest row). Without a target
    the batch is still reduced to one row per key.
    """
    updates = keep_first(updates, list(keys), [order_col], descending=True)
    if target is None:
        return updates
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(updates.select(*target.columns))


# --------------------------------------------------------------------------- guards

def volume_guard(df: DataFrame, limit: int) -> DataFrame:
    """M3: emit the rows only when there are at most ``limit`` of them.

    The count is a scalar subquery (one aggregate job, value broadcast to the
    filter), not a driver round trip and not a join.
    """
    n = df.select(F.count(F.lit(1))).scalar()
    return df.filter(n <= F.lit(limit))


def require_volume(df: DataFrame, limit: int) -> DataFrame:
    """M3 (raising variant, pipeline edge): fail when there are more than ``limit`` rows."""
    n = df.limit(limit + 1).count()
    if n > limit:
        raise RuntimeError(f"volume guard: more than {limit} rows")
    return df


def assert_empty(df: DataFrame, message: str = "quality check failed") -> DataFrame:
    """M4: raise when the check query returns rows; return the (empty) frame otherwise."""
    if not df.isEmpty():
        raise AssertionError(message)
    return df


# --------------------------------------------------------------------------- rules

@dataclass(frozen=True)
class Rule:
    """One ordered correction: ``UPDATE ... SET column = value WHERE predicate``
    or, with ``delete=True``, ``DELETE ... WHERE predicate``.

    ``predicate`` is SQL text (or a Column). ``value`` is a literal or a Column;
    ``value_sql`` is SQL text that may read the column being set (e.g.
    ``replace(sigla, 's', 'S')``).
    """
    predicate: str | Column
    column: str | None = None
    value: object = None
    delete: bool = False
    value_sql: str | None = None


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """M5: apply corrections in order; later rules see the results of earlier ones.

    A rule whose predicate reads the column it sets would reference the
    previous value twice (in the test and in the ELSE branch); when Catalyst
    pushes a later filter through the chain it substitutes every reference, so
    the expression would double per rule. SQL-text rules therefore bind the
    column once per step with a one-element lambda
    (``transform(array(c), c -> CASE WHEN pred THEN value ELSE c END)[0]``),
    keeping the plan linear in the number of rules.
    """
    for r in rules:
        if r.delete:
            pred = F.expr(r.predicate) if isinstance(r.predicate, str) else r.predicate
            df = keep_unless(df, pred)
        elif isinstance(r.predicate, str) and not isinstance(r.value, Column):
            c = f"`{r.column}`"
            val = r.value_sql if r.value_sql is not None else _sql_literal(r.value)
            # a NULL predicate falls through to ELSE: the row keeps its value
            df = df.withColumn(r.column, F.expr(
                f"transform(array({c}), {c} -> CASE WHEN {r.predicate} THEN {val} ELSE {c} END)[0]"))
        else:
            pred = F.expr(r.predicate) if isinstance(r.predicate, str) else r.predicate
            val = r.value if isinstance(r.value, Column) else (
                F.expr(r.value_sql) if r.value_sql is not None else F.lit(r.value))
            df = df.withColumn(r.column, F.when(pred, val).otherwise(F.col(r.column)))
    return df


def recode_by_table(df: DataFrame, col: str, mapping: DataFrame, key: str = "key", value: str = "value",
                    keep_unmapped: bool = True) -> DataFrame:
    """F15 for large maps: replace ``col`` through a mapping table by a left join.

    A ``CASE`` chain (``functions.text.recode``) suits a handful of fixed values;
    a long map is a table, joined on the key (AQE broadcasts it when its measured
    size is small). The map must have one row per key; unmapped values stay
    unchanged unless ``keep_unmapped=False`` (then NULL).
    """
    m = mapping.select(F.col(key).alias("__mk"), F.col(value).alias("__mv"))
    j = df.join(m, df[col] == m["__mk"], "left")
    new = F.coalesce(F.col("__mv"), df[col]) if keep_unmapped else F.col("__mv")
    return j.select(*[new.alias(c) if c == col else df[c] for c in df.columns])
