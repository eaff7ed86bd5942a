"""Alert-threshold tuning.

Two rule sets propose a corrected threshold (``valor_correto``) per job and
notification:

* set 1 reads the notification *report* joined to run statistics on
  (server, job): rules 1a–1d;
* set 2 reads the notification *definitions* joined to jobs, folders and
  statistics: rules 2a–2c.

Rules are stacked with a ``rule_no`` (stands in for the insertion order of the
summary table), then: last end time filled from executions (J3), one row per
(server, folder, job, notification) kept by insertion order (W1), numbers above
999 capped to ``+30%`` (F21), rows already at the right value dropped (P9).

Join key of set 2: the folder id. Definitions are reduced first to one row per
(folder, condition, time), the smallest urgency and message winning as they do
in W1, so a folder's jobs meet its few distinct notification texts and not
every definition row of the folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.functions.text import cap_threshold
from jobscope.functions.thresholds import effective_threshold, recommended_threshold
from jobscope.functions.timefmt import jitter_small
from jobscope.operators.ordering import keep_first
from jobscope.operators.relational import alerts_if_threshold, trailing_window, update_from

# ---------------------------------------------------------------------------
# Fixed values of the rules (durations in seconds; texts compared as text).
# 1a: EXECTIME, centre DS%, mean >= 30 min, notification not in ('>35', '>035') -> '+03%'
# 1b: EXECTIME, centre DS%, mean >= 50 min, notification != '+070%'            -> '+070%'
# 1c: EXECTIME, centre DS%, mean >= 90 min, notification not like '=%'         -> recommended
# 1d: EXECTIME, centre = 'OS', mean >= 60 min, notification like '%>%'         -> recommended
# 2a: EXECUTING, centre PRD%, mean >= 30 min, time >= '+03%' and != '+070%'    -> '+03%'
# 2b: EXECUTING, centre PRD%, mean >= 50 min, time >= '+070%' and != '+03%'    -> '+070%'
# 2c: NOTOK, centre PRD%, no statistics (mean 0)                               -> 'OK'
# cap: number > 999 -> '+30%'; model sample: runtime <= 24 min -> random 50..58 s
# ---------------------------------------------------------------------------
MIN_30, MIN_50, MIN_60, MIN_90 = 30 * 60, 50 * 60, 60 * 60, 90 * 60
PCT_3, PCT_70, OK = "+03%", "+070%", "OK"
SET_2 = 20  # rule numbers from here on belong to set 2


def _lit_or_col(df: DataFrame, name: str, default=None) -> Column:
    return F.col(name) if name in df.columns else F.lit(default).cast("string")


def report_rules(report: DataFrame, stat: DataFrame, centre_prefix: str = "DS", cond: str | None = "EXECTIME",
                 os_centre: str = "OS", band: tuple[int, int] | None = None) -> DataFrame:
    """Rules 1a–1d over the notification report joined to statistics on (server, job).

    ``cond=None`` skips the condition test (a report without a ``when`` column).
    ``band=(lo_s, hi_s)``: rule 1c also requires the recommended value to fall
    outside [mean+lo_s, mean+hi_s] (the reference line is cut off; default no band).
    """
    j = report.join(stat, (report.server_name == stat.datacenter) & (report.job_name == stat.jobname), "inner")
    j = j.filter(F.col("media_s").isNotNull())
    if cond is not None:
        j = j.filter(F.col("when") == cond)
    nt = F.col("notification_time")
    ds = F.col("server_name").startswith(centre_prefix)
    m = F.col("media_s")
    rec = recommended_threshold(m)
    base = [F.col("server_name"), F.col("folder_name"), F.col("job_name"), m.alias("media_s"), nt.alias("notification_time"),
            _lit_or_col(report, "urgency").alias("urgency"), _lit_or_col(report, "message").alias("message")]
    r1 = j.filter(ds & (m >= MIN_30) & (nt != ">35") & (nt != ">035")).select(F.lit(11).alias("rule_no"), *base, F.lit(PCT_3).alias("valor_correto"))
    r2 = j.filter(ds & (m >= MIN_50) & (nt != PCT_70)).select(F.lit(12).alias("rule_no"), *base, F.lit(PCT_70).alias("valor_correto"))
    c3 = ds & (m >= MIN_90) & ~nt.like("=%")
    if band is not None:
        rec_s = F.floor((m * 1.5 + 1800) / 60) * 60
        c3 = c3 & ~rec_s.between(m + band[0], m + band[1])
    r3 = j.filter(c3).select(F.lit(13).alias("rule_no"), *base, rec.alias("valor_correto"))
    r4 = j.filter((F.col("server_name") == os_centre) & (m >= MIN_60) & nt.contains(">")).select(
        F.lit(14).alias("rule_no"), *base, rec.alias("valor_correto"))
    return r1.unionByName(r2).unionByName(r3).unionByName(r4)


def definition_rules(shout: DataFrame, def_job: DataFrame, def_table: DataFrame, stat: DataFrame,
                     centre_prefix: str = "PRD", job_key: Sequence[str] = ("table_id",),
                     current_only: bool = False) -> DataFrame:
    """Rules 2a–2c over notification definitions x jobs x folders (x statistics).

    Texts are compared as text (``'=90' >= '+03%'`` is true, as in the reference).
    """
    s = keep_first(shout, [*job_key, "when_cond", "shout_time"], ["urgency", "message"])
    if "table_id" not in job_key:
        raise ValueError("job_key must hold table_id")
    s = s.alias("s")
    jb = def_job.alias("j")
    tb = def_table.alias("t")
    if current_only and "is_current_version" in def_job.columns:
        jb = jb.filter(F.col("j.is_current_version") == "Y")
    cond = None
    for k in job_key:
        term = F.col(f"s.{k}") == F.col(f"j.{k}")
        cond = term if cond is None else cond & term
    # folders are few: a broadcast side whose size is one row per folder
    base = (s.join(jb, cond, "inner")
            .join(tb, F.col("s.table_id") == F.col("t.table_id"), "inner")
            .filter(F.col("t.data_center").startswith(centre_prefix))
            .select(F.col("t.data_center").alias("server_name"), F.col("t.sched_table").alias("folder_name"),
                    F.trim(F.col("j.job_name")).alias("job_name"), F.col("s.when_cond").alias("when_cond"),
                    F.col("s.shout_time").alias("notification_time"), F.col("s.urgency").alias("urgency"),
                    F.col("s.message").alias("message")))
    st = stat.alias("st")
    ws = base.join(st, (base.server_name == F.col("st.datacenter")) & (base.job_name == F.col("st.jobname")), "inner") \
        .filter(F.col("st.media_s").isNotNull())
    cols = ["server_name", "folder_name", "job_name", F.col("st.media_s").alias("media_s"), "notification_time",
            "urgency", "message"]
    nt = F.col("notification_time")
    m = F.col("st.media_s")
    ex = F.col("when_cond") == "EXECUTING"
    r1 = ws.filter(ex & (m >= MIN_30) & (nt >= PCT_3) & (nt != PCT_70)).select(
        F.lit(21).alias("rule_no"), *cols, F.lit(PCT_3).alias("valor_correto"))
    r2 = ws.filter(ex & (m >= MIN_50) & (nt >= PCT_70) & (nt != PCT_3)).select(
        F.lit(22).alias("rule_no"), *cols, F.lit(PCT_70).alias("valor_correto"))
    r3 = base.filter(F.col("when_cond") == "NOTOK").select(
        F.lit(23).alias("rule_no"), "server_name", "folder_name", "job_name", F.lit(0).cast("long").alias("media_s"),
        "notification_time", "urgency", "message", F.lit(OK).alias("valor_correto"))
    return r1.unionByName(r2).unionByName(r3)


def finalize_summary(candidates: DataFrame, exec_df: DataFrame | None = None,
                     alert_counts: DataFrame | None = None, yesterday: DataFrame | None = None) -> DataFrame:
    """Fill last end (J3) and, where the last end is unknown, the recent alert
    count (A7 output: data_center, job_name, quant_alert); keep the first row per
    (server, folder, job, notification) by insertion order (W1), cap large
    numbers (F21), drop rows already right (P9).

    Set 1 finds the last end by (server, folder, job), set 2 by (server, job) and only
    for jobs of ``yesterday`` (server_name, job_name), if given."""
    df = candidates.withColumn("end_time", F.lit(None).cast("timestamp"))
    if exec_df is not None:
        last = exec_df.select(F.col("data_center").alias("server_name"), F.col("sched_table").alias("folder_name"),
                              "job_name", "end_time")
        wrong, second = F.col("valor_correto") != OK, F.col("rule_no") >= SET_2
        known = last if yesterday is None else last.join(yesterday.select("server_name", "job_name").distinct(),
                                                         ["server_name", "job_name"], "left_semi")
        one = update_from(df.filter(wrong & ~second), last, ["server_name", "folder_name", "job_name"], {"end_time": "end_time"})
        two = update_from(df.filter(wrong & second), known, ["server_name", "job_name"], {"end_time": "end_time"})
        df = one.unionByName(two).unionByName(df.filter(~wrong))
    df = df.withColumn("quant_alert", F.lit(0).cast("long"))
    if alert_counts is not None:
        cnt = alert_counts.filter(F.col("quant_alert") >= 1).select(
            F.col("data_center").alias("__srv"), F.col("job_name").alias("__job"), F.col("quant_alert").alias("__qa"))
        j = df.join(cnt, (df.server_name == cnt["__srv"]) & (df.job_name == cnt["__job"]), "left")
        fill = F.col("end_time").isNull() & (F.col("job_name") != "") & F.col("__qa").isNotNull()
        df = j.withColumn("quant_alert", F.when(fill, F.col("__qa")).otherwise(F.col("quant_alert"))).select(*df.columns)
    order_cols = ["rule_no", "media_s", "urgency", "message", "valor_correto", "end_time"]
    df = keep_first(df, ["server_name", "folder_name", "job_name", "notification_time"],
                    [c for c in order_cols if c in df.columns])
    df = df.withColumn("valor_correto", cap_threshold("valor_correto"))
    return df.filter(~F.coalesce(F.col("valor_correto") == F.col("notification_time"), F.lit(False)))


def threshold_impact(summary: DataFrame, exec_df: DataFrame, id_col: str = "id") -> DataFrame:
    """F8 + J8: new threshold in seconds and how many past runs would have crossed it."""
    with_new = summary.withColumn("new_time_s", effective_threshold("valor_correto", "media_s"))
    return alerts_if_threshold(with_new, exec_df, id_col=id_col,
                               keys={"job_name": "job_name", "server_name": "data_center"},
                               threshold_col="new_time_s", runtime_col="runtime_s", out="calc_shout")


def model_executions(exec_df: DataFrame, summary: DataFrame, as_of, days: int = 60,
                     centre_prefix: str = "DS", jitter: bool = False, seed: int = 42) -> DataFrame:
    """J4 (+F22): successful runs of summarised jobs in the last ``days`` days.

    The reference's RIGHT JOIN filters the left side in WHERE, so it is an
    inner join; one row per matching summary row. ``jitter=True`` replaces run
    times of at most 24 minutes with a random 50–58 s (F22).
    """
    e = trailing_window(exec_df.filter((F.col("completion_status") == "Ended OK")
                                       & F.col("data_center").startswith(centre_prefix)), "start_time", days, as_of)
    s = summary.select(F.col("server_name"), F.col("job_name").alias("s_job"), F.col("folder_name"))
    j = e.join(s, (e.data_center == s.server_name) & (e.job_name == s.s_job) & (e.sched_table == s.folder_name), "inner")
    key = ["data_center", "job_name", F.unix_seconds("start_time"), F.unix_seconds("end_time")]
    rt = jitter_small(F.col("runtime_s"), seed=seed, key=key) if jitter else F.col("runtime_s")
    return j.select("data_center", F.col("s_job").alias("job_name"), "start_time", "end_time", rt.alias("runtime_s"))


def _sec_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def overrun_rule(stat_times: DataFrame, last_runs: DataFrame, centre_prefix: str = "PRD") -> DataFrame:
    """Rule 2d: seconds a job's last run exceeded its mean, for jobs whose run is
    above the mean and at least ``mean*1.5 - 1800``, with a known last end.

    ``stat_times``: datacenter, jobname, media_s, start_s, end_s (seconds of day).
    ``last_runs``: server_name, job_name, end_time (one row per latest run; ties repeat).
    The source's BETWEEN has a boolean upper bound: the lower bound is kept and
    the upper bound read as ``end > start``.
    """
    run = F.col("end_s") - F.col("start_s")
    m = F.col("media_s")
    lr = last_runs.filter(F.col("end_time").isNotNull()).select(
        F.col("server_name").alias("__srv"), F.col("job_name").alias("__job"))
    j = stat_times.join(lr, (stat_times.datacenter == lr["__srv"]) & (stat_times.jobname == lr["__job"]), "inner")
    return j.filter(m.isNotNull() & (m != 0) & (F.col("start_s") != 0) & (F.col("end_s") != 0)
                    & F.col("datacenter").startswith(centre_prefix) & (run > m) & (run >= m * 1.5 - 1800)
                    & (F.col("end_s") > F.col("start_s"))).select(
        F.col("datacenter").alias("server_name"), F.col("jobname").alias("job_name"), (run - m).alias("quant_alert"))


def planned_start_rule(today: DataFrame, yesterday: DataFrame, last_runs: DataFrame, listed: DataFrame,
                       centre_prefix: str = "PRD") -> DataFrame:
    """Rule 2e: ``((end - planned start) / 1.5 - 1800)`` seconds and minutes for jobs
    present today and yesterday, with a known last end, not already listed.

    ``today``: server_name, job_name, end_time, planned_start (times of day are used).
    """
    t = today.filter(F.col("server_name").startswith(centre_prefix))
    key = ["server_name", "job_name"]
    t = t.join(yesterday.select(*key).distinct(), key, "left_semi")
    t = t.join(last_runs.filter(F.col("end_time").isNotNull()).select(*key), key, "inner")
    t = t.join(listed.select(*key), key, "left_anti")
    secs = (_sec_of_day(F.col("end_time")) - _sec_of_day(F.col("planned_start"))) / 1.5 - 1800
    return t.select(*key, secs.alias("quant_alert"), (secs / 60).alias("total_minutes"))
