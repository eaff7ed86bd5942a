"""Queries for the generic table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscope.functions import text as T
from jobscope.operators import aggregates as A
from jobscope.operators import relational as R
from jobscope.operators.ordering import keep_first
from jobscope.operators.seasonality import seasonality
from jobscope.plans.registry import register
from jobscope.sources.fixtures import AS_OF_DATES, AS_OF_EVENTS, Estate

AS_OF = AS_OF_EVENTS


# --------------------------------------------------------------------------- joins

@register("j6_latest_execution", sql="""
SELECT data_center, job_name, end_time FROM fx_exec e
WHERE end_time = (SELECT max(end_time) FROM fx_exec x WHERE x.job_name = e.job_name)""", views=("fx_exec",))
def q_latest(spark, sf):
    return R.latest_execution(Estate(spark, sf).runs)


@register("j5_mttr", sql=f"""
WITH f AS (SELECT * FROM fx_exec WHERE completion_status = 'Ended Not OK' AND CAST(start_time AS DATE) >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY)
SELECT c.data_center, c.order_id, c.job_name, c.rerun_counter, p.start_time AS prev_start_time, c.end_time,
       date_diff('second', p.start_time, c.end_time) AS mttr_s
FROM f c JOIN f p ON c.order_id = p.order_id AND c.job_name = p.job_name AND c.rerun_counter = p.rerun_counter + 1""",
          views=("fx_exec",))
def q_mttr(spark, sf):
    return R.mttr(Estate(spark, sf).exec.withColumn("odate", F.to_date("start_time")), AS_OF, 10)


@register("j3_update_from_last_end", sql="""
SELECT s.id, s.server_name, s.folder_name, s.job_name, s.valor_correto,
       CASE WHEN s.valor_correto <> 'OK' THEN (SELECT max(e.end_time) FROM fx_exec e WHERE e.data_center = s.server_name
            AND e.sched_table = s.folder_name AND e.job_name = s.job_name) END AS end_time
FROM fx_shout_sum s""", views=("fx_shout_sum",))
def q_update_from(spark, sf):
    E = Estate(spark, sf)
    target = E.shout_sum.select("id", "server_name", "folder_name", "job_name", "valor_correto",
                                F.lit(None).cast("timestamp").alias("end_time"))
    src = E.runs.select(F.col("data_center").alias("server_name"), F.col("sched_table").alias("folder_name"),
                        "job_name", "end_time")
    todo = target.filter(F.col("valor_correto") != "OK")
    done = R.update_from(todo, src, ["server_name", "folder_name", "job_name"], {"end_time": "end_time"})
    return done.unionByName(target.filter(F.col("valor_correto") == "OK"))


@register("j7_not_exists_jobs_never_run", sql="""
SELECT job_id, job_name FROM fx_def_job d WHERE NOT EXISTS (SELECT 1 FROM fx_exec e WHERE trim(e.job_name) = trim(d.job_name))""",
          views=("fx_def_job", "fx_exec"))
def q_not_exists(spark, sf):
    E = Estate(spark, sf)
    runs = E.runs.select("job_name").distinct()
    return R.anti_join(E.def_job.select("job_id", "job_name"), runs, ["job_name"], trim_keys=True)


@register("j2_left_enrichment", sql="""
SELECT e.exec_id, e.job_name, d.memname FROM fx_exec e LEFT JOIN (SELECT trim(job_name) AS jn, memname FROM fx_def_job) d
ON e.job_name = d.jn""", views=("fx_exec", "fx_def_job"))
def q_left(spark, sf):
    E = Estate(spark, sf)
    look = E.def_job.select(F.trim("job_name").alias("jn"), "memname")
    e = E.runs.select("exec_id", "job_name")
    return e.join(look, e.job_name == look.jn, "left").select("exec_id", "job_name", "memname")


@register("j8_alerts_if_threshold", sql="""
WITH s AS (SELECT id, server_name, job_name, valor_correto, media_s,
  CASE WHEN starts_with(valor_correto, '=') THEN TRY_CAST(substring(valor_correto, 2) AS BIGINT) * 60
       WHEN starts_with(valor_correto, '+') THEN CAST(floor(CAST(media_s AS DOUBLE) + CAST(media_s AS DOUBLE) * (CAST(TRY_CAST(substring(valor_correto, 2, length(valor_correto) - 2) AS BIGINT) AS DOUBLE) / 100)) AS BIGINT)
  END AS new_time_s FROM fx_shout_sum)
SELECT s.id, s.server_name, s.job_name, s.valor_correto, s.new_time_s,
  (SELECT count(*) FROM fx_exec e WHERE e.job_name = s.job_name AND e.data_center = s.server_name AND s.new_time_s < e.runtime_s) AS calc_shout
FROM s""", views=("fx_shout_sum", "fx_exec"))
def q_alerts_if(spark, sf):
    from jobscope.functions.thresholds import effective_threshold

    E = Estate(spark, sf)
    s = E.shout_sum.select("id", "server_name", "job_name", "valor_correto",
                           effective_threshold("valor_correto", "media_s").alias("new_time_s"))
    return R.alerts_if_threshold(s, E.runs)


# --------------------------------------------------------------------------- sets

@register("u2_distinct_service_map", sql="SELECT DISTINCT data_center, jobname, memname, service_name FROM fx_bim",
          views=("fx_bim",))
def q_distinct(spark, sf):
    return Estate(spark, sf).bim.select("data_center", "jobname", "memname", "service_name").distinct()


@register("u3_singletons", sql="""
SELECT data_center, jobname, service_name, data_car FROM fx_bim GROUP BY ALL HAVING count(*) = 1""", views=("fx_bim",))
def q_singletons(spark, sf):
    return R.singletons(Estate(spark, sf).bim.select("data_center", "jobname", "service_name", "data_car"))


DIFF_SQL = """SELECT a.*, 'I' AS flag FROM fx_jobs_cur a WHERE NOT EXISTS (SELECT 1 FROM fx_jobs_prev b WHERE trim(a.job_name) = trim(b.job_name))
UNION ALL SELECT a.*, 'D' AS flag FROM fx_jobs_prev a WHERE NOT EXISTS (SELECT 1 FROM fx_jobs_cur b WHERE a.job_name = b.job_name)"""


@register("u4_snapshot_diff", sql=DIFF_SQL, views=("fx_jobs_cur", "fx_jobs_prev"))
def q_diff(spark, sf):
    E = Estate(spark, sf)
    return R.snapshot_diff(E.jobs_cur, E.jobs_prev, "job_name")


@register("a3_app_delta_summary", sql=f"""
WITH d AS ({DIFF_SQL}), c AS (SELECT t.data_center, trim(CASE WHEN rtrim(substring(d.job_name, 1, 3)) = 'M' THEN substring(d.job_name, 1, 2) ELSE substring(d.job_name, 1, 3) END) AS sigla
  FROM d JOIN fx_def_table t ON d.table_id = t.table_id)
SELECT substring(data_center, 1, 2) AS platform, sigla, count(*) AS n, DATE '{AS_OF_DATES}' AS data FROM c GROUP BY ALL""",
          views=("fx_jobs_cur", "fx_jobs_prev", "fx_def_table"))
def q_app_delta(spark, sf):
    E = Estate(spark, sf)
    d = R.snapshot_diff(E.jobs_cur, E.jobs_prev, "job_name")
    c = d.join(E.def_table.select("table_id", "data_center"), "table_id").select(
        "data_center", T.app_code("job_name", "M").alias("sigla"))
    return A.app_delta_summary(c, AS_OF_DATES)


@register("m3_volume_guard", sql=f"""
WITH d AS ({DIFF_SQL}) SELECT job_id, flag FROM d WHERE (SELECT count(*) FROM d) <= 5000""",
          views=("fx_jobs_cur", "fx_jobs_prev"))
def q_guard(spark, sf):
    E = Estate(spark, sf)
    return R.volume_guard(R.snapshot_diff(E.jobs_cur, E.jobs_prev, "job_name").select("job_id", "flag"), 5000)


@register("m3_volume_guard_tripped", sql=f"""
WITH d AS ({DIFF_SQL}) SELECT job_id, flag FROM d WHERE (SELECT count(*) FROM d) <= 100""",
          views=("fx_jobs_cur", "fx_jobs_prev"))
def q_guard_tripped(spark, sf):
    E = Estate(spark, sf)
    return R.volume_guard(R.snapshot_diff(E.jobs_cur, E.jobs_prev, "job_name").select("job_id", "flag"), 100)


# --------------------------------------------------------------------------- maintenance

@register("m1_purge_39_days", sql=f"""
SELECT * FROM fx_bim WHERE data_car IS NULL OR data_car >= TIMESTAMP '{AS_OF_DATES} 00:00:00' - INTERVAL 39 DAY""",
          views=("fx_bim",))
def q_purge(spark, sf):
    return R.purge(Estate(spark, sf).bim, "data_car", 39, f"{AS_OF_DATES} 00:00:00")


@register("m1_purge_30_days_exec", sql=f"""
SELECT exec_id, end_time FROM fx_exec WHERE end_time IS NULL OR end_time >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY""",
          views=("fx_exec",))
def q_purge_exec(spark, sf):
    return R.purge(Estate(spark, sf).runs.select("exec_id", "end_time"), "end_time", 30, AS_OF)


@register("p9_delete_by_predicate", sql="""
SELECT exec_id, data_center, sched_table FROM fx_exec WHERE NOT coalesce(data_center LIKE 'MP%' OR sched_table = 'CREATED', false)""",
          views=("fx_exec",))
def q_delete_pred(spark, sf):
    e = Estate(spark, sf).runs.select("exec_id", "data_center", "sched_table")
    return R.keep_unless(e, F.col("data_center").startswith("MP") | (F.col("sched_table") == "CREATED"))


CATALOG_SQL = """SELECT DISTINCT trim(CASE WHEN rtrim(substring(j.job_name, 1, 3)) = 'M' THEN substring(j.job_name, 1, 2) ELSE substring(j.job_name, 1, 3) END) AS sigla,
  trim(t.data_center) AS data_center, trim(t.sched_table) AS sched_table, trim(j.job_name) AS job_name, trim(j.memname) AS memname,
  CASE WHEN substring(j.group_name, 1, 1) = 'A' THEN 'High' WHEN substring(j.group_name, 1, 1) = 'M' THEN 'Moderate' WHEN substring(j.group_name, 1, 1) = 'B' THEN 'Low' END AS criticality,
  substring(j.node_id, 1, 1) AS node_group
FROM fx_def_table t JOIN fx_def_job j ON trim(CAST(t.table_id AS VARCHAR)) = trim(CAST(j.table_id AS VARCHAR)) WHERE t.data_center NOT LIKE 'MP%'"""


@register("m5_apply_rules_catalogue", sql=f"""
WITH c AS ({CATALOG_SQL}),
r1 AS (SELECT sigla, data_center, sched_table, job_name, memname, criticality,
        CASE WHEN node_group = 'B' THEN 'Bx' ELSE node_group END AS node_group FROM c),
r2 AS (SELECT CASE WHEN data_center = 'DS-A' AND job_name LIKE 'PX%' THEN 'PXA' ELSE sigla END AS sigla,
        data_center, sched_table, job_name, memname, criticality, node_group FROM r1),
r3 AS (SELECT CASE WHEN sigla LIKE 'PXA%' THEN replace(sigla, 'A', 'Z') ELSE sigla END AS sigla,
        data_center, sched_table, job_name, memname, criticality, node_group FROM r2)
SELECT sigla, data_center, sched_table, job_name, memname,
  CASE WHEN criticality = 'A' THEN 'High' WHEN criticality = 'M' THEN 'Moderate' WHEN criticality = 'B' THEN 'Low'
       WHEN criticality NOT IN ('High', 'Moderate', 'Low', 'Urgent') THEN 'R' ELSE criticality END AS criticality, node_group
FROM r3 WHERE NOT coalesce(sigla = 'P1' OR sigla LIKE 'X%' OR sigla = 'JB0', false)""",
          views=("fx_def_table", "fx_def_job"))
def q_rules(spark, sf):
    from jobscope.plans.catalogue import job_catalogue, CATALOGUE_RULES
    from jobscope.operators.relational import Rule

    E = Estate(spark, sf)
    cat = job_catalogue(E.def_job, E.def_table)
    fixture_rules = [
        Rule("node_group = 'B'", "node_group", "Bx"),
        Rule("data_center = 'DS-A' AND job_name LIKE 'PX%'", "sigla", "PXA"),
        Rule("sigla LIKE 'PXA%'", "sigla", value_sql="replace(sigla, 'A', 'Z')"),
        Rule("sigla = 'JB0'", delete=True),
    ]
    out = R.apply_rules(cat, fixture_rules + CATALOGUE_RULES)
    return out.withColumn("criticality", T.normalise_criticality("criticality"))


# --------------------------------------------------------------------------- aggregates

@register("a1_daily_volume", sql="""
SELECT substring(strftime(end_time, '%Y-%m-%d %H:%M:%S'), 1, 10) AS data, substring(data_center, 1, 2) AS ambiente, data_center,
  trim(CASE WHEN rtrim(substring(job_name, 1, 3)) = 'M' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END) AS sigla,
  completion_status AS status, count(*) AS volume
FROM fx_exec WHERE data_center NOT IN ('DS-B', 'WS-B') GROUP BY ALL""", views=("fx_exec",))
def q_daily_volume(spark, sf):
    return A.daily_volume(Estate(spark, sf).runs, None, "M", exclude_centres=("DS-B", "WS-B"))


@register("a1_daily_volume_mainframe_day", sql="""
SELECT substring(strftime(end_time, '%Y-%m-%d %H:%M:%S'), 1, 10) AS data, substring(data_center, 1, 2) AS ambiente, data_center,
  trim(CASE WHEN rtrim(substring(job_name, 1, 3)) = 'P' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END) AS sigla,
  completion_status AS status, count(*) AS volume
FROM fx_exec WHERE starts_with(data_center, 'MP') AND data_center NOT IN ('MP-B', 'MP-C')
  AND substring(strftime(end_time, '%Y-%m-%d %H:%M:%S'), 1, 10) = '2024-01-15' GROUP BY ALL""", views=("fx_exec",))
def q_daily_volume_mp(spark, sf):
    return A.daily_volume(Estate(spark, sf).runs, "2024-01-15", "P", centre_prefix="MP",
                          exclude_centres=("MP-B", "MP-C"))


@register("a2_o1_platform_volume", sql=f"""
SELECT substring(data_center, 1, 2) AS platform, CAST(start_time AS DATE) AS data, count(*) AS n FROM fx_exec
WHERE start_time BETWEEN CAST(CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 2 DAY AS TIMESTAMP) AND CAST(CAST(TIMESTAMP '{AS_OF}' AS DATE) AS TIMESTAMP)
GROUP BY ALL ORDER BY data DESC""", views=("fx_exec",))
def q_platform_volume(spark, sf):
    return A.platform_volume(Estate(spark, sf).runs, AS_OF, 2).orderBy(F.col("data").desc())


@register("a4_service_fanout", sql="""
SELECT data_center, jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'DS') GROUP BY ALL
UNION ALL SELECT data_center, memname AS jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'WS') GROUP BY ALL""",
          views=("fx_bim",))
def q_fanout(spark, sf):
    return A.service_fanout(Estate(spark, sf).bim)


@register("a5_max_end_per_job", sql="SELECT data_center, job_name, max(end_time) AS max_end_time FROM fx_exec GROUP BY ALL",
          views=("fx_exec",))
def q_max(spark, sf):
    return A.max_per_key(Estate(spark, sf).runs, ["data_center", "job_name"], "end_time", "max_end_time")


@register("a6_jobs_over_80_runs", sql="SELECT job_name, count(*) AS runs FROM fx_exec GROUP BY job_name HAVING count(*) > 80",
          views=("fx_exec",))
def q_having(spark, sf):
    return A.keys_with_more_than(Estate(spark, sf).runs, ["job_name"], 80)


ALARM_SQL = """SELECT server_name AS data_center, job_name, CASE WHEN message = 'Ended not OK' THEN 'NOTOK' ELSE 'LATESUB' END AS when_cond,
  alert_time AS host_time FROM fx_alert"""


def alarms_of(alert_df):
    """Alarm table shape (centre, job, condition, time) derived from the alert view."""
    return alert_df.select(F.col("server_name").alias("data_center"), "job_name",
                           F.when(F.col("message") == "Ended not OK", "NOTOK").otherwise("LATESUB").alias("when_cond"),
                           F.col("alert_time").alias("host_time"))


@register("a7_alert_count_30_days", sql=f"""
WITH al AS ({ALARM_SQL}) SELECT data_center, job_name, count(*) AS quant_alert FROM al
WHERE when_cond = 'NOTOK' AND CAST(host_time AS DATE) >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 30 DAY
  AND starts_with(data_center, 'DS') GROUP BY ALL""", views=("fx_alert",))
def q_alert_count(spark, sf):
    return A.alert_count(alarms_of(Estate(spark, sf).alert_plain), AS_OF, 30, centre_prefix="DS")


@register("a8_daily_mean", sql="""
SELECT job_name, CAST(start_time AS DATE) AS d, avg(CAST(runtime_s AS DOUBLE)) AS x FROM fx_exec GROUP BY ALL""",
          views=("fx_exec",))
def q_daily_mean(spark, sf):
    return A.daily_mean(Estate(spark, sf).runs)


@register("a9_sample_variance", sql="""
SELECT job_name,
  CASE WHEN count(runtime_s) > 1 THEN CAST(count(runtime_s) * sum(CAST(runtime_s AS HUGEINT) * runtime_s) - sum(runtime_s) * sum(runtime_s) AS DOUBLE)
       / CAST(count(runtime_s) * (count(runtime_s) - 1) AS DOUBLE) END AS var_runtime_s,
  CASE WHEN count(rerun_counter) > 1 THEN CAST(count(rerun_counter) * sum(CAST(rerun_counter AS HUGEINT) * rerun_counter) - sum(rerun_counter) * sum(rerun_counter) AS DOUBLE)
       / CAST(count(rerun_counter) * (count(rerun_counter) - 1) AS DOUBLE) END AS var_rerun_counter
FROM fx_exec GROUP BY ALL""",
          views=("fx_exec",))
def q_var(spark, sf):
    return A.sample_variances(Estate(spark, sf).exec, "job_name", ["runtime_s", "rerun_counter"])


@register("a10_total_count", sql="SELECT count(*) AS n FROM fx_exec", views=("fx_exec",))
def q_count(spark, sf):
    return A.total_count(Estate(spark, sf).runs)


# --------------------------------------------------------------------------- windows / sorts

@register("w1_keep_first_by_insertion", sql="""
SELECT id, server_name, folder_name, job_name, notification_time, valor_correto FROM (
  SELECT *, row_number() OVER (PARTITION BY server_name, folder_name, job_name, notification_time ORDER BY id) AS rn FROM fx_shout_sum) t
WHERE rn = 1""", views=("fx_shout_sum",))
def q_keep_first(spark, sf):
    s = Estate(spark, sf).shout_sum.select("id", "server_name", "folder_name", "job_name", "notification_time",
                                           "valor_correto")
    return keep_first(s, ["server_name", "folder_name", "job_name", "notification_time"], ["id"])


@register("w2_o3_first_row_per_job", sql="""
SELECT job_name, run_id, server_name, start_time FROM (
  SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY start_time, run_id) AS rn FROM fx_active) t WHERE rn = 1""",
          views=("fx_active",))
def q_first_row(spark, sf):
    a = Estate(spark, sf).active.select("job_name", "run_id", "server_name", "start_time")
    return keep_first(a, ["job_name"], ["start_time", "run_id"])


W3_SQL = """WITH elig AS (SELECT job_name FROM fx_exec WHERE NOT starts_with(job_name, 'A') AND NOT starts_with(job_name, 'CM')
  GROUP BY job_name HAVING count(*) > 80),
daily AS (SELECT job_name, CAST(start_time AS DATE) AS d, avg(CAST(runtime_s AS DOUBLE)) AS x FROM fx_exec WHERE job_name IN (SELECT job_name FROM elig) GROUP BY job_name, CAST(start_time AS DATE)),
s AS (SELECT job_name, d, x, row_number() OVER (PARTITION BY job_name ORDER BY d) - 1 AS i, count(*) OVER (PARTITION BY job_name) AS n,
  CASE WHEN count(*) OVER w = 7 THEN avg(x) OVER w END AS trend FROM daily WINDOW w AS (PARTITION BY job_name ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
p AS (SELECT *, avg(x - trend) OVER (PARTITION BY job_name, i % 7) AS pa FROM s WHERE n >= 14),
pm AS (SELECT job_name, avg(pa) AS m FROM (SELECT DISTINCT job_name, i % 7 AS ph, pa FROM p) t GROUP BY job_name),
f AS (SELECT p.job_name, x, trend, pa - m AS seas, x - trend - (pa - m) AS resid FROM p JOIN pm ON p.job_name = pm.job_name),
v AS (SELECT job_name, var_samp(seas) AS vs, var_samp(trend) AS vt, var_samp(resid) AS vr, var_samp(x) AS vx FROM f GROUP BY job_name)
SELECT job_name, CASE WHEN vs / nullif(vx, 0) * 100 > 20 THEN 'Sazonal' ELSE 'Linear' END AS tipo,
  round_even(vs / nullif(vx, 0) * 100, 2) AS sazonal_percentual, round_even(vs, 2) AS variancia_sazonal,
  round_even(vt, 2) AS variancia_tendencia, round_even(vr, 2) AS variancia_ruido, round_even(vx, 2) AS variancia_total FROM v"""


@register("w3_seasonality", sql=W3_SQL, views=("fx_exec",))
def q_seasonality(spark, sf):
    return seasonality(Estate(spark, sf).runs)


@register("o2_sorted_unique_stat_lines", sql="""
SELECT DISTINCT concat_ws(';', '', jobname, datacenter, CAST(media_s AS VARCHAR)) AS line FROM fx_stat ORDER BY line""",
          views=("fx_stat",))
def q_sorted_unique(spark, sf):
    st = Estate(spark, sf).stat
    return st.select(F.concat_ws(";", F.lit(""), "jobname", "datacenter", F.col("media_s").cast("string")).alias("line")) \
        .distinct().orderBy("line")


# --------------------------------------------------------------------------- predicates

@register("p2_p3_prefix_and_in_list", sql="""
SELECT exec_id, data_center, job_name FROM fx_exec WHERE (starts_with(data_center, 'DS') OR starts_with(data_center, 'WS'))
  AND NOT starts_with(job_name, 'A') AND NOT starts_with(job_name, 'CM') AND completion_status IN ('Ended OK', 'Ended Not OK')
  AND data_center NOT IN ('DS-B')""", views=("fx_exec",))
def q_prefix(spark, sf):
    e = Estate(spark, sf).runs
    return e.filter((F.col("data_center").startswith("DS") | F.col("data_center").startswith("WS"))
                    & ~F.col("job_name").startswith("A") & ~F.col("job_name").startswith("CM")
                    & F.col("completion_status").isin("Ended OK", "Ended Not OK")
                    & ~F.col("data_center").isin("DS-B")).select("exec_id", "data_center", "job_name")


@register("p4_p5_text_and_duration_thresholds", sql="""
SELECT id, shout_time, media_s FROM fx_shout s JOIN fx_stat st ON st.jobname = concat(CASE s.id % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'CM' WHEN 2 THEN 'M' WHEN 3 THEN 'PX' ELSE 'JB' END, lpad(CAST(s.id AS VARCHAR), 6, '0'))
WHERE shout_time >= '+03%' AND shout_time <> '+070%' AND media_s >= 1800 AND media_s NOT BETWEEN 3600 AND 5400""",
          views=("fx_shout", "fx_stat"))
def q_text_threshold(spark, sf):
    E = Estate(spark, sf)
    from jobscope.sources.fixtures import JOB_PREFIXES, _pick

    s = E.shout.select("id", "shout_time", F.concat(_pick(F.col("id") % 5, JOB_PREFIXES),
                                                     F.lpad(F.col("id").cast("string"), 6, "0")).alias("jn"))
    j = s.join(E.stat, s.jn == E.stat.jobname, "inner")
    m = F.col("media_s")
    return j.filter((F.col("shout_time") >= "+03%") & (F.col("shout_time") != "+070%") & (m >= 1800)
                    & ~m.between(3600, 5400)).select("id", "shout_time", "media_s")


@register("p6_current_version_export", sql="""
SELECT job_id, concat_ws('#;', coalesce(CAST(table_id AS VARCHAR), ''), coalesce(CAST(job_id AS VARCHAR), ''), coalesce(job_name, ''),
  coalesce(memname, ''), coalesce(group_name, ''), coalesce(node_id, ''), coalesce(cyclic, '')) AS line
FROM fx_def_job WHERE is_current_version = 'Y'""", views=("fx_def_job",))
def q_current_export(spark, sf):
    from jobscope.sources.sinks import export_delimited

    j = Estate(spark, sf).def_job.filter(F.col("is_current_version") == "Y")
    return j.select("job_id", export_delimited(j.drop("is_current_version"), "#;").alias("line"))


@register("p7_trailing_window", sql=f"""
SELECT exec_id, start_time FROM fx_exec WHERE start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY""", views=("fx_exec",))
def q_trailing(spark, sf):
    return R.trailing_window(Estate(spark, sf).runs.select("exec_id", "start_time"), "start_time", 10, AS_OF)


@register("p8_drop_header_lines", sql="""
WITH l AS (SELECT concat('"', service_name, '","', memname, '","', data_center, '"') AS line FROM fx_bim
           UNION ALL SELECT DISTINCT '"SERVICE","LOB","SIGLA"' AS line FROM fx_bim)
SELECT replace(line, '"', '') AS line FROM l WHERE NOT contains(line, 'SERVICE')""", views=("fx_bim",))
def q_headers(spark, sf):
    b = Estate(spark, sf).bim
    body = b.select(F.concat(F.lit('"'), "service_name", F.lit('","'), "memname", F.lit('","'), "data_center",
                             F.lit('"')).alias("line"))
    head = b.select(F.lit('"SERVICE","LOB","SIGLA"').alias("line")).distinct()
    lines = body.unionByName(head)
    return lines.filter(~F.col("line").contains("SERVICE")).select(T.strip_quotes("line").alias("line"))


@register("p10_null_tests", sql="""
SELECT alert_id, notes FROM fx_alert WHERE notes IS NULL""", views=("fx_alert",))
def q_nulls(spark, sf):
    return Estate(spark, sf).alert_plain.select("alert_id", "notes").filter(F.col("notes").isNull())


# --------------------------------------------------------------------------- upsert

@register("s9_upsert_replace_into", sql="""
WITH u AS (SELECT job_id, job_name, concat(memname, '-new') AS memname FROM fx_jobs_cur)
SELECT p.job_id, p.job_name, p.memname FROM fx_jobs_prev p WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.job_id = p.job_id)
UNION ALL SELECT job_id, job_name, memname FROM u""", views=("fx_jobs_cur", "fx_jobs_prev"))
def q_upsert(spark, sf):
    E = Estate(spark, sf)
    target = E.jobs_prev.select("job_id", "job_name", "memname")
    # two rows a key in the batch: the larger order value wins
    updates = E.jobs_cur.select("job_id", "job_name", F.explode(F.array(
        F.concat("memname", F.lit("-new")), F.concat("memname", F.lit("-alt")))).alias("memname"))
    return R.upsert(target, updates, ["job_id"], "memname")
