"""Queries for threshold tuning (card E: rule sets 1 and 2, U1, J3, W1, F21, P9; J4, F22).

Fixture centres carry DS/WS/MP prefixes, so rule set 2 (production prefix
``PRD`` in the reference) is run with ``centre_prefix="DS"``. The notification
report of rule set 1 is the threshold summary view, which has no ``when``
column, so its condition test is skipped (``cond=None``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscope.operators import tuning as TU
from jobscope.plans.registry import register
from jobscope.plans.table_queries import ALARM_SQL
from jobscope.sources.fixtures import AS_OF_EVENTS, Estate

AS_OF = AS_OF_EVENTS
TODAY, YESTERDAY = "2024-01-30", "2024-01-29"

RULES1_SQL = """
r AS (SELECT server_name, folder_name, job_name, notification_time FROM fx_shout_sum),
j AS (SELECT r.*, s.media_s FROM r JOIN fx_stat s ON r.server_name = s.datacenter AND r.job_name = s.jobname WHERE s.media_s IS NOT NULL),
rules1 AS (
 SELECT 11 AS rule_no, server_name, folder_name, job_name, media_s, notification_time, NULL::VARCHAR AS urgency, NULL::VARCHAR AS message, '+03%' AS valor_correto
   FROM j WHERE starts_with(server_name, 'DS') AND media_s >= 1800 AND notification_time <> '>35' AND notification_time <> '>035'
 UNION ALL SELECT 12, server_name, folder_name, job_name, media_s, notification_time, NULL, NULL, '+070%'
   FROM j WHERE starts_with(server_name, 'DS') AND media_s >= 3000 AND notification_time <> '+070%'
 UNION ALL SELECT 13, server_name, folder_name, job_name, media_s, notification_time, NULL, NULL, concat('=', CAST(CAST(floor((media_s * 1.5 + 1800) / 60) AS BIGINT) AS VARCHAR))
   FROM j WHERE starts_with(server_name, 'DS') AND media_s >= 5400 AND notification_time NOT LIKE '=%'
 UNION ALL SELECT 14, server_name, folder_name, job_name, media_s, notification_time, NULL, NULL, concat('=', CAST(CAST(floor((media_s * 1.5 + 1800) / 60) AS BIGINT) AS VARCHAR))
   FROM j WHERE server_name = 'OS' AND media_s >= 3600 AND notification_time LIKE '%>%')"""

RULES2_SQL = """
sd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_id, when_cond, shout_time ORDER BY urgency NULLS FIRST, message NULLS FIRST) AS rn
         FROM fx_shout) t WHERE rn = 1),
base AS (SELECT t.data_center AS server_name, t.sched_table AS folder_name, trim(jb.job_name) AS job_name, s.when_cond,
           s.shout_time AS notification_time, s.urgency, s.message
         FROM sd s JOIN fx_def_job jb ON s.table_id = jb.table_id
         JOIN fx_def_table t ON s.table_id = t.table_id WHERE starts_with(t.data_center, 'DS')),
ws AS (SELECT base.*, st.media_s FROM base JOIN fx_stat st ON base.server_name = st.datacenter AND base.job_name = st.jobname WHERE st.media_s IS NOT NULL),
rules2 AS (
 SELECT 21 AS rule_no, server_name, folder_name, job_name, media_s, notification_time, urgency, message, '+03%' AS valor_correto
   FROM ws WHERE when_cond = 'EXECUTING' AND media_s >= 1800 AND notification_time >= '+03%' AND notification_time <> '+070%'
 UNION ALL SELECT 22, server_name, folder_name, job_name, media_s, notification_time, urgency, message, '+070%'
   FROM ws WHERE when_cond = 'EXECUTING' AND media_s >= 3000 AND notification_time >= '+070%' AND notification_time <> '+03%'
 UNION ALL SELECT 23, server_name, folder_name, job_name, CAST(0 AS BIGINT), notification_time, urgency, message, 'OK'
   FROM base WHERE when_cond = 'NOTOK')"""


def _rules1(E):
    return TU.report_rules(E.shout_sum.drop("media_s"), E.stat, centre_prefix="DS", cond=None)


def _jobs_of_yesterday(E):
    return E.runs.filter(F.to_date("start_time") == F.lit(YESTERDAY).cast("date")).select(
        F.col("data_center").alias("server_name"), "job_name")


def _rules2(E):
    return TU.definition_rules(E.shout, E.def_job, E.def_table, E.stat, centre_prefix="DS")


@register("e1_u1_report_threshold_rules", sql=f"WITH {RULES1_SQL}\nSELECT * FROM rules1", views=("fx_shout_sum", "fx_stat"))
def q_rules1(spark, sf):
    return _rules1(Estate(spark, sf))


@register("e2_j1_definition_threshold_rules", sql=f"WITH {RULES2_SQL}\nSELECT * FROM rules2",
          views=("fx_shout", "fx_def_job", "fx_def_table", "fx_stat"))
def q_rules2(spark, sf):
    return _rules2(Estate(spark, sf))


SUMMARY_SQL = f"""{RULES1_SQL}, {RULES2_SQL},
c AS (SELECT * FROM rules1 UNION ALL SELECT * FROM rules2),
yd AS (SELECT DISTINCT data_center, job_name FROM fx_exec WHERE CAST(start_time AS DATE) = DATE '{YESTERDAY}'),
le AS (SELECT e.data_center, e.job_name, max(e.end_time) AS last_end FROM fx_exec e JOIN yd ON e.data_center = yd.data_center AND e.job_name = yd.job_name GROUP BY ALL),
f0 AS (SELECT c.*, CASE WHEN c.valor_correto = 'OK' THEN NULL WHEN c.rule_no < 20 THEN (SELECT max(e.end_time) FROM fx_exec e WHERE e.data_center = c.server_name
        AND e.sched_table = c.folder_name AND e.job_name = c.job_name) ELSE le.last_end END AS end_time
        FROM c LEFT JOIN le ON c.server_name = le.data_center AND c.job_name = le.job_name),
al AS ({ALARM_SQL}),
ac AS (SELECT data_center, job_name, count(*) AS quant_alert FROM al WHERE when_cond = 'NOTOK'
        AND CAST(host_time AS DATE) >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 30 DAY AND starts_with(data_center, 'DS') GROUP BY ALL),
f AS (SELECT f0.*, CAST(CASE WHEN f0.end_time IS NULL AND f0.job_name <> '' AND ac.quant_alert >= 1 THEN ac.quant_alert ELSE 0 END AS BIGINT) AS quant_alert
        FROM f0 LEFT JOIN ac ON f0.server_name = ac.data_center AND f0.job_name = ac.job_name),
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY server_name, folder_name, job_name, notification_time
        ORDER BY rule_no NULLS FIRST, media_s NULLS FIRST, urgency NULLS FIRST, message NULLS FIRST, valor_correto NULLS FIRST, end_time NULLS FIRST,
        quant_alert NULLS FIRST) AS rn FROM f) t WHERE rn = 1),
x AS (SELECT rule_no, server_name, folder_name, job_name, media_s, notification_time, urgency, message, end_time, quant_alert,
        CASE WHEN TRY_CAST(replace(valor_correto, '%', '') AS BIGINT) > 999 THEN '+30%' ELSE valor_correto END AS valor_correto FROM k),
final AS (SELECT * FROM x WHERE NOT coalesce(valor_correto = notification_time, false))"""
SUMMARY_VIEWS = ("fx_shout_sum", "fx_stat", "fx_shout", "fx_def_job", "fx_def_table", "fx_exec", "fx_alert")

# Effective threshold (F8) in seconds.
NEW_TIME_SQL = """CASE WHEN starts_with(valor_correto, '=') THEN TRY_CAST(substring(valor_correto, 2) AS BIGINT) * 60
       WHEN starts_with(valor_correto, '+') THEN CAST(floor(CAST(media_s AS DOUBLE) + CAST(media_s AS DOUBLE) * (CAST(TRY_CAST(substring(valor_correto, 2, length(valor_correto) - 2) AS BIGINT) AS DOUBLE) / 100)) AS BIGINT)
  END AS new_time_s"""


@register("pl4_threshold_tuning_impact", sql=f"""
WITH {SUMMARY_SQL}, s AS (SELECT *, {NEW_TIME_SQL} FROM final)
SELECT s.*, (SELECT count(*) FROM fx_exec e WHERE e.job_name = s.job_name AND e.data_center = s.server_name AND s.new_time_s < e.runtime_s) AS calc_shout
FROM s""", views=SUMMARY_VIEWS)
def q_threshold_tuning(spark, sf):
    """PL4 as a whole: both rule sets, summary, impact of each new threshold."""
    from jobscope.plans.jobs import threshold_tuning
    from jobscope.plans.table_queries import alarms_of

    E = Estate(spark, sf)
    return threshold_tuning(E.shout_sum.drop("media_s"), E.shout, E.def_job, E.def_table, E.stat, E.runs, AS_OF,
                            centre_prefix="DS", report_cond=None, alarms=alarms_of(E.alert_plain),
                            yesterday=_jobs_of_yesterday(E))["impact"].drop("id")


@register("e3_threshold_summary_final", sql=f"WITH {SUMMARY_SQL}\nSELECT * FROM final", views=SUMMARY_VIEWS)
def q_summary(spark, sf):
    from jobscope.operators.aggregates import alert_count
    from jobscope.plans.table_queries import alarms_of

    E = Estate(spark, sf)
    counts = alert_count(alarms_of(E.alert_plain), AS_OF, 30, centre_prefix="DS")
    return TU.finalize_summary(_rules1(E).unionByName(_rules2(E)), E.runs, counts, _jobs_of_yesterday(E))


@register("j4_model_executions", sql=f"""
SELECT e.data_center, s.job_name, e.start_time, e.end_time, e.runtime_s FROM fx_exec e
JOIN fx_shout_sum s ON e.data_center = s.server_name AND e.job_name = s.job_name AND e.sched_table = s.folder_name
WHERE e.completion_status = 'Ended OK' AND starts_with(e.data_center, 'DS') AND e.start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY""",
          views=("fx_exec", "fx_shout_sum"))
def q_model(spark, sf):
    E = Estate(spark, sf)
    return TU.model_executions(E.runs, E.shout_sum, AS_OF, 60, "DS")


@register("j4_f22_model_executions_jittered", sql=f"""
SELECT e.data_center, s.job_name, e.start_time, e.end_time, CASE WHEN e.runtime_s <= 1440 THEN CAST('0x' || substr(md5(concat_ws('|', '42', e.data_center, e.job_name,
    CAST(epoch(e.start_time) AS BIGINT), CAST(epoch(e.end_time) AS BIGINT), e.runtime_s)), 1, 8) AS BIGINT) % 9 + 50 ELSE e.runtime_s END AS runtime_s FROM fx_exec e
JOIN fx_shout_sum s ON e.data_center = s.server_name AND e.job_name = s.job_name AND e.sched_table = s.folder_name
WHERE e.completion_status = 'Ended OK' AND starts_with(e.data_center, 'DS') AND e.start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 60 DAY""",
          views=("fx_exec", "fx_shout_sum"))
def q_model_jitter(spark, sf):
    """Run times of at most 24 minutes are replaced by 50–58 s, drawn from a hash of the run."""
    E = Estate(spark, sf)
    return TU.model_executions(E.runs, E.shout_sum, AS_OF, 60, "DS", jitter=True)


@register("e4_f8_j8_threshold_impact", sql=f"""
WITH s AS (SELECT id, server_name, folder_name, job_name, media_s, valor_correto, notification_time, {NEW_TIME_SQL} FROM fx_shout_sum)
SELECT s.*, (SELECT count(*) FROM fx_exec e WHERE e.job_name = s.job_name AND e.data_center = s.server_name AND s.new_time_s < e.runtime_s) AS calc_shout
FROM s""", views=("fx_shout_sum", "fx_exec"))
def q_impact(spark, sf):
    E = Estate(spark, sf)
    return TU.threshold_impact(E.shout_sum, E.runs)


STAT_TIMES_SQL = """st AS (SELECT s.datacenter, s.jobname, s.media_s,
    hour(r.ms) * 3600 + minute(r.ms) * 60 + second(r.ms) AS start_s, hour(r.me) * 3600 + minute(r.me) * 60 + second(r.me) AS end_s
  FROM fx_stat s JOIN (SELECT data_center, job_name, max(start_time) AS ms, max(end_time) AS me FROM fx_exec GROUP BY ALL) r
  ON s.datacenter = r.data_center AND s.jobname = r.job_name),
lr AS (SELECT data_center AS server_name, job_name, end_time FROM fx_exec e
  WHERE end_time = (SELECT max(end_time) FROM fx_exec x WHERE x.job_name = e.job_name))"""


@register("e5_overrun_rule", sql=f"""
WITH {STAT_TIMES_SQL}
SELECT st.datacenter AS server_name, st.jobname AS job_name, (end_s - start_s) - media_s AS quant_alert
FROM st JOIN lr ON st.datacenter = lr.server_name AND st.jobname = lr.job_name
WHERE lr.end_time IS NOT NULL AND media_s IS NOT NULL AND media_s <> 0 AND start_s <> 0 AND end_s <> 0 AND starts_with(datacenter, 'DS')
  AND (end_s - start_s) > media_s AND (end_s - start_s) >= media_s * 1.5 - 1800 AND end_s > start_s""",
          views=("fx_stat", "fx_exec"))
def q_overrun(spark, sf):
    from jobscope.operators.relational import latest_execution

    E = Estate(spark, sf)
    r = E.runs.groupBy("data_center", "job_name").agg(F.max("start_time").alias("ms"), F.max("end_time").alias("me"))
    st = E.stat.join(r, (E.stat.datacenter == r.data_center) & (E.stat.jobname == r.job_name), "inner").select(
        "datacenter", "jobname", "media_s", TU._sec_of_day(F.col("ms")).alias("start_s"),
        TU._sec_of_day(F.col("me")).alias("end_s"))
    lr = latest_execution(E.runs).withColumnRenamed("data_center", "server_name")
    return TU.overrun_rule(st, lr, centre_prefix="DS")


def _clock(c: str) -> str:
    return f"(hour({c}) * 3600 + minute({c}) * 60 + second({c}))"


@register("e6_planned_start_rule", sql=f"""
WITH {STAT_TIMES_SQL},
listed AS (SELECT data_center AS server_name, job_name FROM fx_exec WHERE starts_with(data_center, 'DS') GROUP BY ALL HAVING max(runtime_s) >= 14000),
y AS (SELECT DISTINCT data_center AS server_name, job_name FROM fx_exec WHERE CAST(start_time AS DATE) = DATE '{YESTERDAY}'),
t AS (SELECT data_center AS server_name, job_name, CAST({_clock('end_time')} - {_clock('start_time')} AS DOUBLE) / CAST(1.5 AS DOUBLE) - 1800 AS quant_alert
  FROM fx_exec WHERE CAST(start_time AS DATE) = DATE '{TODAY}' AND starts_with(data_center, 'DS'))
SELECT server_name, job_name, quant_alert, quant_alert / 60 AS total_minutes
FROM t JOIN y USING (server_name, job_name) JOIN lr USING (server_name, job_name)
WHERE lr.end_time IS NOT NULL AND NOT EXISTS (SELECT 1 FROM listed l WHERE l.server_name = t.server_name AND l.job_name = t.job_name)""",
          views=("fx_stat", "fx_exec"))
def q_planned_start(spark, sf):
    """Rule 2e; jobs with a run of 14,000 s or more stand for those listed already."""
    from jobscope.operators.relational import latest_execution

    E = Estate(spark, sf)
    runs = E.runs.withColumnRenamed("data_center", "server_name")
    day = F.to_date("start_time")
    today = runs.filter(day == F.lit(TODAY).cast("date")).select("server_name", "job_name", "end_time",
                                                                 F.col("start_time").alias("planned_start"))
    yesterday = runs.filter(day == F.lit(YESTERDAY).cast("date"))
    listed = runs.groupBy("server_name", "job_name").agg(F.max("runtime_s").alias("m")).filter(F.col("m") >= 14000)
    lr = latest_execution(E.runs).withColumnRenamed("data_center", "server_name")
    return TU.planned_start_rule(today, yesterday, lr, listed, centre_prefix="DS")
