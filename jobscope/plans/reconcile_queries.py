"""Queries for alert / job / incident reconciliation (J9–J18, S12, S13; PL14–PL16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscope.operators import reconcile as RC
from jobscope.plans.registry import register
from jobscope.sources import sinks as S
from jobscope.sources.fixtures import AS_OF_EVENTS, Estate

AS_OF = AS_OF_EVENTS
SYS = "i.sys_created_by = 'system' AND i.u_source = 'scheduler' AND i.category = 'monitoring'"
ORIGIN = "i.u_source = 'scheduler' AND i.category = 'monitoring'"
INC_OF_NOTES = "CASE WHEN upper(a.notes) LIKE '%INC%' AND strpos(a.notes, 'INC') > 0 THEN substring(a.notes, strpos(a.notes, 'INC')) END"


def _lists(E):
    main = E.alert.filter(F.col("message") == "Ended not OK")
    late = E.alert.filter(F.col("message") == "Late submission")
    return main, late


def _failed_jobs(E):
    return E.active.filter(F.col("job_status") == "Ended Not OK")


@register("j9_classify_alerts_to_keep", sql="""
WITH fa AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, server_name ORDER BY start_time, job_status, cyclic, number_of_runs) AS rn FROM fx_active) t WHERE rn = 1),
r AS (SELECT DISTINCT run_id FROM fx_active),
m AS (SELECT 'main' AS list, a.alert_id,
  CASE WHEN r.run_id IS NULL THEN NULL WHEN f.run_id IS NULL THEN 'SERVER_MISMATCH'
       WHEN coalesce(f.job_status <> 'Executing', true) AND f.start_time IS NOT NULL AND lower(a.message) = 'ended not ok' THEN 'FAILED_STILL_ACTIVE'
       WHEN f.cyclic = 'Yes' THEN CASE WHEN a.run_counter < f.number_of_runs THEN 'CYCLIC_OLD_RUN' END
       ELSE 'OTHER' END AS reason
  FROM (SELECT * FROM fx_alert WHERE message = 'Ended not OK') a LEFT JOIN r ON a.run_id = r.run_id
  LEFT JOIN fa f ON a.run_id = f.run_id AND a.server_name = f.server_name),
l AS (SELECT 'late' AS list, a.alert_id, CASE WHEN r.run_id IS NOT NULL THEN 'LATE_ACTIVE' END AS reason
  FROM (SELECT * FROM fx_alert WHERE message = 'Late submission') a LEFT JOIN r ON a.run_id = r.run_id)
SELECT list, alert_id, reason, reason IS NOT NULL AS flag FROM (SELECT * FROM m UNION ALL SELECT * FROM l) u""",
          views=("fx_alert", "fx_active"))
def q_classify(spark, sf):
    E = Estate(spark, sf)
    main, late = _lists(E)
    return RC.classify_alerts_to_keep(main, late, E.active)


@register("j10_alerts_to_reopen", sql="""
WITH f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, server_name ORDER BY start_time, number_of_runs) AS rn
           FROM fx_active WHERE job_status = 'Ended Not OK') t WHERE rn = 1)
SELECT a.* FROM fx_alert a JOIN f ON a.run_id = f.run_id AND a.server_name = f.server_name WHERE f.number_of_runs = a.run_counter""",
          views=("fx_alert", "fx_active"))
def q_reopen(spark, sf):
    E = Estate(spark, sf)
    return RC.alerts_to_reopen(E.alert, _failed_jobs(E))


@register("j11_jobs_without_alert", sql="""
SELECT j.* FROM fx_active j WHERE j.job_status = 'Ended Not OK' AND NOT EXISTS (SELECT 1 FROM fx_alert a
  WHERE a.server_name = j.server_name AND a.run_id = j.run_id AND a.job_name = j.job_name AND a.run_counter = j.number_of_runs)""",
          views=("fx_alert", "fx_active"))
def q_jobs_without_alert(spark, sf):
    E = Estate(spark, sf)
    return RC.jobs_without_alert(_failed_jobs(E), E.alert)


def _j12_sql(lookback_h: int, max_age_days: int) -> str:
    return f"""
SELECT a.*, 'Not Found' AS error FROM fx_alert a
WHERE CAST(a.alert_time AS DATE) >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL {max_age_days} DAY
  AND NOT EXISTS (SELECT 1 FROM fx_incident i WHERE {SYS} AND i.u_datacenter = a.server_name AND i.u_orderid = a.run_id
      AND starts_with(i.u_alert_id, CAST(a.alert_id AS VARCHAR)) AND i.sys_created_on >= a.alert_time - INTERVAL {lookback_h} HOUR
      AND ({INC_OF_NOTES} IS NULL OR i.number = {INC_OF_NOTES}))"""


def _j12_both_sql(lookback_h: int, max_age_days: int) -> str:
    return _j12_sql(lookback_h, max_age_days) + f"""
  AND NOT EXISTS (SELECT 1 FROM fx_incident i WHERE {SYS} AND i.u_datacenter = a.server_name AND i.u_orderid = a.run_id
      AND starts_with(i.u_alert_id, CAST(a.alert_id AS VARCHAR)) AND i.sys_created_on >= a.alert_time)"""


@register("j12_second_pass", sql=_j12_both_sql(0, 60), views=("fx_alert", "fx_incident"))
def q_never_matched(spark, sf):
    E = Estate(spark, sf)
    return RC.alerts_never_matched(E.alert, E.incident, AS_OF, lookback_hours=0, max_age_days=60)


@register("j12_alerts_without_incident", sql=_j12_sql(2, 2), views=("fx_alert", "fx_incident"))
def q_without_incident(spark, sf):
    E = Estate(spark, sf)
    return RC.alerts_without_incident(E.alert, E.incident, AS_OF, lookback_hours=2, max_age_days=2)


@register("j12_alerts_without_incident_all_ages", sql=_j12_sql(0, 60), views=("fx_alert", "fx_incident"))
def q_without_incident_all(spark, sf):
    E = Estate(spark, sf)
    return RC.alerts_without_incident(E.alert, E.incident, AS_OF, lookback_hours=0, max_age_days=60)


AUDIT_EVENTS_SQL = """SELECT 'Auditoria - Cancelamento de Rotina' AS metric_name, 'event-hub' AS u_source,
  concat(server_name, '-', CAST(run_counter AS VARCHAR)) AS resource, run_id AS message_key, job_name AS node
  FROM fx_alert WHERE message = 'Late submission'"""


def _audit_events(E):
    return E.alert.filter(F.col("message") == "Late submission").select(
        F.lit(RC.AUDIT_METRIC).alias("metric_name"), F.lit(RC.AUDIT_SOURCE).alias("u_source"),
        F.concat_ws("-", "server_name", F.col("run_counter").cast("string")).alias("resource"),
        F.col("run_id").alias("message_key"), F.col("job_name").alias("node"))


@register("j13_drop_already_reported", sql=f"""
WITH jobs AS (SELECT * FROM fx_active WHERE job_status = 'Ended Not OK'), ev AS ({AUDIT_EVENTS_SQL}),
h1 AS (SELECT DISTINCT j.job_name FROM jobs j JOIN ev ON concat(j.server_name, '-', CAST(j.number_of_runs AS VARCHAR)) = ev.resource
       AND j.run_id = ev.message_key AND j.job_name = ev.node),
r1 AS (SELECT * FROM jobs WHERE job_name NOT IN (SELECT job_name FROM h1)),
h2 AS (SELECT DISTINCT r1.job_name FROM r1 JOIN fx_incident i ON {SYS} AND i.u_datacenter = r1.server_name AND i.u_orderid = r1.run_id
       AND i.sys_created_on >= r1.end_time - INTERVAL 2 HOUR)
SELECT * FROM r1 WHERE job_name NOT IN (SELECT job_name FROM h2)""", views=("fx_alert", "fx_active", "fx_incident"))
def q_already_reported(spark, sf):
    E = Estate(spark, sf)
    return RC.drop_already_reported(_failed_jobs(E), _audit_events(E), E.incident)


GAPS_SQL = f"""
WITH jg AS (SELECT j.* FROM fx_active j WHERE j.job_status = 'Ended Not OK' AND NOT EXISTS (SELECT 1 FROM fx_alert a
  WHERE a.server_name = j.server_name AND a.run_id = j.run_id AND a.job_name = j.job_name AND a.run_counter = j.number_of_runs)),
ag AS ({_j12_sql(0, 60)}),
fj AS (SELECT job_name, start_time, end_time FROM (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY start_time, end_time) AS rn FROM fx_active) t WHERE rn = 1),
gaps AS (
SELECT job_name, server_name, run_id, start_time AS run_time, start_time, end_time, number_of_runs AS rerun_counter FROM jg
UNION ALL
SELECT ag.job_name, ag.server_name, ag.run_id, ag.alert_time AS run_time, CASE WHEN fj.job_name IS NOT NULL THEN fj.start_time ELSE ag.alert_time END,
  CASE WHEN fj.job_name IS NOT NULL THEN fj.end_time ELSE ag.alert_time END, ag.run_counter FROM ag LEFT JOIN fj ON ag.job_name = fj.job_name)"""


def _gaps(E):
    jg = RC.jobs_without_alert(_failed_jobs(E), E.alert)
    ag = RC.alerts_without_incident(E.alert, E.incident, AS_OF, lookback_hours=0, max_age_days=60)
    return RC.merge_gaps(jg, ag, E.active)


@register("j14_merge_gaps", sql=GAPS_SQL + "\nSELECT * FROM gaps", views=("fx_alert", "fx_active", "fx_incident"))
def q_gaps(spark, sf):
    return _gaps(Estate(spark, sf))


@register("m3_s12_event_payloads_guarded", sql=GAPS_SQL + """
SELECT job_name, run_id, CAST(json_object('node', job_name, 'resource', concat_ws('-', server_name, CAST(rerun_counter AS VARCHAR), run_id),
  'metric_name', 'Auditoria - Cancelamento de Rotina', 'severity', 3,
  'description', concat('Cancelamento da rotina ', job_name, ' referente ao ', strftime(run_time, '%d/%m/%Y %H:%M:%S')),
  'messageKey', run_id,
  'additional_info', json_object('monitoring_tool', 'scheduler', 'kb', 'KB-0001', 'group', '', 'kb01', '', 'kb02', '', 'kb03', '',
     'alert_group', 'I', 'assignment_group_incident', 'batch support', 'fechamento_automatico', 'False',
     'CONTROLMSERVER_ADDINFO', server_name, 'ORDERDATE_ADDINFO', strftime(run_time, '%d/%m/%Y %H:%M:%S'), 'ORDERID_ADDINFO', run_id,
     'RUN_NUMBER', CAST(rerun_counter AS VARCHAR), 'JOBNAME_ADDINFO', job_name,
     'DATETIME_START', strftime(start_time, '%d/%m/%Y %H:%M:%S'), 'DATETIME_END', strftime(end_time, '%d/%m/%Y %H:%M:%S'),
     'DATETIME_RUN', strftime(run_time, '%d/%m/%Y %H:%M:%S'))) AS VARCHAR) AS payload
FROM gaps""", views=("fx_alert", "fx_active", "fx_incident"))
def q_payloads(spark, sf):
    return S.event_payload(_gaps(Estate(spark, sf)))


@register("j15_incident_families", sql=f"""
WITH si AS (SELECT * FROM fx_incident i WHERE {ORIGIN}),
k AS (SELECT parent_incident AS p, count(*) AS child_incidents FROM fx_incident WHERE parent_incident IS NOT NULL GROUP BY 1),
par AS (SELECT si.number AS parent_number, si.u_datacenter AS parent_datacenter, k.child_incidents FROM si JOIN k ON si.number = k.p
  WHERE NOT si.state IN (6, 7, 8) AND starts_with(si.u_datacenter, 'DS') AND si.u_orderid IS NOT NULL AND si.u_orderid <> ''
    AND starts_with(si.description, 'Cancelamento') AND si.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AND NOT coalesce(si.u_additional_info LIKE '%host-x%', false))
SELECT par.*, c.number AS child_number, c.u_datacenter AS child_datacenter, c.u_orderid AS child_orderid, c.u_run_number AS child_run_number,
  json_extract_string(c.u_additional_info, '$.JOBNAME_ADDINFO') AS child_job_name
FROM par JOIN fx_incident c ON c.parent_incident = par.parent_number WHERE c.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY""",
          views=("fx_incident",))
def q_families(spark, sf):
    return RC.incident_families(Estate(spark, sf).incident, AS_OF, "DS")


@register("j16_cleanup_decision", sql=f"""
WITH k AS (SELECT parent_incident AS p, count(*) AS n FROM fx_incident WHERE parent_incident IS NOT NULL GROUP BY 1),
c AS (SELECT i.*, json_extract_string(i.u_additional_info, '$.JOBNAME_ADDINFO') AS job_name FROM fx_incident i LEFT JOIN k ON i.number = k.p
  WHERE i.u_source = 'scheduler' AND i.category = 'monitoring' AND i.parent_incident IS NULL AND coalesce(k.n, 0) = 0
    AND starts_with(i.u_datacenter, 'DS') AND i.u_orderid IS NOT NULL AND i.u_orderid <> '' AND i.state IN (1, 2, 3)
    AND i.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AND NOT coalesce(i.u_additional_info LIKE '%host-x%', false))
SELECT c.number, c.u_datacenter, c.u_orderid, c.job_name, CAST(coalesce(c.u_run_number, 0) AS BIGINT) AS run_number,
  CASE WHEN s.server_name IS NULL THEN 'GONE' WHEN NOT coalesce(s.job_status = 'Ended Not OK', false) THEN 'NOT_FAILED'
       WHEN NOT coalesce(CAST(s.number_of_runs AS BIGINT) = CAST(coalesce(c.u_run_number, 0) AS BIGINT), false) THEN 'COUNTER_DIFFERS'
       WHEN s.held THEN 'DELETE' ELSE 'HOLD_THEN_DELETE' END AS decision
FROM c LEFT JOIN fx_active s ON c.u_datacenter = s.server_name AND c.u_orderid = s.run_id""", views=("fx_incident", "fx_active"))
def q_cleanup(spark, sf):
    E = Estate(spark, sf)
    return RC.cleanup_decision(RC.cleanup_candidates(E.incident, AS_OF, "DS"), E.active)


@register("j17_isolated_jobs", sql="""
SELECT a.* FROM fx_active a WHERE a.run_id NOT IN (SELECT src FROM fx_edge UNION SELECT dst FROM fx_edge)""",
          views=("fx_active", "fx_edge"))
def q_isolated(spark, sf):
    E = Estate(spark, sf)
    return RC.isolated_jobs(E.active, E.edge)


FAILED_MSG_SQL = """SELECT concat('Failed for alerts [', split_part(u_alert_id, '-', 1), ']') AS message FROM fx_incident"""


def _failed_messages(E):
    return E.incident.select(F.concat(F.lit("Failed for alerts ["), F.split_part("u_alert_id", F.lit("-"), F.lit(1)),
                                      F.lit("]")).alias("message"))


@register("j18_f20_split_success", sql=f"""
WITH m AS ({FAILED_MSG_SQL}), f AS (SELECT DISTINCT TRY_CAST(trim(unnest(string_split(regexp_extract(message, '\\[([^\\]]*)', 1), ','))) AS BIGINT) AS fid FROM m)
SELECT a.alert_id, a.run_id, CASE WHEN f.fid IS NULL THEN 'ok' ELSE 'failed' END AS outcome
FROM fx_alert a LEFT JOIN (SELECT fid FROM f WHERE fid IS NOT NULL) f ON a.alert_id = f.fid""", views=("fx_alert", "fx_incident"))
def q_split(spark, sf):
    E = Estate(spark, sf)
    return RC.split_success(E.alert_plain.select("alert_id", "run_id"), _failed_messages(E))


@register("s13_audit_log", sql=f"""
WITH m AS ({FAILED_MSG_SQL}), f AS (SELECT DISTINCT TRY_CAST(trim(unnest(string_split(regexp_extract(message, '\\[([^\\]]*)', 1), ','))) AS BIGINT) AS fid FROM m),
o AS (SELECT a.alert_id, a.message AS old_value, CASE WHEN f.fid IS NULL THEN 'OK' ELSE 'NOK' END AS status,
             CASE WHEN f.fid IS NULL THEN NULL ELSE 'close failed' END AS err
      FROM fx_alert a LEFT JOIN (SELECT fid FROM f WHERE fid IS NOT NULL) f ON a.alert_id = f.fid)
SELECT TIMESTAMP '{AS_OF}' AS log_time, 1 AS automation_id, CASE status WHEN 'OK' THEN 1 WHEN 'NOK' THEN 2 ELSE 0 END AS status_id,
  CAST(alert_id AS VARCHAR) AS alerta_id, CASE WHEN status = 'OK' THEN old_value END AS old_value,
  CASE WHEN status = 'OK' THEN 'Closed' END AS new_value, CASE WHEN status <> 'OK' THEN err END AS error_message FROM o""",
          views=("fx_alert", "fx_incident"))
def q_audit(spark, sf):
    E = Estate(spark, sf)
    o = RC.split_success(E.alert_plain.select("alert_id", "message"), _failed_messages(E))
    o = o.select("alert_id", F.col("message").alias("old_value"),
                 F.when(F.col("outcome") == "ok", "OK").otherwise("NOK").alias("status"),
                 F.when(F.col("outcome") != "ok", F.lit("close failed")).alias("err"))
    return S.audit_log(o, 1, AS_OF, status_col="status", id_col="alert_id", old_col="old_value",
                       new_value="Closed", error_col="err")


@register("s13_audit_log_nothing_found", sql=f"""
SELECT TIMESTAMP '{AS_OF}' AS log_time, 4 AS automation_id, -1 AS status_id, NULL::VARCHAR AS alerta_id, NULL::VARCHAR AS old_value,
  NULL::VARCHAR AS new_value, NULL::VARCHAR AS error_message
WHERE NOT EXISTS (SELECT 1 FROM fx_incident i WHERE i.state IN (1, 2, 3) AND i.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 400 DAY)""",
          views=("fx_incident",))
def q_audit_empty(spark, sf):
    E = Estate(spark, sf)
    old = E.incident.filter(F.col("state").isin(1, 2, 3) & (F.col("sys_created_on") < F.lit(AS_OF).cast("timestamp")
                                                             - F.make_dt_interval(F.lit(400))))
    o = old.select(F.col("number").alias("alert_id"), F.lit("OK").alias("status"), F.lit(None).cast("string").alias("old_value"))
    return S.audit_log(o, 4, AS_OF, status_col="status", id_col="alert_id", old_col="old_value")


def _families_by_order(E):
    """Incidents where the first incident (by number) of each centre/order is the
    parent of the others: a family structure derived from the incident table."""
    inc = E.incident
    first = inc.groupBy("u_datacenter", "u_orderid").agg(F.min("number").alias("__first"))
    j = inc.join(first, ["u_datacenter", "u_orderid"], "left")
    return j.withColumn("parent_incident", F.when(F.col("number") != F.col("__first"), F.col("__first"))) \
        .drop("__first").select(*inc.columns)


@register("j15_incident_families_by_order", sql=f"""
WITH f AS (SELECT u_datacenter, u_orderid, min(number) AS first_no FROM fx_incident GROUP BY 1, 2),
inc AS (SELECT i.* REPLACE (CASE WHEN i.number <> f.first_no THEN f.first_no END AS parent_incident)
        FROM fx_incident i LEFT JOIN f ON i.u_datacenter = f.u_datacenter AND i.u_orderid = f.u_orderid),
si AS (SELECT * FROM inc i WHERE {ORIGIN}),
k AS (SELECT parent_incident AS p, count(*) AS child_incidents FROM inc WHERE parent_incident IS NOT NULL GROUP BY 1),
par AS (SELECT si.number AS parent_number, si.u_datacenter AS parent_datacenter, k.child_incidents FROM si JOIN k ON si.number = k.p
  WHERE NOT si.state IN (6, 7, 8) AND starts_with(si.u_datacenter, 'DS') AND si.u_orderid IS NOT NULL AND si.u_orderid <> ''
    AND starts_with(si.description, 'Cancelamento') AND si.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AND NOT coalesce(si.u_additional_info LIKE '%host-x%', false))
SELECT par.*, c.number AS child_number, c.u_datacenter AS child_datacenter, c.u_orderid AS child_orderid, c.u_run_number AS child_run_number,
  json_extract_string(c.u_additional_info, '$.JOBNAME_ADDINFO') AS child_job_name
FROM par JOIN inc c ON c.parent_incident = par.parent_number WHERE c.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY""",
          views=("fx_incident",))
def q_families_by_order(spark, sf):
    return RC.incident_families(_families_by_order(Estate(spark, sf)), AS_OF, "DS")
