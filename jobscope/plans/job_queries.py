"""Queries for the named job compositions: each runs the whole job
plan of ``plans.jobs`` / ``plans.catalogue`` / ``plans.services`` on the fixture
views, so the composition itself (not only its parts) is checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscope.operators.aggregates import service_fanout
from jobscope.operators.relational import Rule
from jobscope.plans import jobs as J
from jobscope.plans.catalogue import build_catalogue
from jobscope.plans.reconcile_queries import (AUDIT_EVENTS_SQL, FAILED_MSG_SQL, ORIGIN, SYS, _audit_events,
                                              _failed_jobs, _failed_messages, _j12_both_sql, _lists)
from jobscope.plans.registry import register
from jobscope.plans.services import service_map_load
from jobscope.plans.table_queries import CATALOG_SQL, DIFF_SQL
from jobscope.sources.sinks import gap_log
from jobscope.sources.fixtures import AS_OF_DATES, AS_OF_EVENTS, Estate

AS_OF = AS_OF_EVENTS
DAY = "2024-01-15"
APP_M = "trim(CASE WHEN rtrim(substring(job_name, 1, 3)) = 'M' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END)"
APP_P = "trim(CASE WHEN rtrim(substring(job_name, 1, 3)) = 'P' THEN substring(job_name, 1, 2) ELSE substring(job_name, 1, 3) END)"
END_DAY = "substring(strftime(end_time, '%Y-%m-%d %H:%M:%S'), 1, 10)"


@register("pl2_snapshot_job_summary", sql=f"""
WITH d AS ({DIFF_SQL}), g AS (SELECT * FROM d),
c AS (SELECT t.data_center, {APP_M.replace('job_name', 'g.job_name')} AS sigla FROM g JOIN fx_def_table t ON g.table_id = t.table_id)
SELECT substring(data_center, 1, 2) AS platform, sigla, count(*) AS n, DATE '{AS_OF_DATES}' AS data FROM c GROUP BY ALL""",
          views=("fx_jobs_cur", "fx_jobs_prev", "fx_def_table"))
def q_snapshot_job(spark, sf):
    E = Estate(spark, sf)
    return J.snapshot_job(E.jobs_cur, E.jobs_prev, E.def_table.select("table_id", "data_center"), AS_OF_DATES)["summary"]


@register("pl1_alert_load", sql="""
SELECT CAST(alert_id AS VARCHAR) AS serial, NULL::VARCHAR AS alert_key, server_name AS node, NULL::VARCHAR AS node_alias, 'agent' AS agent,
  NULL::VARCHAR AS alert_group, NULL::VARCHAR AS x7, job_name AS application, 'mgr' AS manager, run_id AS server, '3' AS severity, notes AS summary,
  alert_time AS first_occurrence, alert_time AS last_occurrence, NULL::TIMESTAMP AS internal_last, NULL::VARCHAR AS poll,
  CAST(run_counter AS VARCHAR) AS tally, NULL::VARCHAR AS expire_time, NULL::VARCHAR AS owner_uid FROM fx_alert""", views=("fx_alert",))
def q_alert_load(spark, sf):
    from jobscope.plans.expression_queries import alert_report_lines

    return J.load_alerts(alert_report_lines(Estate(spark, sf).alert).select(F.col("line").alias("value")))


def _loaded(spark, sf):
    from jobscope.plans.expression_queries import exec_report_lines

    return J.load_executions(exec_report_lines(Estate(spark, sf).exec).select(F.col("line").alias("value")), AS_OF)


@register("pl3_execution_load", sql=f"""
WITH f AS (SELECT * FROM fx_exec WHERE completion_status = 'Ended Not OK' AND CAST(start_time AS DATE) >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY)
SELECT e.data_center, e.sched_table, 'APP' AS application, 'GRP' AS group_name, 'N1' AS node_id, e.job_name, CAST(e.start_time AS DATE) AS odate,
  e.start_time, e.end_time, CAST(e.rerun_counter AS INTEGER) AS rerun_counter, e.completion_status, '0' AS average_cpu_time, e.order_id, e.runtime_s,
  date_diff('second', p.start_time, c.end_time) AS mttr_s
FROM fx_exec e LEFT JOIN f c ON c.exec_id = e.exec_id
LEFT JOIN f p ON p.order_id = c.order_id AND p.job_name = c.job_name AND p.rerun_counter + 1 = c.rerun_counter""", views=("fx_exec",))
def q_execution_load(spark, sf):
    """All rows, those of ``MP`` centres and old ones too, with the repair time written back."""
    return _loaded(spark, sf)["executions"]


@register("pl3_latest_run", sql="""
SELECT data_center, job_name, end_time, CAST(end_time AS DATE) AS end_date, strftime(end_time, '%H:%M:%S') AS end_clock
FROM (SELECT *, max(end_time) OVER (PARTITION BY job_name) AS last_end FROM fx_exec) t WHERE end_time = last_end""", views=("fx_exec",))
def q_latest_run(spark, sf):
    return _loaded(spark, sf)["latest"]


@register("pl9_status_volume_day", sql=f"""
SELECT {END_DAY} AS data, substring(data_center, 1, 2) AS ambiente, data_center, {APP_M} AS sigla, completion_status AS status, count(*) AS volume
FROM fx_exec WHERE starts_with(data_center, 'DS') AND {END_DAY} = '{DAY}' GROUP BY ALL
UNION ALL
SELECT {END_DAY} AS data, CASE WHEN data_center = 'MP' THEN '1' ELSE '2' END AS ambiente, data_center, {APP_P} AS sigla, completion_status AS status, count(*) AS volume
FROM fx_exec WHERE starts_with(data_center, 'MP') AND {END_DAY} = '{DAY}' GROUP BY ALL""",
          views=("fx_exec",))
def q_status_volume(spark, sf):
    return J.status_volume(Estate(spark, sf).runs, DAY, open_prefix="DS")


@register("pl10_platform_volume_history", sql=f"""
SELECT * FROM (SELECT substring(data_center, 1, 2) AS platform, CAST(start_time AS DATE) AS data, count(*) AS n FROM fx_exec
  WHERE start_time BETWEEN CAST(CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL 2 DAY AS TIMESTAMP) AND CAST(CAST(TIMESTAMP '{AS_OF}' AS DATE) AS TIMESTAMP)
  GROUP BY ALL) v
WHERE data IS NULL OR data >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAY""", views=("fx_exec",))
def q_platform_history(spark, sf):
    return J.platform_volume_job(Estate(spark, sf).runs, None, AS_OF)


@register("pl11_service_map_distinct", sql=f"""
WITH u AS (SELECT * FROM fx_bim GROUP BY ALL HAVING count(*) = 1),
h AS (SELECT * FROM u WHERE data_car IS NULL OR data_car >= TIMESTAMP '{AS_OF_DATES} 00:00:00' - INTERVAL 39 DAY)
SELECT DISTINCT replace(service_name, '"', '') AS service_name, replace(jobname, '"', '') AS jobname FROM h""", views=("fx_bim",))
def q_service_map(spark, sf):
    _, dmap = service_map_load(Estate(spark, sf).bim, None, f"{AS_OF_DATES} 00:00:00", 39)
    return dmap


@register("pl12_definitions_mirror", sql="""
SELECT table_id, job_id, job_name, memname, 'SRV_A' AS source,
  concat_ws('#;', coalesce(CAST(table_id AS VARCHAR), ''), coalesce(CAST(job_id AS VARCHAR), ''), coalesce(job_name, ''), coalesce(memname, '')) AS line
FROM fx_def_job WHERE is_current_version = 'Y'
UNION ALL
SELECT table_id, job_id, job_name, memname, 'SRV_B' AS source,
  concat_ws('#;', coalesce(CAST(table_id AS VARCHAR), ''), coalesce(CAST(job_id AS VARCHAR), ''), coalesce(job_name, ''), coalesce(memname, '')) AS line
FROM fx_jobs_prev WHERE is_current_version = 'Y'""", views=("fx_def_job", "fx_jobs_prev"))
def q_mirror(spark, sf):
    E = Estate(spark, sf)
    return J.definitions_mirror({"SRV_A": E.def_job, "SRV_B": E.jobs_prev},
                                columns=["table_id", "job_id", "job_name", "memname"])


@register("pl14_close_alerts_log", sql=f"""
WITH fa AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, server_name ORDER BY start_time, job_status, cyclic, number_of_runs) AS rn FROM fx_active) t WHERE rn = 1),
r AS (SELECT DISTINCT run_id FROM fx_active),
m AS (SELECT a.alert_id,
  CASE WHEN r.run_id IS NULL THEN NULL WHEN f.run_id IS NULL THEN 'SERVER_MISMATCH'
       WHEN coalesce(f.job_status <> 'Executing', true) AND f.start_time IS NOT NULL AND lower(a.message) = 'ended not ok' THEN 'FAILED_STILL_ACTIVE'
       WHEN f.cyclic = 'Yes' THEN CASE WHEN a.run_counter < f.number_of_runs THEN 'CYCLIC_OLD_RUN' END
       ELSE 'OTHER' END AS reason
  FROM (SELECT * FROM fx_alert WHERE message = 'Ended not OK') a LEFT JOIN r ON a.run_id = r.run_id
  LEFT JOIN fa f ON a.run_id = f.run_id AND a.server_name = f.server_name),
l AS (SELECT a.alert_id, CASE WHEN r.run_id IS NOT NULL THEN 'LATE_ACTIVE' END AS reason
  FROM (SELECT * FROM fx_alert WHERE message = 'Late submission') a LEFT JOIN r ON a.run_id = r.run_id),
closed AS (SELECT alert_id FROM m WHERE reason IS NULL UNION ALL SELECT alert_id FROM l WHERE reason IS NULL),
msg AS ({FAILED_MSG_SQL}),
f AS (SELECT DISTINCT TRY_CAST(trim(unnest(string_split(regexp_extract(message, '\\[([^\\]]*)', 1), ','))) AS BIGINT) AS fid FROM msg),
o AS (SELECT c.alert_id, CASE WHEN f.fid IS NULL THEN 'OK' ELSE 'NOK' END AS status FROM closed c LEFT JOIN (SELECT fid FROM f WHERE fid IS NOT NULL) f ON c.alert_id = f.fid)
SELECT TIMESTAMP '{AS_OF}' AS log_time, 1 AS automation_id, CASE status WHEN 'OK' THEN 1 ELSE 2 END AS status_id,
  CAST(alert_id AS VARCHAR) AS alerta_id, NULL::VARCHAR AS old_value, CASE WHEN status = 'OK' THEN 'Closed' END AS new_value,
  NULL::VARCHAR AS error_message FROM o""", views=("fx_alert", "fx_active", "fx_incident"))
def q_close_log(spark, sf):
    E = Estate(spark, sf)
    main, late = _lists(E)
    return J.close_reopen(main, late, E.active, _failed_jobs(E), _failed_messages(E), AS_OF)["log"]


GAPS_SQL = f"""WITH jobs AS (SELECT j.* FROM fx_active j WHERE j.job_status = 'Ended Not OK' AND NOT EXISTS (SELECT 1 FROM fx_alert a
  WHERE a.server_name = j.server_name AND a.run_id = j.run_id AND a.job_name = j.job_name AND a.run_counter = j.number_of_runs)),
ev AS ({AUDIT_EVENTS_SQL}),
h1 AS (SELECT DISTINCT j.job_name FROM jobs j JOIN ev ON concat(j.server_name, '-', CAST(j.number_of_runs AS VARCHAR)) = ev.resource
       AND j.run_id = ev.message_key AND j.job_name = ev.node),
r1 AS (SELECT * FROM jobs WHERE job_name NOT IN (SELECT job_name FROM h1)),
h2 AS (SELECT DISTINCT r1.job_name FROM r1 JOIN fx_incident i ON {SYS} AND i.u_datacenter = r1.server_name AND i.u_orderid = r1.run_id
       AND i.sys_created_on >= r1.end_time - INTERVAL 2 HOUR),
jg AS (SELECT * FROM r1 WHERE job_name NOT IN (SELECT job_name FROM h2)),
ag AS ({_j12_both_sql(2, 2)}),
fj AS (SELECT job_name, start_time, end_time FROM (SELECT *, row_number() OVER (PARTITION BY job_name ORDER BY start_time, end_time) AS rn FROM fx_active) t WHERE rn = 1),
gaps0 AS (
  SELECT job_name, server_name, run_id, start_time AS run_time, start_time, end_time, number_of_runs AS rerun_counter FROM jg
  UNION ALL
  SELECT ag.job_name, ag.server_name, ag.run_id, ag.alert_time, CASE WHEN fj.job_name IS NOT NULL THEN fj.start_time ELSE ag.alert_time END,
    CASE WHEN fj.job_name IS NOT NULL THEN fj.end_time ELSE ag.alert_time END, ag.run_counter FROM ag LEFT JOIN fj ON ag.job_name = fj.job_name),
gaps AS (SELECT * FROM gaps0)"""


@register("pl15_gap_events", sql=f"""
{GAPS_SQL}
SELECT job_name, run_id, concat_ws('-', server_name, CAST(rerun_counter AS VARCHAR), run_id) AS resource,
  strftime(start_time, '%d/%m/%Y %H:%M:%S') AS datetime_start FROM gaps""",
          views=("fx_alert", "fx_active", "fx_incident"))
def q_gap_events(spark, sf):
    E = Estate(spark, sf)
    ev = J.gaps_to_events(_failed_jobs(E), E.alert, E.incident, _audit_events(E), E.active, AS_OF)["events"]
    return ev.select("job_name", "run_id", F.get_json_object("payload", "$.resource").alias("resource"),
                     F.get_json_object("payload", "$.additional_info.DATETIME_START").alias("datetime_start"))


@register("pl15_log", sql=f"""
{GAPS_SQL},
inc AS (SELECT u_datacenter, job_name, min(number) AS number FROM (SELECT u_datacenter, number, json_extract_string(u_additional_info, '$.JOBNAME_ADDINFO') AS job_name
  FROM fx_incident WHERE right(number, 1) IN ('2', '4')) t GROUP BY 1, 2),
lg AS (SELECT g.job_name, i.number, coalesce(ends_with(g.run_id, '5'), false) AS bad FROM gaps g LEFT JOIN inc i ON g.server_name = i.u_datacenter AND g.job_name = i.job_name)
SELECT TIMESTAMP '{AS_OF}' AS log_time, 5 AS automation_id, CASE WHEN bad THEN 2 ELSE 1 END AS status_id, job_name, CASE WHEN NOT bad THEN number END AS incidents,
  CASE WHEN NOT bad THEN 'Event Opened' END AS old_value, CASE WHEN NOT bad THEN 'None' END AS new_value, CASE WHEN bad THEN 'HTTP 500' END AS error_message FROM lg
UNION ALL SELECT TIMESTAMP '{AS_OF}', 5, -1, NULL, NULL, NULL, NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM lg)""",
          views=("fx_alert", "fx_active", "fx_incident"))
def q_gap_log(spark, sf):
    """Outcomes of the gap events: runs ending in 5 could not be posted, and some incidents carry a job's name as their order."""
    E = Estate(spark, sf)
    gaps = J.gaps_to_events(_failed_jobs(E), E.alert, E.incident, _audit_events(E), E.active, AS_OF)["gaps"]
    failures = gaps.filter(F.col("run_id").endswith("5")).select("job_name", "run_id", F.lit("HTTP 500").alias("error_message"))
    found = E.incident.filter(F.substring("number", -1, 1).isin("2", "4")).select(
        "number", "u_datacenter", F.get_json_object("u_additional_info", "$.JOBNAME_ADDINFO").alias("u_orderid"))
    return gap_log(gaps, AS_OF, failures, found)


@register("pl16_stale_cleanup_decisions_ws", sql=f"""
WITH k AS (SELECT parent_incident AS p, count(*) AS n FROM fx_incident WHERE parent_incident IS NOT NULL GROUP BY 1),
c AS (SELECT i.*, json_extract_string(i.u_additional_info, '$.JOBNAME_ADDINFO') AS job_name FROM fx_incident i LEFT JOIN k ON i.number = k.p
  WHERE i.u_source = 'scheduler' AND i.category = 'monitoring' AND i.parent_incident IS NULL AND coalesce(k.n, 0) = 0
    AND starts_with(i.u_datacenter, 'WS') AND i.u_orderid IS NOT NULL AND i.u_orderid <> '' AND i.state IN (1, 2, 3)
    AND i.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 15 DAY AND NOT coalesce(i.u_additional_info LIKE '%host-x%', false))
SELECT c.number, c.u_datacenter, c.u_orderid, c.job_name, CAST(coalesce(c.u_run_number, 0) AS BIGINT) AS run_number,
  CASE WHEN s.server_name IS NULL THEN 'GONE' WHEN NOT coalesce(s.job_status = 'Ended Not OK', false) THEN 'NOT_FAILED'
       WHEN NOT coalesce(CAST(s.number_of_runs AS BIGINT) = CAST(coalesce(c.u_run_number, 0) AS BIGINT), false) THEN 'COUNTER_DIFFERS'
       WHEN s.held THEN 'DELETE' ELSE 'HOLD_THEN_DELETE' END AS decision
FROM c LEFT JOIN fx_active s ON c.u_datacenter = s.server_name AND c.u_orderid = s.run_id""", views=("fx_incident", "fx_active"))
def q_stale_ws(spark, sf):
    E = Estate(spark, sf)
    return J.stale_cleanup(E.incident, E.active, E.active, E.edge, AS_OF, server="WS")["decisions"]


FAMILY_SQL = f"""k AS (SELECT parent_incident AS p, count(*) AS n FROM fx_incident WHERE parent_incident IS NOT NULL GROUP BY 1),
old AS (SELECT * FROM fx_incident WHERE sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY),
par AS (SELECT i.number FROM old i JOIN k ON i.number = k.p WHERE {ORIGIN} AND i.state NOT IN (6, 7, 8) AND starts_with(i.u_datacenter, 'DS')
  AND i.u_orderid <> '' AND starts_with(i.description, 'Cancelamento') AND NOT contains(i.u_additional_info, 'host-x')),
kids AS (SELECT c.number, c.parent_incident FROM old c JOIN par ON c.parent_incident = par.number),
ids AS (SELECT number FROM kids UNION SELECT parent_incident FROM kids),
c AS (SELECT i.* FROM fx_incident i JOIN ids USING (number)),
fam AS (SELECT c.number, c.u_datacenter, c.u_orderid, json_extract_string(c.u_additional_info, '$.JOBNAME_ADDINFO') AS job_name,
  CAST(coalesce(c.u_run_number, 0) AS BIGINT) AS run_number,
  CASE WHEN s.server_name IS NULL THEN 'GONE' WHEN s.job_status <> 'Ended Not OK' THEN 'NOT_FAILED'
       WHEN s.number_of_runs <> coalesce(c.u_run_number, 0) THEN 'COUNTER_DIFFERS'
       WHEN s.held THEN 'DELETE' ELSE 'HOLD_THEN_DELETE' END AS decision
FROM c LEFT JOIN fx_active s ON c.u_datacenter = s.server_name AND c.u_orderid = s.run_id)"""


def _cleanup_log_sql(source: str) -> str:
    """Rows of ``source`` (decisions joined with their incident) as the clean-up log; every sixth incident's deletion failed."""
    return f"""lg AS (SELECT d.job_name, d.number, CASE WHEN length(d.number) % 2 = 0 THEN regexp_replace(i.u_alert_id, '-X$', '') ELSE '0' END AS alert,
  d.decision IN ('DELETE', 'HOLD_THEN_DELETE') AND ends_with(d.number, '6') AS bad FROM {source} d JOIN fx_incident i USING (number))
SELECT TIMESTAMP '{AS_OF}' AS log_time, 4 AS automation_id, CASE WHEN bad THEN 2 ELSE 1 END AS status_id, job_name, number AS incidents, alert AS alerta_id,
  NULL::VARCHAR AS new_value, CASE WHEN bad THEN 'HTTP 500' END AS error_message FROM lg
UNION ALL SELECT TIMESTAMP '{AS_OF}', 4, -1, NULL, NULL, NULL, NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM lg)"""


def _cleanup(spark, sf, server: str = "DS"):
    """The clean-up over the fixture; deletions of incidents ending in 6 are said to have failed."""
    E = Estate(spark, sf)
    plain = E.incident.withColumn("u_alert_id", F.when(F.length("number") % 2 == 0, F.regexp_replace("u_alert_id", "-X$", "")).otherwise(F.col("u_alert_id")))
    failures = E.incident.filter(F.col("number").endswith("6")).select("number", F.lit("HTTP 500").alias("error_message"))
    return J.stale_cleanup(plain, E.active, E.active, E.edge, AS_OF, server, failures)


@register("pl16_log", sql=f"WITH {FAMILY_SQL},\n{_cleanup_log_sql('fam')}", views=("fx_incident", "fx_active"))
def q_cleanup_log(spark, sf):
    return _cleanup(spark, sf)["log"]


@register("pl16_single_log", sql=f"""WITH k AS (SELECT parent_incident AS p, count(*) AS n FROM fx_incident WHERE parent_incident IS NOT NULL GROUP BY 1),
c AS (SELECT i.*, json_extract_string(i.u_additional_info, '$.JOBNAME_ADDINFO') AS job_name FROM fx_incident i LEFT JOIN k ON i.number = k.p
  WHERE i.u_source = 'scheduler' AND i.category = 'monitoring' AND i.parent_incident IS NULL AND coalesce(k.n, 0) = 0
    AND starts_with(i.u_datacenter, 'DS') AND i.u_orderid IS NOT NULL AND i.u_orderid <> '' AND i.state IN (1, 2, 3)
    AND i.sys_created_on < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AND NOT coalesce(i.u_additional_info LIKE '%host-x%', false)),
one AS (SELECT c.number, c.job_name, CASE WHEN s.job_status = 'Ended Not OK' AND CAST(s.number_of_runs AS BIGINT) = CAST(coalesce(c.u_run_number, 0) AS BIGINT)
  THEN 'DELETE' ELSE 'NONE' END AS decision FROM c LEFT JOIN fx_active s ON c.u_datacenter = s.server_name AND c.u_orderid = s.run_id),
{_cleanup_log_sql('one')}""", views=("fx_incident", "fx_active"))
def q_cleanup_single_log(spark, sf):
    return _cleanup(spark, sf)["single_log"]


@register("pl16_held_log", sql=f"""
WITH ends AS (SELECT src AS n FROM fx_edge UNION SELECT dst FROM fx_edge),
h AS (SELECT a.job_name, ends.n IS NULL AS free FROM fx_active a LEFT JOIN ends ON a.run_id = ends.n
      WHERE a.held AND CAST(a.start_time AS DATE) <= DATE '{AS_OF[:10]}' - INTERVAL 15 DAY)
SELECT TIMESTAMP '{AS_OF}' AS log_time, 6 AS automation_id, CASE WHEN free THEN 1 ELSE 2 END AS status_id, job_name, NULL::VARCHAR AS incidents,
  NULL::VARCHAR AS alerta_id, NULL::VARCHAR AS new_value, CASE WHEN NOT free THEN 'Rotina com sucessores' END AS error_message FROM h
UNION ALL SELECT TIMESTAMP '{AS_OF}', 6, -1, NULL, NULL, NULL, NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM h)""", views=("fx_active", "fx_edge"))
def q_held_log(spark, sf):
    return _cleanup(spark, sf)["held_log"]


@register("pl16_family_decisions", sql=f"WITH {FAMILY_SQL}\nSELECT * FROM fam", views=("fx_incident", "fx_active"))
def q_family_decisions(spark, sf):
    E = Estate(spark, sf)
    return J.stale_cleanup(E.incident, E.active, E.active, E.edge, AS_OF)["family_decisions"]


# Site corrections of the fixture estate (a code later deleted, one later upper-cased, a node group).
SITE_RULES = [
    Rule("data_center = 'DS-A' AND job_name LIKE 'PX%'", "sigla", "X-PX"),
    Rule("data_center = 'DS-B' AND job_name LIKE 'JB%'", "sigla", "wsj"),
    Rule("data_center = 'DS-A' AND job_name LIKE 'JB%'", "sigla", "Wsk"),
    Rule("node_group LIKE 'B%'", "node_group", "Brand"),
]

CAT_SQL = f"""
cat0 AS ({CATALOG_SQL}),
mf AS (SELECT trim(substring(trim(j.job_name), 1, 3)) AS sigla, trim(t.data_center) AS data_center, trim(t.sched_table) AS sched_table,
         trim(j.job_name) AS job_name, trim(j.memname) AS memname
       FROM fx_def_table t JOIN fx_def_job j ON t.table_id = j.table_id WHERE starts_with(t.data_center, 'MP')),
cat1 AS (SELECT sigla, data_center, sched_table, job_name, memname, criticality, node_group, 'Producao-open' AS ambiente FROM cat0 c
         WHERE NOT EXISTS (SELECT 1 FROM mf WHERE mf.data_center = c.data_center AND mf.sched_table = c.sched_table AND mf.job_name = c.job_name)
         UNION ALL SELECT sigla, data_center, sched_table, job_name, memname, NULL, 'Z', 'Producao' FROM mf),
look AS (SELECT substring(concat(trim(job_name), ''), 1, 3) AS sh, max(concat('F-', substring(trim(job_name), 1, 3))) AS full_code FROM fx_def_job
  WHERE job_id % 2 = 0 GROUP BY 1),
cat1b AS (SELECT c.* REPLACE (CASE WHEN c.data_center = 'MP-A' AND l.sh IS NOT NULL THEN l.full_code ELSE c.sigla END AS sigla)
          FROM cat1 c LEFT JOIN look l ON c.sigla = l.sh),
cat1c AS (SELECT * REPLACE (CASE WHEN data_center = 'DS-A' AND job_name LIKE 'PX%' THEN 'X-PX' WHEN data_center = 'DS-B' AND job_name LIKE 'JB%' THEN 'wsj'
            WHEN data_center = 'DS-A' AND job_name LIKE 'JB%' THEN 'Wsk'
            ELSE sigla END AS sigla, CASE WHEN node_group LIKE 'B%' THEN 'Brand' ELSE node_group END AS node_group) FROM cat1b),
cat1d AS (SELECT * REPLACE (CASE WHEN sigla LIKE 'ws%' THEN replace(sigla, 's', 'S') ELSE sigla END AS sigla) FROM cat1c),
cat2 AS (SELECT * REPLACE (CASE WHEN sigla LIKE 'Ws%' THEN replace(sigla, 'w', 'W') ELSE sigla END AS sigla) FROM cat1d
         WHERE NOT coalesce(sigla = 'P1' OR sigla LIKE 'X%', false)),
vu AS (SELECT DISTINCT trim(job_name) AS jobname FROM fx_def_job WHERE job_id % 10 = 3),
fan AS (SELECT data_center, jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'DS') GROUP BY ALL
  UNION ALL SELECT data_center, memname AS jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'WS') GROUP BY ALL),
fq AS (SELECT jobname, CAST(max(qlobis) AS VARCHAR) AS q FROM fan GROUP BY 1),
sv AS (SELECT jobname, max(service_name) AS s FROM fx_bim GROUP BY 1)"""


@register("pl5_catalogue_build", sql=f"""
WITH {CAT_SQL}
SELECT c.sigla, c.data_center, c.sched_table, c.job_name, c.memname,
  CASE WHEN vu.jobname IS NOT NULL THEN 'Very Urgent' WHEN c.criticality = 'A' THEN 'High' WHEN c.criticality = 'M' THEN 'Moderate' WHEN c.criticality = 'B' THEN 'Low'
       WHEN c.criticality NOT IN ('High', 'Moderate', 'Low', 'Urgent') THEN 'R' ELSE c.criticality END AS criticality,
  c.node_group, DATE '{AS_OF_DATES}' AS date_load, c.ambiente, coalesce(sv.s, fq.q) AS lob_bim
FROM cat2 c LEFT JOIN fq ON c.job_name = fq.jobname LEFT JOIN sv ON c.job_name = sv.jobname LEFT JOIN vu ON c.job_name = vu.jobname""",
          views=("fx_def_table", "fx_def_job", "fx_bim"))
def q_catalogue(spark, sf):
    E = Estate(spark, sf)
    mf = (E.def_job.join(E.def_table.filter(F.col("data_center").startswith("MP")), "table_id")
          .select(F.substring(F.trim("job_name"), 1, 3).alias("sigla"), "data_center", "sched_table", "job_name", "memname"))
    urgent = E.def_job.filter(F.col("job_id") % 10 == 3).select(F.trim("job_name").alias("jobname"))
    code = F.substring(F.trim("job_name"), 1, 3)
    lookup = E.def_job.filter(F.col("job_id") % 2 == 0).select(code.alias("siglaSH"), F.concat(F.lit("F-"), code).alias("siglaFULL"))
    return build_catalogue(E.def_job, E.def_table, AS_OF_DATES, "Producao-open", mainframe=mf, code_lookup=lookup,
                           fanout=service_fanout(E.bim), service_names=E.bim.select("jobname", "service_name"),
                           very_urgent=urgent, site_rules=SITE_RULES, code_centres=("MP-A",))
