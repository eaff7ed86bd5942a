"""Queries for sources that can run on the given tables (S5 multi-source extract, A4 over it).

File-based readers (S1–S4) and writers (S7–S11) are exercised by unit tests
on files written to a scratch folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from jobscope.operators.aggregates import service_fanout
from jobscope.plans.registry import register
from jobscope.sources.fixtures import Estate
from jobscope.sources.reports import extract_table


@register("s5_extract_tagged_sources", sql="""
SELECT table_id, job_id, job_name, 'SRV_A' AS source FROM fx_def_job WHERE is_current_version = 'Y'
UNION ALL SELECT table_id, job_id, job_name, 'SRV_B' AS source FROM fx_jobs_cur""", views=("fx_def_job", "fx_jobs_cur"))
def q_extract(spark, sf):
    E = Estate(spark, sf)
    cols = ["table_id", "job_id", "job_name"]
    return extract_table(spark, {"SRV_A": E.def_job.filter(F.col("is_current_version") == "Y"),
                                 "SRV_B": E.jobs_cur}, columns=cols)


@register("pl6_service_summary", sql="""
WITH fan AS (SELECT data_center, jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'DS') GROUP BY ALL
  UNION ALL SELECT data_center, memname AS jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'WS') GROUP BY ALL),
le AS (SELECT job_name, max(end_time) AS last_end FROM fx_exec GROUP BY job_name),
cy AS (SELECT trim(job_name) AS job_name, max(cyclic) AS cyclic FROM fx_def_job GROUP BY 1)
SELECT f.data_center, f.jobname, f.qlobis, CASE WHEN starts_with(f.data_center, 'DS') THEN le.last_end END AS last_end, cy.cyclic FROM fan f LEFT JOIN le ON f.jobname = le.job_name
LEFT JOIN cy ON f.jobname = cy.job_name""", views=("fx_bim", "fx_exec", "fx_def_job"))
def q_service_summary(spark, sf):
    from jobscope.plans.services import service_summary

    E = Estate(spark, sf)
    return service_summary(E.bim, E.runs, E.def_job)


@register("pl13_m4_criticality_check", sql="""
WITH fan AS (SELECT data_center, jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'DS') GROUP BY ALL
  UNION ALL SELECT data_center, memname AS jobname, count(DISTINCT service_name) AS qlobis FROM fx_bim WHERE starts_with(data_center, 'WS') GROUP BY ALL)
SELECT f.data_center, f.jobname, j.group_name, f.qlobis FROM fan f JOIN fx_def_job j ON f.jobname = j.job_name
WHERE f.qlobis > 0 AND starts_with(f.data_center, 'DS-') AND substring(j.group_name, 1, 1) <> 'A' ORDER BY f.qlobis DESC""",
          views=("fx_bim", "fx_def_job"))
def q_crit(spark, sf):
    from jobscope.plans.catalogue import criticality_check

    E = Estate(spark, sf)
    return criticality_check(service_fanout(E.bim), E.def_job)
