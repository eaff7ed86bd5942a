"""Job catalogue and criticality check (PL13, M4).

job x folder on trimmed id, centres not ``MP%``, DISTINCT, app code (F10),
criticality (F13), first char of the node; the mainframe file is upserted on
top (fixed ``Producao`` / ``Z``); ordered corrections (M5) incl. deletes of
``P1`` / ``X%``; service count then service name overwrite the same column
(the second wins where present); criticality words normalised (F14); jobs in
a named list become ``Very Urgent``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.functions import text as T
from jobscope.operators.relational import Rule, apply_rules, update_from, upsert

# ---------------------------------------------------------------------------
# Ordered corrections that hold at every site. Corrections by
# centre, job or host name, and the list of urgent jobs, are the caller's.
# ---------------------------------------------------------------------------
CATALOGUE_RULES = [
    Rule("sigla LIKE 'ws%'", "sigla", value_sql="replace(sigla, 's', 'S')"),
    Rule("sigla LIKE 'Ws%'", "sigla", value_sql="replace(sigla, 'w', 'W')"),
    Rule("sigla = 'P1' OR sigla LIKE 'X%'", delete=True),
]
MAINFRAME_ENV, MAINFRAME_NODE_GROUP = "Producao", "Z"


def job_catalogue(def_job: DataFrame, def_table: DataFrame, letter: str = "M") -> DataFrame:
    """Distinct catalogue rows from job and folder definitions (centres not ``MP%``)."""
    t = def_table.filter(~F.col("data_center").startswith("MP"))
    j = def_job.join(t, F.trim(def_job.table_id.cast("string")) == F.trim(t.table_id.cast("string")), "inner")
    return j.select(T.app_code(def_job.job_name, letter).alias("sigla"), F.trim(t.data_center).alias("data_center"),
                    F.trim(t.sched_table).alias("sched_table"), F.trim(def_job.job_name).alias("job_name"),
                    F.trim(def_job.memname).alias("memname"), T.criticality(def_job.group_name).alias("criticality"),
                    F.substring(def_job.node_id, 1, 1).alias("node_group")).distinct()


def build_catalogue(def_job: DataFrame, def_table: DataFrame, as_of_date, environment: str,
                    mainframe: DataFrame | None = None, code_lookup: DataFrame | None = None,
                    fanout: DataFrame | None = None, service_names: DataFrame | None = None,
                    very_urgent: DataFrame | None = None, site_rules=(), code_centres=()) -> DataFrame:
    """PL5: the whole catalogue job as one lazy plan.

    ``site_rules`` run before ``CATALOGUE_RULES``; ``code_lookup`` (siglaSH -> siglaFULL)
    is applied in the centres ``code_centres``; ``very_urgent`` lists job names.
    """
    d = F.lit(as_of_date).cast("date")
    cat = job_catalogue(def_job, def_table).withColumn("date_load", d).withColumn("ambiente", F.lit(environment)) \
        .withColumn("lob_bim", F.lit(None).cast("string"))
    if mainframe is not None:
        mf = mainframe.select(*[F.trim(c).alias(c) for c in ["sigla", "data_center", "sched_table", "job_name", "memname"]],
                              F.lit(None).cast("string").alias("criticality"), F.lit(MAINFRAME_NODE_GROUP).alias("node_group"),
                              d.alias("date_load"), F.lit(MAINFRAME_ENV).alias("ambiente"),
                              F.lit(None).cast("string").alias("lob_bim"))
        cat = upsert(cat, mf, ["data_center", "sched_table", "job_name"], "memname")
    if code_lookup is not None and code_centres:
        in_centre = F.coalesce(F.col("data_center").isin(*code_centres), F.lit(False))
        fixed = update_from(cat.filter(in_centre), code_lookup, {"sigla": "siglaSH"}, {"sigla": "siglaFULL"})
        cat = cat.filter(~in_centre).unionByName(fixed)
    cat = apply_rules(cat, list(site_rules) + CATALOGUE_RULES)
    if fanout is not None:
        # largest count per job, as text (the column also receives service names)
        fan = fanout.groupBy("jobname").agg(F.max("qlobis").cast("string").alias("qlobis"))
        cat = update_from(cat, fan, {"job_name": "jobname"}, {"lob_bim": "qlobis"})
    if service_names is not None:
        cat = update_from(cat, service_names, {"job_name": "jobname"}, {"lob_bim": "service_name"})
    cat = cat.withColumn("criticality", T.normalise_criticality("criticality"))
    if very_urgent is not None:
        hit = very_urgent.select(F.col("jobname").alias("__vu")).distinct().withColumn("__hit", F.lit(True))
        cat = cat.join(hit, cat.job_name == hit["__vu"], "left").withColumn(
            "criticality", F.when(F.col("__hit"), F.lit("Very Urgent")).otherwise(F.col("criticality"))
        ).drop("__vu", "__hit")
    return cat


def criticality_check(fanout: DataFrame, def_job: DataFrame) -> DataFrame:
    """PL13/M4 query: jobs feeding services on ``DS-`` centres whose group is not ``A``."""
    j = fanout.join(def_job, fanout.jobname == def_job.job_name, "inner")
    return (j.filter((F.col("qlobis") > 0) & F.col("data_center").startswith("DS-")
                     & (F.substring(def_job.group_name, 1, 1) != "A"))
            .select("data_center", "jobname", def_job.group_name, "qlobis").orderBy(F.col("qlobis").desc()))
