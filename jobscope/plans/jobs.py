"""Named batch jobs of the estate, each one lazy Spark plan.

Each function takes DataFrames (or paths for landed files) and returns the
frames the job would write; writing is left to the caller (``sources.sinks``),
so the same plan runs in tests and in production. Only the execution load (PL3)
writes a table of its own, which its steps share. Catalogue (PL5), criticality
check (PL13) and service summary (PL6) live in ``catalogue`` and ``services``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobscope.functions import text as T
from jobscope.functions import timefmt as TF
from jobscope.operators import aggregates as A
from jobscope.operators import reconcile as RC
from jobscope.operators import relational as R
from jobscope.operators import tuning as TU
from jobscope.operators.seasonality import seasonality
from jobscope.plans.expression_queries import EXEC_REPORT_SCHEMA, WHEN_PHRASES
from jobscope.sources import sinks as S
from jobscope.sources.reports import read_report
from jobscope.sources.scratch import keep

ALERT_FIELDS = ["serial", "alert_key", "node", "node_alias", "agent", "alert_group", "x7", "application", "manager",
                "server", "severity", "summary", "first_occurrence", "last_occurrence", "internal_last", "poll",
                "tally", "expire_time", "owner_uid"]
ALERT_TIME_FIELDS = ("first_occurrence", "last_occurrence", "internal_last")


def alert_load(spark: SparkSession, path, current: DataFrame | None = None) -> DataFrame:
    """PL1 on landed alert report files; see ``load_alerts``."""
    return load_alerts(spark.read.text(path), current)


def load_alerts(lines: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """PL1: quoted 19-field alert lines (column ``value``) -> blanks to NULL (F4), times parsed
    (F5), upserted on the serial, the last occurrence winning (S9)."""
    schema = ", ".join(f"{c} STRING" for c in ALERT_FIELDS)
    raw = lines.where(F.trim("value") != "").select(F.from_csv("value", schema, {"quote": '"'}).alias("r"))
    typed = raw.select("r.*").select(*[
        (TF.parse_ts(T.blank_to_null(T.strip_quotes(c)), TF.ALERT_TS) if c in ALERT_TIME_FIELDS
         else T.blank_to_null(T.strip_quotes(c))).alias(c) for c in ALERT_FIELDS])
    return R.upsert(current, typed, ["serial"], "last_occurrence")


def execution_load(spark: SparkSession, paths, as_of, current: DataFrame | None = None,
                   purge_days: int = 30) -> dict[str, DataFrame]:
    """PL3 on landed execution reports (S3, header per file); see ``load_executions``."""
    lines = spark.read.text(paths).filter(~F.col("value").startswith("DATA_CENTER"))
    return load_executions(lines, as_of, current, purge_days)


def load_executions(lines: DataFrame, as_of, current: DataFrame | None = None, purge_days: int = 30) -> dict[str, DataFrame]:
    """PL3: report lines (column ``value``) -> F2 + quoted CSV -> typed rows
    (F3, F5, F7) -> upsert on (centre, order, job, attempt), the last end winning (S9).

    ``executions`` is the full table with the repair time written back (J5) and
    ``latest`` its latest run per job (J6), end date and time apart; ``open`` is the recent
    table without ``MP%`` and ``CREATED`` rows (P9), purged after ``purge_days`` (M1).

    The loaded table is written once and every later step reads it: a lazy one would be parsed and
    reduced again by each of them, in other plans (filters moved below the parse), so no shuffle is shared.
    """
    rec = lines.select(F.from_csv(T.drop_comma_in_date("value"), EXEC_REPORT_SCHEMA, {"quote": '"'}).alias("r"))
    start, end = TF.parse_report_ts(F.trim("r.c8")), TF.parse_report_ts(F.trim("r.c9"))
    typed = rec.select(
        *[F.trim(f"r.c{i}").alias(n) for i, n in [(1, "data_center"), (2, "sched_table"), (3, "application"),
                                                  (4, "group_name"), (5, "node_id"), (6, "job_name")]],
        TF.parse_date(T.drop_commas(F.trim("r.c7")), TF.REPORT_DATE).alias("odate"),
        start.alias("start_time"), end.alias("end_time"), F.trim("r.c10").try_cast("int").alias("rerun_counter"),
        F.trim("r.c11").alias("completion_status"), F.trim("r.c12").alias("average_cpu_time"),
        F.trim("r.c13").alias("order_id"), TF.duration_s(end, start).alias("runtime_s"))
    keys = ["data_center", "order_id", "job_name", "rerun_counter"]
    table = keep(R.upsert(current.drop("mttr_s") if current is not None else None, typed, keys, "end_time"), "executions")
    recent = R.keep_unless(table, F.col("data_center").startswith("MP") | (F.col("sched_table") == "CREATED"))
    mttr = R.mttr(table, as_of, 10)
    latest = R.latest_execution(table).select("data_center", "job_name", "end_time",
                                              F.to_date("end_time").alias("end_date"),
                                              F.date_format("end_time", "HH:mm:ss").alias("end_clock"))
    return {"executions": table.join(mttr.select(*keys, "mttr_s"), keys, "left"),
            "open": R.purge(recent, "end_time", purge_days, as_of), "mttr": mttr, "latest": latest}


def notification_load(spark: SparkSession, path) -> DataFrame:
    """PL3 (last step): ``;`` notification report with the condition phrases recoded."""
    cols = ["server_name", "folder_name", "job_name", "when", "notification_time", "urgency", "message"]
    df = read_report(spark, path, cols, sep=";")
    return df.withColumn("when", T.recode("when", WHEN_PHRASES))


def snapshot_job(cur: DataFrame, prev: DataFrame, catalogue_centres: DataFrame, as_of_date,
                 limit: int = 5000) -> dict[str, DataFrame]:
    """PL2: diff (U4) -> history rows and app summary (A3) over all of it; only the change list
    that is handed on is emptied above ``limit`` (M3). The caller appends the
    history (S8) and rotates today's snapshot into D1 (M2)."""
    diff = R.snapshot_diff(cur, prev, "job_name")
    sig = diff.join(catalogue_centres, "table_id").select("data_center", T.app_code("job_name", "M").alias("sigla"))
    return {"changes": R.volume_guard(diff, limit), "history": diff, "summary": A.app_delta_summary(sig, as_of_date)}


def change_file_load(spark: SparkSession, path, history: DataFrame | None, as_of, days: int = 730,
                     schema: str = "data_operacao string, item string") -> DataFrame:
    """PL7: ``;`` change file with header appended (S8) and purged to two years (M1)."""
    df = spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)
    df = df.withColumn("data_operacao", F.to_date(F.try_to_timestamp("data_operacao", F.lit("yyyy-MM-dd"))))
    hist = df if history is None else history.unionByName(df, allowMissingColumns=True)
    return R.purge(hist, "data_operacao", days, as_of)


def service_lob_load(spark: SparkSession, path, lob_lookup: DataFrame) -> DataFrame:
    """PL8: drop header-like lines (P8), strip quotes (F1), 3 fields -> name, lob
    (F16 concat), app code (F11); enrich with the lookup's job (J2)."""
    lines = spark.read.text(path).filter(~F.col("value").contains("SERVICE"))
    parts = F.split(T.strip_quotes("value"), ",")
    df = lines.select(F.get(parts, 0).alias("service_name"),
                      F.concat(F.get(parts, 1), F.get(parts, 2)).alias("service_lob"),
                      T.last3(F.get(parts, 0)).alias("sigla"))
    look = lob_lookup.select(F.col("lob").alias("__lob"), F.col("jobname").alias("rotina_bim"))
    return df.join(look, df.service_lob == look["__lob"], "left").drop("__lob")


def status_volume(executions: DataFrame, day: str, open_prefix: str = "M", open_excluded=(),
                  mainframe_excluded=()) -> DataFrame:
    """PL9: daily status volume of the open centres (prefix ``open_prefix``) and the mainframe ones
    (``MP``), each row once: the second statement replaces rows of the first with the
    same key. The mainframe platform is a number there: 1 for the centre ``MP`` itself, else 2."""
    open_ = A.daily_volume(executions, day, "M", centre_prefix=open_prefix, exclude_centres=open_excluded)
    mp = A.daily_volume(executions, day, "P", centre_prefix="MP", exclude_centres=mainframe_excluded)
    mp = mp.withColumn("ambiente", F.when(F.col("data_center") == "MP", "1").otherwise("2"))
    return R.upsert(open_, mp, ["data", "ambiente", "data_center", "sigla", "status"], "volume")


def platform_volume_job(executions: DataFrame, history: DataFrame | None, as_of) -> DataFrame:
    """PL10: two-day platform volume appended to history (S8), purged to one year (M1)."""
    vol = A.platform_volume(executions, as_of, 2)
    hist = vol if history is None else history.unionByName(vol)
    return R.purge(hist, "data", 365, as_of)


def definitions_mirror(sources: dict, columns=None) -> DataFrame:
    """PL12: current-version definitions (P6) from several servers, tagged (S5),
    rendered as ``#;`` lines (S6). Write per centre with ``sinks.replace_partition``."""
    from jobscope.sources.reports import extract_table

    parts = {k: v.filter(F.col("is_current_version") == "Y") for k, v in sources.items()}
    df = extract_table(next(iter(parts.values())).sparkSession, parts, columns=columns)
    return df.withColumn("line", S.export_delimited(df.drop("source"), "#;"))


def threshold_tuning(report, definitions, def_job, def_table, stat, executions, as_of,
                     centre_prefix: str = "PRD", report_cond: str | None = "EXECTIME",
                     alarms: DataFrame | None = None, yesterday: DataFrame | None = None) -> dict[str, DataFrame]:
    """PL4: rule sets (card E) -> final summary -> impact (F8, J8) ->
    model sample (J4, F22) -> seasonality (W3)."""
    cands = TU.report_rules(report, stat, cond=report_cond).unionByName(
        TU.definition_rules(definitions, def_job, def_table, stat, centre_prefix=centre_prefix))
    counts = A.alert_count(alarms, as_of, 30, centre_prefix=centre_prefix) if alarms is not None else None
    summary = TU.finalize_summary(cands, executions, counts, yesterday)
    # After keep_first the (server, folder, job, notification) key is unique: it
    # is the row id the impact count groups by (no global numbering needed).
    summary = summary.withColumn("id", F.struct("server_name", "folder_name", "job_name", "notification_time"))
    return {"summary": summary, "impact": TU.threshold_impact(summary, executions),
            "model": TU.model_executions(executions, summary, as_of, jitter=True),
            "seasonality": seasonality(executions)}


def close_reopen(alerts, late, active, failed, messages, as_of) -> dict[str, DataFrame]:
    """PL14: keep/close decisions (J9), reopen list (J10), outcome split (J18), log."""
    decisions = RC.classify_alerts_to_keep(alerts, late, active)
    to_close = decisions.filter(~F.col("flag")).select("alert_id")
    outcome = RC.split_success(to_close, messages)
    log = S.audit_log(outcome.select("alert_id", F.when(F.col("outcome") == "ok", "OK").otherwise("NOK")
                                     .alias("status"), F.lit(None).cast("string").alias("old_value")),
                      1, as_of, new_value="Closed")
    return {"decisions": decisions, "reopen": RC.alerts_to_reopen(alerts, failed), "log": log}


def gaps_to_events(failed_jobs, alerts, incidents, audit_events, all_jobs, as_of,
                   limit: int | None = None, failures: DataFrame | None = None) -> dict[str, DataFrame]:
    """PL15: jobs without alert (J11) minus already reported (J13) + alerts without
    incident in any search (J12) -> merged (J14) -> event payloads (S12) and the log of their outcomes (S13).
    With ``limit`` the job fails above it (M3); it never returns part of the gaps. ``failures``
    (job_name, run_id, error_message) names the events that could not be posted."""
    jg = RC.drop_already_reported(RC.jobs_without_alert(failed_jobs, alerts), audit_events, incidents)
    ag = RC.alerts_never_matched(alerts, incidents, as_of)
    gaps = RC.merge_gaps(jg, ag, all_jobs)
    if limit is not None:
        gaps = R.require_volume(gaps, limit)
    return {"gaps": gaps, "events": S.event_payload(gaps), "log": S.gap_log(gaps, as_of, failures, incidents)}


# Ids of the clean-up automations in the log.
CLEANUP_ID, HELD_CLEANUP_ID = 4, 6


def _cleanup_log(candidates, job_status, as_of, failures) -> DataFrame:
    """Log rows of incidents with a clean-up decision: a job that is gone, no longer failed or at another run counts
    as done; only a deletion that was tried can have failed (``failures``: number, error_message)."""
    done = RC.cleanup_decision(candidates.withColumn("alert_id", T.digits_or_zero("u_alert_id")), job_status, also=["alert_id"])
    error = F.lit(None).cast("string")
    if failures is not None:
        bad = failures.groupBy(F.col("number").alias("__bad")).agg(F.coalesce(F.max("error_message"), F.lit("Erro desconhecido")).alias("__error"))
        done = done.join(bad, done.number == bad["__bad"], "left")
        error = F.when(F.col("decision").isin("DELETE", "HOLD_THEN_DELETE"), F.col("__error"))
    done = done.withColumn("error", error).withColumn("status", F.when(F.col("error").isNull(), "OK").otherwise("NOK"))
    return S.job_log(done, CLEANUP_ID, as_of, alert_col="alert_id", error_col="error")


def stale_cleanup(incidents, job_status, held, edges, as_of, server: str = "DS", failures: DataFrame | None = None) -> dict[str, DataFrame]:
    """PL16: single-incident decisions (J16), families (J15), isolated held jobs (J17), and the
    logs (S13) of the families, of the single incidents and of the jobs held for 15 days, each with its
    "nothing found" row. ``failures`` (number, error_message) names deletions that did not succeed."""
    members = RC.family_members(incidents, as_of, server)
    single = RC.cleanup_candidates(incidents, as_of, server)
    isolated = RC.held_outcomes(held, edges, as_of)
    return {"decisions": RC.cleanup_decision(single, job_status),
            "families": RC.incident_families(incidents, as_of, server), "family_decisions": RC.cleanup_decision(members, job_status),
            "log": _cleanup_log(members, job_status, as_of, failures), "single_log": _cleanup_log(single, job_status, as_of, failures),
            "isolated_held": isolated.filter(F.col("status") == "OK"),
            "held_log": S.job_log(isolated.withColumn("none", F.lit(None).cast("string")), HELD_CLEANUP_ID, as_of, incident_col="none", error_col="error")}
