"""Alert / job / incident reconciliation.

The reference runs these as per-row loops with a remote lookup per row
(quadratic ``x in df[col].values`` scans, one HTTP query per alert). Here each
rule is a join, and every existence test with a range condition is reduced to
an aggregate per equality key first (``max(created_on)`` per key), so no key
pairs up its rows with another table's rows: a busy data centre or order id
cannot turn into a nested loop in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.functions.text import incident_in_notes, json_field
from jobscope.operators.ordering import keep_first

# ---------------------------------------------------------------------------
# Fixed values of the reconciliation rules.
# incident origin: created_by 'system', source 'scheduler', category 'monitoring'
# audit event: metric 'Auditoria - Cancelamento de Rotina', source 'event-hub'
# job states: 'Executing', 'Ended Not OK'; cyclic flag 'Yes'
# open incident states 1, 2, 3; closed states 6, 7, 8
# excluded host anywhere in additional info: '%host-x%'
# family parent description prefix: 'Cancelamento'
# ---------------------------------------------------------------------------
INC_CREATED_BY, INC_SOURCE, INC_CATEGORY = "system", "scheduler", "monitoring"
AUDIT_METRIC, AUDIT_SOURCE = "Auditoria - Cancelamento de Rotina", "event-hub"
EXECUTING, ENDED_NOT_OK = "Executing", "Ended Not OK"
OPEN_STATES = (1, 2, 3)
CLOSED_STATES = (6, 7, 8)
EXCLUDED_HOST_LIKE = "%host-x%"
FAMILY_PREFIX = "Cancelamento"


def _system_incidents(incidents: DataFrame) -> DataFrame:
    return incidents.filter((F.col("sys_created_by") == INC_CREATED_BY) & (F.col("u_source") == INC_SOURCE)
                            & (F.col("category") == INC_CATEGORY))


def _hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(F.lit(0), F.lit(hours)) if hours else ts


# --------------------------------------------------------------------------- card A, J9

def classify_alerts_to_keep(alerts: DataFrame, late: DataFrame, active: DataFrame,
                            order_col: str = "start_time") -> DataFrame:
    """J9 (card A): every alert of both lists with ``flag`` (keep open) and ``reason``.

    Main list, per alert, looking at active jobs with the same run id:
    none -> not flagged; none on the alert's server -> ``SERVER_MISMATCH``;
    first such row not executing, with a start time, and message 'ended not ok'
    -> ``FAILED_STILL_ACTIVE``; cyclic -> ``CYCLIC_OLD_RUN`` when the alert's
    counter is below the job's number of runs, else not flagged; otherwise
    ``OTHER``. Late list: flagged ``LATE_ACTIVE`` when the run id is active at all.
    ``order_col`` fixes "first row" (report order does not exist in Spark).
    """
    runs = active.select("run_id").distinct().withColumn("__run_active", F.lit(True))
    first = keep_first(active.select("run_id", "server_name", order_col, "job_status", "cyclic", "number_of_runs",
                                     *([] if order_col == "start_time" else ["start_time"])),
                       ["run_id", "server_name"], [order_col])
    first = first.select(F.col("run_id").alias("f_run_id"), F.col("server_name").alias("f_server"),
                         F.col("job_status"), F.col("cyclic"), F.col("number_of_runs"), F.col("start_time").alias("job_start"))
    a = alerts.select("alert_id", "run_id", "server_name", "message", "run_counter")
    m = (a.join(runs, "run_id", "left")
         .join(first, (F.col("run_id") == F.col("f_run_id")) & (F.col("server_name") == F.col("f_server")), "left"))
    not_exec = ~F.coalesce(F.col("job_status") == EXECUTING, F.lit(False))
    reason = (F.when(F.col("__run_active").isNull(), F.lit(None))
              .when(F.col("f_run_id").isNull(), F.lit("SERVER_MISMATCH"))
              .when(not_exec & F.col("job_start").isNotNull() & (F.lower("message") == "ended not ok"),
                    F.lit("FAILED_STILL_ACTIVE"))
              .when(F.col("cyclic") == "Yes",
                    F.when(F.col("run_counter") < F.col("number_of_runs"), F.lit("CYCLIC_OLD_RUN")))
              .otherwise(F.lit("OTHER")))
    main = m.select(F.lit("main").alias("list"), "alert_id", reason.alias("reason"))
    lt = late.select("alert_id", "run_id").join(runs, "run_id", "left").select(
        F.lit("late").alias("list"), "alert_id",
        F.when(F.col("__run_active"), F.lit("LATE_ACTIVE")).alias("reason"))
    out = main.unionByName(lt)
    return out.withColumn("flag", F.col("reason").isNotNull())


# --------------------------------------------------------------------------- J10

def alerts_to_reopen(alerts: DataFrame, failed: DataFrame, order_col: str = "start_time") -> DataFrame:
    """Alerts whose run id and server match a failed job whose first matching
    row has ``number_of_runs`` equal to the alert's counter."""
    first = keep_first(failed.select("run_id", "server_name", order_col, "number_of_runs"),
                       ["run_id", "server_name"], [order_col])
    j = alerts.join(first.select("run_id", "server_name", "number_of_runs"), ["run_id", "server_name"], "inner")
    return j.filter(F.col("number_of_runs") == F.col("run_counter")).select(*alerts.columns)


# --------------------------------------------------------------------------- J11

def jobs_without_alert(jobs: DataFrame, alerts: DataFrame) -> DataFrame:
    """Failed jobs with no alert on (server, run id, job, run number)."""
    a = alerts.select(F.col("server_name").alias("a_server"), F.col("run_id").alias("a_run"),
                      F.col("job_name").alias("a_job"), F.col("run_counter").alias("a_counter"))
    cond = ((jobs.server_name == a.a_server) & (jobs.run_id == a.a_run) & (jobs.job_name == a.a_job)
            & (jobs.number_of_runs == a.a_counter))
    return jobs.join(a, cond, "left_anti")


# --------------------------------------------------------------------------- card B, J12

def alerts_without_incident(alerts: DataFrame, incidents: DataFrame, as_of, lookback_hours: int = 2,
                            max_age_days: int = 2, match_number: bool = True) -> DataFrame:
    """J12 (card B): recent alerts with no matching incident, ``error = 'Not Found'``.

    Alerts older than ``max_age_days`` (by calendar day) are skipped. A match is
    a system incident on the same centre and order, whose alert id *starts
    with* the alert's id, created at or after ``alert_time - lookback_hours``,
    and whose number equals the ``INC...`` text of the notes when present
    (``match_number=False``: the later searches, which do not test the number).

    The starts-with test is made an equality: each prefix of an incident's alert
    id whose length occurs among the alert ids is emitted once, so the join key becomes
    (centre, order, prefix[, number]) and the time test becomes ``max(created_on)``
    per key >= alert time. No alert is compared with a list of incidents.
    """
    as_of_ts = F.lit(as_of).cast("timestamp")
    recent = alerts.filter(F.to_date("alert_time") >= F.date_sub(F.to_date(as_of_ts), max_age_days))
    a = recent.withColumn("__inc", incident_in_notes("notes")).withColumn(
        "__since", _hours_before(F.col("alert_time"), lookback_hours))
    # A prefix can only equal an alert id of the same length: emit only the
    # lengths that occur among the alert ids (one scalar subquery, placed once).
    lens = recent.select(F.struct(F.min(F.length(F.col("alert_id").cast("string"))).alias("lo"),
                                  F.max(F.length(F.col("alert_id").cast("string"))).alias("hi"))).scalar()
    inc = _system_incidents(incidents).withColumn("__len", lens).select(
        "u_datacenter", "u_orderid", "number", "sys_created_on",
        # (sequence() counts down when start > stop: guard so short ids emit nothing)
        F.explode(F.expr("CASE WHEN __len.lo <= least(length(u_alert_id), __len.hi) THEN "
                         "transform(sequence(__len.lo, least(length(u_alert_id), __len.hi)), "
                         "i -> substring(u_alert_id, 1, i)) END")).alias("prefix"))
    by_key = inc.groupBy("u_datacenter", "u_orderid", "prefix").agg(F.max("sys_created_on").alias("__last_any"))
    by_num = inc.groupBy("u_datacenter", "u_orderid", "prefix", "number").agg(
        F.max("sys_created_on").alias("__last_num"))
    aid = F.col("alert_id").cast("string")
    j = (a.join(by_key, (F.col("server_name") == by_key.u_datacenter) & (F.col("run_id") == by_key.u_orderid)
                & (aid == by_key.prefix), "left")
         .drop("u_datacenter", "u_orderid", "prefix"))
    j = (j.join(by_num, (F.col("server_name") == by_num.u_datacenter) & (F.col("run_id") == by_num.u_orderid)
                & (aid == by_num.prefix) & (F.col("__inc") == by_num.number), "left")
         .drop("u_datacenter", "u_orderid", "prefix", "number"))
    last = F.when(F.lit(not match_number) | F.col("__inc").isNull(), F.col("__last_any")).otherwise(F.col("__last_num"))
    found = F.coalesce(last >= F.col("__since"), F.lit(False))
    return j.filter(~found).select(*alerts.columns, F.lit("Not Found").alias("error"))


def alerts_never_matched(alerts: DataFrame, incidents: DataFrame, as_of, lookback_hours: int = 2,
                         max_age_days: int = 2) -> DataFrame:
    """J12, all searches: what the first one misses is searched again among incidents
    created at or after the alert, whatever their number; only alerts that both miss stay."""
    first = alerts_without_incident(alerts, incidents, as_of, lookback_hours, max_age_days).drop("error")
    return alerts_without_incident(first, incidents, as_of, 0, max_age_days, match_number=False)


# --------------------------------------------------------------------------- card H, J13

def drop_already_reported(jobs: DataFrame, events: DataFrame | None, incidents: DataFrame | None,
                          lookback_hours: int = 2, resource_cols: Sequence[str] = ("server_name", "number_of_runs")
                          ) -> DataFrame:
    """J13 (card H): remove failed jobs already reported; removal is by job *name*.

    Pass 1: an audit event (metric/source fixed) with resource
    ``'-'.join(resource_cols)``, same order id (message key) and node = job name.
    Pass 2 (on what is left): a system incident on the same centre and order,
    created at or after ``end_time - lookback_hours``. Each pass drops every
    remaining job with a hit's name, so the names to drop are those with a hit of either
    pass: both are looked up side by side from the jobs' keys, and one anti-join removes them.
    """
    if events is None and incidents is None:
        return jobs
    res = F.concat_ws("-", *[F.col(c).cast("string") for c in resource_cols])
    keys = jobs.select("job_name", "server_name", "run_id", "end_time", res.alias("__res"))
    hit = F.lit(False)
    if events is not None:
        ev = events.filter((F.col("metric_name") == AUDIT_METRIC) & (F.col("u_source") == AUDIT_SOURCE)).select(
            F.col("resource").alias("__e_res"), F.col("message_key").alias("__e_key"), F.col("node").alias("__e_node")).distinct()
        keys = keys.join(ev, (F.col("__res") == F.col("__e_res")) & (F.col("run_id") == F.col("__e_key"))
                         & (F.col("job_name") == F.col("__e_node")), "left")
        hit = hit | F.col("__e_key").isNotNull()
    if incidents is not None:
        last = _system_incidents(incidents).groupBy(F.col("u_datacenter").alias("__i_dc"), F.col("u_orderid").alias("__i_order")).agg(
            F.max("sys_created_on").alias("__last"))
        keys = keys.join(last, (F.col("server_name") == F.col("__i_dc")) & (F.col("run_id") == F.col("__i_order")), "left")
        hit = hit | F.coalesce(F.col("__last") >= _hours_before(F.col("end_time"), lookback_hours), F.lit(False))
    hits = keys.filter(hit).select("job_name").distinct()
    return jobs.join(hits, "job_name", "left_anti")


# --------------------------------------------------------------------------- J14

GAP_COLUMNS = ["job_name", "server_name", "run_id", "run_time", "start_time", "end_time", "rerun_counter"]


def merge_gaps(jobs_gap: DataFrame, alerts_gap: DataFrame, all_jobs: DataFrame,
               order_col: str = "start_time") -> DataFrame:
    """One 7-column list of jobs without alert and alerts without incident.

    Alerts take start/end from the first job with the same name, else the alert time.
    """
    j = jobs_gap.select("job_name", "server_name", "run_id", F.col("start_time").alias("run_time"), "start_time",
                        "end_time", F.col("number_of_runs").alias("rerun_counter"))
    first = keep_first(all_jobs.select("job_name", order_col, *([] if order_col == "start_time" else ["start_time"]),
                                       "end_time"), ["job_name"], [order_col])
    first = first.select(F.col("job_name").alias("f_job"), F.col("start_time").alias("f_start"),
                         F.col("end_time").alias("f_end"))
    a = alerts_gap.join(first, alerts_gap.job_name == first.f_job, "left").select(
        "job_name", "server_name", "run_id", F.col("alert_time").alias("run_time"),
        F.when(F.col("f_job").isNotNull(), F.col("f_start")).otherwise(F.col("alert_time")).alias("start_time"),
        F.when(F.col("f_job").isNotNull(), F.col("f_end")).otherwise(F.col("alert_time")).alias("end_time"),
        F.col("run_counter").alias("rerun_counter"))
    return j.unionByName(a).select(*GAP_COLUMNS)


# --------------------------------------------------------------------------- J15

def with_child_counts(incidents: DataFrame) -> DataFrame:
    """Add ``child_incidents`` = number of incidents naming this one as parent."""
    kids = incidents.filter(F.col("parent_incident").isNotNull()).groupBy(
        F.col("parent_incident").alias("__p")).agg(F.count(F.lit(1)).alias("child_incidents"))
    j = incidents.join(kids, incidents.number == kids["__p"], "left")
    return j.select(*incidents.columns, F.coalesce(F.col("child_incidents"), F.lit(0)).cast("long")
                    .alias("child_incidents"))


def incident_families(incidents: DataFrame, as_of, server: str = "DS", days: int | None = None,
                      child_days: int = 10, description_prefix: str | None = FAMILY_PREFIX) -> DataFrame:
    """Parent incidents (children > 0, still open, older than the cut-off)
    paired with their children that are older than ``child_days``.

    The cut-off is 10 days for ``DS`` centres and 15 otherwise unless ``days`` is given;
    children must be older than both cut-offs. Who created the incidents is not tested.
    ``description_prefix=None`` skips the description test (tables without one).
    """
    days = days if days is not None else (10 if server == "DS" else 15)
    as_of_ts = F.lit(as_of).cast("timestamp")
    inc = with_child_counts(incidents) if "child_incidents" not in incidents.columns else incidents
    older = as_of_ts - F.make_dt_interval(F.lit(max(days, child_days)))
    parents = inc.filter((F.col("u_source") == INC_SOURCE) & (F.col("category") == INC_CATEGORY)
                         & (F.col("child_incidents") > 0) & ~F.col("state").isin(*CLOSED_STATES)
                         & F.col("u_datacenter").startswith(server) & F.col("u_orderid").isNotNull()
                         & (F.col("u_orderid") != "")
                         & (F.col("sys_created_on") < older)
                         & ~F.coalesce(F.col("u_additional_info").like(EXCLUDED_HOST_LIKE), F.lit(False)))
    if description_prefix is not None and "description" in inc.columns:
        parents = parents.filter(F.col("description").startswith(description_prefix))
    children = incidents.filter(F.col("sys_created_on") < older)
    p = parents.select(F.col("number").alias("parent_number"), F.col("u_datacenter").alias("parent_datacenter"),
                       F.col("child_incidents"))
    c = children.select(F.col("number").alias("child_number"), F.col("parent_incident"),
                        F.col("u_datacenter").alias("child_datacenter"), F.col("u_orderid").alias("child_orderid"),
                        F.col("u_run_number").alias("child_run_number"),
                        json_field("u_additional_info", "$.JOBNAME_ADDINFO").alias("child_job_name"))
    return p.join(c, p.parent_number == c.parent_incident, "inner").drop("parent_incident")


# --------------------------------------------------------------------------- card C, J16

def cleanup_candidates(incidents: DataFrame, as_of, server: str = "DS", days: int | None = None,
                       second_days: int = 10) -> DataFrame:
    """Card C candidates: single open system incidents older than the cut-offs."""
    days = days if days is not None else (10 if server == "DS" else 15)
    as_of_ts = F.lit(as_of).cast("timestamp")
    inc = with_child_counts(incidents) if "child_incidents" not in incidents.columns else incidents
    older = as_of_ts - F.make_dt_interval(F.lit(max(days, second_days)))
    return (inc.filter((F.col("u_source") == INC_SOURCE) & (F.col("category") == INC_CATEGORY)
                       & F.col("parent_incident").isNull() & (F.col("child_incidents") == 0)
                       & F.col("u_datacenter").startswith(server) & F.col("u_orderid").isNotNull()
                       & (F.col("u_orderid") != "") & F.col("state").isin(*OPEN_STATES)
                       & (F.col("sys_created_on") < older)
                       & ~F.coalesce(F.col("u_additional_info").like(EXCLUDED_HOST_LIKE), F.lit(False)))
            .withColumn("job_name", json_field("u_additional_info", "$.JOBNAME_ADDINFO")))


def family_members(incidents: DataFrame, as_of, server: str = "DS", **cutoffs) -> DataFrame:
    """Incidents of J15's families that get a card C decision: each old child, then the parent."""
    pairs = incident_families(incidents, as_of, server, **cutoffs)
    ids = pairs.select(F.col("child_number").alias("__n")).union(pairs.select(F.col("parent_number").alias("__n"))).distinct()
    return (incidents.join(ids, incidents.number == ids["__n"], "left_semi")
            .withColumn("job_name", json_field("u_additional_info", "$.JOBNAME_ADDINFO")))


def cleanup_decision(candidates: DataFrame, job_status: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """J16 (card C): decision per candidate incident from the job's current state.

    not found -> ``GONE``; status not 'Ended Not OK' -> ``NOT_FAILED``; run
    number differs from the incident's (missing = 0) -> ``COUNTER_DIFFERS``;
    else held -> ``DELETE``, not held -> ``HOLD_THEN_DELETE``. The first three
    count as success with no action. ``job_status`` has one row per (server, run id);
    ``also`` names further candidate columns to keep.
    """
    st = job_status.select(F.col("server_name").alias("__srv"), F.col("run_id").alias("__run"),
                           F.col("job_status").alias("__status"), F.col("number_of_runs").alias("__runs"),
                           (F.col("held") if "held" in job_status.columns else F.lit(False)).alias("__held"))
    j = candidates.join(st, (candidates.u_datacenter == st["__srv"]) & (candidates.u_orderid == st["__run"]), "left")
    run_number = F.coalesce(F.col("u_run_number").cast("long"), F.lit(0))
    decision = (F.when(F.col("__srv").isNull(), F.lit("GONE"))
                .when(~F.coalesce(F.col("__status") == ENDED_NOT_OK, F.lit(False)), F.lit("NOT_FAILED"))
                .when(~F.coalesce(F.col("__runs").cast("long") == run_number, F.lit(False)), F.lit("COUNTER_DIFFERS"))
                .when(F.coalesce(F.col("__held"), F.lit(False)), F.lit("DELETE"))
                .otherwise(F.lit("HOLD_THEN_DELETE")))
    return j.select("number", "u_datacenter", "u_orderid", "job_name", run_number.alias("run_number"),
                    decision.alias("decision"), *also)


# --------------------------------------------------------------------------- J17

def isolated_jobs(held: DataFrame, edges: DataFrame, key: str = "run_id") -> DataFrame:
    """Held jobs with no neighbour in the dependency edge list (may be deleted)."""
    ends = edges.select(F.col("src").alias("__n")).union(edges.select(F.col("dst").alias("__n"))).distinct()
    return held.join(ends, held[key] == ends["__n"], "left_anti")


# Fixed value: error text of a held job that is not isolated.
NOT_ISOLATED = "Rotina com sucessores"


def held_outcomes(jobs: DataFrame, edges: DataFrame, as_of, days: int = 15) -> DataFrame:
    """J17 with outcomes: held jobs that started on a day at least ``days`` days ago, with ``status`` OK when isolated,
    else NOK and an ``error``. Jobs without a centre or run id are skipped."""
    day = F.date_sub(F.to_date(F.lit(as_of).cast("timestamp")), days)
    old = jobs.filter(F.col("held") & (F.to_date("start_time") <= day) & (F.col("server_name") != "") & (F.col("run_id") != ""))
    ends = edges.select(F.col("src").alias("__n")).union(edges.select(F.col("dst").alias("__n"))).distinct()
    j = old.join(ends, old.run_id == ends["__n"], "left")
    free = F.col("__n").isNull()
    return j.select("job_name", "server_name", "run_id", F.when(free, "OK").otherwise("NOK").alias("status"),
                    F.when(~free, F.lit(NOT_ISOLATED)).alias("error"))


# --------------------------------------------------------------------------- J18

def split_success(ids: DataFrame, messages: DataFrame, id_col: str = "alert_id",
                  message_col: str = "message") -> DataFrame:
    """J18 (+F20): tag each id acted on as ``ok`` or ``failed`` from error texts
    listing failed ids inside ``[...]``."""
    from jobscope.functions.text import failed_ids

    failed = messages.select(F.explode(failed_ids(F.col(message_col))).alias("__fid")).distinct()
    j = ids.join(failed, ids[id_col] == failed["__fid"], "left")
    return j.select(*[ids[c] for c in ids.columns],
                    F.when(F.col("__fid").isNull(), F.lit("ok")).otherwise(F.lit("failed")).alias("outcome"))
