"""The named job compositions run end to end on landed files and fixture views."""

import datetime as dt
import tempfile

from jobscope.plans import jobs as J
from jobscope.plans.table_queries import alarms_of
from jobscope.sources.fixtures import AS_OF_EVENTS, Estate

HEADER = "DATA_CENTER,SCHED_TABLE,APPLICATION,GROUP_NAME,NODE_ID,JOB_NAME,ODATE,START,END,RERUN,STATUS,CPU,ORDER\n"
LINES = [
    'DS-A,FLD1,APP,GRP,N1,M000001,"May 20, 2025","May 20 2025 03:04:05 PM","May 20 2025 03:10:05 PM",1,Ended Not OK,0,O1',
    'DS-A,FLD1,APP,GRP,N1,M000001,"May 20, 2025","May 20 2025 03:20:00 PM","May 20, 2025 03:30:00 PM",2,Ended Not OK,0,O1',
    'MP-A,FLD2,APP,GRP,N1,P000002,"May 20, 2025","May 20 2025 01:00:00 AM","May 20 2025 01:00:10 AM",1,Ended OK,0,O2',
]


def test_execution_load(spark):
    d = tempfile.mkdtemp(prefix="jobscope-test-")
    with open(f"{d}/r1.csv", "w") as f:
        f.write(HEADER + LINES[0] + "\n")
    with open(f"{d}/r2.csv", "w") as f:
        f.write(HEADER + "\n".join(LINES[1:]) + "\n")
    out = J.execution_load(spark, [f"{d}/r1.csv", f"{d}/r2.csv"], "2025-05-25 00:00:00")
    ex = out["executions"].collect()
    assert len(ex) == 3 and {r.data_center for r in ex} == {"DS-A", "MP-A"}  # headers not loaded
    assert {r.data_center for r in out["open"].collect()} == {"DS-A"}
    assert {r.mttr_s for r in ex} == {None, 1555}
    m = out["mttr"].collect()
    assert len(m) == 1 and m[0].mttr_s == (dt.datetime(2025, 5, 20, 15, 30) - dt.datetime(2025, 5, 20, 15, 4, 5)).seconds
    assert sorted((r.end_date, r.end_clock) for r in out["latest"].collect()) == [
        (dt.date(2025, 5, 20), "01:00:10"), (dt.date(2025, 5, 20), "15:30:00")]


def test_summary_is_not_guarded_and_the_limit_raises(spark, sf_dir):
    import pytest

    E = Estate(spark, sf_dir)
    out = J.snapshot_job(E.jobs_cur, E.jobs_prev, E.def_table.select("table_id", "data_center"), "2024-01-31", limit=1)
    assert out["changes"].count() == 0 and out["history"].count() > 1 and out["summary"].count() > 0
    from jobscope.operators.relational import assert_empty, require_volume
    with pytest.raises(RuntimeError):
        require_volume(out["history"], 1)
    with pytest.raises(AssertionError):
        assert_empty(out["history"])


def test_upsert_keeps_the_last_row_without_a_target(spark):
    from jobscope.operators.relational import upsert

    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, t int")
    assert sorted((r.k, r.v) for r in upsert(None, rows, ["k"], "t").collect()) == [(1, "b"), (2, "c")]


def test_alert_load(spark):
    d = tempfile.mkdtemp(prefix="jobscope-test-")
    row = ['"1"', '""', '"n1"'] + ['""'] * 9 + ['"31-12-24 23:01:02"'] * 3 + ['""'] * 4
    with open(f"{d}/a.csv", "w") as f:
        f.write(",".join(row) + "\n")
    r = J.alert_load(spark, f"{d}/a.csv").collect()[0]
    assert r.serial == "1" and r.alert_key is None and r.first_occurrence == dt.datetime(2024, 12, 31, 23, 1, 2)


def test_threshold_tuning_runs(spark, sf_dir):
    E = Estate(spark, sf_dir)
    out = J.threshold_tuning(E.shout_sum.drop("media_s"), E.shout, E.def_job, E.def_table, E.stat, E.runs,
                             AS_OF_EVENTS, centre_prefix="DS", report_cond=None,
                             alarms=alarms_of(E.alert))
    s = out["summary"]
    n = s.count()
    assert n == s.select("id").distinct().count()
    assert out["impact"].count() == n


def test_change_file_append_and_purge(spark):
    """PL7: appended history (S8) keeps two years (M1); NULL dates are kept."""
    import os

    from jobscope.sources import sinks as S

    d = tempfile.mkdtemp(prefix="jobscope-test-")
    with open(f"{d}/c1.csv", "w") as f:
        f.write("data_operacao;item\n2024-01-10;a\n2020-01-01;old\nbad;x\n")
    hist_path = os.path.join(d, "hist")
    first = J.change_file_load(spark, f"{d}/c1.csv", None, "2024-02-01 00:00:00")
    S.append(first, hist_path)
    with open(f"{d}/c2.csv", "w") as f:
        f.write("data_operacao;item\n2024-01-20;b\n")
    S.append(J.change_file_load(spark, f"{d}/c2.csv", None, "2024-02-01 00:00:00"), hist_path)
    got = sorted((r.item, r.data_operacao) for r in spark.read.parquet(hist_path).collect())
    assert got == [("a", dt.date(2024, 1, 10)), ("b", dt.date(2024, 1, 20)), ("x", None)]


def test_service_lob_load(spark):
    """PL8: header-like lines dropped, quotes removed, lob = field2 || field3, app code = last 3."""
    d = tempfile.mkdtemp(prefix="jobscope-test-")
    with open(f"{d}/s.csv", "w") as f:
        f.write('"SERVICE","LOB","X"\n"Pagamentos ABC","L1","2"\n"Cartoes XYZ","L9","9"\n')
    look = spark.createDataFrame([("L12", "JOB_A")], "lob string, jobname string")
    got = sorted(tuple(r) for r in J.service_lob_load(spark, f"{d}/s.csv", look).collect())
    assert got == [("Cartoes XYZ", "L99", "XYZ", None), ("Pagamentos ABC", "L12", "ABC", "JOB_A")]


def test_logs_with_failures_and_nothing_found(spark, sf_dir):
    from pyspark.sql import functions as F

    from jobscope.operators.reconcile import held_outcomes
    from jobscope.sources.sinks import gap_log

    t0 = dt.datetime(2024, 1, 10)
    held = spark.createDataFrame([("J1", "DS-A", "R1", t0, True), ("J2", "DS-A", "R2", t0, True), ("J3", "DS-A", "R3", dt.datetime(2024, 1, 17), True),
                                  ("J4", "DS-A", "R4", t0, False), ("J5", None, "R5", t0, True), ("J6", "DS-A", "R6", dt.datetime(2024, 1, 16, 23), True)],
                                 "job_name string, server_name string, run_id string, start_time timestamp, held boolean")
    edges = spark.createDataFrame([("R2", "R9"), ("R9", "R2")], "src string, dst string")
    got = sorted(tuple(r)[0:1] + tuple(r)[3:] for r in held_outcomes(held, edges, "2024-01-31 00:00:00").collect())
    assert got == [("J1", "OK", None), ("J2", "NOK", "Rotina com sucessores"), ("J6", "OK", None)]
    E = Estate(spark, sf_dir)
    none = J.stale_cleanup(E.incident.limit(0), E.active, E.active.limit(0), E.edge, AS_OF_EVENTS)
    assert [[(r.automation_id, r.status_id, r.job_name) for r in none[k].collect()] for k in ("log", "single_log", "held_log")] == [
        [(4, -1, None)], [(4, -1, None)], [(6, -1, None)]]
    gaps = spark.createDataFrame([("A", "1", "DS-A"), ("B", "2", "DS-A")], "job_name string, run_id string, server_name string")
    bad = spark.createDataFrame([("B", "2", "HTTP 500")], "job_name string, run_id string, error_message string")
    inc = spark.createDataFrame([("INC9", "DS-A", "A"), ("INC8", "DS-A", "A")], "number string, u_datacenter string, u_orderid string")
    log = sorted((r.job_name, r.status_id, r.incidents, r.old_value, r.error_message) for r in gap_log(gaps, AS_OF_EVENTS, bad, inc).collect())
    assert log == [("A", 1, "INC8", "Event Opened", None), ("B", 2, None, None, "HTTP 500")]
    assert [(r.automation_id, r.status_id) for r in gap_log(gaps.filter(F.lit(False)), AS_OF_EVENTS).collect()] == [(5, -1)]
