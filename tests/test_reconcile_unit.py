"""Branch cases of cards A and C that the fixture views do not reach."""

import datetime as dt

from jobscope.operators.reconcile import classify_alerts_to_keep, cleanup_decision, drop_already_reported

T0 = dt.datetime(2024, 1, 10, 8, 0, 0)
ACTIVE = "run_id string, server_name string, job_status string, cyclic string, start_time timestamp, number_of_runs int"
ALERTS = "alert_id long, run_id string, server_name string, message string, run_counter int"


def test_card_a_branches(spark):
    active = spark.createDataFrame([
        ("R1", "OTHER", "Ended Not OK", "No", T0, 2),      # run active, only on another server
        ("R2", "DS-A", "Ended Not OK", "No", T0, 2),       # failed, still active
        ("R3", "DS-A", "Executing", "Yes", T0, 5),         # cyclic, alert from an older run
        ("R4", "DS-A", "Executing", "Yes", T0, 1),         # cyclic, same run -> closable
        ("R5", "DS-A", "Executing", "No", T0, 1),          # anything else -> keep
        ("R6", "DS-A", "Ended OK", "No", T0, 1),
        ("R6", "DS-B", "Ended OK", "No", T0 - dt.timedelta(hours=1), 1),
    ], ACTIVE)
    alerts = spark.createDataFrame([
        (1, "R0", "DS-A", "Ended not OK", 1), (2, "R1", "DS-A", "Ended not OK", 1), (3, "R2", "DS-A", "Ended NOT ok", 1),
        (4, "R3", "DS-A", "Ended not OK", 2), (5, "R4", "DS-A", "Ended not OK", 1), (6, "R5", "DS-A", "Ended not OK", 1),
        (7, "R6", "DS-B", "Late submission", 1)], ALERTS)
    late = spark.createDataFrame([(8, "R5", "DS-A", "Late", 1), (9, "R9", "DS-A", "Late", 1)], ALERTS)
    got = {r.alert_id: (r.reason, r.flag) for r in classify_alerts_to_keep(alerts, late, active).collect()}
    assert got == {1: (None, False), 2: ("SERVER_MISMATCH", True), 3: ("FAILED_STILL_ACTIVE", True),
                   4: ("CYCLIC_OLD_RUN", True), 5: (None, False), 6: ("OTHER", True), 7: ("OTHER", True),
                   8: ("LATE_ACTIVE", True), 9: (None, False)}


def test_card_c_branches(spark):
    cands = spark.createDataFrame([
        ("INC1", "DS-A", "O1", "J1", 2), ("INC2", "DS-A", "O2", "J2", 2), ("INC3", "DS-A", "O3", "J3", 2),
        ("INC4", "DS-A", "O4", "J4", None), ("INC5", "DS-A", "O5", "J5", 3)],
        "number string, u_datacenter string, u_orderid string, job_name string, u_run_number int")
    status = spark.createDataFrame([
        ("DS-A", "O2", "Ended OK", 2, False), ("DS-A", "O3", "Ended Not OK", 7, False),
        ("DS-A", "O4", "Ended Not OK", 0, True), ("DS-A", "O5", "Ended Not OK", 3, False)],
        "server_name string, run_id string, job_status string, number_of_runs int, held boolean")
    got = {r.number: r.decision for r in cleanup_decision(cands, status).collect()}
    assert got == {"INC1": "GONE", "INC2": "NOT_FAILED", "INC3": "COUNTER_DIFFERS", "INC4": "DELETE",
                   "INC5": "HOLD_THEN_DELETE"}


def test_card_h_removal_by_name(spark):
    jobs = spark.createDataFrame([
        ("O1", "DS-A", "JA", 2, T0), ("O2", "DS-A", "JA", 1, T0), ("O3", "DS-B", "JB", 1, T0), ("O4", "DS-B", "JC", 1, T0)],
        "run_id string, server_name string, job_name string, number_of_runs int, end_time timestamp")
    events = spark.createDataFrame([("Auditoria - Cancelamento de Rotina", "event-hub", "DS-A-2", "O1", "JA")],
                                   "metric_name string, u_source string, resource string, message_key string, node string")
    inc = spark.createDataFrame([
        ("system", "scheduler", "monitoring", "DS-B", "O3", T0 - dt.timedelta(hours=1)),   # within 2 h before end
        ("system", "scheduler", "monitoring", "DS-B", "O4", T0 - dt.timedelta(hours=3))],  # too early
        "sys_created_by string, u_source string, category string, u_datacenter string, u_orderid string, sys_created_on timestamp")
    left = sorted(r.run_id for r in drop_already_reported(jobs, events, inc).collect())
    assert left == ["O4"]  # both JA rows go with the single event hit; JB goes by incident


def test_planned_start_rule(spark):
    from jobscope.operators.tuning import planned_start_rule

    sch = "server_name string, job_name string, end_time timestamp, planned_start timestamp"
    today = spark.createDataFrame([("PRD1", "J1", dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 8, 0)),
                                   ("PRD1", "J2", dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 8, 0)),
                                   ("PRD1", "J3", dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 8, 0))], sch)
    d1 = today.select("server_name", "job_name")
    last = spark.createDataFrame([("PRD1", "J1", T0), ("PRD1", "J2", T0), ("PRD1", "J3", None)],
                                 "server_name string, job_name string, end_time timestamp")
    listed = spark.createDataFrame([("PRD1", "J2")], "server_name string, job_name string")
    rows = planned_start_rule(today, d1, last, listed).collect()
    assert [(r.job_name, r.quant_alert, r.total_minutes) for r in rows] == [("J1", 7200 / 1.5 - 1800, (7200 / 1.5 - 1800) / 60)]
