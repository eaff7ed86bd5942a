"""The rewritten join algorithms agree with a brute-force statement on random data with a hot key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from jobscope.operators.reconcile import alerts_without_incident
from jobscope.operators.relational import alerts_if_threshold

T0 = dt.datetime(2024, 1, 30, 8, 0, 0)


def test_alerts_if_threshold_bruteforce(spark):
    rnd = random.Random(7)
    runs = [("HOT" if rnd.random() < 0.4 else f"J{rnd.randint(0, 30)}", "DS-A", rnd.randint(0, 400))
            for _ in range(4000)] + [("J1", "DS-A", None)]
    th = [(i, "HOT" if i % 3 == 0 else f"J{rnd.randint(0, 35)}", "DS-A", rnd.choice([None, rnd.randint(0, 400)]))
          for i in range(300)]
    e = spark.createDataFrame(runs, "job_name string, data_center string, runtime_s long")
    t = spark.createDataFrame(th, "id long, job_name string, server_name string, new_time_s long")
    got = {r.id: r.calc_shout for r in alerts_if_threshold(t, e).collect()}
    for i, job, srv, thr in th:
        exp = 0 if thr is None else sum(1 for j, s, r in runs if j == job and s == srv and r is not None and r > thr)
        assert got[i] == exp, (i, got[i], exp)


def test_alerts_without_incident_bruteforce(spark):
    rnd = random.Random(11)
    alerts, incidents = [], []
    for i in range(600):
        aid = rnd.choice([rnd.randint(1, 9), rnd.randint(10, 99), rnd.randint(100, 9999)])
        run = "HOT" if rnd.random() < 0.4 else f"R{rnd.randint(0, 40)}"
        at = T0 + dt.timedelta(minutes=rnd.randint(-3000, 600))
        notes = rnd.choice([None, None, f"see INC{rnd.randint(0, 50)}", "inc7"])
        alerts.append((aid, run, "DS-A", at, notes))
    for k in range(900):
        run = "HOT" if rnd.random() < 0.4 else f"R{rnd.randint(0, 40)}"
        u = rnd.choice([f"{rnd.randint(1, 9999)}-X", f"{rnd.randint(1, 99)}", None, ""])
        created = T0 + dt.timedelta(minutes=rnd.randint(-3000, 900))
        incidents.append((f"INC{rnd.randint(0, 50)}", "DS-A", run, u, created, "system", "scheduler", "monitoring"))
    a = spark.createDataFrame(alerts, "alert_id long, run_id string, server_name string, alert_time timestamp, notes string")
    i = spark.createDataFrame(incidents, "number string, u_datacenter string, u_orderid string, u_alert_id string, "
                                         "sys_created_on timestamp, sys_created_by string, u_source string, category string")
    as_of = "2024-01-31 00:00:00"
    got = sorted(r.alert_id for r in alerts_without_incident(a, i, as_of, lookback_hours=2, max_age_days=2).collect())

    def inc_of(n):
        if n is None or "INC" not in n.upper() or "INC" not in n:
            return None
        return n[n.index("INC"):]

    exp = []
    cut = dt.date(2024, 1, 31) - dt.timedelta(days=2)
    for aid, run, srv, at, notes in alerts:
        if at.date() < cut:
            continue
        want = inc_of(notes)
        hit = any(dc == srv and orr == run and u is not None and u.startswith(str(aid))
                  and c >= at - dt.timedelta(hours=2) and (want is None or num == want)
                  for num, dc, orr, u, c, *_ in incidents)
        if not hit:
            exp.append(aid)
    assert got == sorted(exp)
