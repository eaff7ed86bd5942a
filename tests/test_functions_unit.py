"""Small literal cases for the expressions (FIXTURES.md literal rows)."""

import datetime as dt

from pyspark.sql import functions as F

from jobscope.functions import text as T
from jobscope.functions import thresholds as TH
from jobscope.functions import timefmt as TF
from jobscope.plans.expression_queries import parse_exec_report

EXEC_LINE = ('DS-A,FLD1,APP,GRP,N1,M000001,"May 20, 2025","May 20 2025 03:04:05 PM",'
             '"May 20 2025 03:10:05 PM",2,Ended Not OK,0,O1')


def test_execution_line(spark):
    lines = spark.createDataFrame([(1, EXEC_LINE)], "exec_id long, line string")
    r = parse_exec_report(lines).collect()[0]
    assert r.data_center == "DS-A" and r.job_name == "M000001" and r.order_id == "O1"
    assert r.odate == dt.date(2025, 5, 20)
    assert r.start_time == dt.datetime(2025, 5, 20, 15, 4, 5)
    assert r.runtime_s == 360 and r.rerun_counter == 2


def test_notes_and_ids(spark):
    df = spark.createDataFrame([("ver INC123",), ("inc123",), (None,)], "notes string")
    got = [r[0] for r in df.select(T.incident_in_notes("notes")).collect()]
    assert got == ["INC123", None, None]
    m = spark.createDataFrame([("Failed for alerts [12, 13]",), ("no list",)], "m string")
    ids = sorted(r[0] for r in m.select(F.explode(T.failed_ids("m"))).collect())
    assert ids == [12, 13]


def test_thresholds(spark):
    df = spark.createDataFrame([("=90", 1000), ("+03%", 1000), ("+070%", 1000), ("OK", 1000), ("+1200%", 5),
                                ("+30%", 5)], "v string, m long")
    rows = df.select(TH.effective_threshold("v", "m").alias("s"), T.cap_threshold("v").alias("c"),
                     TH.recommended_threshold("m").alias("r")).collect()
    assert [r.s for r in rows] == [5400, 1030, 1700, None, 65, 6]
    assert [r.c for r in rows] == ["=90", "+03%", "+070%", "OK", "+30%", "+30%"]
    assert rows[0].r == "=55"


def test_jitter_range_and_untouched(spark):
    df = spark.range(0, 3000).select((F.col("id") * 3).alias("v"))
    out = df.select("v", TF.jitter_small("v").alias("j")).collect()
    for r in out:
        if r.v <= 1440:
            assert 50 <= r.j <= 58
        else:
            assert r.j == r.v


def test_jitter_is_the_same_in_any_layout(spark):
    df = spark.range(0, 500).select("id", (F.col("id") % 5).alias("v"))
    j = TF.jitter_small("v", key=["id"]).alias("j")
    one = {r.id: r.j for r in df.coalesce(1).select("id", j).collect()}
    assert one == {r.id: r.j for r in df.repartition(7, F.col("id") % 3).orderBy(F.desc("id")).select("id", j).collect()}
    assert set(one.values()) == set(range(50, 59))


def test_codes_and_criticality(spark):
    df = spark.createDataFrame([("M",), ("M  ",), ("MAB123",), ("PX0001",), ("ab",)], "j string")
    rows = df.select(T.app_code("j", "M").alias("a"), T.app_code("j", "M", test_len=1).alias("b"),
                     T.last3("j").alias("c")).collect()
    assert [r.a for r in rows] == ["M", "M", "MAB", "PX0", "ab"]
    assert [r.b for r in rows] == ["M", "M", "MA", "PX0", "ab"]
    assert [r.c for r in rows] == ["", "M", "123", "001", ""]
    c = spark.createDataFrame([("A",), ("Urgent",), ("zzz",), (None,)], "c string")
    assert [r[0] for r in c.select(T.normalise_criticality("c")).collect()] == ["High", "Urgent", "R", None]


def test_time_round_trip(spark):
    df = spark.createDataFrame([(0,), (3661,), (90061,)], "s long")
    rows = df.select(TF.sec_to_time("s").alias("t")).select("t", TF.time_to_sec("t").alias("b")).collect()
    assert [r.t for r in rows] == ["00:00:00", "01:01:01", "25:01:01"]
    assert [r.b for r in rows] == [0, 3661, 90061]
    z = spark.createDataFrame([("0000-00-00 00:00:00",)], "t string")
    assert z.select(TF.parse_ts("t", TF.ISO_TS)).collect()[0][0] is None


def test_inferred_times(spark):
    df = spark.createDataFrame([("May 20, 2025 3:04:05 PM",), ("2025-05-20 15:04:05",), ("20250520150405",),
                                ("20/05/2025 15:04:05",), ("garbage",)], "t string")
    got = [r[0] for r in df.select(TF.parse_inferred_ts("t")).collect()]
    assert got[:4] == [dt.datetime(2025, 5, 20, 15, 4, 5)] * 4 and got[4] is None


def test_recode_by_table(spark):
    from jobscope.operators.relational import recode_by_table

    df = spark.createDataFrame([(1, "Job execution time"), (2, "other"), (3, None)], "id int, w string")
    m = spark.createDataFrame([("Job execution time", "EXECTIME")], "key string, value string")
    got = sorted((r.id, r.w) for r in recode_by_table(df, "w", m).collect())
    assert got == [(1, "EXECTIME"), (2, "other"), (3, None)]
    strict = sorted((r.id, r.w) for r in recode_by_table(df, "w", m, keep_unmapped=False).collect())
    assert strict == [(1, "EXECTIME"), (2, None), (3, None)]
