"""File readers/writers (S1–S4, S7–S11, M2) and the streaming variants."""

import datetime as dt
import os
import tempfile
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from jobscope.operators.reconcile import alerts_without_incident
from jobscope.plans.services import service_map_load
from jobscope.sources import sinks as S
from jobscope.sources.reports import concat_reports, load_delimited, read_checked, read_dated_checked, read_dated_files, read_report
from jobscope.streaming.landing import alerts_unmatched_after_grace, ingest_landing, merge_batch, run_grace_check


def _scratch():
    return tempfile.mkdtemp(prefix="jobscope-test-")


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_report_and_concat(spark):
    d = _scratch()
    _write(f"{d}/a.csv", 'Run ID,Server Name\n"r1",DS-A\n')
    _write(f"{d}/b.csv", 'Run ID,Server Name\nr2,"DS-B"\n')
    one = read_report(spark, f"{d}/a.csv", ["run_id", "server_name"]).collect()
    assert [tuple(r) for r in one] == [("r1", "DS-A")]
    both = sorted(tuple(r) for r in concat_reports(spark, [f"{d}/a.csv", f"{d}/b.csv"],
                                                    ["run_id", "server_name"]).collect())
    assert both == [("r1", "DS-A"), ("r2", "DS-B")]  # second header not loaded as data


def test_load_delimited_keeps_every_row(spark):
    d = _scratch()
    _write(f"{d}/mf.txt", " S1 ;MP-X; FLD ;JOB1;MEM1\nS2;MP-X;FLD;JOB2;MEM2\n")
    df = load_delimited(spark, f"{d}/mf.txt", 5, {"sigla": "trim(c1)", "job_name": F.trim("c4")}, sep=";")
    assert sorted(tuple(r) for r in df.collect()) == [("S1", "JOB1"), ("S2", "JOB2")]


def test_dated_files_and_service_map(spark):
    d = _scratch()
    body = '"DS-A";"JOB1";"MEM1";"SVC1"\n"DS-A";"JOB1";"MEM1";"SVC1"\n"DS-A";"JOB2";"MEM2";"SVC2"\n'
    _write(f"{d}/BIM_BANCO_PROD.20250520.csv", body)
    _write(f"{d}/BIM_BANCO_PROD.20250519.TMP.csv", body)
    cols = ["data_center", "jobname", "memname", "service_name"]
    df = read_dated_files(spark, d, "BIM_*.csv", cols)
    rows = df.collect()
    assert len(rows) == 3 and {r.data_car for r in rows} == {dt.date(2025, 5, 20)}
    hist, dmap = service_map_load(df, None, "2025-05-21 00:00:00")
    assert [r.jobname for r in hist.collect()] == ["JOB2"]  # uniq -u drops both copies
    assert dmap.count() == 1


def test_versioned_table_upsert_and_purge(spark):
    root = os.path.join(_scratch(), "tb")
    t = S.VersionedTable(spark, root)
    t.replace(spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2020, 1, 1))],
                                    "k int, v string, d date"))
    t.upsert(spark.createDataFrame([(1, "x", dt.date(2024, 1, 2)), (1, "y", dt.date(2024, 1, 3)),
                                    (3, "c", None)], "k int, v string, d date"), ["k"], order_col="d")
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "y"), (2, "b"), (3, "c")]
    t.purge("d", 365, "2024-06-01 00:00:00")
    assert sorted(r.k for r in t.read().collect()) == [1, 3]  # NULL date kept
    assert t.versions() == [1, 2, 3]
    d1 = S.VersionedTable(spark, root + "_d1")
    S.rotate_snapshot(t, d1)
    assert d1.read().count() == 2


def test_replace_partition_and_write_per_key(spark):
    root = os.path.join(_scratch(), "bim")
    df = spark.createDataFrame([("DS-A", "j1"), ("WS-A", "j2")], "data_center string, jobname string")
    S.overwrite(df, root, ["data_center"])
    S.replace_partition(spark.createDataFrame([("DS-A", "j9")], "data_center string, jobname string"),
                        root, "data_center")
    got = sorted((r.data_center, r.jobname) for r in spark.read.parquet(root).collect())
    assert got == [("DS-A", "j9"), ("WS-A", "j2")]
    out = os.path.join(_scratch(), "perjob")
    runs = spark.createDataFrame([("j1", i) for i in range(5)] + [("j2", 1)], "job string, v int")
    S.write_per_key(runs, out, "job", min_rows=2)
    assert sorted(n for n in os.listdir(out) if n.startswith("job=")) == ["job=j1"]
    assert os.path.exists(os.path.join(out, "_SUCCESS"))


def test_export_and_audit_empty(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(S.export_delimited(df, "#;")).collect()[0][0] == "a#;#;c"
    empty = spark.createDataFrame([], "alert_id long, status string, old_value string")
    rows = S.audit_log(empty, 1, "2024-01-31 00:00:00").collect()
    assert len(rows) == 1 and rows[0].status_id == -1


def test_ingest_landing_stream(spark):
    landing = _scratch()
    target = os.path.join(_scratch(), "t")
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    _write(f"{landing}/f1.csv", "k,v\na,1\nb,1\n")
    ckpt = os.path.join(_scratch(), "ckpt")
    ingest_landing(spark, landing, schema, target, ["k"], "v", ckpt)
    _write(f"{landing}/f2.csv", "k,v\nb,0\nc,2\n")
    ingest_landing(spark, landing, schema, target, ["k"], "v", ckpt)
    # the second run reads f2 only, and its b replaces the earlier one
    got = sorted(tuple(r) for r in S.VersionedTable(spark, target).read().collect())
    assert got == [("a", "1"), ("b", "0"), ("c", "2")]
    before = S.VersionedTable(spark, target).versions()
    ingest_landing(spark, landing, schema, target, ["k"], "v", ckpt)
    assert S.VersionedTable(spark, target).versions() == before


def test_grace_join_matches_batch(spark):
    a_dir, i_dir = _scratch(), _scratch()
    t0 = dt.datetime(2024, 1, 30, 10, 0, 0)
    alerts = [(11, "R1", "DS-A", t0), (12, "R2", "DS-A", t0), (13, "R3", "DS-B", t0 + dt.timedelta(minutes=1)),
              (99, "RF", "DS-A", t0 + dt.timedelta(hours=1))]  # later row moves the watermark
    origin = ("system", "scheduler", "monitoring")
    incidents = [("INC1", "DS-A", "R1", "11-X", t0 + dt.timedelta(minutes=3), *origin),
                 ("INC0", "DS-B", "R3", "13-X", t0 + dt.timedelta(minutes=2), "someone", *origin[1:]),  # not the system's
                 ("INC2", "DS-A", "R2", "12-X", t0 + dt.timedelta(minutes=30), *origin),  # too late
                 ("INCF", "DS-A", "RF", "99-X", t0 + dt.timedelta(hours=1, minutes=1), *origin)]
    a_schema = StructType([StructField("alert_id", LongType()), StructField("run_id", StringType()),
                           StructField("server_name", StringType()), StructField("alert_time", TimestampType())])
    i_schema = StructType([StructField("number", StringType()), StructField("u_datacenter", StringType()),
                           StructField("u_orderid", StringType()), StructField("u_alert_id", StringType()),
                           StructField("sys_created_on", TimestampType())]
                          + [StructField(c, StringType()) for c in ("sys_created_by", "u_source", "category")])
    spark.createDataFrame(alerts, a_schema).write.mode("overwrite").parquet(a_dir + "/p")
    spark.createDataFrame(incidents, i_schema).write.mode("overwrite").parquet(i_dir + "/p")
    out = run_grace_check(spark, a_dir + "/p", i_dir + "/p", a_schema, i_schema,
                          target=os.path.join(_scratch(), "out"), checkpoint=os.path.join(_scratch(), "ckpt"))
    assert sorted(r.alert_id for r in out.collect()) == [12, 13]
    # batch twin: same alerts, a 0-hour look-back, incidents within the 5-minute grace count as found
    batch = alerts_unmatched_after_grace(spark.createDataFrame(alerts, a_schema),
                                         spark.createDataFrame(incidents, i_schema))
    assert sorted(r.alert_id for r in batch.collect()) == [12, 13]
    inc = spark.createDataFrame(incidents, i_schema)
    al = spark.createDataFrame(alerts, a_schema).withColumn("notes", F.lit(None).cast("string"))
    j12 = alerts_without_incident(al, inc, "2024-01-31 00:00:00", lookback_hours=0, max_age_days=2)
    assert sorted(r.alert_id for r in j12.collect()) == [13]  # no upper time bound in the batch rule


def test_rejected_lines_come_out_with_their_file(spark):
    d = _scratch()
    _write(f"{d}/BIM.20250520.csv", 'DS-A;"J;1";S1\nDS-A;J2\n\nDS-B;J3;S3;extra\n;;\n')
    _write(f"{d}/BIM.20250521.TMP.csv", "x;y\n")
    rows, rejected = read_dated_checked(spark, d, "BIM.*", ["dc", "job", "svc"])
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == [("DS-A", "J;1", "S1", dt.date(2025, 5, 20)), (None, None, None, dt.date(2025, 5, 20))]
    assert sorted(tuple(r) for r in rejected.collect()) == [("BIM.20250520.csv", "DS-A", "DS-A;J2"), ("BIM.20250520.csv", "DS-B", "DS-B;J3;S3;extra")]
    assert (rows.count(), rejected.count(), rejected.select("line").distinct().count()) == (2, 2, 2)
    _write(f"{d}/h.csv", "Run ID,Server\nr1,DS-A\nr2\n")
    rows, rejected = read_checked(spark, f"{d}/h.csv", ["run_id", "server"], header=True)
    assert [r.run_id for r in rows.collect()] == ["r1"] and [r.line for r in rejected.collect()] == ["r2"]


def test_replayed_micro_batch_and_new_checkpoint(spark):
    landing, target, c1, c2 = _scratch(), os.path.join(_scratch(), "t"), os.path.join(_scratch(), "a"), os.path.join(_scratch(), "b")
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    _write(f"{landing}/f1.csv", "k,v\na,1\n")
    ingest_landing(spark, landing, schema, target, ["k"], "v", c1)
    t = S.VersionedTable(spark, target)
    merge_batch(t, spark.createDataFrame([("a", "again")], schema), 0, ["k"], "v", c1)
    assert [tuple(r) for r in t.read().collect()] == [("a", "1")] and t.versions() == [1]
    _write(f"{landing}/f2.csv", "k,v\na,2\n")
    ingest_landing(spark, landing, schema, target, ["k"], "v", c2)  # a stream of its own: its batch 0 counts
    assert [tuple(r) for r in t.read().collect()] == [("a", "2")] and len(t.current().batches) == 2
