"""Queries over files and stored tables that Spark writes from the given tables into the shared folder first:
readers with rejected lines (S2, S4), file loads (PL7, PL8), partition-wise merge and purge (S9, M1),
versions (M2), landing ingest (T1) and the stream-stream grace check (T2)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.plans import jobs as J
from jobscope.plans.registry import register
from jobscope.session import checkpoint_dir
from jobscope.sources.fixtures import AS_OF_DATES, AS_OF_EVENTS, Estate
from jobscope.sources.reports import load_checked, read_dated_checked
from jobscope.operators import relational as R
from jobscope.sources.sinks import write_per_key_bucketed
from jobscope.sources.stored import StoredTable, VolumeExceeded
from jobscope.streaming.landing import ingest_landing, merge_batch, rows_too_late, run_grace_check


def _folder(spark, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _lines(df: DataFrame, path: str) -> str:
    """One column of text written as lines."""
    df.write.mode("append").text(path)
    return path


# --------------------------------------------------------------------------- S2, S4: readers

@register("s2_load_delimited", sql="""
WITH src AS (SELECT job_id, job_name, memname FROM fx_def_job)
SELECT CAST(job_id AS VARCHAR) AS job_id, trim(job_name) AS job_name, upper(memname) AS memname, NULL::VARCHAR AS rejected
FROM src WHERE job_id % 17 <> 0 AND job_id % 19 <> 0
UNION ALL SELECT NULL, NULL, NULL, CASE WHEN job_id % 17 = 0 THEN concat(job_id, ';', job_name) ELSE concat(job_id, ';', job_name, ';', memname, ';x') END
FROM src WHERE job_id % 17 = 0 OR job_id % 19 = 0""", views=("fx_def_job",))
def q_load_delimited(spark, sf):
    """Job lines with planted bad ones (a field missing, a field too many) are written, loaded and split."""
    j = Estate(spark, sf).def_job
    k = F.col("job_id")
    path = _lines(j.select(F.concat_ws(";", k.cast("string"), "job_name", *[F.when(k % 17 != 0, F.col("memname"))],
                                       F.when((k % 19 == 0) & (k % 17 != 0), F.lit("x")))), _folder(spark, "lines"))
    rows, rejected = load_checked(spark, path, 3, {"job_id": "c1", "job_name": F.trim("c2"), "memname": F.upper("c3")}, sep=";")
    none = F.lit(None).cast("string")
    return rows.withColumn("rejected", none).unionByName(
        rejected.select(none.alias("job_id"), none.alias("job_name"), none.alias("memname"), F.col("line").alias("rejected")))


@register("s4_dated_files", sql="""
WITH src AS (SELECT data_center, jobname, service_name, CAST(date_trunc('year', data_car) AS DATE) AS data_car FROM fx_bim)
SELECT data_center, jobname, service_name, data_car, count(*) AS n, false AS rejected FROM src WHERE service_name NOT LIKE '%7' GROUP BY ALL
UNION ALL SELECT data_center, jobname, NULL, NULL, count(*), true FROM src WHERE service_name LIKE '%7' GROUP BY ALL""", views=("fx_bim",))
def q_dated_files(spark, sf):
    """One file per year, named by its date; lines without a service are rejected."""
    path = _folder(spark, "dated")
    b = Estate(spark, sf).bim.withColumn("day", F.date_format(F.trunc("data_car", "year"), "yyyyMMdd"))
    line = F.concat_ws(";", "data_center", "jobname", F.when(~F.col("service_name").endswith("7"), F.col("service_name")))
    b.select(line.alias("value"), "day").hint("rebalance", "day").write.partitionBy("day").text(path)
    _name_by_day(spark, path, "SVC")
    rows, rejected = read_dated_checked(spark, f"{path}/*", "SVC.*", ["data_center", "jobname", "service_name"])
    ok = rows.groupBy("data_center", "jobname", "service_name", "data_car").count().withColumn("rejected", F.lit(False))
    parts = F.split("line", ";")
    bad = rejected.groupBy(parts[0].alias("data_center"), parts[1].alias("jobname")).count()
    bad = bad.select("data_center", "jobname", F.lit(None).cast("string").alias("service_name"), F.lit(None).cast("date").alias("data_car"), "count",
                     F.lit(True).alias("rejected"))
    return ok.unionByName(bad).withColumnRenamed("count", "n")


def _name_by_day(spark, path: str, name: str) -> None:
    """Rename ``day=<d>/part-*`` to ``day=<d>/<name>.<d>.<number>.txt`` (a handful of files a day)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/day=*/part-*")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, s in enumerate(fs.globStatus(p) or []):
        folder = s.getPath().getParent()
        fs.rename(s.getPath(), jvm.org.apache.hadoop.fs.Path(folder, f"{name}.{folder.getName()[4:]}.{i}.txt"))


# --------------------------------------------------------------------------- PL7, PL8: file loads

@register("pl7_change_file", sql=f"""
WITH src AS (SELECT data_car, jobname FROM fx_bim),
h AS (SELECT CAST(data_car AS DATE) AS data_operacao, concat('old-', jobname) AS item FROM src WHERE jobname LIKE 'PX%'
      UNION ALL SELECT CASE WHEN jobname LIKE 'JB%' THEN NULL ELSE CAST(data_car AS DATE) END, jobname FROM src)
SELECT * FROM h WHERE data_operacao IS NULL OR data_operacao >= TIMESTAMP '{AS_OF_DATES} 00:00:00' - INTERVAL 730 DAY""", views=("fx_bim",))
def q_change_file(spark, sf):
    """A change file (rows with an unreadable date among them) is appended to the history, which is purged to two years."""
    b = Estate(spark, sf).bim
    path = _folder(spark, "changes")
    day = F.when(F.col("jobname").startswith("JB"), F.lit("??")).otherwise(F.date_format("data_car", "yyyy-MM-dd"))
    b.select(day.alias("data_operacao"), F.col("jobname").alias("item")).write.option("header", True).option("sep", ";").csv(path)
    history = b.filter(F.col("jobname").startswith("PX")).select(F.to_date("data_car").alias("data_operacao"), F.concat(F.lit("old-"), "jobname").alias("item"))
    return J.change_file_load(spark, path, history, f"{AS_OF_DATES} 00:00:00")


@register("pl8_service_lob", sql="""
WITH svc AS (SELECT service_name, min(jobname) AS job FROM fx_bim GROUP BY 1),
src AS (SELECT service_name, concat('L', right(service_name, 1)) AS a, concat('B', length(service_name)) AS b, job FROM svc)
SELECT s.service_name, concat(s.a, s.b) AS service_lob, right(s.service_name, 3) AS sigla, l.job AS rotina_bim
FROM src s LEFT JOIN (SELECT concat(a, b) AS lob, min(job) AS job FROM src WHERE a <> 'L3' GROUP BY 1) l ON concat(s.a, s.b) = l.lob""",
          views=("fx_bim",))
def q_service_lob(spark, sf):
    """Quoted service lines with header-like ones in between are cleaned, split and given the job of their business line."""
    svc = Estate(spark, sf).bim.groupBy("service_name").agg(F.min("jobname").alias("job"))
    src = svc.select("service_name", F.concat(F.lit("L"), F.substring("service_name", -1, 1)).alias("a"),
                     F.concat(F.lit("B"), F.length("service_name").cast("string")).alias("b"), "job")
    quoted = F.concat(*[x for c in ("service_name", "a", "b") for x in (F.lit('"'), F.col(c), F.lit('"'), F.lit(","))][:-1])
    path = _lines(src.select(F.explode(F.array(quoted, F.lit('"SERVICE NAME","LOB"'))).alias("value")), _folder(spark, "lob"))
    look = src.filter(F.col("a") != "L3").groupBy(F.concat("a", "b").alias("lob")).agg(F.min("job").alias("jobname"))
    return J.service_lob_load(spark, path, look)


# --------------------------------------------------------------------------- S9, M1, M2: stored tables

RUNS_SQL = "r AS (SELECT exec_id, data_center, job_name, runtime_s, end_time FROM fx_exec)"


def _stored_runs(spark, sf, label: str) -> tuple[StoredTable, DataFrame]:
    runs = Estate(spark, sf).runs.select("exec_id", "data_center", "job_name", "runtime_s", "end_time")
    return StoredTable(spark, _folder(spark, label), "data_center", slices=4), runs


@register("s9_partition_merge", sql=f"""
WITH {RUNS_SQL},
u AS (SELECT exec_id, data_center, job_name, runtime_s + 100 AS runtime_s, end_time FROM r WHERE data_center IN ('DS-A', 'MP-A') AND exec_id % 5 = 0)
SELECT r.exec_id, r.data_center, r.job_name, coalesce(u.runtime_s, r.runtime_s) AS runtime_s, r.end_time FROM r LEFT JOIN u USING (exec_id)
WHERE r.exec_id % 7 <> 0 OR u.exec_id IS NOT NULL""", views=("fx_exec",))
def q_partition_merge(spark, sf):
    """A batch with several rows a key, for two centres, is merged into a stored table: the largest order value wins."""
    t, runs = _stored_runs(spark, sf, "merge")
    t.replace(runs.filter("exec_id % 7 <> 0"), ["data_center", "exec_id"])
    batch = runs.filter("data_center IN ('DS-A', 'MP-A') AND exec_id % 5 = 0").withColumn("k", F.explode(F.array(F.lit(100), F.lit(1), F.lit(50))))
    t.upsert(batch.withColumn("runtime_s", F.col("runtime_s") + F.col("k")).drop("k"), ["data_center", "exec_id"], "runtime_s")
    return t.read()


@register("m1_partition_purge", sql=f"""
SELECT exec_id, data_center, job_name, runtime_s, end_time FROM fx_exec
WHERE end_time IS NULL OR end_time >= TIMESTAMP '{AS_OF_EVENTS}' - INTERVAL 12 DAY""", views=("fx_exec",))
def q_partition_purge(spark, sf):
    """Runs that ended over 12 days ago leave a stored table."""
    t, runs = _stored_runs(spark, sf, "purge")
    t.replace(runs, ["data_center", "exec_id"])
    t.purge("end_time", 12, AS_OF_EVENTS, ["data_center", "exec_id"])
    return t.read()


@register("m2_versions_kept", sql=f"""
WITH {RUNS_SQL}
SELECT 3 AS version, (SELECT count(*) FROM r) - (SELECT count(*) FROM r WHERE exec_id % 3 = 2) AS n
UNION ALL SELECT 4, (SELECT count(*) FROM r)""", views=("fx_exec",))
def q_versions_kept(spark, sf):
    """Four versions of a table, the newest two kept: both can still be read whole."""
    t, runs = _stored_runs(spark, sf, "versions")
    keys = ["data_center", "exec_id"]
    t.replace(runs.filter("exec_id % 3 = 0"), keys)
    t.upsert(runs.filter("exec_id % 3 = 0"), keys, "runtime_s")
    t.upsert(runs.filter("exec_id % 3 = 1"), keys, "runtime_s")
    t.upsert(runs.filter("exec_id % 3 = 2"), keys, "runtime_s")
    t.expire(keep=2)
    out = [t.read(n).agg(F.lit(n).alias("version"), F.count(F.lit(1)).alias("n")) for n in t.versions()]
    return out[0].unionByName(out[1])


@register("m3_guarded_replace", sql="""
SELECT job_id, job_name, memname FROM fx_jobs_cur c WHERE NOT EXISTS (SELECT 1 FROM fx_jobs_prev p WHERE trim(p.job_name) = trim(c.job_name))""",
          views=("fx_jobs_cur", "fx_jobs_prev"))
def q_guarded_replace(spark, sf):
    """New jobs replace a stored table under its limit; a result above the limit is refused and leaves it as it was."""
    E = Estate(spark, sf)
    new = R.snapshot_diff(E.jobs_cur, E.jobs_prev).filter(F.col("flag") == "I").select("job_id", "job_name", "memname")
    t = StoredTable(spark, _folder(spark, "guarded"))
    t.replace(new, limit=10**9)
    try:
        t.replace(E.jobs_cur.select("job_id", "job_name", "memname"), limit=0)
    except VolumeExceeded:
        return t.read()
    raise AssertionError("the guard let everything through")


@register("s11_per_job_index", sql="""
SELECT job_name, count(*) AS n FROM fx_exec GROUP BY job_name HAVING count(*) > 80""", views=("fx_exec",))
def q_per_job_index(spark, sf):
    """Runs of the jobs with over 80 of them, in 16 buckets, counted by the index of the files."""
    index = write_per_key_bucketed(Estate(spark, sf).runs, _folder(spark, "per-job"), "job_name", 16, min_rows=80)
    return index.groupBy("job_name").agg(F.sum("rows").alias("n"))


# --------------------------------------------------------------------------- T1, T2: streams

@register("t1_ingest_landing", sql=f"""
WITH {RUNS_SQL}
SELECT CAST(exec_id AS VARCHAR) AS exec_id, data_center, CASE WHEN exec_id % 4 = 0 THEN 'second' ELSE 'first' END AS status,
  CASE WHEN exec_id % 4 = 0 THEN '2' ELSE '1' END AS seq FROM r""", views=("fx_exec",))
def q_ingest_landing(spark, sf):
    """Two landings, each ingested once; the last micro-batch, run again with other rows, changes nothing."""
    runs = Estate(spark, sf).runs.select(F.col("exec_id").cast("string").alias("exec_id"), "data_center")
    landing, target, ckpt = (_folder(spark, x) for x in ("landing", "target", "ingest"))
    first = runs.withColumn("status", F.lit("first")).withColumn("seq", F.lit("1"))
    again = runs.filter("CAST(exec_id AS BIGINT) % 4 = 0").withColumn("status", F.lit("second")).withColumn("seq", F.lit("2"))
    for rows in (first, again):
        rows.write.mode("append").option("header", True).csv(landing)
        ingest_landing(spark, landing, rows.schema, target, ["data_center", "exec_id"], "seq", ckpt, partition_by="data_center", slices=4)
    t = StoredTable(spark, target, "data_center", slices=4)
    replayed = max(t.current().batches.values())
    merge_batch(t, first.withColumn("status", F.lit("replayed")).withColumn("seq", F.lit("3")), replayed, ["data_center", "exec_id"], "seq", ckpt)
    return t.read()


@register("t2_unmatched_after_grace", sql="""
WITH a AS (SELECT alert_id, run_id, server_name, alert_time FROM fx_alert),
i AS (SELECT * FROM fx_incident WHERE sys_created_by = 'system' AND u_source = 'scheduler' AND category = 'monitoring')
SELECT 'unmatched' AS kind, alert_id, 1 AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.u_datacenter = a.server_name AND i.u_orderid = a.run_id
  AND i.sys_created_on >= a.alert_time AND i.sys_created_on <= a.alert_time + INTERVAL 5 MINUTE AND starts_with(i.u_alert_id, CAST(a.alert_id AS VARCHAR)))
UNION ALL SELECT 'late', NULL, count(*) FROM a WHERE alert_id % 50 = 0""", views=("fx_alert", "fx_incident"))
def q_unmatched_after_grace(spark, sf):
    """Alerts without an incident within five minutes, from two streams; alerts that land behind the watermark are counted as late.

    One closing pair a year on moves the watermark past the last alert.
    """
    E = Estate(spark, sf)
    alerts = E.alert_plain.select("alert_id", "run_id", "server_name", "alert_time")
    incidents = E.incident.select("number", "u_datacenter", "u_orderid", "u_alert_id", "sys_created_on", "sys_created_by", "u_source", "category")
    a_dir, i_dir, target, ckpt = (_folder(spark, x) for x in ("alerts", "incidents", "unmatched", "grace"))
    closing = F.expr(f"TIMESTAMP '{AS_OF_EVENTS}' + INTERVAL 366 DAY")
    end = spark.range(1).select(F.lit(-1).cast("long").alias("alert_id"), F.lit("END").alias("run_id"), F.lit("END").alias("server_name"), closing.alias("alert_time"))
    end_i = spark.range(1).select(F.lit("INC-END").alias("number"), F.lit("END").alias("u_datacenter"), F.lit("END").alias("u_orderid"),
                                  F.lit("-1-X").alias("u_alert_id"), closing.alias("sys_created_on"), F.lit("system").alias("sys_created_by"),
                                  F.lit("scheduler").alias("u_source"), F.lit("monitoring").alias("category"))
    alerts.unionByName(end).write.parquet(a_dir)
    incidents.unionByName(end_i).write.parquet(i_dir)
    progress: list = []
    args = (spark, a_dir, i_dir, alerts.schema, incidents.schema, target, ckpt)
    run_grace_check(*args, progress=progress)
    late = alerts.filter("alert_id % 50 = 0").withColumn("alert_id", -F.col("alert_id") - 100)
    late.write.mode("append").parquet(a_dir)
    out = run_grace_check(*args, progress=progress)
    count = spark.range(1).select(F.lit("late").alias("kind"), F.lit(None).cast("long").alias("alert_id"), F.lit(rows_too_late(progress)).cast("int").alias("n"))
    return out.select(F.lit("unmatched").alias("kind"), "alert_id", F.lit(1).alias("n")).unionByName(count)
