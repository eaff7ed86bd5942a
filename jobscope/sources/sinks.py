"""Writers.

Plain outputs are Parquet or CSV folders. A table that is rewritten from itself (upsert,
purge, rotation) is a :class:`~jobscope.sources.stored.StoredTable`: readers see the
newest committed version, so a job never overwrites the files it is reading
and a failed write leaves the previous version intact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.sources.stored import StoredTable, Version

# ---------------------------------------------------------------------------
# Audit status codes and event payload constants.
# ---------------------------------------------------------------------------
STATUS_IDS = {"NOF": -1, "Error": 0, "OK": 1, "NOK": 2}
EVENT_METRIC = "Auditoria - Cancelamento de Rotina"
EVENT_SEVERITY = 3
EVENT_INFO = {"monitoring_tool": "scheduler", "kb": "KB-0001", "group": "", "kb01": "", "kb02": "", "kb03": "",
              "alert_group": "I", "assignment_group_incident": "batch support",
              "fechamento_automatico": "False"}


# --------------------------------------------------------------------------- S6

def export_delimited(df: DataFrame, sep: str = "#;", cols: Sequence[str] | None = None) -> Column:
    """All columns as one text line; NULL fields become empty (``concat_ws``
    alone would drop them and shift the positions)."""
    cols = list(cols or df.columns)
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


# --------------------------------------------------------------------------- S7/S8/S10/S11

def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate + insert (the whole folder, whatever the session's partition mode)."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Add rows to a history table."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partition(df: DataFrame, path: str, part_col: str) -> None:
    """Rewrite only the partitions present in ``df`` (e.g. one data centre).

    Dynamic partition overwrite: the other centres' folders are untouched.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)


def write_per_key(df: DataFrame, path: str, key: str, min_rows: int | None = None,
                  fmt: str = "csv") -> None:
    """One folder per key (optionally only keys with more than ``min_rows`` rows).

    A REBALANCE hint on the key keeps a key's rows together (normally one file
    per folder) while AQE splits an oversized partition, so a hot key is
    written by several tasks (several files in its folder) instead of one.
    """
    if min_rows is not None:
        keep = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > min_rows).select(key)
        df = df.join(keep, key, "left_semi")
    (df.hint("rebalance", key).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(key)
     .format(fmt).option("header", True).save(path))


def write_per_key_bucketed(df: DataFrame, path: str, key: str, buckets: int, min_rows: int | None = None,
                           max_records_per_file: int = 1_000_000) -> DataFrame:
    """S11 for many keys: rows in ``buckets`` folders by a hash of the key, sorted by it, and an index.

    The number of files depends on ``buckets`` and the rows, not on the number of keys. Returns the index, one row
    per (key, file): key, file, rows; it is also written to ``<path>/index``. A reader of one key opens the files the index
    names and filters by key. A rebalance splits an oversized bucket, so a hot key becomes several files.
    """
    spark = df.sparkSession
    if min_rows is not None:
        keep = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > min_rows).select(F.col(key).alias("__key"))
        df = df.join(keep, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    data = f"{path.rstrip('/')}/data"
    rows = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).hint("rebalance", "bucket").sortWithinPartitions("bucket", key)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("maxRecordsPerFile", max_records_per_file).partitionBy("bucket").parquet(data)
    back = spark.read.schema(df.schema).parquet(f"{data}/*").select(F.col(key), F.col("_metadata.file_path").alias("file"))
    back.groupBy(key, "file").agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(f"{path.rstrip('/')}/index")
    return spark.read.parquet(f"{path.rstrip('/')}/index")


# --------------------------------------------------------------------------- versioned tables

#: Tables with versions (see ``jobscope.sources.stored``); without a partition column an upsert rewrites the whole table.
VersionedTable = StoredTable


def rotate_snapshot(today: StoredTable, yesterday: StoredTable, keep: int | None = None) -> Version:
    """M2: yesterday := today (a new version of the D1 table); ``keep`` limits the versions it holds on to."""
    out = yesterday.replace(today.read())
    if keep is not None:
        yesterday.expire(keep=keep)
    return out


# --------------------------------------------------------------------------- S12

def event_payload(gaps: DataFrame, event_info: dict = EVENT_INFO) -> DataFrame:
    """One nested JSON event per gap row (job, server, run id, times); ``event_info`` is the caller's site data."""
    disp = "dd/MM/yyyy HH:mm:ss"
    run_disp = F.date_format("run_time", disp)
    info = F.struct(*[F.lit(v).alias(k) for k, v in event_info.items()],
                    F.col("server_name").alias("CONTROLMSERVER_ADDINFO"), run_disp.alias("ORDERDATE_ADDINFO"),
                    F.col("run_id").alias("ORDERID_ADDINFO"), F.col("rerun_counter").cast("string").alias("RUN_NUMBER"),
                    F.col("job_name").alias("JOBNAME_ADDINFO"),
                    F.date_format("start_time", disp).alias("DATETIME_START"),
                    F.date_format("end_time", disp).alias("DATETIME_END"), run_disp.alias("DATETIME_RUN"))
    body = F.struct(F.col("job_name").alias("node"),
                    F.concat_ws("-", F.col("server_name"), F.col("rerun_counter").cast("string"), F.col("run_id")).alias("resource"),
                    F.lit(EVENT_METRIC).alias("metric_name"), F.lit(EVENT_SEVERITY).alias("severity"),
                    F.concat(F.lit("Cancelamento da rotina "), F.col("job_name"), F.lit(" referente ao "), run_disp)
                    .alias("description"),
                    F.col("run_id").alias("messageKey"), info.alias("additional_info"))
    return gaps.select("job_name", "run_id", F.to_json(body).alias("payload"))


# --------------------------------------------------------------------------- S13

def audit_log(outcomes: DataFrame, automation_id: int, as_of, status_col: str = "status",
              id_col: str = "alert_id", old_col: str | None = "old_value", new_value: str | None = None,
              error_col: str | None = None) -> DataFrame:
    """Log rows from an outcome frame; one "nothing found" row when it is empty.

    Status text maps to a code (NOF -1, Error 0, OK 1, NOK 2, other 0). Success
    rows carry old/new values, failures the error text. The empty case is a
    one-row frame kept only when ``outcomes`` has no row (a scalar-subquery
    test, not a driver-side count).
    """
    code = _status_code(status_col)
    ok = code == 1
    rows = outcomes.select(
        F.lit(as_of).cast("timestamp").alias("log_time"), F.lit(automation_id).alias("automation_id"),
        code.alias("status_id"), F.col(id_col).cast("string").alias("alerta_id"),
        F.when(ok, F.col(old_col) if old_col else F.lit(None)).cast("string").alias("old_value"),
        F.when(ok, F.lit(new_value)).cast("string").alias("new_value"),
        F.when(~ok, F.col(error_col) if error_col else F.lit(None)).cast("string").alias("error_message"))
    return _or_nothing_found(rows, outcomes, automation_id, as_of)


def job_log(outcomes: DataFrame, automation_id: int, as_of, status_col: str = "status", job_col: str = "job_name",
            incident_col: str = "number", alert_col: str | None = None, new_value: str | None = None,
            error_col: str | None = None) -> DataFrame:
    """S13, job layout: job, incident and alert of OK and NOK outcomes (other statuses log none of
    them), the new value of OK, the error text of NOK; one "nothing found" row when empty."""
    code = _status_code(status_col)

    def known(name: str | None) -> Column:
        return F.when(code > 0, F.col(name) if name else F.lit(None)).cast("string")

    rows = outcomes.select(
        F.lit(as_of).cast("timestamp").alias("log_time"), F.lit(automation_id).alias("automation_id"),
        code.alias("status_id"), known(job_col).alias("job_name"), known(incident_col).alias("incidents"),
        known(alert_col).alias("alerta_id"), F.when(code == 1, F.lit(new_value)).cast("string").alias("new_value"),
        F.when(code == 2, F.col(error_col) if error_col else F.lit(None)).cast("string").alias("error_message"))
    return _or_nothing_found(rows, outcomes, automation_id, as_of)


def gap_log(gaps: DataFrame, as_of, failures: DataFrame | None = None, incidents: DataFrame | None = None,
            automation_id: int = 5, order_col: str = "job_name") -> DataFrame:
    """S13, gap layout: one row per event posted, or the "nothing found" row.

    An opened event logs job, the incident found for it, ``Event Opened`` as old and the text ``None`` as new value; a
    failed one (its job and run are in ``failures``: job_name, run_id, error_message) logs the job and the error. The
    incident is the first by number of the centre whose order id equals ``order_col`` of the gap
    (LITERAL: the source compares it with the job's name).
    """
    rows = gaps.select("job_name", "run_id", "server_name", F.col(order_col).alias("__order"))
    if failures is not None:
        bad = failures.groupBy(F.col("job_name").alias("__job"), F.col("run_id").alias("__run")).agg(F.max("error_message").alias("__error"),
                                                                                                  F.lit(True).alias("__failed"))
        rows = rows.join(bad, rows.job_name.eqNullSafe(F.col("__job")) & rows.run_id.eqNullSafe(F.col("__run")), "left")
    else:
        rows = rows.withColumn("__error", F.lit(None).cast("string")).withColumn("__failed", F.lit(None).cast("boolean"))
    if incidents is not None:
        inc = incidents.groupBy(F.col("u_datacenter").alias("__dc"), F.col("u_orderid").alias("__oid")).agg(F.min("number").alias("__number"))
        rows = rows.join(inc, (F.col("server_name") == F.col("__dc")) & (F.col("__order") == F.col("__oid")), "left")
    else:
        rows = rows.withColumn("__number", F.lit(None).cast("string"))
    ok = F.col("__failed").isNull()
    out = rows.select(F.lit(as_of).cast("timestamp").alias("log_time"), F.lit(automation_id).alias("automation_id"),
                      F.when(ok, F.lit(STATUS_IDS["OK"])).otherwise(F.lit(STATUS_IDS["NOK"])).alias("status_id"), F.col("job_name").cast("string").alias("job_name"),
                      F.when(ok, F.col("__number")).cast("string").alias("incidents"), F.when(ok, F.lit("Event Opened")).alias("old_value"),
                      F.when(ok, F.lit("None")).alias("new_value"), F.when(~ok, F.col("__error")).alias("error_message"))
    return _or_nothing_found(out, gaps, automation_id, as_of)


def _status_code(status_col: str) -> Column:
    names = F.create_map(*[x for k, v in STATUS_IDS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(names[F.col(status_col)], F.lit(0))


def _or_nothing_found(rows: DataFrame, outcomes: DataFrame, automation_id: int, as_of) -> DataFrame:
    n = outcomes.select(F.count(F.lit(1))).scalar()
    fixed = {"log_time": F.lit(as_of), "automation_id": F.lit(automation_id), "status_id": F.lit(STATUS_IDS["NOF"])}
    empty = outcomes.sparkSession.range(1).select(
        *[fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema]).filter(n == 0)
    return rows.unionByName(empty)
