"""Structured Streaming variants of the polling loops.

T1 ``ingest_landing``: every report file landed in a folder is read once
(the file source keeps the list of processed files in its checkpoint) and
upserted into a versioned table per micro-batch.

T2 ``alerts_unmatched_after_grace``: the reference searches for an alert's
incident every 60 s, four times, then treats it as missing. Here alerts and
incidents are two streams joined with a left outer stream–stream join whose
time condition bounds the state; an alert is emitted as unmatched once the
watermark passes ``alert_time + grace`` with no incident.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobscope.operators.reconcile import _system_incidents
from jobscope.sources.stored import StoredTable


def ingest_landing(spark: SparkSession, landing_dir: str, schema: StructType, target_root: str,
                   keys: Sequence[str], order_col: str, checkpoint: str, sep: str = ",", header: bool = True,
                   query_name: str = "ingest_landing", transform=None, partition_by: str | None = None, slices: int = 1):
    """Read each landed CSV file once and upsert it into the stored table at ``target_root``.

    ``checkpoint`` is this ingest's own folder in shared storage; it remembers the files already read, so a
    rerun (of this or a later application) with the same folder reads new files only. Runs with ``trigger(availableNow=True)``: everything landed so far is
    processed and the query stops; rerunning later picks up only new files. A micro-batch merges only the partitions
    (and slices) it touches, and its number is committed with its rows, so a batch that runs again after a failure between
    commit and checkpoint changes nothing. Returns the finished ``StreamingQuery``.
    """
    stream = (spark.readStream.schema(schema).option("header", header).option("sep", sep)
              .option("quote", '"').csv(landing_dir))
    if transform is not None:
        stream = transform(stream)
    table = StoredTable(spark, target_root, partition_by, slices)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        merge_batch(table, batch, batch_id, keys, order_col, checkpoint)

    q = (stream.writeStream.foreachBatch(upsert_batch).queryName(query_name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def merge_batch(table: StoredTable, batch: DataFrame, batch_id: int, keys: Sequence[str], order_col: str, checkpoint: str):
    """One micro-batch of the stream with this checkpoint folder, at most once.

    A checkpoint folder made anew starts again at batch 0, so batches are counted under the id in its metadata.
    """
    stream = json.loads(table.spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
    return table.upsert(batch, keys, order_col, batch=(stream, batch_id))


def alerts_unmatched_after_grace(alerts: DataFrame, incidents: DataFrame, grace: str = "5 minutes",
                                 watermark: str = "1 minute") -> DataFrame:
    """Alerts with no system incident on the same centre and order, whose alert id
    starts with the alert's id, created within ``grace`` after the alert.

    Both inputs are streams with event times ``alert_time`` / ``sys_created_on``.
    The output is append-only: a row appears once the watermark has passed the
    alert's grace window.
    """
    a = alerts.withWatermark("alert_time", watermark).alias("a")
    i = (_system_incidents(incidents).select("number", "u_datacenter", "u_orderid", "u_alert_id", "sys_created_on")
         .withWatermark("sys_created_on", watermark).alias("i"))
    cond = ((F.col("a.server_name") == F.col("i.u_datacenter")) & (F.col("a.run_id") == F.col("i.u_orderid"))
            & (F.col("i.sys_created_on") >= F.col("a.alert_time"))
            & (F.col("i.sys_created_on") <= F.col("a.alert_time") + F.expr(f"INTERVAL {grace}"))
            & F.col("i.u_alert_id").startswith(F.col("a.alert_id").cast("string")))
    j = a.join(i, cond, "leftOuter")
    return j.filter(F.col("i.number").isNull()).select("a.*")


def run_grace_check(spark: SparkSession, alerts_dir: str, incidents_dir: str, alert_schema: StructType,
                    incident_schema: StructType, target: str, checkpoint: str, grace: str = "5 minutes", watermark: str = "1 minute",
                    query_name: str = "alerts_unmatched", progress: list | None = None):
    """Drive T2 over Parquet landing folders once (``availableNow``) and append the unmatched to ``target``.

    ``progress`` (a list) takes the run's progress reports; see :func:`rows_too_late`.
    """
    alerts = spark.readStream.schema(alert_schema).parquet(alerts_dir)
    incidents = spark.readStream.schema(incident_schema).parquet(incidents_dir)
    out = alerts_unmatched_after_grace(alerts, incidents, grace, watermark)
    q = (out.writeStream.format("parquet").option("path", target).queryName(query_name).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if progress is not None:
        progress.extend(q.recentProgress)
    return spark.read.schema(out.schema).parquet(target)


def rows_too_late(progress: list) -> int:
    """Rows that arrived behind the watermark and were left out of the join, over some runs' progress reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
