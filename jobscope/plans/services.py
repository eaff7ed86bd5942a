"""Service summary and service-map load (PL11).

A4 fan-out for ``DS`` (per job) and ``WS`` (per member) centres -> latest end
per job from all executions, set on ``DS`` summary rows only, -> cyclic flag from definitions.
Joins are on the job name only, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.functions.text import strip_quotes
from jobscope.operators.aggregates import service_fanout
from jobscope.operators.relational import purge, singletons


def service_summary(bim: DataFrame, exec_df: DataFrame, def_job: DataFrame) -> DataFrame:
    fan = service_fanout(bim)
    last = exec_df.groupBy("job_name").agg(F.max("end_time").alias("last_end"))
    cyc = def_job.groupBy(F.trim("job_name").alias("cy_job")).agg(F.max("cyclic").alias("cyclic"))
    j = fan.join(last, fan.jobname == last.job_name, "left").drop("job_name")
    j = j.join(cyc, j.jobname == cyc.cy_job, "left").drop("cy_job")
    end = F.when(F.col("data_center").startswith("DS"), F.col("last_end")).alias("last_end")
    return j.select("data_center", "jobname", "qlobis", end, "cyclic")


def service_map_load(files: DataFrame, history: DataFrame | None, as_of, days: int = 39,
                     mode: str = "unique") -> tuple[DataFrame, DataFrame]:
    """PL11: landed map rows (S4) -> lines seen once (U3) -> quotes removed (F1) ->
    appended to history (S8) -> 39-day purge (M1) -> distinct service and job (U2).

    Returns (new history, distinct map).
    """
    text_cols = [c for c, t in files.dtypes if t == "string"]
    once = singletons(files, mode)
    fresh = once.select(*[strip_quotes(c).alias(c) if c in text_cols else F.col(c) for c in files.columns])
    hist = fresh if history is None else history.unionByName(fresh)
    hist = purge(hist, "data_car", days, as_of)
    distinct_map = hist.select("service_name", "jobname").distinct()
    return hist, distinct_map
