"""Additive moving-average decomposition of daily run times per job.

Per job: daily mean run time ordered by date (positions, not calendar days),
``trend`` = centred moving average of ``period`` points (NULL at both ends),
``detr = x - trend``, ``seasonal`` = mean of ``detr`` per phase ``i mod period``
minus the mean of the phase means, ``resid = detr - seasonal``. The job is
``Sazonal`` when var(seasonal)/var(x)*100 > ``cut`` (tested before rounding).

Everything runs as window functions partitioned by job over the *daily* series,
so a window partition holds one row per day of a job whatever the number of
executions; the per-job CSV hop and the per-job query loop of the reference
disappear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobscope.operators.aggregates import daily_mean

# ---------------------------------------------------------------------------
# Period 7, cut 20 %, more than 80 runs, names not starting A/CM,
# labels Sazonal / Linear.
# ---------------------------------------------------------------------------
PERIOD = 7
CUT_PCT = 20.0
MIN_RUNS = 80
EXCLUDED_PREFIXES = ("A", "CM")
LABEL_SEASONAL = "Sazonal"
LABEL_LINEAR = "Linear"


def eligible_jobs(exec_df: DataFrame, min_runs: int = MIN_RUNS,
                  excluded_prefixes=EXCLUDED_PREFIXES, key: str = "job_name") -> DataFrame:
    """A6 + P2: jobs with more than ``min_runs`` executions, excluding name prefixes."""
    df = exec_df
    for p in excluded_prefixes:
        df = df.filter(~F.col(key).startswith(p))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("runs")).filter(F.col("runs") > min_runs).select(key)


def decompose(daily: DataFrame, period: int = PERIOD, key: str = "job_name") -> DataFrame:
    """Per (job, day): x, trend, seasonal, resid. Jobs with fewer than 2*period days are dropped."""
    by_job = Window.partitionBy(key)
    ordered = Window.partitionBy(key).orderBy("d")
    half = period // 2
    frame = ordered.rowsBetween(-half, half)
    s = daily.select(key, "d", "x",
                     (F.row_number().over(ordered) - 1).alias("i"),
                     F.count(F.lit(1)).over(by_job).alias("n"))
    if period % 2 == 1:
        trend = F.when(F.count("x").over(frame) == period, F.avg("x").over(frame))
    else:
        # 2 x period moving average: half weight on both end points
        edge = F.first("x").over(frame) + F.last("x").over(frame)
        trend = F.when(F.count("x").over(frame) == period + 1,
                       (F.sum("x").over(frame) - edge / 2) / period)
    s = s.withColumn("trend", trend).filter(F.col("n") >= 2 * period)
    s = s.withColumn("ph", F.col("i") % period)
    s = s.withColumn("pa", F.avg(F.col("x") - F.col("trend")).over(Window.partitionBy(key, "ph")))
    phase_means = s.select(key, "ph", "pa").distinct().groupBy(key).agg(F.avg("pa").alias("m"))
    f = s.join(phase_means, key)
    seas = F.col("pa") - F.col("m")
    return f.select(key, "d", "x", "trend", seas.alias("seasonal"),
                    (F.col("x") - F.col("trend") - seas).alias("resid"))


def seasonality(exec_df: DataFrame, period: int = PERIOD, cut: float = CUT_PCT,
                min_runs: int = MIN_RUNS, excluded_prefixes=EXCLUDED_PREFIXES,
                key: str = "job_name") -> DataFrame:
    """Variances, seasonal share and type per eligible job."""
    jobs = eligible_jobs(exec_df, min_runs, excluded_prefixes, key)
    daily = daily_mean(exec_df.join(jobs, key, "left_semi"), key=key)
    comp = decompose(daily, period, key)
    v = comp.groupBy(key).agg(
        F.var_samp("x").alias("var_x"), F.var_samp("trend").alias("var_trend"),
        F.var_samp("seasonal").alias("var_seasonal"), F.var_samp("resid").alias("var_resid"))
    pct = F.try_divide(F.col("var_seasonal"), F.col("var_x")) * 100
    # the type is decided on the unrounded share; every number is then rounded
    # half-even to 2 places, as the reference's result file is
    return v.select(key,
                    F.when(pct > cut, F.lit(LABEL_SEASONAL)).otherwise(F.lit(LABEL_LINEAR)).alias("tipo"),
                    F.bround(pct, 2).alias("sazonal_percentual"),
                    F.bround("var_seasonal", 2).alias("variancia_sazonal"),
                    F.bround("var_trend", 2).alias("variancia_tendencia"),
                    F.bround("var_resid", 2).alias("variancia_ruido"),
                    F.bround("var_x", 2).alias("variancia_total"))
