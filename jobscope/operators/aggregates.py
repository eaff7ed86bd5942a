"""Counts and summaries.

All are hash aggregates with map-side partial combine, so a hot key is reduced
to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.functions.text import app_code, platform_prefix


def daily_volume(exec_df: DataFrame, day: str | None = None, letter: str = "M",
                 centre_prefix: str | None = None, exclude_centres=(), test_len: int = 3) -> DataFrame:
    """A1: executions per (day, platform, centre, app code, status).

    ``day`` (``yyyy-MM-dd``) keeps one day of end times; None keeps every day.
    ``centre_prefix`` restricts centres (the reference's broken ``(DATA_CENTER,1,2)='M'``
    test becomes a prefix parameter); ``exclude_centres`` drops named centres.
    """
    df = exec_df
    if centre_prefix:
        df = df.filter(F.col("data_center").startswith(centre_prefix))
    if exclude_centres:
        df = df.filter(~F.col("data_center").isin(*exclude_centres))
    d = F.substring(F.date_format("end_time", "yyyy-MM-dd HH:mm:ss"), 1, 10)
    if day is not None:
        df = df.filter(d == F.lit(day))
    return df.groupBy(d.alias("data"), platform_prefix("data_center").alias("ambiente"),
                      F.col("data_center"), app_code("job_name", letter, test_len).alias("sigla"),
                      F.col("completion_status").alias("status")).agg(F.count(F.lit(1)).alias("volume"))


def platform_volume(exec_df: DataFrame, as_of, days: int = 2) -> DataFrame:
    """A2: executions per platform x start day, start between midnight ``days``
    days before ``as_of`` and midnight of ``as_of`` (both inclusive, as the
    source's ``BETWEEN CURRENT_DATE() - INTERVAL n DAY AND CURRENT_DATE()``).
    Order the output by ``data`` descending for the newest-first report (O1).
    """
    today = F.to_date(F.lit(as_of).cast("timestamp"))
    lo = F.date_sub(today, days).cast("timestamp")
    df = exec_df.filter(F.col("start_time").between(lo, today.cast("timestamp")))
    return (df.groupBy(platform_prefix("data_center").alias("platform"), F.to_date("start_time").alias("data"))
            .agg(F.count(F.lit(1)).alias("n")))


def app_delta_summary(changes: DataFrame, as_of_date) -> DataFrame:
    """A3: changed jobs per platform x app code, stamped with the run date."""
    d = as_of_date if isinstance(as_of_date, Column) else F.lit(as_of_date).cast("date")
    return (changes.groupBy(platform_prefix("data_center").alias("platform"), F.col("sigla"))
            .agg(F.count(F.lit(1)).alias("n")).withColumn("data", d))


def service_fanout(bim: DataFrame) -> DataFrame:
    """A4: distinct business services fed by each job.

    ``DS`` centres are counted per (centre, job name), ``WS`` centres per
    (centre, member name); the two parts are stacked.
    """
    ds = (bim.filter(F.col("data_center").startswith("DS"))
          .groupBy("data_center", "jobname").agg(F.countDistinct("service_name").alias("qlobis")))
    ws = (bim.filter(F.col("data_center").startswith("WS"))
          .groupBy("data_center", F.col("memname").alias("jobname"))
          .agg(F.countDistinct("service_name").alias("qlobis")))
    return ds.unionByName(ws)


def max_per_key(df: DataFrame, keys, col: str, out: str | None = None) -> DataFrame:
    """A5: latest value per key."""
    return df.groupBy(*keys).agg(F.max(col).alias(out or f"max_{col}"))


def keys_with_more_than(df: DataFrame, keys, n: int, out: str = "runs") -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > n)


def alert_count(alarms: DataFrame, as_of, days: int = 30, cond_col: str = "when_cond",
                cond: str = "NOTOK", ts_col: str = "host_time", centre_prefix: str | None = None) -> DataFrame:
    """Alerts of one condition per (centre, job) whose day is within ``days``
    days of ``as_of`` (``DATE(ts) >= CURDATE() - n``, written as a raw timestamp
    bound so it reaches the scan). The reference keeps ``PRD%`` centres only:
    pass ``centre_prefix``.
    """
    since = F.date_sub(F.to_date(F.lit(as_of).cast("timestamp")), days).cast("timestamp")
    df = alarms.filter((F.col(cond_col) == cond) & (F.col(ts_col) >= since))
    if centre_prefix is not None:
        df = df.filter(F.col("data_center").startswith(centre_prefix))
    return df.groupBy("data_center", "job_name").agg(F.count(F.lit(1)).alias("quant_alert"))


def daily_mean(exec_df: DataFrame, key: str = "job_name", ts_col: str = "start_time",
               value_col: str = "runtime_s") -> DataFrame:
    """Mean value per key x calendar day."""
    return exec_df.groupBy(F.col(key), F.to_date(ts_col).alias("d")).agg(
        F.avg(F.col(value_col).cast("double")).alias("x"))


def _exact_var_samp(c: str) -> Column:
    """n-1 sample variance of an integer column from exact DECIMAL(38,0) sums.

    ``(n*sum(x^2) - sum(x)^2) / (n*(n-1))``: the sums are exact, so the result
    does not depend on how partial aggregates are merged (the same value on
    every run and every cluster layout); only the final division rounds.
    """
    x = F.col(c).cast("decimal(38,0)")
    n = F.count(F.col(c))
    num = (n * F.sum(x * x) - F.sum(x) * F.sum(x)).cast("double")
    return F.when(n > 1, num / (n * (n - 1)).cast("double"))


def sample_variances(df: DataFrame, key: str, cols) -> DataFrame:
    """Sample variance (n-1, NULLs skipped) of several columns per key.

    Integer columns use exact sums (order-independent); others use ``var_samp``.
    """
    integral = {"byte", "short", "integer", "long"}
    aggs = []
    for c in cols:
        if df.schema[c].dataType.typeName() in integral:
            aggs.append(_exact_var_samp(c).alias(f"var_{c}"))
        else:
            aggs.append(F.var_samp(c).alias(f"var_{c}"))
    return df.groupBy(key).agg(*aggs)


def total_count(df: DataFrame, out: str = "n") -> DataFrame:
    """A10: one-row total count."""
    return df.agg(F.count(F.lit(1)).alias(out))
