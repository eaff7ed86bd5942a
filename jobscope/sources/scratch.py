"""Intermediate tables in the shared checkpoint folder: they cut lineage and outlive any executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from jobscope.session import checkpoint_dir


def keep(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` once as Parquet and read it back with its schema."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/scratch-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table made by :func:`keep` once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/scratch-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
