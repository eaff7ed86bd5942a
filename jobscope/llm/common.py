"""Helpers shared by the training-data operators: shared tables, code shipping, small expressions."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobscope.session import checkpoint_dir

#: ASCII white space that separates words (Java and Python regex syntax).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts lineage with a table that survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``written`` once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers (once per application)."""
    sc = spark.sparkContext
    if getattr(sc, "_jobscope_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="jobscope-ship-"), "jobscope_llm_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "jobscope")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._jobscope_shipped = True


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once (a one-element lambda binds it)."""
    return F.transform(F.array(value), body)[0]


def fold(doc_id: Column, parts: int = 4) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 2


def sampled(key: Column, share: float) -> Column:
    """Deterministic choice of about ``share`` of the keys."""
    return F.pmod(F.xxhash64(key, F.lit(77)), F.lit(1_000_000)) < int(min(1.0, share) * 1_000_000)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base
