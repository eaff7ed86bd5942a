"""Readers for delimited reports and source extracts.

Every reader declares its schema (all strings at the text edge) and never
infers it; typing happens afterwards with ``try_*`` expressions, so a bad
field becomes NULL instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def string_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


def read_report(spark: SparkSession, path, columns: Sequence[str], sep: str = ",",
                header: bool = True, quote: str = '"') -> DataFrame:
    """Header CSV (UTF-8) with a declared all-string layout.

    ``path`` may be a list of files: each file's own header line is dropped (S3),
    which fixes the reference's concatenation that loaded the second header as data.
    """
    return (spark.read.schema(string_schema(columns)).option("header", header).option("sep", sep)
            .option("quote", quote).option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path))


def load_delimited(spark: SparkSession, path, n_fields: int, mapping: Mapping[str, Column | str],
                   sep: str = ",", header: bool = False, quote: str | None = '"') -> DataFrame:
    """Positional fields ``c1..cN`` mapped by ``SET col = expr``.

    ``mapping`` values are Columns over ``c1..cN`` or SQL text. No data row is
    ever skipped (the reference's "ignore 1 line" on header-less files dropped one).
    """
    r = spark.read.schema(string_schema([f"c{i}" for i in range(1, n_fields + 1)])).option("header", header) \
        .option("sep", sep)
    r = r.option("quote", quote if quote is not None else "\u0000")
    df = r.csv(path)
    return df.select(*[(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()])


def read_checked(spark: SparkSession, path, columns: Sequence[str], sep: str = ",", header: bool = False,
                 quote: str | None = '"') -> tuple[DataFrame, DataFrame]:
    """S1–S4 with a second output: (rows, rejected).

    A line with another number of fields than ``columns`` is rejected, not padded or cut: it
    comes out as (file_name, first_field, line). ``rows`` has the columns and ``file_name``. Both read the
    same files; nothing is collected, so a file may be wrong from end to end.
    """
    bad = "__rejected_line"
    schema = StructType([*string_schema(columns).fields, StructField(bad, StringType(), True)])
    df = (spark.read.schema(schema).option("header", header).option("sep", sep).option("quote", quote if quote is not None else "\u0000")
          .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
          .option("columnPruning", False).csv(path))  # a line's fields are counted whatever columns a query reads
    df = df.withColumn("file_name", F.col("_metadata.file_name"))
    # a query that reads nothing but the rejected text is refused by the CSV source, so its value leans on the first field
    # (of which it takes no character)
    line = F.concat(F.substring(F.coalesce(F.col(columns[0]), F.lit("")), 1, 0), F.col(bad))
    df = df.withColumn("__line", line)
    rejected = df.filter(F.col("__line").isNotNull()).select("file_name", F.col(columns[0]).alias("first_field"), F.col("__line").alias("line"))
    return df.filter(F.col("__line").isNull()).drop(bad, "__line"), rejected


def load_checked(spark: SparkSession, path, n_fields: int, mapping: Mapping[str, Column | str], sep: str = ",",
                 header: bool = False, quote: str | None = '"') -> tuple[DataFrame, DataFrame]:
    """S2 with rejected lines: (mapped rows, rejected); see :func:`read_checked`."""
    rows, rejected = read_checked(spark, path, [f"c{i}" for i in range(1, n_fields + 1)], sep, header, quote)
    return rows.select(*[(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in mapping.items()]), rejected


def read_dated_checked(spark: SparkSession, folder: str, pattern: str, columns: Sequence[str], sep: str = ";", header: bool = False,
                       exclude: str = "TMP", date_col: str = "data_car") -> tuple[DataFrame, DataFrame]:
    """S4 with rejected lines: rows get the date in their file's name; names containing ``exclude`` are skipped in both."""
    rows, rejected = read_checked(spark, f"{folder.rstrip('/')}/{pattern}", columns, sep, header)
    day = F.to_date(F.try_to_timestamp(F.split(F.col("file_name"), r"\.").getItem(1), F.lit("yyyyMMdd")))
    keep = ~F.col("file_name").contains(exclude)
    return rows.filter(keep).withColumn(date_col, day).drop("file_name"), rejected.filter(keep)


def concat_reports(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """S3: several reports of one layout, one header each, read as one frame."""
    return read_report(spark, list(paths), columns, sep=sep, header=True)


def read_dated_files(spark: SparkSession, folder: str, pattern: str, columns: Sequence[str], sep: str = ";",
                     header: bool = False, exclude: str = "TMP", date_col: str = "data_car") -> DataFrame:
    """Every file matching ``pattern`` in ``folder`` (names containing ``exclude``
    skipped); the load date is cut from the file name (``NAME.yyyyMMdd.ext``)."""
    df = (spark.read.schema(string_schema(columns)).option("header", header).option("sep", sep)
          .option("quote", '"').csv(f"{folder.rstrip('/')}/{pattern}"))
    name = F.col("_metadata.file_name")
    df = df.withColumn("__file", name).filter(~F.col("__file").contains(exclude))
    day = F.to_date(F.try_to_timestamp(F.split(F.col("__file"), r"\.").getItem(1), F.lit("yyyyMMdd")))
    return df.withColumn(date_col, day).drop("__file")


def extract_table(spark: SparkSession, sources: Mapping[str, object], tag_col: str = "source",
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Pull one table from several sources, tag each with its source name, union.

    A source is a DataFrame, a Parquet path, or a dict of JDBC options
    (``url``, ``dbtable``/``query``, and for a parallel read ``partitionColumn``,
    ``lowerBound``, ``upperBound``, ``numPartitions``).
    """
    parts = []
    for tag, src in sources.items():
        if isinstance(src, DataFrame):
            df = src
        elif isinstance(src, str):
            df = spark.read.parquet(src)
        else:
            df = spark.read.format("jdbc").options(**dict(src)).load()
        if columns is not None:
            df = df.select(*columns)
        parts.append(df.withColumn(tag_col, F.lit(tag)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
