"""Corpus pipeline: toxicity, line dedup, near-duplicates, benchmark decontamination, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the
documents it keeps with their columns, the last one the packed pieces. ``run`` applies
them in order to ``documents``, each result written as a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobscope.llm import decontam, line_dedup, near_dedup, packing, toxicity
from jobscope.llm.common import WORD, fresh, written
from jobscope.llm.queries import vocabulary
from jobscope.sources.tables import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below 0.3."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs.

    A document that consists of later copies alone goes; ``n_chars``, if there, follows the text.
    """
    count = fresh(docs, "n_removed")
    cut = line_dedup.dedup_lines(docs, removed=count)
    cut = cut.where((F.col(count) == 0) | F.col("text").rlike(WORD))
    if "n_chars" in cut.columns:
        kind = dict(cut.dtypes)["n_chars"]
        cut = cut.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group; of rows with one id and text, one as well."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    out = fresh(docs, "decontamination")
    flagged = decontam.flag_contaminated(docs, table(spark, sf_dir, "benchmark"), out=out)
    return flagged.where(~F.col(out)["contaminated"]).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [("toxicity", drop_toxic), ("line_dedup", cut_repeated_lines), ("near_dedup", one_of_each),
          ("decontamination", drop_contaminated), ("packing", pack)]

#: The first stage's learned model and the third's similarity closure are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
