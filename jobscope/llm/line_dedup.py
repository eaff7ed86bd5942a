"""Maximal repeated line runs: a suffix array over line-id sequences by distributed prefix doubling.

Lines become 64-bit ids; lines without a word are no part of a sequence and stay. A line
that occurs once in the corpus ends every repeat, so only repeated lines go on. Doubling then
names the run of 1, 2, 4, ... lines that starts at each place, the name of a longer one being
made of two names, and classes met once drop out after every round. Two names that overlap
decide whether a run of any length in between recurs: the classes are the intervals of the
suffix order whose longest common prefix is at least that run.

A repeated run is as long as two places agree, to both sides. What is deleted are the lines of
every run that also occurs earlier, if it has at least ``min_chars`` characters and ``min_lines``
lines; one long line is enough by default. Such a run is the union of the shortest runs inside it
that start or end at one of its lines and reach both bounds. How long these are depends on
the run's own lines alone, so equal ones are met by one grouping per length class, and doubling ends at the
longest of them: no more than ``max(min_chars, min_lines)`` lines, as every line has a character.
The first copy stays, but for lines in which it overlaps a later one (a line repeated over and over keeps its first place).

Defined results: null and empty texts have no lines; documents are ordered by id (null
first), rows of one id by a hash of their text, and rows that repeat id and text are one
sequence, cut alike; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import WORD, discard, fresh, let, written


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _worded(text: Column) -> Column:
    """Lines of the sequence: those with a word."""
    return F.filter(_lines(text), lambda x: x.rlike(WORD))


def _row(doc_id: str, text: str) -> Column:
    """Documents in order: the id, then a hash of the text."""
    return F.struct(F.col(doc_id).cast("long").alias("d"), F.xxhash64(F.col(text)).alias("t"))


def _shortest(chars: Column, min_lines: int, min_chars: int) -> Column:
    """How many leading entries of ``chars`` reach both bounds (0: all together do not)."""
    enough = lambda a: (a["chars"] >= min_chars) & (a["n"] >= min_lines)
    return F.aggregate(chars, F.struct(F.lit(0).alias("n"), F.lit(0).alias("chars")),
                       lambda a, x: F.when(enough(a), a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["chars"] + x).alias("chars"))),
                       lambda a: F.when(enough(a), a["n"]).otherwise(0))


def _places(lines: Column, min_lines: int, min_chars: int) -> Column:
    """Per line: its name, and the lines of the shortest run that starts (``ahead``) and that ends (``back``) there."""
    most = max(min_lines, min_chars, 1)

    def place(cs: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            alone = (F.length(x) >= min_chars) & F.lit(min_lines <= 1)
            before = F.slice(cs, F.greatest(i + 2 - most, F.lit(1)), F.least(i + 1, F.lit(most)))
            return F.struct(F.xxhash64(x).alias("name"),
                            F.when(alone, 1).otherwise(_shortest(F.slice(cs, i + 1, most), min_lines, min_chars)).alias("ahead"),
                            F.when(alone, 1).otherwise(_shortest(F.reverse(before), min_lines, min_chars)).alias("back"))

        return F.transform(lines, one)

    return let(F.transform(lines, lambda x: F.length(x)), place)


def _classes(places: DataFrame, *key: str) -> DataFrame:
    """(key, head) of the keys met at two places or more; ``head`` is the first place."""
    at = F.struct("row", "k")
    return places.groupBy(*key).agg(F.min(at).alias("head"), F.max(at).alias("tail")).where("head != tail").drop("tail")


def _recurring(level: DataFrame, span: int) -> DataFrame:
    """(row, k, n) of the shortest runs of ``span`` to ``2 * span - 1`` lines that have an earlier copy."""
    fits = lambda c: F.col(c).between(span, 2 * span - 1)
    if span == 1:
        return level.where((F.col("ahead") == 1) & (F.struct("row", "k") != F.col("head"))).select("row", "k", F.lit(1).alias("n"))
    runs = level.where(fits("ahead")).select("row", "k", F.col("ahead").alias("n")).unionAll(
        level.where(fits("back")).select("row", (F.col("k") + span - F.col("back")).alias("k"), F.col("back").alias("n"))).distinct()
    ends = level.select("row", F.col("k").alias("last"), F.col("name").alias("next"))
    runs = runs.join(level.select("row", "k", "name"), ["row", "k"]).withColumn("last", F.col("k") + F.col("n") - span).join(ends, ["row", "last"])
    runs = written(runs.select("row", "k", "n", "name", "next"), "runs")
    return runs.join(_classes(runs, "n", "name", "next"), ["n", "name", "next"]).where(
        F.struct("row", "k") != F.col("head")).select("row", "k", "n")


def later_copies(docs: DataFrame, min_lines: int, min_chars: int, doc_id: str, text: str) -> DataFrame:
    """(row, gone): the places in the sequence of worded lines to delete of each row that has any."""
    row, lines = _row(doc_id, text).alias("row"), _worded(F.col(text))
    often = written(_classes(docs.select(row, F.posexplode(F.transform(lines, lambda x: F.xxhash64(x))).alias("k", "name")), "name"), "lines")
    seq = docs.select(row, F.posexplode(_places(lines, min_lines, min_chars)).alias("k", "x")).select("row", "k", "x.*")
    level = written(seq.join(often, "name").select("row", "k", F.xxhash64("head").alias("name"), "head", "ahead", "back").distinct(), "names")
    discard(often)
    span, found = 1, [written(_recurring(level, 1), "cuts")]
    while 2 * span <= max(min_lines, min_chars):
        # a place goes on if a shortest run of the next span or more can hold the doubled run there
        right = level.select("row", (F.col("k") - span).alias("k"), F.col("name").alias("next"), F.col("back").alias("end"))
        both = level.select("row", "k", "name", "ahead").join(right, ["row", "k"]).where(
            "ahead = 0 or end = 0 or ahead >= {0} or end >= {0}".format(2 * span))
        both = written(both, "pairs")
        named = written(both.join(_classes(both, "name", "next"), ["name", "next"]).select(
            "row", "k", F.xxhash64("head").alias("name"), "head", "ahead", F.col("end").alias("back")), "names")
        discard(level), discard(both)
        level, span = named, 2 * span
        if level.isEmpty():
            break
        found.append(written(_recurring(level, span), "cuts"))
    covered = F.explode(F.sequence(F.col("k"), F.col("k") + F.col("n") - 1))
    gone = reduce(DataFrame.unionAll, found).select("row", covered.alias("k"))
    return gone.groupBy("row").agg(F.array_sort(F.collect_set("k")).alias("gone"))


def dedup_lines(docs: DataFrame, min_lines: int = 1, min_chars: int = 60, doc_id: str = "doc_id", text: str = "text",
                removed: str = "n_removed") -> DataFrame:
    """``docs`` with later copies of maximal repeated line runs cut from ``text`` and the number of lines cut."""
    row, gone, removed = (fresh(docs, c) for c in ("line_row", "line_gone", removed))
    cuts = later_copies(docs, min_lines, min_chars, doc_id, text).select(
        F.col("row").alias(row), F.col("gone").alias(gone))
    wide = docs.withColumn(row, _row(doc_id, text)).join(cuts, row, "left")

    def keep(ls: Column) -> Column:
        """Lines less the deleted ones: numbers of worded lines, those at deleted places, all others by one hash set."""
        worded = F.filter(F.transform(ls, lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())
        cut = let(worded, lambda w: F.transform(F.col(gone), lambda k: F.get(w, k)))
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), cut), lambda i: F.get(ls, i)), "\n")

    out = F.when(F.col(gone).isNull(), F.col(text)).otherwise(let(_lines(F.col(text)), keep))
    return wide.select(*((out if c == text else F.col(c)).alias(c) for c in docs.columns),
                       F.greatest(F.size(gone), F.lit(0)).cast("long").alias(removed))
