"""Quality rules: a learned decision list over whole-text statistics.

The statistics are Spark expressions. From labelled rows, sequential covering
learns ordered rules that reject: a rule grows by the threshold test with the
largest information gain (FOIL) on the growing part, is pruned from its end on the pruning part, and the
rows it covers leave before the next rule is sought. Every step is one
aggregation over the table of statistics, so nothing but sums reaches the driver.
The list is emitted as one ordered ``CASE WHEN`` expression.

Defined results: a null or empty text has no words, so the base test rejects it; null labels or
ids are not learned from; without labels of both kinds no rule is learned and the base test
alone decides; repeated rows are judged each; ties between tests go to the first by name and
threshold; only id and text are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import SPACE, WORD, fold, let, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
TESTED = ("symbol_rate", "dup_line_rate", "repeat_rate", "word_length", "upper_rate", "digit_rate", "mark_rate",
          "n_words", "line_words")


def _text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def repeated_words(words: Column) -> Column:
    """Words inside a window of ``WINDOW`` words that the text holds twice or more."""
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def count(s: Column) -> Column:
            shifted = F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(1)))
            twins = F.flatten(F.zip_with(s, shifted, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
                                         .otherwise(F.array().cast("array<int>"))))
            return let(F.array_sort(F.array_distinct(twins)), lambda p: F.aggregate(
                F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
                F.lit(0), lambda s_, x: s_ + x))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(placed, count))

    return let(F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW)))), covered)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the struct column ``s`` of whole-text statistics."""
    t = _text(F.col(text))
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))

    def made(w: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
        return let(lines, lambda ls: F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"), F.size(ls).cast("long").alias("n_lines"),
            letters.cast("long").alias("n_letters"), F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
            F.length(F.regexp_replace(t, "[^0-9]+", "")).cast("long").alias("n_digits"),
            F.length(F.regexp_replace(t, "[^!?.,;:]+", "")).cast("long").alias("n_marks")))

    words = F.array_remove(F.split(t, SPACE + "+"), "")
    return docs.withColumn("s", let(words, made))


def tested(s: str = "s") -> dict[str, Column]:
    """The values that rules may test, from the statistics."""
    c = {k: F.col(f"{s}.{k}") for k in (*BASE, "n_lines", "n_letters", "n_upper", "n_digits", "n_marks")}
    words, chars = F.greatest(c["n_words"], F.lit(1)), F.greatest(c["word_chars"], F.lit(1))
    return {"symbol_rate": c["n_symbols"] / words, "dup_line_rate": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1)),
            "repeat_rate": c["n_repeat_words"] / words, "word_length": c["word_chars"] / words,
            "upper_rate": c["n_upper"] / F.greatest(c["n_letters"], F.lit(1)), "digit_rate": c["n_digits"] / chars,
            "mark_rate": c["n_marks"] / words, "n_words": c["n_words"].cast("double"),
            "line_words": c["n_words"] / F.greatest(c["n_lines"], F.lit(1))}


@dataclass(frozen=True)
class Test:
    name: str
    above: bool
    at: float

    def column(self, values: dict[str, Column]) -> Column:
        return values[self.name] > self.at if self.above else values[self.name] <= self.at

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.at:.6g}"


def _all(tests, values: dict[str, Column]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t.column(values)
    return out


def learn(rows: DataFrame, thresholds: int = 24, max_rules: int = 6, max_tests: int = 3, min_precision: float = 0.6,
          min_cover: int = 8) -> list[tuple[Test, ...]]:
    """Ordered rejecting rules from rows (the ``TESTED`` values, bad 0/1, prune boolean)."""
    values = {k: F.col(k) for k in TESTED}
    cuts = rows.select(*(F.percentile_approx(k, [i / (thresholds + 1) for i in range(1, thresholds + 1)], 2000).alias(k)
                         for k in TESTED)).first()
    bad = rows.where("bad = 1").select(*(F.percentile_approx(k, [i / 9 for i in range(1, 9)], 2000).alias(k) for k in TESTED)).first()
    tests = [Test(k, up, v) for k in TESTED for v in sorted({*(cuts[k] or []), *(bad[k] or [])}) for up in (True, False)]
    rules: list[tuple[Test, ...]] = []

    def sums(where: Column, prune: bool, options) -> list[tuple[int, int]]:
        """(bad, good) rows that each option covers."""
        cols = []
        for i, o in enumerate(options):
            hit = _all(o, values)
            cols += [F.count(F.when(hit & (F.col("bad") == b), 1)).alias(f"c{i}_{b}") for b in (1, 0)]
        r = rows.where(where & (F.col("prune") == prune)).agg(*cols).first()
        return [(r[f"c{i}_1"], r[f"c{i}_0"]) for i in range(len(options))]

    left = F.lit(True)
    while len(rules) < max_rules:
        rule: tuple[Test, ...] = ()
        (p, n), = sums(left, False, [()])
        while p and n and len(rule) < max_tests:
            best, gain = None, 1e-9
            for t, (a, b) in zip(tests, sums(left & _all(rule, values), False, [(t,) for t in tests])):
                g = a * (math.log2(a / (a + b)) - math.log2(p / (p + n))) if a >= min_cover else 0.0
                if g > gain:
                    best, gain, after = t, g, (a, b)
            if best is None:
                break
            rule, (p, n) = (*rule, best), after
        if not rule:
            break
        heads = [rule[:k] for k in range(1, len(rule) + 1)]
        held = sums(left, True, heads)
        worth = [(a - b) / (a + b) if a + b else -1.0 for a, b in held]
        k = max(range(len(heads)), key=lambda i: (round(worth[i], 9), -i))
        a, b = held[k]
        if a + b == 0 or a / (a + b) < min_precision:
            break
        rules.append(heads[k])
        left = left & ~_all(heads[k], values)
    return rules


def verdict(rules: list[tuple[Test, ...]], values: dict[str, Column]) -> Column:
    """The decision list: the first rule that holds rejects, otherwise the text is kept."""
    out = None
    for rule in rules:
        hit = _all(rule, values)
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                  **settings) -> DataFrame:
    """(doc_id, the base statistics, base_failed, kept, rule) of every row.

    ``labels`` holds 1 for good and 0 for bad rows; one fold in four (crc32 of the id
    as text modulo 4 is 2) is never learned from, one (3) prunes.
    """
    s = written(statistics(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "s"),
                "statistics")
    s = s.withColumn("base_failed", (F.col("s.n_words") < 20)
                     | (F.lit(100) * F.col("s.n_repeat_words") > F.lit(30) * F.col("s.n_words")))
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).alias("y")).where(
        "doc_id is not null and y is not null").where(fold(F.col("doc_id")) != 2)
    rows = written(s.where("not base_failed").join(known, "doc_id").select(
        *(v.cast("double").alias(k) for k, v in tested().items()), (F.col("y") == 0).cast("int").alias("bad"),
        (fold(F.col("doc_id")) == 3).alias("prune")), "labelled")
    rules = learn(rows, **settings) if not rows.isEmpty() else []
    return s.select("doc_id", *(F.col(f"s.{k}").alias(k) for k in BASE), "base_failed",
                    (~F.col("base_failed") & verdict(rules, tested())).alias("kept"))
