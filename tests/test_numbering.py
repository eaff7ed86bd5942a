"""Exact row numbers over written ranges: strings with a common prefix, outliers, ties, hot groups."""

from pyspark.sql import functions as F

from jobscope.operators.numbering import number_rows, sorted_ranges
from jobscope.sources.scratch import keep


def _stored(spark, rows, schema):
    return keep(spark.createDataFrame(rows, schema).repartition(5))


def _expected(rows, key, order):
    out, seen = {}, {}
    for r in sorted(rows, key=order):
        seen[key(r)] = seen.get(key(r), 0) + 1
        out[r] = seen[key(r)]
    return out, seen


def test_common_prefix_outlier_and_ties_spread_over_all_ranges(spark):
    n = 24_000
    df = keep(spark.range(n).select(F.concat(F.lit("DS-A-JOB-"), F.lpad((F.col("id") * 7919 % n).cast("string"), 6, "0")).alias("s"),
                                    F.when(F.col("id") == 5, F.lit(10**17)).otherwise(F.col("id") * 31 % 9973).alias("v"),
                                    F.lit("same").alias("t")))
    for order in (["s"], ["v", "s"], ["t"]):
        rows, part, place = sorted_ranges(df, order, rows_per_range=2000)
        sizes = [r["count"] for r in rows.groupBy(part).count().collect()]
        assert len(sizes) >= 10 and max(sizes) < 3 * n / len(sizes), (order, sizes)
    got = number_rows(df, ["s"], name="rn", rows_per_range=2000)
    assert got.where(F.col("rn") != F.substring("s", -6, 6).cast("long") + 1).count() == 0
    assert got.agg(F.count("rn"), F.countDistinct("rn"), F.max("rn")).first() == (n, n, n)


def test_numbers_inside_groups_with_nulls_and_a_hot_group(spark):
    rows = [(k, o, f"x{i}") for i, (k, o) in enumerate([("hot", i * 37 % 1000) for i in range(3000)]
            + [(None, i % 7) for i in range(50)] + [("b", None), ("b", 3), ("b", 1), ("", 2)])]
    df = _stored(spark, rows, "k string, o long, tie string")
    got = {(r.k, r.o, r.tie): (r.rn, r.n) for r in number_rows(df, ["o", "tie"], ["k"], "rn", "n", rows_per_range=300).collect()}
    want, size = _expected(rows, lambda r: r[0], lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert got == {r: (want[r], size[r[0]]) for r in rows}


def test_descending_repeated_and_empty(spark):
    df = _stored(spark, [(1,), (1,), (2,), (None,)], "v int").withColumn("place", F.lit("taken"))
    assert sorted((r.rn, r.v) for r in number_rows(df, [F.col("v").desc()], name="rn").collect()) == [(1, 2), (2, 1), (3, 1), (4, None)]
    assert number_rows(df.limit(0), ["v"]).collect() == []
