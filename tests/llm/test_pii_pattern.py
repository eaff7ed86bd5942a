"""The quick form of the entity pattern finds what the plain union of its kinds finds."""

from pyspark.sql import functions as F

from jobscope.llm import pii

ODD = ["Mr Al Bo@x.com", "x +49 30 123456", "Госпожа Анна Иванова", "GB29NWBK60161331926819", "api_key: abcdefghijklmnop1", "none", None, "",
       "10.0.0.1", "(212) 555-1234", "key=abcdefghijklmnopqrstuvw.x@foo.com 123@foo.com a.b+c@d.co", "1234-5678-1234-5678x@y.org",
       "a@b@c.com x@y.com@z.org..q@r.io 10.1.2.3@host.net token=0123456789abcdef0@x.com", "+1 555 1234567@foo.com", "123-45-6789", "mytoken=short"]


def test_quick_pattern_equals_plain_union(spark, sf_dir):
    plain = "|".join(f"(?:{p})" for p in pii.KINDS.values())
    t = F.col("text")
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").unionAll(
        spark.createDataFrame([(x,) for x in ODD], "text string"))
    found = rows.select(F.regexp_extract_all(t, F.lit(plain), F.lit(0)).alias("old"), pii._has_entity(t).alias("hit"),
                        F.regexp_extract_all(t, F.lit(pii.ENTITY), F.lit(0)).alias("new")).collect()
    assert any(r["hit"] for r in found)
    for r in found:
        assert r["old"] == r["new"] and r["hit"] == bool(r["old"])
