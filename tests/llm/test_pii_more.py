"""Entities in upper case and in their printed groups; surrogates of types whose first pool is too small."""

import re

import pytest
from pyspark.sql import functions as F

from jobscope.llm import pii

PRINTED = {
    'TOKEN = "9233A8EC0D5B47A1B6C2F00D12345678"': "9233A8EC0D5B47A1B6C2F00D12345678", "PASSWORD=Abcdefghij0123456": "Abcdefghij0123456",
    "API_KEY: abcdefghijklmnop1": "abcdefghijklmnop1", "Secret: abcdefghij+/klmnop1": "abcdefghij+/klmnop1",
    "pay DE89 3704 0044 0532 0130 00 now": "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947, yes": "NO93 8601 1117 947",
    "AT61 1904 3002 3457 3201 AM 3. MAI": "AT61 1904 3002 3457 3201", "GB29 NWBK 6016 1331 9268 19.": "GB29 NWBK 6016 1331 9268 19",
    "ZZ11 1234 1234 1234 12": "ZZ11 1234 1234 1234 12", "card 3782 822463 10005.": "3782 822463 10005", "3782-822463-10005": "3782-822463-10005",
}


def test_upper_case_and_printed_groups(spark):
    plain = "|".join(f"(?:{p})" for p in pii.KINDS.values())
    df = spark.createDataFrame([(k, t) for k, t in enumerate(PRINTED)], "doc_id long, text string")
    t = F.col("text")
    for r in df.select("text", F.regexp_extract_all(t, F.lit(plain), F.lit(0)).alias("old"), pii._has_entity(t).alias("hit"),
                       F.regexp_extract_all(t, F.lit(pii.ENTITY), F.lit(0)).alias("new")).collect():
        assert r.hit and r.old == r.new and len(r.new) == 1 and r.new[0].endswith(PRINTED[r.text]), r
    for r in pii.replace_entities(df, "k").collect():
        before = list(PRINTED)[r.doc_id]
        value = PRINTED[before]
        at = before.index(value)
        new = r.text[at:at + len(value)]
        assert r.n_entities == 1 and len(r.text) == len(before) and r.text[:at] + value + r.text[at + len(value):] == before
        assert [c.isalnum() for c in new] == [c.isalnum() for c in value] and new != value
        if " " in value and value[:2].isalpha():
            assert new[:2] == value[:2]
        if re.fullmatch("[0-9A-F]+", value):
            assert re.fullmatch("[0-9A-F]+", new)


def test_plain_words_are_no_entities(spark):
    rows = [("AB12 THIS WORD WILL STAY HERE",), ("1234 123456 123",), ("SECRET: SHORT",)]
    assert not any(r[0] for r in spark.createDataFrame(rows, "text string").select(pii._has_entity(F.col("text"))).collect())


@pytest.mark.parametrize("kind, values, shape", [
    ("ip", [f"{a}.{b}.{c}.{d}" for a in range(1, 9) for b in range(1, 9) for c in range(1, 9) for d in range(1, 9)], r"(\d{1,3}\.){3}\d{1,3}"),
    ("email", [f"{a}@{b}.com" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"], r"[a-z]+@[a-z]\.com"),
    ("phone", [f"+1 {n // 100:02d} {n % 100:02d}" for n in range(10_000)], r"\+1 \d\d \d{2,4}"),
    ("secret", ["_" * 16, "-" * 16], r"[_-]{16}[a-z]+"),
    ("family_any", [f"Name{n}" for n in range(130_000)], r"[A-Z][a-z]+")])
def test_more_entities_than_the_first_pool(spark, kind, values, shape):
    df = spark.createDataFrame([(v,) for v in values], "value string").select(F.lit(kind).alias("kind"), "value")
    new = [r.surrogate for r in pii._distinct_surrogates(df, "k", 50).collect()]
    assert len(new) == len(set(new)) == len(values) and not set(new) & set(values) and all(re.fullmatch(shape, x) for x in new)
