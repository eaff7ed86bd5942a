"""One number in several layouts is one entity; calling codes stay; the whole result on a table."""

import re

from pyspark.sql import functions as F

from jobscope.llm import pii

SAME = [("4539578763621486", "4539 5787 6362 1486", "4539-5787-6362-1486"), ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00"),
        ("+12125551234", "+1 212 555 1234", "+1 (212) 555-1234", "+1-212-555-1234"), ("(212) 555-9876", "212-555-9876", "212.555.9876"),
        ("+493012345678", "+49 30 1234 5678"), ("+35312345678", "+353 1234 5678")]
CODES = {2: "+1", 4: "+49", 5: "+353"}


def test_layouts_of_one_number(spark):
    rows = [(10 * k + n, f"a {v}, b") for k, forms in enumerate(SAME) for n, v in enumerate(forms)]
    new = {r.doc_id: r.text[2:-3] for r in pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    bare = []
    for k, forms in enumerate(SAME):
        got = [new[10 * k + n] for n in range(len(forms))]
        assert len({re.sub(pii.LAYOUT, "", g) for g in got}) == 1, got
        for g, v in zip(got, forms):
            assert re.sub("[A-Z0-9]", "x", g) == re.sub("[A-Z0-9]", "x", v) and g != v and g.startswith(CODES.get(k, ""))
        bare.append(re.sub(pii.LAYOUT, "", got[0]))
    assert len(set(bare)) == len(SAME)


def test_whole_result_on_a_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plain = re.compile(r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-.]+|\+?[0-9][0-9 .()\-]{6,}[0-9]|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
    old = {r.doc_id: r.text for r in docs.collect()}
    cut = {r.doc_id: (r.g, r.f) for r in docs.select("doc_id", F.split("text", pii.ENTITY, -1).alias("g"), F.regexp_extract_all(
        "text", F.lit(pii.ENTITY), F.lit(0)).alias("f")).collect()}
    became, n = {}, 0
    for r in pii.replace_entities(docs, "k").collect():
        gaps, found = cut[r.doc_id]
        if not found:
            assert r.text == old[r.doc_id] and r.n_entities == 0
            continue
        fit = re.fullmatch("(.+?)".join(map(re.escape, gaps)), r.text, re.S)  # all but the entities is unchanged
        assert fit and r.n_entities >= len(found), r.doc_id
        n += len(found)
        for v, s in zip(found, fit.groups()):
            if plain.fullmatch(v):
                kind = "mail" if "@" in v else "number"
                v, s = (v, s) if kind == "mail" else (re.sub(pii.LAYOUT, "", v), re.sub(pii.LAYOUT, "", s))
                assert became.setdefault((kind, v), s) == s and s != v  # the same wherever it recurs
    assert n > 20 and len(set(became.values())) == len(became) and not set(became.values()) & {v for _, v in became}
