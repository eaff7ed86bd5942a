"""Rows that share an id but not the text are documents of their own."""

import numpy as np

from jobscope.llm import near_dedup


def test_one_id_with_two_texts(spark):
    rng = np.random.default_rng(4)
    words = [" ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(60)) for _ in range(4)]
    a, b, c, d = words
    rows = [(7, a), (7, b), (3, a + " end"), (8, c), (8, c), (8, d), (9, d), (7, None), (None, c), (None, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    kept = sorted(((r.doc_id, r.text) for r in near_dedup.keep_one(docs).collect()), key=key)
    assert kept == sorted([(3, a + " end"), (7, b), (7, None), (8, c), (8, d), (None, c), (None, c)], key=key)
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).where("doc_id is not null and n_shingles > 0").collect()))
    assert got == sorted([(3, 3, True), (7, 3, False), (7, 7, True), (8, 8, True), (8, 8, True), (8, 8, True), (9, 8, False)])


def test_links_across_blocks_carry_the_text_hash(spark):
    rng = np.random.default_rng(6)
    base = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(200)]
    rows = [(k % 3, " ".join(w if i % 200 != 7 * k else f"new{k}" for i, w in enumerate(base))) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sig = near_dedup.signatures(docs.select(near_dedup._node("doc_id", "text").alias("doc_id"), "text"), 5, 40, 5).cache()
    left = sig.selectExpr("1L as key", "doc_id as rep", "doc_id as comp")
    links = near_dedup._across(left, sig, docs.select(near_dedup._node("doc_id", "text").alias("doc_id"), "text"), 5, 75, block=4).collect()
    assert links and all(x.a < x.b for x in links)
    assert near_dedup.keep_one(docs).count() == 1


def test_filter_before_the_shuffle_keeps_every_wanted_row(spark):
    rows = spark.range(20_000).selectExpr("named_struct('d', id % 15000, 't', id * 7919) as id", "concat('x', id) as text")
    ids = rows.where("id.t % 40 = 0").select("id")
    for bits in (32, 1):  # a crowded table lets more rows pass, never fewer
        got = near_dedup._maybe_in(rows, ids, bits_per_id=bits)
        assert got.join(ids, "id", "left_semi").count() == ids.count() == 500
        assert got.count() < (700 if bits == 32 else 20_000)
    assert near_dedup._maybe_in(rows, ids.limit(0)).count() == 0
