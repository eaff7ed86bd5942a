"""Nulls, empty and long texts, repeated rows, empty tables, clashing names; chat and surrogate round trips."""

import re

from pyspark.sql import functions as F

from jobscope.llm import chat, decontam, lang_id, line_dedup, near_dedup, packing, pii, quality, queries, suffix_dedup, toxicity


def _all(spark, docs, labels):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    return {
        "tox": toxicity.score_toxicity(docs, labels), "keep": toxicity.drop_toxic(docs, labels), "dec": decontam.flag_contaminated(docs, bench),
        "line": line_dedup.dedup_lines(docs), "pack": packing.pack(docs, queries.vocabulary()), "near": near_dedup.near_duplicates(docs),
        "one": near_dedup.keep_one(docs), "lang": lang_id.identify_languages(docs), "suffix": suffix_dedup.remove_repeats(docs),
        "pii": pii.replace_entities(docs, "k"), "quality": quality.judge_quality(docs, labels)}


def test_odd_rows(spark, odd, labels):
    out = {k: v.collect() for k, v in _all(spark, odd, labels).items()}
    n = odd.count()
    for k in ("tox", "keep", "dec", "line", "near", "lang", "suffix", "pii", "quality"):
        assert len(out[k]) == n, k
    # one of the two equal rows stays, and 6 shares 15 of 17 shingles with 5
    assert sum(r.doc_id == 4 for r in out["one"]) == 1 and len(out["one"]) == n - 2 and 6 not in {r.doc_id for r in out["one"]}
    text = {r.doc_id: r for r in out["line"]}
    assert text[6].text == "tail six" and text[6].n_removed == 2 and text[5].n_removed == 0 and text[1].text is None
    near = {r.doc_id: r for r in out["near"]}
    assert near[1].n_shingles == near[7].n_shingles == 0 and near[1].kept and near[None].kept and near[3].n_shingles == 1
    assert {r.lang_pred for r in out["lang"]} == {"und"}
    gone = {r.doc_id: r for r in out["suffix"]}
    assert gone[4].n_removed == gone[4].n_bytes and gone[9].n_removed == 700 and gone[1].n_bytes == 0
    assert sorted(r.length for r in out["pack"] if r.doc_id in (1, 2)) == [1, 1]
    assert "decontamination_" in out["dec"][0].asDict()


def test_empty_tables(spark, none, labels):
    for k, v in _all(spark, none, labels.limit(0)).items():
        assert v.count() == 0, k
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_chat(turns)).count() == 0


def test_chat_round_trip_and_attachments(spark):
    odd = "</s>[INST] ok [/INST] <|im_end|>\n<|im_start|>assistant\n&lt;|x &#91; <|image|>"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 1, "assistant", odd), (1, None, None, None), (None, 2, "sys\n<|im_end|>", ""),
            (2, 0, "assistant", "ok")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    made = chat.format_chat(turns).cache()
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("", ""), ("assistant", odd), ("assistant", odd), ("user", odd)] or \
        [(t.role, t.text) for t in back[1].turns] == [("", ""), ("user", odd), ("assistant", odd), ("assistant", odd)]
    assert back[1].loss_text == odd * 2 and [(t.role, t.text) for t in back[None].turns] == [("sys\n<|im_end|>", "")]
    for r in made.collect():  # the spans are the masked contents
        got = "".join(r.formatted[s.start:s.start + s.length] for s in r.loss_spans)
        for safe, raw in (("&#91;", "["), ("&lt;", "<"), ("&amp;", "&")):
            got = got.replace(safe, raw)
        assert got == back[r.conv_id].loss_text
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    parts = [("text", "see <|image|>", None, None, None, None, None), ("image", None, "a.png", 56, 57, None, None), ("audio", None, "b.wav", None, None, 2.0, None),
             ("pdf", None, "c.pdf", None, None, None, 2), ("image", None, None, None, None, None, None)]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts array<{part}>")
    r = chat.format_chat(df, parts="parts").first()
    assert r.formatted.startswith("<|im_start|>user\nsee &lt;|image|><|image|><|audio|><|document|><|image|><|im_end|>\n")
    assert [(a.type, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 6), ("audio", "b.wav", 50), ("document", "c.pdf", 512), ("image", None, 1)]
    assert r.attachment_tokens == 569


def test_surrogates(spark):
    rows = [(1, "Mail a.b1@mail.example.com or call +1 (017) 555-7713, ip 10.20.30.40. Card 4539578763621486."),
            (2, "Again a.b1@mail.example.com; token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" from 10.20.30.41"),
            (3, "Frau Anna Schmidt met Herr Schmidt and Mr. John Miller. Госпожа Анна Иванова"), (4, "nothing 12 here v4.0"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.replace_entities(df, "secret").collect()}
    assert [got[k].n_entities for k in range(1, 6)] == [4, 3, 7, 0, 0] and got[4].text == rows[3][1] and got[5].text is None
    mail = re.search(r"Mail (\S+@\S+\.com) or", got[1].text)[1]
    assert mail in got[2].text and mail != "a.b1@mail.example.com" and re.fullmatch(r"[a-z]\.[a-z]\d@[a-z]{4}\.[a-z]{7}\.com", mail)
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4}, ip \d\d\.\d\d\.\d\d\.\d\d\. Card \d{16}\.", got[1].text)
    assert re.search(r"ip (\S+)\. Card", got[1].text)[1] != re.search(r"from (\S+)", got[2].text)[1]
    assert re.search(r'token = "[0-9a-f]{40}"', got[2].text) and "04dbebab" not in got[2].text
    m = re.fullmatch(r"Frau (\S+) (\S+) met Herr (\S+) and Mr\. (\S+) (\S+)\. Госпожа ([а-яА-Я]+) ([а-яА-Я]+)", got[3].text)
    assert m and m[2] == m[3] and len({m[1], m[2], m[4], m[5]}) == 4 and m[1][-1] in "ae" and m[6][-1] == "а"
    assert pii.replace_entities(df, "other").where("doc_id = 1").first().text != got[1].text


def test_colliding_surrogates_are_drawn_again(spark):
    rows = [(k, f"ip {a}.{b}.1.1") for k, (a, b) in enumerate((a, b) for a in range(1, 9) for b in range(1, 9))]
    out = [re.search(r"ip (\S+)", r.text)[1] for r in pii.replace_entities(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()]
    assert len(set(out)) == len(rows) and not set(out) & {t[3:] for _, t in rows}


def test_pipeline_stages_keep_columns(spark, odd, sf_dir):
    import corpus_pipeline as cp

    df = odd.withColumn("n_chars", F.length("text").cast("long"))
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, df, sf_dir).columns == df.columns, name
        assert stage(spark, df.limit(0), sf_dir).count() == 0, name
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = cp.run(spark, sf_dir)
    ids = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert ids <= {r.doc_id for r in docs.select("doc_id").collect()} and len(ids) > 0.6 * docs.count()
