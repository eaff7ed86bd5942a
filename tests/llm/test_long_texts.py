"""Texts beyond every internal piece length, against plain counts."""

import random
import struct
import zlib

from tokenizers import Tokenizer

from jobscope.llm import lang_id, near_dedup, packing, queries, suffix_dedup


def _words(seed, n, letters="abcdefghijklmnopqrstuvwxyz"):
    rng = random.Random(seed)
    return ["".join(rng.choices(letters, k=5)) for _ in range(n)]


def test_near_duplicates_of_long_texts(spark):
    long = _words(1, 310_000)
    rows = [(3, " ".join(long)), (2, " ".join([*long[:-1], "changed"])), (4, " ".join(long[:200_000])), (5, "a short text that nobody copied")]
    got = {r.doc_id: r for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        words = text.split(" ")
        assert got[doc_id].n_shingles == len(set(zip(*(words[k:] for k in range(5)))))
    assert {k: r.component_id for k, r in got.items()} == {2: 2, 3: 2, 4: 4, 5: 5}


def test_packing_cuts_long_texts_without_loss(spark):
    vocabulary = queries.vocabulary()
    rows = [(1, " ".join(_words(2, 80_000))), (2, "short"), (3, None)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), vocabulary).collect()
    coder = Tokenizer.from_file(vocabulary)
    longest = 0
    for doc_id, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        longest = max(longest, len(ids))
        at = 0
        for r in sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.start):
            part = ids[r.start:r.start + r.length]
            assert r.start == at and len(part) == r.length <= 2048 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    assert longest > packing.LONG
    filled = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048


def test_repeat_across_a_piece_border(spark):
    passage = " ".join(_words(3, 60))
    first, second = (" ".join(_words(k, 190_000)) for k in (4, 5))
    cut = suffix_dedup.PIECE - 120
    rows = [(1, first[:cut] + "#" + passage + "#" + first[cut:]), (2, "<" + passage + ">"), (3, second)]
    assert len(rows[0][1]) > suffix_dedup.PIECE + 1000
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(got[k].n_bytes, got[k].n_removed, got[k].n_spans) for k in (1, 2, 3)] == [
        (len(rows[0][1]), len(passage), 1), (len(passage) + 2, len(passage), 1), (len(second), 0, 0)]


def test_language_of_a_text_longer_than_a_slice(spark):
    made = {"xa": "abcdefgh", "xb": "nopqrstu"}
    rows = [(k, " ".join(_words(k, 80, made[lang])), lang) for k, lang in enumerate(["xa", "xb"] * 20)]
    rows += [(1000, " ".join(_words(1000, 150_000, made["xb"])), None), (1001, " ".join(_words(1001, 150_000, made["xa"])), None)]
    got = {r.doc_id: r for r in lang_id.identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1000].lang_pred == "xb" and got[1001].lang_pred == "xa"
