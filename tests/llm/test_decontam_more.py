"""Tokens of scripts without blanks and of typographic marks; every pattern that the tolerance allows."""

from itertools import combinations

import numpy as np
import pytest

from jobscope.llm import decontam


def test_tokens_of_other_marks_and_scripts():
    def same(x, y):
        return decontam.token_hashes(x).tolist() == decontam.token_hashes(y).tolist()

    assert same("l\u2019homme \u201cdit\u201d", "l'homme \"dit\"") and same("word\u2014word\u00a0one", "word-word one")
    assert same("caf\u00e9 x1 \u00e9", "CAF\u00c9, x1; \u00c9") and len(decontam.token_hashes("cafe\u0301 \u0939\u093f\u0928\u094d\u0926\u0940")) == 2
    assert len(decontam.token_hashes("\u4f60\u597d\uff0c\u4e16\u754cabc1\u3002")) == 5 and len(decontam.token_hashes("\u201c\u2014\u201d \U0001f600\ufe0f")) == 0
    assert same("\U00020000 a \U0001f600 b", "\U00020000 a b") and same("abc", "\u2019abc")


def test_unspaced_scripts_and_curly_quotes_are_found(spark):
    han = "\u5b66\u800c\u65f6\u4e60\u4e4b\u4e0d\u4ea6\u8bf4\u4e4e\u6709\u670b\u81ea\u8fdc\u65b9\u6765\u4e0d\u4ea6\u4e50\u4e4e"
    thai = "\u0e20\u0e32\u0e29\u0e32\u0e44\u0e17\u0e22\u0e40\u0e1b\u0e47\u0e19\u0e20\u0e32\u0e29\u0e32\u0e17\u0e35\u0e48\u0e21\u0e35"
    french = "l'homme qui n'avait pas d'amis s'est assis \"seul\" dans l'ombre d'un arbre"
    bench = spark.createDataFrame([(1, han), (2, thai), (3, french)], "item_id long, text string")
    rows = [(0, "\u4ed6\u8bf4\uff1a" + han[:6] + "\u6211" + han[7:] + "\u3002"), (1, "\u0e02\u0e49\u0e32" + thai), (2, "Il dit: " + french.replace("'", "\u2019")),
            (3, "\u6211\u4eec\u5728\u8fd9\u91cc\u5403\u996d\uff0c\u4eca\u5929\u5929\u6c14\u5f88\u597d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (2_000_000, 20):
        out = decontam.flag_contaminated(docs, bench, block_tokens=size).collect()
        assert {r.doc_id: r.decontamination.item_ids for r in out} == {0: [1], 1: [2], 2: [3], 3: []}


def test_block_sizes_count_tokens(spark):
    bench = spark.createDataFrame([(k, "\u5b66" * 30) for k in range(4)], "item_id long, text string")
    assert [len(b) for b in decontam._blocks(bench, "item_id", "text", 60)] == [2, 2]


@pytest.mark.parametrize("size, wrong", [(13, 3), (12, 3), (11, 2)])
def test_masks_meet_every_allowed_pattern(size, wrong):
    item = decontam.token_hashes(" ".join(f"w{i}" for i in range(size)))
    index = decontam.SeedIndex([(1, " ".join(f"w{i}" for i in range(size)))], decontam.MASKS, 5)
    for k in range(wrong + 1):
        for places in combinations(range(size), k):
            doc = np.concatenate([np.arange(1, 8, dtype=np.uint64), item, np.arange(8, 15, dtype=np.uint64)])
            doc[7 + np.array(places, int)] = 0
            covered, found = index.judge(doc, 13, 0.75)
            assert found == {1} and np.flatnonzero(covered).tolist() == list(range(7, 7 + size)), places


def test_hits_in_small_chunks():
    index = decontam.SeedIndex([(k, "a b c d e f g h i j k l m n") for k in range(9)], decontam.MASKS, 5)
    doc = decontam.token_hashes("x a b c d e f g h i j k l m n " * 4)
    whole, small = index.diagonals(doc), index.diagonals(doc, 3)
    assert all((x == y).all() for x, y in zip(whole, small)) and index.judge(doc, 13, 0.75)[1] == set(range(9))
