"""Maximal repeated line runs against a comparison of all pairs of places, and the cases that need runs of any length."""

import re

import numpy as np
import pytest

from jobscope.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]")


def by_pairs(texts: list[str], min_lines: int, min_chars: int) -> list[tuple[str, int]]:
    """Every two places that agree, stretched to both sides; the later copy of a long enough run goes."""
    split = [t.split("\n") for t in texts]
    worded = [[i for i, x in enumerate(ls) if WORD.search(x)] for ls in split]
    seq = [[ls[i] for i in at] for ls, at in zip(split, worded)]
    gone = [set() for _ in texts]
    places = [(d, k) for d, s in enumerate(seq) for k in range(len(s))]
    for x, (a, i) in enumerate(places):
        for b, j in places[x + 1:]:
            if seq[a][i] != seq[b][j] or (i and j and seq[a][i - 1] == seq[b][j - 1]):
                continue  # no repeat, or not its start
            n = 0
            while i + n < len(seq[a]) and j + n < len(seq[b]) and seq[a][i + n] == seq[b][j + n]:
                n += 1
            if n >= min_lines and sum(map(len, seq[b][j:j + n])) >= min_chars:
                gone[b].update(worded[b][k] for k in range(j, j + n))
    return [("\n".join(x for i, x in enumerate(ls) if i not in g), len(g)) for ls, g in zip(split, gone)]


def cut(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [(r.text, r.n_removed) for r in sorted(line_dedup.dedup_lines(docs, **how).collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("min_lines, min_chars", [(1, 12), (3, 1), (2, 9), (1, 60)])
def test_random_sequences(spark, min_lines, min_chars):
    rng = np.random.default_rng(min_chars)
    pool = ["a", "bb", "ccc", "dddd e", "", "  ", "eleven char", "a line of seventeen"]
    texts = ["\n".join(rng.choice(pool, rng.integers(1, 40), p=[.25, .2, .15, .1, .1, .05, .1, .05])) for _ in range(25)]
    texts += ["\n".join(rng.choice(["x", "yy"], 90)), "\n".join(["x"] * 130), texts[0], "q\n" + texts[3]]
    assert cut(spark, texts, min_lines=min_lines, min_chars=min_chars) == by_pairs(texts, min_lines, min_chars)


def test_runs_of_short_lines_and_single_long_lines(spark):
    menu = "\n".join(f"item number {k:02d} of the menu" for k in range(20))
    line = "one line of many words " * 15
    texts = [menu, "before\n" + menu + "\nafter", "head\n" + line + "\ntail", line + "\nother", "item number 03 of the menu\nalone"]
    assert cut(spark, texts) == [(menu, 0), ("before\nafter", 20), (texts[2], 0), ("other", 1), (texts[4], 0)]


def test_very_long_text_of_short_lines(spark):
    text = "\n".join(f"{k * 7919 % 30011:x}" for k in range(30_000))
    got = cut(spark, [text, "other\n" + text + "\nend"])
    assert got == [(text, 0), ("other\nend", 30_000)]


def test_line_of_a_third_of_all_rows(spark):
    line = "This line stands in a very large number of documents of the table, unchanged."
    texts = [f"{line}\nown text {k}" if k % 3 == 0 else f"text {k}" for k in range(3000)]
    got = cut(spark, texts)
    assert got[0] == (texts[0], 0) and all(g == ((f"own text {k}", 1) if k % 3 == 0 else (texts[k], 0)) for k, g in enumerate(got) if k)
