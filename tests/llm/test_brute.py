"""Each operator against a brute-force version or an exact round trip on the small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobscope.llm import decontam, lang_id, near_dedup, packing, quality, queries, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_near_duplicates(docs, texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for k, t in texts.items():
        w = WORD.findall((t or "").translate(low))
        sets[k] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def test_super_minhash_estimates_and_matches_the_sequential_walk():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b, tiny = pool[:600], pool[200:800], pool[:3]
    sig = near_dedup.super_minhash(np.concatenate([a, b, tiny]), np.repeat([0, 1, 2], [600, 600, 3]), 3, 256)
    assert np.isfinite(sig).all() and abs((sig[0] == sig[1]).mean() - 0.5) < 0.1
    alone = near_dedup.super_minhash(tiny, np.zeros(3, int), 1, 256)
    assert (alone[0] == sig[2]).all()


def test_spanning_links_joins_what_brute_force_joins():
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(0, 2**63, 100, dtype=np.uint64))
    sets = []
    for k in range(30):
        s = base.copy()
        s[rng.choice(100, k % 20, False)] = rng.integers(0, 2**63, k % 20, dtype=np.uint64)
        sets.append(np.unique(s))
    own = np.repeat(np.arange(30), [len(s) for s in sets])
    sig = near_dedup.super_minhash(np.concatenate(sets), own, 30, 200)
    bits = near_dedup.mix64(np.ascontiguousarray(sig).view(np.uint64)).astype(np.uint8)
    all_ = np.arange(30)
    links = near_dedup.spanning_links(all_, all_, bits, sets, all_, all_, 75)

    def groups(edges):
        lab = list(range(30))
        for a, b in edges:
            lab = [lab[a] if x == lab[b] else x for x in lab]
        return {frozenset(i for i in range(30) if lab[i] == g) for g in lab}

    want = [(i, j) for i in range(30) for j in range(i) if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 75 * (len(sets[i]) + len(sets[j]) - n)]
    assert groups(links) == groups(want) and len(links) <= 29


@pytest.mark.parametrize("bucket", [20_000, 2])
def test_suffix_dedup(docs, texts, bucket):
    raw = {k: (t or "").encode() for k, t in texts.items()}
    seen = Counter(t[i:i + 200] for t in raw.values() for i in range(len(t) - 199))
    want = {}
    for k, t in raw.items():
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want[k] = (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    out = suffix_dedup.remove_repeats(docs, bucket=bucket)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()} == want


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.vocabulary())
    rows = packing.pack(docs, queries.vocabulary(), group_docs=50, with_ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_doc[r.doc_id].append(r), by_seq[r.sequence_id].append((r.offset, r.length))
    for k, t in texts.items():
        ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in sorted(by_doc[k], key=lambda r: r.start)])
        assert ids.tolist() == tok.encode(t or "", add_special_tokens=False).ids + [1]
    full = 0
    for pieces in by_seq.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
        full += at == 2048
    assert len(by_seq) - full <= -(-len(texts) // 50)


def test_word_tokenizer_on_odd_texts():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(queries.vocabulary()), packing.WordTokenizer(queries.vocabulary())
    for t in ("It's  a test", "Ábc ́x", "<|endoftext|> a<|ENDOFTEXT|>", "x\x1cy z", "ΣΑΣ İstanbul ß µ", "　日本 12 3½", "you'll WE'RE", " ",
              "L'ÉTÉ «déjà»--'s ª1²3 µÞß ×÷\xad x_y __ 'S'T\t\x0bend\r\n", "caf\xa0é\x85z", "".join(map(chr, range(33, 127))) + "".join(map(chr, range(161, 256)))):
        assert np.frombuffer(own.ids(t), own.dtype).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_every_latin_pair_tokenises_alike():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(queries.vocabulary()), packing.WordTokenizer(queries.vocabulary())
    some = [*"aZ9 '_<|-\n", *map(chr, range(0xa1, 0x100))]
    text = " ".join(a + b + c for a in "a1'-s" for b in some for c in some)
    assert packing._LATIN.fullmatch(text)
    for part in (text[i:i + 5000] for i in range(0, len(text), 5000)):
        assert np.frombuffer(own.ids(part), own.dtype).tolist() == tok.encode(part, add_special_tokens=False).ids


def test_memo_and_stretches_change_nothing(monkeypatch):
    whole = packing.WordTokenizer(queries.vocabulary())
    text = " ".join(f"Word{i % 37}x, {'日本' if i % 50 == 0 else ''}(it's)\n" for i in range(900)) + "z" * 500
    want = whole.ids(text)
    monkeypatch.setattr(packing, "STRETCH", 100), monkeypatch.setattr(packing, "MEMO_WORDS", 5)
    small = packing.WordTokenizer(queries.vocabulary())
    assert small.ids(text) == want and len(small.pieces) <= 6 and len(small.pieces.older) <= 6


def test_equal_rows_and_long_texts_spread_over_groups(spark):
    from jobscope.llm.common import written

    same = written(spark.range(20_000).selectExpr("cast(null as long) as doc_id", "'one two three' as text"))
    rows = packing.pack(same, queries.vocabulary()).selectExpr("sequence_id div 4294967296 as grp", "length").groupBy("grp").agg({"length": "sum"}).collect()
    sizes = sorted(r[1] for r in rows)
    assert len(sizes) == 10 and sum(sizes) == 4 * 20_000 and sizes[-1] < 1.3 * sizes[0]
    n = packing.LONG * 2 + 77
    long = written(spark.createDataFrame([(1, "a " * n), (2, "b"), (3, None)], "doc_id long, text string"))
    got = packing.pack(long, queries.vocabulary(), group_bytes=1 << 17, with_ids=True).where("doc_id = 1").orderBy("start").collect()
    assert got[0].start == 0 and all(a.start + a.length == b.start for a, b in zip(got, got[1:]))
    assert sum(r.length for r in got) == n + 1 == got[0].doc_tokens and len({r.sequence_id >> 32 for r in got}) > 1
    ids = np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in got])
    assert len(set(ids[:-1].tolist())) == 1 and ids[-1] == packing.END


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(1)
    n = rng.integers(1, 100, 300).tolist()
    free, want = [], []
    for i in sorted(range(300), key=lambda i: -n[i]):
        b = next((k for k, f in enumerate(free) if f >= n[i]), len(free))
        if b == len(free):
            free.append(100), want.append([])
        free[b] -= n[i]
        want[b].append(i)
    assert packing.first_fit_decreasing(n, 100) == want


def test_decontamination_finds_substituted_passages(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    items = [[word() for _ in range(30)] for _ in range(5)] + [["just", "five", "words", "in", "here"], ["two", "words"]]
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(99, None)], "item_id long, text string")
    noise = " ".join(word() for _ in range(200))
    changed = [w if i % 9 else "zzz" for i, w in enumerate(items[0])]
    rows = [(0, f"{noise} {' '.join(changed).upper()}, {noise}"), (1, f"{noise} {' '.join(items[1][8:24])} {noise}"), (2, noise + " two words"),
            (3, "so JUST five, words in here."), (4, "just five words are here"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (2_000_000, 20):
        out = decontam.flag_contaminated(docs, bench, block_tokens=size)
        assert {r.doc_id: r.decontamination.item_ids for r in out.collect()} == {0: [0], 1: [1], 2: [], 3: [5], 4: [], 5: []}


def test_decontamination_flags_every_whole_item(spark, sf_dir, docs, texts):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [r.text for r in bench.collect()]
    want = {k for k, t in texts.items() if any(i in (t or "") for i in items)}
    got = {r.doc_id for r in decontam.flag_contaminated(docs, bench).where("decontamination.contaminated").collect()}
    assert got == want


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lang_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_bundle_is_the_sum_of_bound_grams():
    v, there = lang_id.bundle(["ab", "12"], 3, 64)
    a = lang_id._alphabet(64).astype(int)
    bind = lambda g: np.roll(a[ord(g[0])], 2) * np.roll(a[ord(g[1])], 1) * a[ord(g[2])]
    assert there.tolist() == [True, False] and (v[0] == bind(" ab") + bind("ab ")).all() and not v[1].any()


def test_toxicity_separates_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    caught = defaultdict(list)
    for r in out:
        caught[r.lang, r.toxic].append(r.predicted)
    for lang in ("en", "de", "fr"):  # Spanish has 22 toxic texts to learn from, too few for its words
        assert np.mean(caught[lang, 1]) >= 0.9, lang
    assert np.mean(sum((v for (_, y), v in caught.items() if y == 1), [])) >= 0.85
    assert np.mean(sum((v for (_, y), v in caught.items() if y == 0), [])) <= 0.02


def test_lexicon_is_learned_from_its_folds_only(spark):
    rows = [(p, float(y), f"{w if y else 'friend'} filler number{k}") for p, w in ((0, "grobian"), (1, "ruffian"), (3, "villain")) for k in range(40) for y in (0, 1)]
    zero, one, both = toxicity.learn_lexicons(spark.createDataFrame(rows, "part int, label double, text string"))
    assert "grobian" in zero[0] and "ruffian" not in zero[0] + zero[1] and "ruff*" in one[0]
    assert {"grobian", "ruffian", "grob*", "ruffia*"} <= set(both[0]) and not any(x.startswith(("vill", "filler", "friend")) for x in both[0] + both[1])
    words = spark.createDataFrame([("Grobiane! RUFFIAN you",), (None,), ("rough friend",)], "text string")
    x = [dict(zip(toxicity.FEATURES, r.x)) for r in words.select(toxicity.features(words.text, both).alias("x")).collect()]
    assert (x[0]["strong_kinds"], x[0]["strong_near_you"]) == (2, 2) and x[1]["strong"] == x[2]["strong"] == 0


def test_quality_statistics_and_list(spark, sf_dir, docs, texts):
    got = {r.doc_id: r for r in queries.op10_quality(spark, sf_dir).collect()}
    for k, t in texts.items():
        t, w = t or "", WORD.findall(t or "")
        win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
        n = Counter(win)
        rep = {j for i, x in enumerate(win) if n[x] > 1 for j in range(i, i + 8)}
        ls = [x for x in t.split("\n") if WORD.search(x)]
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(rep))
        assert r.base_failed == (len(w) < 20 or 100 * len(rep) > 30 * len(w)) and not (r.kept and r.base_failed)


def test_learned_rules_reject_the_bad_region(spark):
    from pyspark.sql import functions as F

    rows = spark.range(4000).select(*(F.rand(i).alias(k) for i, k in enumerate(quality.TESTED)), (F.col("id") % 3 == 0).alias("prune"))
    rows = rows.withColumn("bad", ((F.col("symbol_rate") > 0.8) & (F.col("upper_rate") < 0.5)).cast("int")).cache()
    rules = quality.learn(rows)
    kept = rows.withColumn("kept", quality.verdict(rules, {k: F.col(k) for k in quality.TESTED}))
    assert 1 <= len(rules) and kept.where((F.col("bad") == 0) & ~F.col("kept")).count() < 100
    assert kept.where((F.col("bad") == 1) & F.col("kept")).count() < 100
