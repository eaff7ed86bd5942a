"""Resampling, Merkle manifest and URL filters against plain versions, with odd rows and empty tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from jobscope.llm import merkle, resample, url_filter
from jobscope.llm.common import written

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ---------------------------------------------------------------- resampling

def _features(text, lo, hi):
    w = WORD.findall((text or "").translate(AZ))
    return w, [" ".join(w[i:i + n]) for n in range(lo, hi + 1) for i in range(len(w) - n + 1)]


def _plain_resample(docs, bench, lo, hi, buckets, percent, min_words):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in _features(t, lo, hi)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(bench)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for d, x in docs:
        w, f = _features(x, lo, hi)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((len(w), (d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))))
    able = sorted((r for n, r in rows if n >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    k = percent * len(able) // 100
    return sorted([(*r, i + 1 if i < k else None) for i, r in enumerate(able)] + [(*r, None) for n, r in rows if n < min_words], key=repr)


@pytest.mark.parametrize("lo, hi, buckets, percent, min_words", [(1, 1, 10_000, 10, 20), (1, 3, 97, 35, 1), (2, 2, 500, 100, 0)])
def test_resample_matches_plain(spark, sf_dir, lo, hi, buckets, percent, min_words):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(3, None), (3, ""), (None, "Über ÜBER über_x I'm"), (None, "Über ÜBER über_x I'm"), (7, "a" * 70_000 + " b"), (8, "x\x85y\u3000z -- 9")]
    bench = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()] + [None, "Über b b"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    target = spark.createDataFrame([(t,) for t in bench], "text string")
    got = resample.resample(df, target, percent, min_words, lo, hi, buckets).collect()
    assert sorted([tuple(r) for r in got], key=repr) == _plain_resample(docs, bench, lo, hi, buckets, percent, min_words)


def test_resample_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert resample.resample(none, one).count() == 0
    assert [(r.doc_id, r.n_features, r["rank"]) for r in resample.resample(one, none, 100, 1).orderBy("doc_id").collect()] == [(1, 3, 1), (2, 0, None)]


def test_cut_score_is_the_score_of_the_last_row_drawn(spark):
    rng = random.Random(3)
    scores = [rng.randint(-5000, 5000) for _ in range(400)] + [17] * 60
    by = written(spark.createDataFrame([(s,) for s in scores], "score long").groupBy("score").count())
    for k in (1, 5, 200, 459, 460):
        assert resample.cut_score(by, k) == sorted(scores, reverse=True)[k - 1]


def test_xxhash_rows_equal_the_library():
    rng = np.random.default_rng(1)
    for n in (*range(1, 70), 200, 1001):
        rows = rng.integers(0, 256, (5, n), dtype=np.uint8)
        assert resample.xxhash64_rows(rows).tolist() == [xxhash.xxh64_intdigest(r.tobytes()) for r in rows]


def test_interning_verifies_bytes_when_hashes_collide():
    words = [b"aa", b"bb", b"cc", b"aa", b"bb", b"aa"]
    arena = np.frombuffer(b"".join(words), np.uint8)
    table = resample.InternTable(arena, 6)
    slots = table.intern(np.arange(0, 12, 2), 2, hashes=np.full(6, 15, np.uint64))  # one hash for all, at the last slot but one turn
    table.finish(slots, 50)
    assert slots[0] == slots[3] == slots[5] and slots[1] == slots[4] and len(set(slots.tolist())) == 3
    assert sorted(table.count[table.place >= 0].tolist()) == [1, 2, 3] and table.bucket[slots[2]] == zlib.crc32(b"cc") % 50


def test_steps_cut_batches_by_bytes(monkeypatch):
    monkeypatch.setattr(resample, "STEP_BYTES", 10)
    b = pa.RecordBatch.from_arrays([pa.array(["a" * 25, "b", "c" * 9, None, "d"])], names=["text"])
    assert [[len(t) for t in texts] for _, texts in resample._steps(iter([b]), 0)] == [[25], [1, 9], [0, 1]]


# ---------------------------------------------------------------- Merkle

def _h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _plain_leaf(row):
    return _h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def _plain_levels(level, fan):
    out = [level]
    while len(out[-1]) > 1:
        out.append([_h(out[-1][i:i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def _plain_proof(levels, at, fan):
    out = []
    for low in levels[:-1]:
        lo = at - at % fan
        out.append((low[lo:at], low[at + 1:lo + fan]))
        at //= fan
    return out


def _plain_audit(rows, fan):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, _plain_leaf(r), r))
    names = sorted(by, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: _plain_levels([x[2] for x in sorted(by[k], key=lambda x: x[:3])], fan) for k in names}
    crown = _plain_levels([trees[k][-1][0] for k in names], fan)
    out = []
    for i, k in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(sorted(by[k], key=lambda x: x[:3])):
            path = _plain_proof(trees[k], at, fan) + _plain_proof(crown, i, fan)
            d, text = row[0], row[4]
            picked = zlib.crc32(("" if d is None else str(d)).encode()) % 3 == 0
            node = _plain_leaf((*row[:4], text.translate(AZ))) if picked and text is not None else leaf
            for left, right in path:
                node = _h([*left, node, *right])
            out.append((d, leaf, trees[k][-1][0], crown[-1][0], _h([x for p in path for side in p for x in side]), node, node == crown[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("fan, every", [(8, 3), (2, 2), (3, 1), (8, 1)])
def test_audit_matches_plain(spark, fan, every):
    rng = random.Random(fan * 10 + every)
    rows = [(i, rng.choice(["s", None, "Ü"]), rng.choice(["en"] * 6 + ["de", "fr", None, ""]), rng.choice([None, 7]),
             rng.choice([None, "", "Mixed Case ÄÖ", "lower", "LONG " * 900])) for i in range(230)]
    rows += [(5, "s", "en", 7, "twin")] * 3 + [(None, None, None, None, None), (None, "s", "en", 1, "No Id"), (-4, "s", "zz", 1, "ALONE")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn("pos", F.lit(2)).repartition(3)
    changed = merkle.leaf([merkle.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.COLUMNS])
    picked = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 0
    made = merkle.build(df, fan=fan, every=every, other=F.when(picked, changed))
    assert (len(made.trees.bands) > 1) == (fan**every < 100)  # several bands where a subtree is small
    got = merkle.prove(made).select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted([tuple(r) for r in got], key=repr) == _plain_audit(rows, fan)


def test_many_trees_have_a_crown_of_several_bands(spark):
    rows = [(i, "s", f"l{i % 70}", 1, f"Text {i}") for i in range(75)]
    made = merkle.build(spark.createDataFrame(rows, SCHEMA), fan=2, every=2)
    got = merkle.prove(made, with_path=True).collect()
    assert len(got) == 75 and all(r.verified for r in got) and len(made.crown.bands) >= 3
    for r in got:  # a path stands by itself: it leads from the leaf to the root
        assert merkle.fold(bytes.fromhex(r.leaf), merkle.unpack_path(bytes(r.path))).hex() == made.root


def test_audit_single_and_empty(spark):
    one = [(1, "s", "en", 1, "x")]
    assert [tuple(r)[1:5] for r in merkle.prove(merkle.build(spark.createDataFrame(one, SCHEMA))).select(
        "id", "leaf", "subroot", "root", "proof_sha256").collect()] == [(_plain_leaf(one[0]),) * 3 + (_h([]),)]
    assert merkle.audit(spark.createDataFrame([], SCHEMA)).count() == 0


# ---------------------------------------------------------------- URL filters

def _plain_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.translate(AZ)
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[3:] if fit else (None, "allow")))


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_urls_match_plain(spark, broadcast):
    rng = random.Random(4)
    names = ["a", "b", "www", "com", "net", "x-y"]
    host = lambda: ".".join(rng.choice(names) for _ in range(rng.randint(1, 4)))
    path = lambda: rng.choice(["", "/", "/a", "/a/", "/ab/c", "/a/b/c", "/A/b"])
    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(40)] + [("com", "en", "block"), ("a.com", "/a", "block"), ("a.com", "/a", "allow")]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(['', 'www.', 'A.B.', '.'])}{host()}{rng.choice(['', ':80', '.'])}{path()}{rng.choice(['', '?q=/a', '#f', 'b'])}"
            for _ in range(400)] + [None, "", "no scheme com/a", "x://", "http://com", "a://b.com/a://c", "http://com/a\n/b", "://a.com/" + "z" * 20_000,
                                    "http://" + "a." * 3000 + "com/a", "http:///com/a", "http://ü.COM/Ü"] + ["http://www.a.com/a/b"] * 50
    df = spark.createDataFrame([(i if i % 7 else None, u, "taken") for i, u in enumerate(urls)], "page_id long, url string, host string")
    book = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge_urls(df, book, broadcast_rules=broadcast, prefix_digits=2)  # short prefixes: many hits to confirm
    assert got.columns == ["page_id", "url", "host", "host_", "path", "rule", "verdict"]
    want = [(i if i % 7 else None, *_plain_verdict(u, rules)) for i, u in enumerate(urls)]
    assert sorted([tuple(r) for r in got.select("page_id", "host_", "path", "rule", "verdict").collect()], key=repr) == sorted(want, key=repr)


def test_urls_without_rules_or_rows_and_bad_rules(spark):
    df = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r)[2:] for r in url_filter.judge_urls(df, none, default="block").collect()] == [("a.com", "/", None, "block")]
    ok = spark.createDataFrame([("COM", None, "Block")], "host string, path string, verdict string")
    assert url_filter.judge_urls(df.limit(0), ok).count() == 0
    assert [tuple(r)[2:] for r in url_filter.judge_urls(df, ok).collect()] == [("a.com", "/", "com", "block")]
    for bad in ((None, "/", "block"), ("", "/", "block"), ("com", "/", "maybe")):
        with pytest.raises(Exception, match="a rule needs"):
            url_filter.judge_urls(df, spark.createDataFrame([bad], "host string, path string, verdict string"))
