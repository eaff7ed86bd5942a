"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is the product
(binding) of its letters' vectors, each rotated (permuted) by its distance from
the end; a text is the sum (bundle) of its n-grams' vectors, and a language's
prototype is the sum of the unit vectors of its training texts. A text gets the
language whose prototype has the largest cosine with its own vector. Before
comparing, the mean prototype is taken out of both sides, so what all languages share
does not blur them.

Whole texts are read: a batch's n-grams are counted, each distinct one is bound
once, and bundling is one matrix product. Prototypes are trained on at most
about ``per_language`` documents of each language, chosen by a hash of the id;
they (languages x ``dim`` numbers) are all that reaches the driver.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text if nothing can be learned; rows without language or id are
not learned from; repeated rows are judged each; equal cosines go to the first
language by name; columns other than id, text and language are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import held_out, ship

LETTERS = 4096
_STATE: dict = {}


def _alphabet(dim: int) -> np.ndarray:
    """Random +-1 vectors by code point modulo ``LETTERS``; row 32 stands for a gap between words."""
    key = ("alphabet", dim)
    if key not in _STATE:
        _STATE[key] = np.random.default_rng(977).integers(0, 2, (LETTERS, dim), dtype=np.int8) * 2 - 1
    return _STATE[key]


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if "letters" not in _STATE:
        _STATE["letters"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _STATE["letters"]


def grams(text: str | None, n: int) -> np.ndarray:
    """Codes (12 bits a letter) of a text's letter n-grams; words are joined by one gap."""
    if not text:
        return np.empty(0, np.int64)
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[a]
    if not is_letter.any():
        return np.empty(0, np.int64)
    a = np.where(is_letter, a % LETTERS, 32).astype(np.int64)
    gap = ~is_letter
    a = np.concatenate(([32], a[~(gap & np.concatenate(([True], gap[:-1])))], [32]))
    if len(a) > 2 and a[-2] == 32:
        a = a[:-1]
    if len(a) < n:
        a = np.concatenate((a, np.full(n - len(a), 32)))
    code = np.zeros(len(a) - n + 1, np.int64)
    for k in range(n):
        code = code << 12 | a[k:k + len(code)]
    return code


def bundle(texts: list[str | None], n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, has any letter) of a list of texts."""
    counted = [np.unique(grams(t, n), return_counts=True) for t in texts]
    out = np.zeros((len(texts), dim), np.float32)
    codes = np.unique(np.concatenate([c for c, _ in counted])) if texts else np.empty(0, np.int64)
    letters = _alphabet(dim)
    step = 4096
    for lo in range(0, len(codes), step):  # n-gram vectors a slice at a time
        part = codes[lo:lo + step]
        vec = np.ones((len(part), dim), np.int8)
        for k in range(n):
            vec *= np.roll(letters, n - 1 - k, axis=1)[part >> 12 * (n - 1 - k) & 4095]
        count = np.zeros((len(texts), len(part)), np.float32)
        for i, (c, m) in enumerate(counted):
            a, b = np.searchsorted(c, part[0]), np.searchsorted(c, part[-1], "right")
            count[i, np.searchsorted(part, c[a:b])] = m[a:b]
        out += count @ vec.astype(np.float32)
    return out, np.array([len(c) > 0 for c, _ in counted], bool)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


def _slices(texts: list[str | None], chars: int = 400_000) -> Iterator[slice]:
    """Row ranges of about ``chars`` characters, so one batch's counts stay small."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars or i - lo >= 255:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def prototypes(docs: DataFrame, n: int = 3, dim: int = 1024, per_language: int = 4000) -> dict[str, np.ndarray]:
    """Language prototypes from rows (doc_id, text, lang) outside the held-out fold."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                      & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.lit(0.0)
    for lang, c in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / c))).otherwise(share)
    rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(1_000_000)) < share * 1_000_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(1).to_pylist(), b.column(2).to_pylist()
            for s in _slices(texts):
                v, _ = bundle(texts[s], n, dim)
                for lang, x in zip(langs[s], _unit(v)):
                    total[lang] = total.get(lang, 0) + x.astype(np.float64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), pa.array([x.tolist() for x in total.values()], pa.list_(pa.float64()))],
                names=["lang", "vec"])

    summed = rows.mapInArrow(run, "lang string, vec array<double>").select("lang", F.posexplode("vec").alias("d", "x"))
    summed = summed.groupBy("lang", "d").agg(F.sum("x").alias("x")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("d", "x"))).alias("v"))
    return {r["lang"]: _unit(np.array([x["x"] for x in r["v"]])) for r in summed.collect()}


def identify(docs: DataFrame, profile: dict[str, np.ndarray], n: int = 3, dim: int = 1024) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; score is the cosine, at least 0."""
    ship(docs.sparkSession)
    names = sorted(profile)
    proto = np.stack([profile[x] for x in names]) if names else np.zeros((0, dim))
    mean = proto.mean(axis=0) if len(names) > 1 else np.zeros(dim)
    shown = _unit(proto - mean).astype(np.float32)
    handle = docs.sparkSession.sparkContext.broadcast((names, mean.astype(np.float32), shown))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, mean, shown = handle.value
        for b in batches:
            texts = b.column(1).to_pylist()
            lang, score = [], []
            for s in _slices(texts):
                v, there = bundle(texts[s], n, dim)
                if not names:
                    there[:] = False
                cos = _unit(_unit(v) - mean) @ shown.T if names else np.zeros((len(v), 1))
                best = cos.argmax(axis=1)
                lang += [names[k] if ok else "und" for k, ok in zip(best, there)]
                score += [float(min(1.0, max(0.0, c[k]))) if ok else 0.0 for c, k, ok in zip(cos, best, there)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify_languages(docs: DataFrame, n: int = 3, dim: int = 1024, per_language: int = 4000, doc_id: str = "doc_id",
                       text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learn from the training folds, then judge every whole text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    out = identify(rows, prototypes(rows, n, dim, per_language), n, dim)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
