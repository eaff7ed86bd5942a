"""Importance resampling towards a target distribution, by hashed n-gram features.

A text's features are its runs of consecutive words; a feature's bucket is the crc32 of its
bytes modulo ``buckets``. A bucket's gain is the smoothed log ratio of its share in the
target texts to its share in the corpus, in thousandths; a document's weight is the mean gain of its
features, and Gumbel noise from a hash of the id turns a top-k choice into a draw without replacement.

Inside a task each Arrow batch is interned by an open-addressed table in numpy: the xxhash64 of
an n-gram's bytes picks a slot, equal hashes are verified byte by byte, others probe
on linearly. A slot holds the n-gram's place, its bucket and its count, so crc32 is
computed once per distinct n-gram of a batch. The counting pass sums slot counts by
bucket (at most ``buckets`` rows leave a task); the scoring pass reads gains by the slot id of each occurrence. Texts are
read twice and never shuffled. Counts cover every document and every target text.

Defined results: a null or empty text has no features and weight 0; a null id counts as the empty text
in the noise; repeated rows are documents of their own, ranked one after the other; ties in score go to the smaller id (null first);
an empty table gives no rows, an empty target gives gains from the smoothing alone. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import ship, written
from jobscope.operators.numbering import number_rows

# The primes of xxhash64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161,
                                             9650029242287828579, 2870177450012600261))
#: Texts of one interning step hold at most about this many bytes (a longer text is a step by itself).
STEP_BYTES = 4 << 20
_IS_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = 32


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxhash64_rows(rows: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of each row of a (n, length) byte matrix."""
    n, length = rows.shape
    at = 0

    def lane(width: int) -> np.ndarray:
        return np.ascontiguousarray(rows[:, at:at + width]).view(f"<u{width}").ravel().astype(np.uint64)

    with np.errstate(over="ignore"):
        if length >= 32:
            acc = [np.full(n, v, np.uint64) for v in (P1 + P2, P2, np.uint64(0), np.uint64(0) - P1)]
            while at + 32 <= length:
                for k in range(4):
                    acc[k] = _round(acc[k], lane(8))
                    at += 8
            h = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
            for a in acc:
                h = (h ^ _round(np.zeros(n, np.uint64), a)) * P1 + P4
        else:
            h = np.full(n, P5, np.uint64)
        h = h + np.uint64(length)
        while at + 8 <= length:
            h = _rotl(h ^ _round(np.zeros(n, np.uint64), lane(8)), 27) * P1 + P4
            at += 8
        if at + 4 <= length:
            h = _rotl(h ^ (lane(4) * P1), 23) * P2 + P3
            at += 4
        while at < length:
            h = _rotl(h ^ (lane(1) * P5), 11) * P1
            at += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        return h ^ (h >> np.uint64(32))


class InternTable:
    """Open-addressed table of the n-grams of one step: slot -> first place, length, bucket, count."""

    def __init__(self, arena: np.ndarray, expected: int):
        self.arena, self.size = arena, 1 << max(4, (2 * expected - 1).bit_length())
        self.key = np.zeros(self.size, np.uint64)
        self.place = np.full(self.size, -1, np.int64)
        self.length = np.zeros(self.size, np.int64)
        self.bucket = np.zeros(self.size, np.int64)
        self.count = np.zeros(self.size, np.int64)

    def intern(self, starts: np.ndarray, length: int, hashes: np.ndarray | None = None) -> np.ndarray:
        """Slot of each n-gram of ``length`` bytes at ``starts``; every one ends in a slot with equal bytes."""
        out = np.empty(len(starts), np.int64)
        step = max(1, (STEP_BYTES * 4) // length)
        for lo in range(0, len(starts), step):
            s = starts[lo:lo + step]
            rows = self.arena[s[:, None] + np.arange(length)]
            h = xxhash64_rows(rows) if hashes is None else hashes[lo:lo + step]
            out[lo:lo + step] = self._probe(s, rows, h)
        return out

    def _probe(self, starts: np.ndarray, rows: np.ndarray, h: np.ndarray) -> np.ndarray:
        length, mask = rows.shape[1], np.uint64(self.size - 1)
        slot = (h & mask).astype(np.int64)
        todo = np.arange(len(starts))
        while len(todo):
            at = slot[todo]
            free = self.place[at] < 0
            if free.any():  # of several claimants one stays; the others compare with it below
                who, where = todo[free], at[free]
                self.place[where] = starts[who]
                won = self.place[where] == starts[who]
                self.key[where[won]], self.length[where[won]] = h[who[won]], length
            same = (self.key[at] == h[todo]) & (self.length[at] == length)
            match = np.flatnonzero(same)
            if len(match):
                held = self.arena[self.place[at[match]][:, None] + np.arange(length)]
                same[match] = (held == rows[todo[match]]).all(axis=1)
            todo = todo[~same]
            slot[todo] = (slot[todo] + 1) & (self.size - 1)
        return slot

    def finish(self, slots: np.ndarray, buckets: int) -> None:
        """Count the occurrences and give every used slot its bucket."""
        self.count += np.bincount(slots, minlength=self.size)
        view = memoryview(self.arena)
        used = np.flatnonzero(self.place >= 0)
        lo, hi = self.place[used].tolist(), (self.place[used] + self.length[used]).tolist()
        self.bucket[used] = [zlib.crc32(view[a:b]) % buckets for a, b in zip(lo, hi)]


def words_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(arena, word starts, word ends, words per text) of texts lying one after the other in ``data``.

    The arena holds the lower-cased words, one space after each, so a run of words of a text is one stretch of bytes.
    ``starts`` are the offsets of the texts and the end of the last.
    """
    low = _LOWER[data]
    word = _IS_WORD[low]
    before = np.concatenate(([False], word[:-1]))
    before[starts[:-1][starts[:-1] < len(word)]] = False  # a word never goes on into the next text
    first = word & ~before
    n = int(first.sum())
    order = np.cumsum(first) - 1
    held = low[word]
    lengths = np.bincount(order[word], minlength=n) if n else np.zeros(0, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    arena = np.full(int(ends[-1]) + 1 if n else 0, _SPACE, np.uint8)
    arena[np.arange(len(held)) + order[word]] = held
    per = np.concatenate(([0], np.cumsum(first)))[starts]
    return arena, begins, ends, np.diff(per)


def ngrams(begins: np.ndarray, ends: np.ndarray, per_text: np.ndarray, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of all runs of ``shortest`` to ``longest`` words of each text."""
    text = np.repeat(np.arange(len(per_text)), per_text)
    out = []
    for n in range(shortest, longest + 1):
        if len(begins) < n:
            continue
        same = text[:len(text) - n + 1] == text[n - 1:]
        s = begins[:len(begins) - n + 1][same]
        out.append((s, ends[n - 1:][same] - s, text[:len(text) - n + 1][same]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def intern_texts(texts: list[bytes], shortest: int, longest: int, buckets: int):
    """(table, slot of each n-gram, its text, words per text) of a step of texts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    arena, begins, ends, per = words_of(data, np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64))
    start, length, text = ngrams(begins, ends, per, shortest, longest)
    table = InternTable(arena, len(start))
    slots = np.empty(len(start), np.int64)
    order = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        slots[group] = table.intern(start[group], int(length[group[0]]))
    table.finish(slots, buckets)
    return table, slots, text, per


def _steps(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts, each of about ``STEP_BYTES``."""
    for b in batches:
        lo, size, texts = 0, 0, []
        for i, t in enumerate(b.column(column)):
            texts.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
            size += len(texts[-1])
            if size >= STEP_BYTES or i == b.num_rows - 1:
                yield b.slice(lo, i + 1 - lo), texts
                lo, size, texts = i + 1, 0, []


def bucket_counts(docs: DataFrame, shortest: int, longest: int, buckets: int, text: str = "text") -> DataFrame:
    """(bucket, n) of all features of the table."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in _steps(batches, 0):
            table, *_ = intern_texts(texts, shortest, longest, buckets)
            np.add.at(total, table.bucket, table.count)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    part = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int, scale: int) -> np.ndarray:
    """Gain of every bucket; the two count tables have at most ``buckets`` rows each."""
    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for r in counts.collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = dense(corpus), dense(target)
    return np.floor(scale * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, shortest: int, longest: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    buckets = len(gain)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _steps(batches, 1):
            table, slots, owner, per = intern_texts(texts, shortest, longest, buckets)
            gathered = gain[table.bucket][slots]
            n = np.bincount(owner, minlength=len(texts))
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, owner, gathered)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(per), pa.array(n), pa.array(total // np.maximum(n, 1))],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int, scale: int) -> Column:
    """Gumbel noise in thousandths (``scale``), from the SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, shortest: int = 1, longest: int = 1,
             buckets: int = 10_000, seed: int = 2024, scale: int = 1000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null for rows not drawn.

    Of the N rows with at least ``min_words`` words, ``floor(percent * N / 100)`` are drawn.
    """
    gain = gains(bucket_counts(docs, shortest, longest, buckets, text), bucket_counts(target, shortest, longest, buckets, text), buckets, scale)
    rows = weigh(docs, gain, shortest, longest, doc_id, text)
    rows = written(rows.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed, scale)).cast("long")), "weights")
    able = rows.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    rest = ["doc_id", "n_features", "weight", "score"]
    # scores above the cut are drawn whole, so only rows from the cut on are put in order
    by_score = written(able.groupBy("score").count(), "scores")
    cut = cut_score(by_score, drawn)
    if cut is None:
        return rows.select(*rest, F.lit(None).cast("long").alias("rank"))
    top = written(able.where(F.col("score") >= cut).select(*rest), "drawn")
    ranked = number_rows(top, [F.col("score").desc(), F.col("doc_id"), F.col("n_features"), F.col("weight")], name="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    out = rows.where((F.col("n_words") < min_words) | (F.col("score") < cut))
    return ranked.unionByName(out.select(*rest, F.lit(None).cast("long").alias("rank")))


def cut_score(by_score: DataFrame, drawn: int, parts: int = 64) -> int | None:
    """The score of the last row drawn, by narrowing the score range: each step is a row of sums, nothing is sorted."""
    if not drawn:
        return None
    lo, hi = by_score.agg(F.min("score"), F.max("score")).first()
    while lo < hi:  # the cut is in [lo, hi]
        marks = sorted({lo + 1 + (hi - lo - 1) * k // (parts - 1) for k in range(parts)})
        above = by_score.agg(*(F.sum(F.when(F.col("score") >= m, F.col("count")).otherwise(0)) for m in marks)).first()
        reached = [m for m, n in zip(marks, above) if n >= drawn]
        hi = min([m - 1 for m in marks if m not in reached], default=hi)
        lo = max(reached, default=lo)
    return lo
