"""Exact repeated-substring removal: blockwise suffix sorting with cover-sample ranks.

A byte goes if it lies in a ``length``-byte string that also starts anywhere
else in the corpus. As in a difference-cover construction, a sparse cover sample
of text places stands in for all suffixes: whatever two places hold equal
``length``-byte strings, there is one distance at which both have a sample place.
The cover is picked by content (in every ``length``-byte window the leftmost
place whose ``gram``-byte string hashes lowest), so equal windows always meet their
samples at the same distance and the sample stays under two places per hundred bytes.

1. Sample classes: equal gram strings. A class met once can hold no repeat.
2. Runs: neighbouring windows share a sample; if the whole stretch they cover
   occurs twice, all of them repeat, and one run stands for the class from here on.
3. Blockwise sort: the suffixes left over are dealt into buckets by the class of
   their sample and one set of buckets at a time is sorted: the sample suffixes to the
   right, and the texts before the samples to the left, with their common
   prefixes. A window's tie over ``length`` bytes is then settled by two
   precomputed ranks (its sample's rank at the remaining depth, and the rank of what
   stands before it), never by comparing long strings pair by pair. A bucket over
   ``bucket`` rows is counted by window hash instead (same answer, splits freely).

Only hashes, places and short contexts are shuffled; texts travel compressed.

Defined results: a null or empty text has 0 bytes and the digest of nothing; texts
shorter than ``length`` lose nothing; repeated rows are documents of their own
(so copies of a long enough text lose every byte); null ids are kept; an empty
table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import discard, ship, written
from jobscope.llm.hashing import Prefix

#: Windows handled at once; longer texts are cut into overlapping pieces of this size.
PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours (block-wise prefix and suffix minima)."""
    n = len(a)
    p = np.full(-(-n // width) * width, np.iinfo(a.dtype).max, a.dtype)
    p[:n] = a
    b = p.reshape(-1, width)
    ahead = np.minimum.accumulate(b, 1).ravel()
    back = np.minimum.accumulate(b[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def cover_runs(data: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(class, stretch hash, sample, first window, last window) of each run of windows with one sample."""
    for c in range(0, len(data) - length + 1, PIECE):
        piece = data[c:c + PIECE + length - 1]
        p = Prefix(piece)
        place = np.arange(len(piece) - gram + 1)
        h = p.hashes(place, place + gram)
        low = sliding_min((h & ~_PLACE) | place.astype(np.uint64), length - gram + 1)
        sample = (low & _PLACE).astype(np.int64)
        cut = np.flatnonzero(np.diff(sample)) + 1
        lo = np.concatenate(([0], cut))
        hi = np.concatenate((cut, [len(sample)])) - 1
        s = sample[lo]
        yield h[s].astype(np.int64), p.hashes(lo, hi + length).astype(np.int64), s + c, lo + c, hi + c


def settle(bucket: np.ndarray, before: list[bytes], after: list[bytes], near: np.ndarray, far: np.ndarray,
           weight: np.ndarray, length: int, gram: int) -> np.ndarray:
    """(rows, distance) mask of windows that occur twice in their bucket.

    Row r's sample has ``before[r]`` to its left and ``after[r]`` from it on; its windows
    start ``near[r]`` to ``far[r]`` bytes before the sample. ``weight`` is how often a row's stretch occurs.
    """
    k, reach = len(bucket), length - gram
    group = np.unique(bucket, return_inverse=True)[1].astype(">u4").view(np.uint8).reshape(k, 4)

    def ranked(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        m = np.frombuffer(b"".join(x[:width].ljust(width, b"\0") for x in parts), np.uint8).reshape(k, width)
        m = np.ascontiguousarray(np.concatenate((group, m), axis=1))
        order = np.argsort(m.view(f"S{width + 4}").ravel(), kind="stable")
        differ = m[order[1:]] != m[order[:-1]]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), width + 4) - 4
        return order, np.concatenate(([-1], common))

    right, right_common = ranked(after, length)
    left, left_common = ranked([x[::-1] for x in before], max(1, reach))
    out = np.zeros((k, reach + 1), bool)
    rank_r, rank_l = np.empty(k, np.int64), np.empty(k, np.int64)
    for o in range(reach + 1):
        own = np.flatnonzero((near <= o) & (o <= far))
        if not len(own):
            continue
        rank_r[right] = np.cumsum(right_common < length - o)
        rank_l[left] = np.cumsum(left_common < o)
        _, key = np.unique(rank_r[own] * (k + 1) + rank_l[own], return_inverse=True)
        out[own, o] = np.bincount(key, weights=weight[own])[key] >= 2
    return out


def _intervals(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of each run of True in the rows of a mask."""
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def repeated_windows(texts: DataFrame, length: int, gram: int, bucket: int) -> DataFrame:
    """(tid, lo, hi): ranges of window starts that occur elsewhere. ``texts`` has tid and packed."""
    spark = texts.sparkSession
    reach = length - gram

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for tid, t in zip(b.column(0).to_pylist(), b.column(1)):
                for run in cover_runs(unpack(t.as_py()), length, gram):
                    for c, x in zip(cols, (*run, np.full(len(run[0]), tid))):
                        c.append(x)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 names=["h", "g", "a", "lo", "hi", "tid"])

    runs = texts.mapInArrow(scan, "h long, g long, a long, lo long, hi long, tid long")
    twice = written(runs.groupBy("h").count().where("count > 1").select("h"), "classes")
    runs = written(runs.join(twice, "h", "left_semi"), "runs")
    stretch = written(runs.groupBy("h", "g").agg(F.count("*").alias("c"), F.min(F.struct("tid", "a", "lo", "hi")).alias("m"))
                      .select("h", "g", "c", "m.*"), "stretches")
    settled = runs.join(stretch.where("c > 1").select("h", "g"), ["h", "g"], "left_semi").select("tid", "lo", "hi")

    open_ = stretch.where("c = 1").groupBy("h").agg(F.count("*").alias("n"))
    sizes = stretch.groupBy("h").agg(F.count("*").alias("size"))
    todo = stretch.join(open_.join(sizes, "h").select("h", (F.col("size") > bucket).alias("large")), "h")
    todo = todo.groupBy("tid").agg(F.collect_list(F.struct("h", "a", "lo", "hi", F.least("c", F.lit(2)).alias("c"), "large"))
                                   .alias("runs"))
    context = ("large boolean, h long, tid long, a long, lo long, hi long, c long, before binary, after binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = [x.split()[0] for x in context.split(", ")]
        types = [pa.bool_()] + [pa.int64()] * 6 + [pa.binary()] * 2
        for b in batches:
            rows = []
            for tid, t, todo_ in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                data = unpack(t.as_py())
                for r in todo_.as_py():
                    h, a, lo, hi, c = (r[x] for x in ("h", "a", "lo", "hi", "c"))
                    if not r["large"]:
                        rows.append((False, h, tid, a, lo, hi, c, data[max(0, a - reach):a], data[a:a + length]))
                        continue
                    p = Prefix(data[lo:hi + length])
                    at = np.arange(hi - lo + 1)
                    rows += [(True, w, tid, a, i, i, c, None, None)
                             for w, i in zip(p.hashes(at, at + length).astype(np.int64).tolist(), range(lo, hi + 1))]
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows), types)], names=names)

    suffixes = written(texts.join(todo, "tid").select("tid", "packed", "runs").mapInArrow(cut, context), "suffixes")

    def sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(t: pa.Table) -> pa.RecordBatch:
            h, tid, a, lo, hi, c = (t.column(x).to_numpy() for x in ("h", "tid", "a", "lo", "hi", "c"))
            mask = settle(h, t.column("before").to_pylist(), t.column("after").to_pylist(), a - hi, a - lo, c, length, gram)
            mask[c > 1] = False
            row, first, last = _intervals(mask)
            return pa.RecordBatch.from_arrays([pa.array(tid[row]), pa.array(a[row] - last), pa.array(a[row] - first)],
                                              names=["tid", "lo", "hi"])

        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size >= 40_000:
                t = pa.Table.from_batches(held).combine_chunks()
                h = t.column("h").to_numpy()
                end = int(np.searchsorted(h, h[-1], "left"))  # the last bucket may go on
                if end:
                    yield flush(t.slice(0, end))
                    held = t.slice(end).combine_chunks().to_batches()
                    size = t.num_rows - end
        if size:
            yield flush(pa.Table.from_batches(held).combine_chunks())

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    small = suffixes.where("not large").drop("large").repartition(parts, "h").sortWithinPartitions("h").mapInArrow(
        sort_buckets, "tid long, lo long, hi long")
    windows = suffixes.where("large").select("h", "tid", "lo", "hi", "c")
    often = windows.groupBy("h").agg(F.sum("c").alias("c")).where("c > 1").select("h")
    large = windows.where("c = 1").join(often, "h", "left_semi").select("tid", "lo", "hi")
    return settled.unionAll(small).unionAll(large)


def remove_repeats(docs: DataFrame, length: int = 200, gram: int = 64, bucket: int = 20_000, doc_id: str = "doc_id",
                   text: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) of every row; see the module text.

    ``with_text`` adds the remaining bytes themselves (binary).
    """
    ship(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                s = b.slice(lo, 1000)
                raw = [(x or "").encode("utf-8", "surrogatepass") for x in s.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array([int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True)
                                            for x in raw], pa.int64()),
                     pa.array([len(x) for x in raw], pa.int64()), pa.array([press(x) for x in raw], pa.binary())],
                    names=["doc_id", "tid", "n", "packed"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        pack, "doc_id long, tid long, n long, packed binary")
    long_ = rows.where(F.col("n") >= length).select("tid", "packed")
    found = repeated_windows(long_, length, gram, bucket)
    spans = found.groupBy("tid").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for i, n, t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                data, s = unpack(t.as_py()), s.values if s.is_valid else None
                gone = np.zeros(n + 1, np.int32)
                if s is not None:
                    np.add.at(gone, s.field("lo").to_numpy(), 1)
                    np.add.at(gone, s.field("hi").to_numpy() + length, -1)
                gone = np.cumsum(gone)[:n] > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                starts = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if n else 0
                out.append((i, n, int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()) + ((kept,) if with_text else ()))
            if out:
                types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*out), types)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][:5 + with_text])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return rows.join(spans, "tid", "left").select("doc_id", "n", "packed", "spans").mapInArrow(strip, schema)
