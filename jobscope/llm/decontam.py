"""Benchmark decontamination with spaced-seed hashes.

A seed mask keeps some of ``span`` consecutive tokens and ignores the others, so
a substituted token only spoils the masks that keep it. Benchmark items are the
query set: their seed hashes form a sorted index in blocks of at most
``block_tokens`` tokens (the proven bound of what a task holds), and every block
is merged with the seeds of every document where the document lies, without a
shuffle. Around each hit the item is laid over the document on that diagonal
and the overlap is verified token by token: a document is contaminated if in
some window of ``window`` aligned tokens (the whole item, if shorter) at least
``tolerance`` of them are equal.

Tokens are runs of Unicode letters (with their marks) and digits, lower-cased; in scripts written
without blanks every character is a token. Items of fewer tokens than
the longest mask are sought whole and unchanged; items of fewer than ``min_tokens``
tokens are no evidence and match nothing.

Defined results: a null or empty text, item or id matches nothing and its row
is kept; repeated rows are judged each; an empty benchmark flags nothing; all
columns of the input pass through, and the added column gets a name that is free.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobscope.llm.common import fresh, ship
from jobscope.llm.hashing import Prefix, mix64

#: Spaced seeds of weight 5 (1: compared, 0: ignored), chosen together: in 13 aligned tokens of which 10 are equal, and in
#: whole items of 12 (9 equal) and 11 (9 equal), wherever the others are, at least one mask meets equal tokens alone.
MASKS = ("111011", "1100001011", "11010011", "11010000101")
RESULT = "contaminated boolean, n_tokens long, matched_tokens long, item_ids array<long>"
#: Scripts without blanks between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Bopomofo, Han, Yi, half-width kana.
UNSPACED = ((0xE00, 0xF00), (0xF00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x3005, 0x3008), (0x3031, 0x3036), (0x3040, 0x3130),
            (0x31A0, 0x31C0), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA4D0), (0xF900, 0xFB00), (0xFF66, 0xFFA0),
            (0x1AFF0, 0x1B170), (0x20000, 0x32400))
_STATE: dict = {}
_KEPT = np.full(256, 32, np.uint8)
for _c in range(128):
    if chr(_c).isalnum():
        _KEPT[_c] = _c
_TABLE = _KEPT.tobytes()


def _kinds() -> np.ndarray:
    """By code point: 0 between tokens, 1 part of a token, 2 a token of its own."""
    if "kinds" not in _STATE:
        def kind(c: int) -> int:
            mark = unicodedata.category(chr(c))[0] == "M" and not (0x20D0 <= c < 0x2100 or 0xFE00 <= c < 0xFE10 or c >= 0xE0100)
            return int(mark or chr(c).isalnum())

        kinds = np.fromiter(map(kind, range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        for lo, hi in UNSPACED:
            kinds[lo:hi] *= 2
        _STATE["kinds"] = kinds
    return _STATE["kinds"]


def token_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's tokens in order."""
    low = (text or "").lower()
    data = low.encode("utf-8", "surrogatepass")
    if not data:
        return np.empty(0, np.uint64)
    if not low.isascii():
        a = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kinds()[a]
        joins = np.concatenate(([False], kind == 1, [False]))
        first, last = (np.flatnonzero((kind == 2) | ((kind == 1) & ~joins[k:len(a) + k])) for k in (0, 2))
        at = np.concatenate(([0], np.cumsum(1 + (a >= 0x80) + (a >= 0x800) + (a >= 0x10000))))
        return Prefix(data).hashes(at[first], at[last + 1]) if len(first) else np.empty(0, np.uint64)
    data = data.translate(_TABLE)
    inside = np.frombuffer(data, np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    return Prefix(data).hashes(edge[::2], edge[1::2]) if len(edge) else np.empty(0, np.uint64)


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """One hash per position where the mask fits."""
    n = len(tokens) - len(mask) + 1
    out = np.zeros(max(0, n), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1" and n > 0:
            out = mix64(out + tokens[k:k + n] * np.uint64(2 * k + 3))
    return mix64(out + np.uint64(len(mask)))


class SeedIndex:
    """Sorted seed hashes of a block of items, with a bit map in front of them."""

    def __init__(self, items: list[tuple[int, str]], masks: tuple[str, ...], min_tokens: int):
        self.ids = [i for i, _ in items]
        self.tokens = [token_hashes(t) for _, t in items]
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.concatenate(self.tokens) if items else np.empty(0, np.uint64)
        span = max(map(len, masks))
        short = {len(t) for t in self.tokens if min_tokens <= len(t) < span}
        self.parts = []
        for mask, whole in [*((m, False) for m in masks), *(("1" * n, True) for n in sorted(short))]:
            own = [(seed_hashes(t, mask), k) for k, t in enumerate(self.tokens)
                   if (len(t) == len(mask) if whole else len(t) >= span)]
            if not own:
                continue
            seeds = np.concatenate([s for s, _ in own])
            item = np.concatenate([np.full(len(s), k) for s, k in own])
            pos = np.concatenate([np.arange(len(s)) for s, _ in own])
            order = np.argsort(seeds, kind="stable")
            bits = max(16, min(26, int(len(seeds) * 32).bit_length()))
            there = np.zeros(1 << bits, bool)
            there[seeds >> np.uint64(64 - bits)] = True
            self.parts.append((mask, seeds[order], item[order], pos[order], there, np.uint64(64 - bits)))

    def diagonals(self, tokens: np.ndarray, most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Item numbers and document places of the item's first token, of all seed hits; ``most`` hits are held at once."""
        out = np.empty(0, np.int64)
        for mask, seeds, item, pos, there, shift in self.parts:
            own = seed_hashes(tokens, mask)
            at = np.flatnonzero(there[own >> shift])
            lo, hi = np.searchsorted(seeds, own[at], "left"), np.searchsorted(seeds, own[at], "right")
            at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            for part in _chunks(n, most):
                m = n[part]
                first = np.repeat(lo[part] - (np.cumsum(m) - m), m) + np.arange(m.sum())
                # one number for both; a place before the document's start is negative
                out = np.union1d(out, item[first] << 32 | (np.repeat(at[part], m) - pos[first] + (1 << 31)))
        return out >> 32, (out & 0xFFFFFFFF) - (1 << 31)

    def judge(self, tokens: np.ndarray, window: int, tolerance: float) -> tuple[np.ndarray, set[int]]:
        """Covered document tokens and matching item ids."""
        edge, found = np.zeros(len(tokens) + 1, np.int64), set()
        item, d = self.diagonals(tokens)
        lo = np.maximum(0, -d)
        n, w = np.minimum(self.size[item], len(tokens) - d) - lo, np.minimum(window, self.size[item])
        item, d, lo, n, w = (x[n >= w] for x in (item, d, lo, n, w))
        for part in _chunks(n, 1 << 20):
            m = n[part]
            own = np.repeat(np.arange(len(m)), m)
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            here = (lo[part] + d[part])[own] + at
            same = np.concatenate(([0], np.cumsum(self.flat[(self.start[item[part]] + lo[part])[own] + at] == tokens[here])))
            fits = np.flatnonzero(at + w[part][own] <= m[own])
            wide = w[part][own[fits]]
            good = same[fits + wide] - same[fits] >= tolerance * wide
            found.update(self.ids[k] for k in np.unique(item[part][own[fits[good]]]))
            np.add.at(edge, here[fits[good]], 1)
            np.add.at(edge, here[fits[good]] + wide[good], -1)
        return np.cumsum(edge)[:-1] > 0, found


def _chunks(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes sum to at most ``most`` (or one element)."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield slice(lo, hi)
        lo = hi


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_tokens: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks whose tokens sum to at most ``block_tokens`` (or one item)."""
    items = benchmark.select(F.col(item_id).cast("long"), F.col(text).cast("string")).where(
        F.col(item_id).isNotNull() & F.col(text).isNotNull())
    block, size = [], 0
    for i, t in items.toLocalIterator():
        n = len(token_hashes(t))
        if block and size + n > block_tokens:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += n
    if block:
        yield block


def flag_contaminated(docs: DataFrame, benchmark: DataFrame, out: str = "decontamination", masks: tuple[str, ...] = MASKS,
                      window: int = 13, tolerance: float = 0.75, min_tokens: int = 5, block_tokens: int = 2_000_000,
                      text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with a struct column (contaminated, n_tokens, matched_tokens, item_ids).

    One narrow pass over the documents per block of items; the benchmark streams
    through the driver block by block and only one block is ever held there.
    """
    spark = docs.sparkSession
    ship(spark)
    out = fresh(docs, out)
    schema = StructType.fromDDL(RESULT)
    result = docs.withColumn(out, F.lit(None).cast(schema))
    arrow = pa.struct([("contaminated", pa.bool_()), ("n_tokens", pa.int64()), ("matched_tokens", pa.int64()),
                       ("item_ids", pa.list_(pa.int64()))])

    def judge(handle):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = SeedIndex(handle.value, masks, min_tokens)
            for b in batches:
                place = b.schema.names.index(out)
                texts, before = b.column(b.schema.names.index(text)), b.column(place)
                rows = []
                for t, old in zip(texts, before):
                    tokens = token_hashes(t.as_py())
                    covered, found = index.judge(tokens, window, tolerance)
                    old, n = old.as_py(), int(covered.sum())
                    if old:
                        found |= set(old["item_ids"])
                        n = max(n, old["matched_tokens"])
                    rows.append({"contaminated": bool(found), "n_tokens": len(tokens), "matched_tokens": n,
                                 "item_ids": sorted(found)})
                yield b.set_column(place, out, pa.array(rows, arrow))
        return run

    empty = True
    for block in _blocks(benchmark, item_id, item_text, block_tokens):
        result = result.mapInArrow(judge(spark.sparkContext.broadcast(block)), result.schema)
        empty = False
    if empty:
        result = result.mapInArrow(judge(spark.sparkContext.broadcast([])), result.schema)
    return result
