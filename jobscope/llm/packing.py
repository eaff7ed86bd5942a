"""Sequence packing: first-fit decreasing with a tournament tree of bin capacities.

Documents are tokenised where they lie, dealt at random (by a hash of id and place in the
text and in the table) into groups of about ``group_docs`` documents or ``group_bytes`` bytes of text, whichever
makes more groups, and every group is packed
by itself in one task, so memory is bounded by the group and no state is shared. Equal rows differ in their
place in the table, so they spread over all groups; the table has to be a stored one (or a projection of one), whose rows come in the
same order when a lost task reads them again.
Pieces of at most ``capacity`` tokens are placed longest first into the first
bin that still has room; a tournament tree over the bins' free space finds it
in log(bins) steps. Bins that stay short are then topped up with tokens cut
from the emptiest bins, so at most one bin of a group is not full.

Defined results: a null or empty text is the one end token; a null id is kept;
repeated rows are packed as documents of their own; texts longer than
``LONG`` tokens are dealt in runs of ``LONG`` tokens so no group grows with one
document; an empty table gives no pieces. Only the id and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import ship

END = 1
LONG = 64 * 2048
MEMO_WORDS = 400_000
#: Longer texts are split into words in stretches of about this many characters.
STRETCH = 1 << 20
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
_STATE: dict = {}
_ODD = re.compile("[\x1c-\x1f]")
_PLAIN = re.compile("[!-~\xa1-\xff]+")
#: Texts of Latin-1 and plain white space, and their pieces once lower-cased: the tokenizer's letters, numbers and the rest.
_LATIN = re.compile("[\t-\r -~\xa1-\xff]*")
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+").findall
_GAP = re.compile(r"\s")


class Memo(dict):
    """Made values by key; two generations of ``MEMO_WORDS``, so what is in use survives when old entries go."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= MEMO_WORDS:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordTokenizer:
    """Token ids of whole texts, the tokenizer's own per piece, remembered by piece.

    The vocabulary's rules never join characters across white space. A text of Latin-1 characters is cut
    into the pieces of the tokenizer's own pattern in one go, and each distinct piece goes to its BPE model once. In other texts, a
    chunk between white space goes the same way if it is printable Latin-1, else to the whole tokenizer.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tok.get_vocab_size() < 65536 else np.dtype("<u4")
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.table = {b: chr(b) for b in shown} | {
            b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.pieces, self.chunks = Memo(self._piece), Memo(self._chunk)

    def _raw(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        shown = piece.encode("utf-8").decode("latin-1").translate(self.table)
        return self._raw([t.id for t in self.tok.model.tokenize(shown)])

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
            return b"".join(map(self.pieces.__getitem__, self.split(chunk.lower())))
        return self._raw(self.tok.encode(chunk, add_special_tokens=False).ids)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            return self._raw(self.tok.encode(text, add_special_tokens=False).ids)
        if len(text) <= STRETCH:
            return self._stretch(text)
        out, lo = [], 0
        while lo < len(text):  # a stretch ends at white space, which no token crosses
            gap = _GAP.search(text, lo + STRETCH)
            hi = gap.start() if gap else len(text)
            out.append(self._stretch(text[lo:hi]))
            lo = hi
        return b"".join(out)

    def _stretch(self, text: str) -> bytes:
        if _LATIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, _PIECES(text.lower())))
        return b"".join(map(self.chunks.__getitem__, text.split()))


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _STATE:
        _STATE[path] = WordTokenizer(path)
    return _STATE[path]


def tokenise(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, start, ids, width, doc_tokens, place); runs of at most ``LONG`` ids, the last ends with ``END``.

    ``place`` tells rows of the table apart.
    """
    ship(docs.sparkSession)
    schema = "doc_id long, start long, ids binary, width int, doc_tokens long, place long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = _tokenizer(vocabulary)
        width = tok.dtype.itemsize
        end = np.asarray([END], tok.dtype).tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows = []
                for i, t, place in zip(*(part.column(k).to_pylist() for k in range(3))):
                    ids = tok.ids(t) + end
                    n = len(ids) // width
                    for s in range(0, n, LONG):
                        rows.append((i, s, ids[s * width:(s + LONG) * width], width, n, place))
                cols = list(zip(*rows))
                types = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["doc_id", "start", "ids", "width", "doc_tokens", "place"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    return rows.mapInArrow(run, schema)


class TournamentTree:
    """Free space of bins; ``first_fit(n)`` is the lowest bin with at least ``n`` free."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, (bins - 1).bit_length())
        self.best = [capacity] * (2 * self.size)

    def first_fit(self, need: int) -> int:
        best, node = self.best, 1
        while node < self.size:
            node *= 2
            if best[node] < need:
                node += 1
        return node - self.size

    def take(self, bin_: int, need: int) -> None:
        best, node = self.best, bin_ + self.size
        best[node] -= need
        node //= 2
        while node:
            left, right = best[2 * node], best[2 * node + 1]
            best[node] = left if left >= right else right
            node //= 2


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers; items (each at most ``capacity``) are placed longest first."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    tree = TournamentTree(max(1, len(lengths)), capacity)
    bins: list[list[int]] = []
    for i in order:
        b = tree.first_fit(lengths[i])
        tree.take(b, lengths[i])
        if b == len(bins):
            bins.append([])
        bins[b].append(i)
    return bins


def top_up(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Fill short bins with pieces (item, start, length) cut from the emptiest bins."""
    bins = sorted(bins, key=lambda b: -sum(p[2] for p in b))
    free = [capacity - sum(p[2] for p in b) for b in bins]
    i, j = 0, len(bins) - 1
    while i < j:
        if not free[i]:
            i += 1
            continue
        item, start, n = bins[j].pop()
        cut = min(n, free[i])
        bins[i].append((item, start, cut))
        free[i] -= cut
        if cut < n:
            bins[j].append((item, start + cut, n - cut))
        if not bins[j]:
            j -= 1
    return bins[:j + 1]


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, group_docs: int = 2000, group_bytes: int = 16 << 20,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset; see the module text.

    ``with_ids`` adds the token ids of each piece (binary, little-endian uint32).
    ``sequence_id`` is the group number times 2**32 plus the bin number.
    """
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text).cast("string"))), F.lit(0))).first()
    groups = max(1, -(-rows // group_docs), -(-size // group_bytes))
    schema = PIECES + (", ids binary" if with_ids else "")
    tokens = tokenise(docs, vocabulary, doc_id, text).withColumn(
        "grp", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", "place"), F.lit(groups))).drop("place")

    def pack_group(t: pa.Table) -> pa.Table:
        grp = t.column("grp")[0].as_py()
        items = []  # (doc_id, start, doc_tokens, ids)
        for d, s, raw, width, n in zip(*(t.column(c).to_pylist() for c in
                                         ("doc_id", "start", "ids", "width", "doc_tokens"))):
            ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4")
            items += [(d, s + k, n, ids[k:k + capacity]) for k in range(0, len(ids), capacity)]
        items.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))
        bins = first_fit_decreasing([len(x[3]) for x in items], capacity)
        rows = []
        for seq, pieces in enumerate(top_up([[(i, 0, len(items[i][3])) for i in b] for b in bins], capacity)):
            offset = 0
            for i, lo, n in pieces:
                d, s, total, ids = items[i]
                raw = ids[lo:lo + n].astype("<u4").tobytes()
                rows.append((d, s + lo, n, zlib.crc32(raw), total, grp * 2**32 + seq, offset)
                            + ((raw,) if with_ids else ()))
                offset += n
        cols = list(zip(*rows))
        types = [pa.int64()] * 7 + [pa.binary()] * with_ids
        names = [c.split()[0] for c in schema.split(", ")]
        return pa.table([pa.array(c, ty) for c, ty in zip(cols, types)], names=names)

    return tokens.groupBy("grp").applyInArrow(pack_group, schema)
