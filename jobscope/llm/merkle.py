"""Merkle manifest of a dataset, with proofs made by checkpoint and recompute.

A row's leaf is the SHA-256 of its columns, each ``-`` if null, else byte count, ``:``
and value. The leaves of a tree (one per ``tree`` value, in ``order`` order) are hashed in
runs of ``fan`` consecutive nodes until one is left, the subroot; the subroots, in order
of their tree value, give the root the same way. A node is the hash of its run's digests as hex text.

Checkpoint and recompute: only every ``every``-th level is stored, each node beside the others
of its aligned subtree (``fan ** every`` descendants, one row). A proof walks down
from the root: for each stored subtree the levels between are hashed again from
its stored descendants, every descendant's siblings are handed out, followed by those of the
subtree's own top, and the levels between are thrown away. Only paths of stored
nodes pass from one band to the next, one per ``fan ** every`` nodes below.

Defined results: a null tree value is a tree of its own and comes first; null order values come
first, and rows that tie are ordered by their leaf, so equal rows are leaves beside each other;
null and empty texts differ (``-`` and ``0:``); a tree of one leaf has that leaf as subroot and one tree alone
has its subroot as root; a lone node in a run is hashed again while its level has others; an
empty table gives no rows. Other columns are not read. A null id counts as the empty text where a
caller picks rows by the id's crc32.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import ship, written
from jobscope.operators.numbering import number_rows, ranges_for

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A subtree: its nodes in order, each with what the caller stored beside its digest.
_NODES = "array<struct<pos:bigint,digest:binary,id:bigint,other:binary>>"


def leaf(columns: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of the columns, each ``-`` if null, else UTF-8 byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hash_run(run: Sequence[bytes]) -> bytes:
    """Digest of a run of digests, written as hex text."""
    return sha256(b"".join(run).hex().encode()).digest()


def interior(level: list[bytes], fan: int, levels: int) -> list[list[bytes]]:
    """The stored level and up to ``levels`` above it, up to one node; ``levels`` < 0: until one is left."""
    out = [level]
    while levels and not (levels < 0 and len(out[-1]) == 1):
        low = out[-1]
        out.append([hash_run(low[i:i + fan]) for i in range(0, len(low), fan)])
        levels -= 1
    return out


def siblings(stack: list[list[bytes]], at: int, fan: int) -> list[tuple[int, list[bytes]]]:
    """(place in the run, the run's other digests) of node ``at`` of the lowest level, level by level below the top."""
    out = []
    for low in stack[:-1]:
        lo = at - at % fan
        run = low[lo:lo + fan]
        out.append((at - lo, run[:at - lo] + run[at - lo + 1:]))
        at //= fan
    return out


def pack_path(path: list[tuple[int, list[bytes]]]) -> bytes:
    """Per level: the place in the run and the number of siblings (one byte each), and their digests."""
    return b"".join(bytes([k, len(run)]) + b"".join(run) for k, run in path)


def unpack_path(raw: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(raw):
        n = raw[i + 1]
        out.append((raw[i], [raw[j:j + 32] for j in range(i + 2, i + 2 + 32 * n, 32)]))
        i += 2 + 32 * n
    return out


def fold(digest: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that ``digest`` leads to with these siblings."""
    for k, run in path:
        digest = hash_run(run[:k] + [digest] + run[k:])
    return digest


def proof_digest(path: list[tuple[int, list[bytes]]]) -> str:
    """Digest of all siblings of a path as hex text, level by level, left to right."""
    return sha256(b"".join(b"".join(run) for _, run in path).hex().encode()).hexdigest()


@dataclass
class Forest:
    """Stored bands of the trees of one kind: subtrees (tree, n, sub, nodes), lowest band first, and tops (tree, digest)."""

    bands: list[DataFrame] = field(default_factory=list)
    tops: DataFrame | None = None
    fan: int = 8
    every: int = 3


def grow(nodes: DataFrame, rows: int, fan: int, every: int) -> Forest:
    """Reduce ``nodes`` (tree, n, pos from 0, digest, id, other), storing one band every ``every`` levels.

    ``n`` is the size of the tree's level, ``rows`` that of the table. A task holds a few subtrees
    (of ``fan ** every`` nodes) at a time.
    """
    width, forest, tops = fan**every, Forest(fan=fan, every=every), None
    tree = nodes.schema["tree"].dataType.simpleString()

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = []
            for n, level in zip(b.column("n").to_pylist(), b.column("nodes")):
                digests.append(interior([x["digest"] for x in level.as_py()], fan, every if n > width else -1)[-1][0])
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("n"), b.column("sub"), pa.array(digests, pa.binary())],
                                             names=["tree", "n", "sub", "digest"])

    ship(nodes.sparkSession)
    while True:
        parts = ranges_for(nodes, rows, 1_000_000)
        dealt = nodes.withColumn("sub", F.expr(f"pos div {width}")).repartition(parts, "tree", "n", "sub")
        band = written(dealt.groupBy("tree", "n", "sub").agg(
            F.array_sort(F.collect_list(F.struct("pos", "digest", "id", "other"))).cast(_NODES).alias("nodes")), "band")
        forest.bands.append(band)
        above = written(band.mapInArrow(climb, f"tree {tree}, n long, sub long, digest binary"), "above")
        done = above.where(F.col("n") <= width).select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        left = above.where(F.col("n") > width)
        rows = left.count()
        if not rows:
            forest.tops = tops
            return forest
        nodes = left.select("tree", F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.col("sub").alias("pos"), "digest",
                            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("other"))


def _with_paths(band: DataFrame, paths: DataFrame) -> DataFrame:
    """Subtrees with the path above their top (``paths``: tree, pos, path, crown)."""
    p = paths.select(F.col("tree").alias("tree_p"), F.col("pos").alias("pos_p"), "path", "crown")
    return band.join(p, F.col("tree").eqNullSafe(F.col("tree_p")) & (F.col("sub") == F.col("pos_p"))).drop("tree_p", "pos_p")


def _walk(b: pa.RecordBatch, fan: int, every: int):
    """(row number, node, its place in the subtree, path up to the root) of every stored node of a batch of subtrees."""
    width = fan**every
    for row, (n, level, up) in enumerate(zip(*(b.column(c).to_pylist() for c in ("n", "nodes", "path")))):
        stack = interior([x["digest"] for x in level], fan, every if n > width else -1)
        above = unpack_path(up)
        for at, x in enumerate(level):
            yield row, x, siblings(stack, at, fan) + above


def descend(forest: Forest, paths: DataFrame) -> DataFrame:
    """The lowest band with the path above each subtree, every band above walked from the top.

    ``paths`` (tree, path, crown) says how each top goes on to the root.
    """
    tree = forest.bands[0].schema["tree"].dataType.simpleString()
    arrow = {"string": pa.string(), "bigint": pa.int64()}[tree]
    fan, every = forest.fan, forest.every

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 16):
                part = b.slice(lo, 16)
                trees, crowns = part.column("tree").to_pylist(), part.column("crown").to_pylist()
                out = [(trees[r], x["pos"], pack_path(path), crowns[r]) for r, x, path in _walk(part, fan, every)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (arrow, pa.int64(), pa.binary(), pa.binary()))],
                                                 names=["tree", "pos", "path", "crown"])

    tops = paths.select("tree", F.lit(0).cast("long").alias("pos"), "path", "crown")
    given = tops
    for k in range(len(forest.bands) - 1, 0, -1):
        # trees that end in this band start from their own top, the others from the band above
        band = _with_paths(forest.bands[k], given)
        below = band.mapInArrow(emit, f"tree {tree}, pos long, path binary, crown binary")
        ends = tops.join(forest.bands[k].select(F.col("tree").alias("tree_b")).distinct(), F.col("tree").eqNullSafe(F.col("tree_b")), "left_anti")
        given = written(below.unionByName(ends), "paths")
    return _with_paths(forest.bands[0], given)


@dataclass
class Manifest:
    """A dataset's trees, the tree over their subroots, and the root (64 hex digits; None for no rows)."""

    trees: Forest
    crown: Forest | None
    root: str | None


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, tree: str = "lang", order: str = "doc_id", fan: int = 8, every: int = 3,
          other: Column | None = None) -> Manifest:
    """The manifest of ``docs``; ``other`` is a second 32-byte digest (or null) to be carried beside each leaf."""
    if not 2 <= fan <= 255:
        raise ValueError("fan must be from 2 to 255")
    none = F.lit(None).cast("binary")
    leaves = written(docs.select(F.col(tree).cast("string").alias("tree"), F.col(order).cast("long").alias("id"),
                                 leaf([F.col(c) for c in columns]).alias("digest"), (none if other is None else other).alias("other")), "leaves")
    placed = number_rows(leaves, ["id", "digest"], ["tree"], "rn", "n")
    trees = grow(placed.withColumn("pos", F.col("rn") - 1), leaves.count(), fan, every)
    tops = written(trees.tops.select(F.col("tree").alias("name"), "digest"), "subroots")
    if tops.isEmpty():
        return Manifest(trees, None, None)
    named = number_rows(tops, ["name"], [], "rn", "n")
    # a subroot's tree value rides along as the second digest, null as no bytes at all
    crown = grow(named.select(F.lit(0).cast("long").alias("tree"), "n", (F.col("rn") - 1).alias("pos"), "digest",
                              F.lit(None).cast("long").alias("id"), F.encode("name", "UTF-8").alias("other")), tops.count(), fan, every)
    return Manifest(trees, crown, bytes(crown.tops.first()["digest"]).hex())


def prove(manifest: Manifest, with_path: bool = False) -> DataFrame:
    """(id, tree, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    ``folded_root`` starts from the second digest of the leaf where there is one; ``with_path`` adds the packed
    proof as column ``path`` (see :func:`unpack_path`).
    """
    fan, every, root = manifest.trees.fan, manifest.trees.every, manifest.root
    schema = ("id long, tree string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean") + (", path binary" if with_path else "")
    if root is None:
        return manifest.trees.tops.sparkSession.createDataFrame([], schema)

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(None if x["other"] is None else x["other"].decode(), pack_path(path), x["digest"]) for _, x, path in _walk(b, fan, every)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.binary(), pa.binary()))],
                                             names=["tree", "path", "crown"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), *[pa.string()] * 6, pa.bool_(), *[pa.binary()] * with_path)
        for b in batches:
            for lo in range(0, b.num_rows, 8):
                part = b.slice(lo, 8)
                trees, crowns = part.column("tree").to_pylist(), part.column("crown").to_pylist()
                out = []
                for r, x, path in _walk(part, fan, every):
                    folded = fold(x["digest"] if x["other"] is None else x["other"], path).hex()
                    out.append((x["id"], trees[r], x["digest"].hex(), crowns[r].hex(), root, proof_digest(path), folded, folded == root)
                               + ((pack_path(path),) if with_path else ()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in schema.split(", ")])

    start = manifest.crown.tops.select("tree", F.lit(b"").alias("path"), F.col("digest").alias("crown"))
    subroots = written(descend(manifest.crown, start).mapInArrow(tops, "tree string, path binary, crown binary"), "paths")
    return descend(manifest.trees, subroots).mapInArrow(leaves, schema)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def audit(docs: DataFrame, columns: Sequence[str] = COLUMNS, tree: str = "lang", order: str = "doc_id", text: str = "text",
          third: int = 3) -> DataFrame:
    """Proofs of all rows, folded from tampered leaves where ``third`` divides the crc32 of the id.

    Tampering lower-cases A-Z in ``text`` and leaves the other columns as they are.
    """
    changed = leaf([lower_ascii(F.col(c)) if c == text else F.col(c) for c in columns])
    picked = F.crc32(F.coalesce(F.col(order).cast("string"), F.lit(""))) % third == 0
    return prove(build(docs, columns, tree, order, other=F.when(picked, changed)))
