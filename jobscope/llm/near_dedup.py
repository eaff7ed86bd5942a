"""Near-duplicate groups: SuperMinHash signatures, banding, exact verification, union-find.

1. Every text's five-word shingle set becomes a SuperMinHash signature: each
   element walks one random permutation of the slots and offers (step + random)
   to the slot it visits; a document stops as soon as every slot is filled, so
   long sets need few steps. The walk is done for all elements of a batch at once.
2. Equal sets collapse to one representative (partial aggregate, so a group
   of copies of any size costs one row).
3. Bands of the signature are bucket keys. In each bucket with several
   representatives, the one that shares most buckets is the centre and the
   others are paired with it: pairs grow with rows, not with their square.
4. Pairs that size and signature do not rule out are confirmed on the full
   sets, and links are closed to components.
5. Members of buckets that still hold several components are compared in full with all
   members of other components that size and signature do not rule out, in blocks; only links that join
   components come out, so no connection between different texts is lost and output stays linear.

Defined results: a null or empty text, or one without words, has the empty set
and is linked with nothing; a null id links nothing, is kept and has a null
component; a document is an id and a text (by its hash), so rows that repeat both are one and rows
that share only the id are documents of their own, the smaller text hash first; an empty table
gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobscope.llm.common import discard, fresh, ship, written
from jobscope.llm.graph import components
from jobscope.llm.hashing import mix64, shingle_hashes

BANDS, ROWS = 40, 5
#: A document in graphs and joins: its id and the hash of its text.
NODE, NODE_ARROW = "struct<d:bigint,t:bigint>", pa.struct([("d", pa.int64()), ("t", pa.int64())])
PAIR = f"a {NODE}, b {NODE}"
#: A pair whose signatures agree on this much less than the threshold is ruled out (five standard errors at 200 slots).
MARGIN = 0.15


def _node(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).cast("long").alias("d"), F.xxhash64(F.col(text).cast("string")).alias("t"))


def super_minhash(elements: np.ndarray, owner: np.ndarray, n_sets: int, slots: int) -> np.ndarray:
    """(n_sets, slots) signature values; ``owner`` gives the set of each element hash."""
    best = np.full(n_sets * slots, np.inf)
    draws: list[np.ndarray] = []
    h, own = elements, owner.astype(np.int64)
    for step in range(slots):
        if not len(h):
            break
        u = mix64(h + np.uint64((step * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))
        value = (u >> np.uint64(11)).astype(np.float64) * 2.0**-53 + step
        k = (step + mix64(u ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(slots - step)).astype(np.int16)
        slot = k.copy()  # the slot now at place k after the earlier swaps
        for i in range(step - 1, -1, -1):
            slot[slot == draws[i]] = i
        np.minimum.at(best, own * slots + slot, value)
        draws.append(k)
        open_ = np.isinf(best.reshape(n_sets, slots)).any(axis=1)[own]
        if not open_.all():
            h, own, draws = h[open_], own[open_], [d[open_] for d in draws]
    return best.reshape(n_sets, slots)


def signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n, s1, s2, keys, bits): set size, set digest, band keys and eight bits of each slot."""
    ship(docs.sparkSession)
    slots = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            lo = 0
            while lo < b.num_rows:
                sets, size, hi = [], 0, lo
                while hi < b.num_rows and size < 300_000 and hi - lo < 2000:
                    sets.append(shingle_hashes(texts[hi].as_py(), words))
                    size += len(sets[-1])
                    hi += 1
                n = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
                own = np.repeat(np.arange(len(sets)), n)
                sig = super_minhash(flat, own, len(sets), slots)
                slot_hash = mix64(np.ascontiguousarray(sig).view(np.uint64))
                key = np.zeros((len(sets), bands), np.uint64)
                for r in range(rows):
                    key = mix64(key * np.uint64(31) + slot_hash[:, r::rows])
                key = mix64(key + np.arange(bands, dtype=np.uint64))
                digest = [np.zeros(len(sets), np.uint64) for _ in range(2)]
                for d, salt in zip(digest, (0x1234567, 0x89ABCDEF01)):
                    np.add.at(d, own, mix64(flat + np.uint64(salt)))
                keys = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(sets) + 1) * bands, bands, dtype=np.int32)),
                                                pa.array(key.astype(np.int64).ravel()))
                bits = [row.tobytes() for row in slot_hash.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n), pa.array(digest[0].astype(np.int64)),
                     pa.array(digest[1].astype(np.int64)), keys, pa.array(bits, pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "keys", "bits"])
                lo = hi

    return docs.mapInArrow(run, f"doc_id {NODE}, n long, s1 long, s2 long, keys array<long>, bits binary")


def _plausible(pairs: DataFrame, sig: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that neither set sizes nor signatures rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if not t.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint8).reshape(t.num_rows, -1)
                    for c in ("bits_a", "bits_b"))
            same = (x == y).mean(axis=1)
            keep = pa.array((same - 1 / 256) * 256 / 255 >= percent / 100 - MARGIN)
            yield t.select(["a", "b"]).filter(keep)

    side = {c: sig.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
            for c in "ab"}
    return (pairs.join(side["a"], "a").join(side["b"], "b")
            .where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
            .select("a", "b", "bits_a", "bits_b").mapInArrow(run, PAIR))


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs whose full sets satisfy 100 * |A & B| >= percent * |A | B|."""
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    full = _set_rows(docs, ids, words)
    x, y = (full.select(F.col("id").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    out = written(pairs.join(x, "a").join(y, "b").select("a", "b", "set_a", "set_b").mapInArrow(test, PAIR),
                  "links")
    discard(full)
    return out


def _maybe_in(rows: DataFrame, ids: DataFrame, bits_per_id: int = 32, max_bits: int = 1 << 28) -> DataFrame:
    """``rows`` (id, text) whose id may be in ``ids``: all that are, and a few others; a filter before the shuffle.

    One bit per hash value, at most ``max_bits`` (32 MB) whatever the number of ids: beyond that
    more rows pass, and the join that follows is as right as before.
    """
    size = 1 << min(max_bits.bit_length() - 1, max(16, (ids.count() * bits_per_id).bit_length()))
    at = F.pmod(F.xxhash64("id.d", "id.t"), F.lit(size))
    words = ids.select(at.alias("at")).groupBy(F.expr("at div 32").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits")).toPandas()
    table = np.zeros(size // 32, np.uint32)
    table[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    known = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        for b in batches:
            x = b.column(2).to_numpy(zero_copy_only=False)
            yield b.select(["id", "text"]).filter(pa.array((bits[x >> 5] >> (x & 31).astype(np.uint32)) & 1 == 1))

    return rows.select("id", "text", at.alias("at")).mapInArrow(run, f"id {NODE}, text string")


def _set_rows(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the documents in ``ids``, as a written table; other texts, but for a few, are not shuffled."""
    ids = written(ids, "ids")
    near = _maybe_in(docs.select(F.col("doc_id").alias("id"), "text"), ids)
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                s = b.slice(lo, 500)
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array([shingle_hashes(t, words).tobytes() for t in s.column(1).to_pylist()],
                                           pa.binary())], names=["id", "shingles"])

    out = written(near.join(ids, "id", "left_semi").mapInArrow(
        sets, f"id {NODE}, shingles binary"), "sets")
    discard(ids)
    return out


def spanning_links(rep: np.ndarray, comp: np.ndarray, bits: np.ndarray, sets: list[np.ndarray], left: np.ndarray,
                   right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between rows of ``left`` and ``right`` that join different components, each of them confirmed.

    Every pair across components is ruled out by size or signature or compared in full;
    components that a link has joined are one from then on, so no more links than components come out.
    """
    label = np.unique(comp, return_inverse=True)[1]
    n = np.array([len(s) for s in sets], np.int64)
    flat, start = np.concatenate(sets), np.concatenate(([0], np.cumsum(n)))
    out = []
    for x in left:
        y = right[label[right] != label[x]]
        y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent]
        if len(y):
            same = (bits[y] == bits[x]).mean(axis=1)
            y = y[(same - 1 / 256) * 256 / 255 >= percent / 100 - MARGIN]
        if not len(y):
            continue
        ends = np.cumsum(n[y])
        values = flat[np.repeat(start[y] - (ends - n[y]), n[y]) + np.arange(ends[-1])]
        at = np.minimum(np.searchsorted(sets[x], values), n[x] - 1)
        both = np.add.reduceat((sets[x][at] == values).astype(np.int64), ends - n[y])
        for k in y[100 * both >= percent * (n[x] + n[y] - both)]:
            if label[k] != label[x]:
                out.append((int(min(rep[x], rep[k])), int(max(rep[x], rep[k]))))
                label[label == label[k]] = label[x]
    return out


def _flat(nodes: pa.ChunkedArray) -> list[pa.Array]:
    """The two fields of a column of nodes."""
    return pa.concat_arrays([c.cast(NODE_ARROW) for c in nodes.chunks]).flatten()


def _across(left: DataFrame, heads: DataFrame, docs: DataFrame, words: int, percent: int, block: int = 3000) -> DataFrame:
    """Links (a, b) between components that still share buckets.

    Buckets that share a member form a cluster; each member comes once, with its set, and a
    cluster is compared in blocks: block i meets block j in the task (cluster, i, j).
    """
    def compare(t: pa.Table) -> pa.Table:
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        d, x = (part.to_numpy() for part in _flat(t.column("rep")))
        t = t.take(np.lexsort((x, d))).combine_chunks()
        node, blk = t.column("rep"), t.column("blk").to_numpy()
        comp = np.unique(np.stack([part.to_numpy() for part in _flat(t.column("comp"))], 1), axis=0, return_inverse=True)[1].ravel()
        bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint8).reshape(t.num_rows, -1)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        links = spanning_links(np.arange(t.num_rows), comp, bits, sets, np.flatnonzero(blk == i), np.flatnonzero(blk == j), percent)
        return pa.table({c: node.take(pa.array([x[k] for x in links], pa.int64())) for k, c in enumerate("ab")})

    low = left.groupBy("key").agg(F.min("rep").alias("low"))
    cluster = components(left.join(low, "key").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    cluster = cluster.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    rows = written(left.select("rep", "comp").distinct().join(cluster, "rep"), "clusters")
    sets = _set_rows(docs, rows.select(F.col("rep").alias("id")).distinct(), words)
    size = rows.groupBy("cluster").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    rows = (rows.join(size, "cluster").join(heads.select(F.col("doc_id").alias("rep"), "bits"), "rep")
            .join(sets.select(F.col("id").alias("rep"), "shingles"), "rep")
            .withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")))
    return written(rows.select("cluster", "i", "j", "blk", "rep", "comp", "bits", "shingles").groupBy("cluster", "i", "j")
                   .applyInArrow(compare, PAIR), "links")


def _groups(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = BANDS, rows: int = ROWS,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, n_shingles, component, kept) of every row; nodes and components are id and text hash."""
    docs = docs.select(_node(doc_id, text).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sig = written(signatures(docs, words, bands, rows), "signatures")
    real = sig.where("n > 0 and doc_id.d is not null")
    reps = real.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"))
    classes = written(reps, "classes")
    heads = sig.join(classes.select(F.col("rep").alias("doc_id"), "s1", "s2", "n"), ["doc_id", "s1", "s2", "n"],
                     "left_semi").select("doc_id", "n", "keys", "bits")
    spread = heads.select(F.explode("keys").alias("key"), F.col("doc_id").alias("rep"))
    # whether a bucket has several nodes is seen by their hashes, which aggregate in place
    shared = written(spread.groupBy("key").agg(F.min(F.xxhash64("rep")).alias("lo"), F.max(F.xxhash64("rep")).alias("hi"),
                                               F.count("*").alias("size")).where("lo < hi").select("key", "size"), "keys")
    members = written(spread.join(shared, "key"), "members")
    degree = members.groupBy("rep").agg(F.sum("size").alias("degree"))
    members = written(members.select("key", "rep").join(degree, "rep"), "members")

    best = members.groupBy("key").agg(F.min_by("rep", F.struct(-F.col("degree"), F.col("rep"))).alias("centre"))
    pairs = members.join(best, "key").where("rep <> centre").select(
        F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()
    links = _confirmed(written(_plausible(pairs, heads, percent), "pairs"), docs, words, percent)
    comps = written(components(links), "components")
    left = members.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("comp"))
    mixed = left.groupBy("key").agg(F.min(F.xxhash64("comp")).alias("lo"), F.max(F.xxhash64("comp")).alias("hi")).where("lo < hi")
    left = written(left.join(mixed.select("key"), "key", "left_semi"), "open")
    more = _across(left, heads, docs, words, percent)
    if not more.isEmpty():
        comps = written(components(links.unionAll(more)), "components")
    member = sig.where("n > 0").select("doc_id", "n", "s1", "s2").join(classes, ["s1", "s2", "n"], "left")
    out = member.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("doc_id").alias("node"), F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id.d").isNotNull(), F.coalesce("component", "rep")).alias("component"))
    out = out.unionAll(sig.where("n = 0").select(F.col("doc_id").alias("node"), F.col("n").alias("n_shingles"), F.col("doc_id").alias("component")))
    return out.withColumn("kept", F.col("node.d").isNull() | F.coalesce(F.col("node") == F.col("component"), F.lit(True)))


def near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; see the module text.

    ``kept`` says whether the id is its component's smallest (true for null ids); :func:`keep_one` also chooses among rows of one id.
    """
    own, least = F.col("node.d"), F.col("component.d")
    return _groups(docs, **settings).select(own.alias("doc_id"), "n_shingles", least.alias("component_id"),
                                            F.coalesce(own == least, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One row of each near-duplicate group and of rows equal in id and text, all columns kept."""
    d, t = (fresh(docs, c) for c in ("node_d", "node_t"))
    node = _node(settings.get("doc_id", "doc_id"), settings.get("text", "text"))
    found = written(_groups(docs, **settings), "groups").select(F.col("node.d").alias(d), F.col("node.t").alias(t), "kept")
    gone = found.where(~F.col("kept")).select(d, t).distinct()
    left = docs.withColumn(d, node["d"]).withColumn(t, node["t"]).join(gone, [d, t], "left_anti")
    again = written(found.where("kept").where(F.col(d).isNotNull()).groupBy(d, t).count().where("count > 1").select(d, t), "repeated")
    if again.isEmpty():
        return left.select(*docs.columns)
    one = left.join(again, [d, t], "left_semi").dropDuplicates([d, t])
    return left.join(again, [d, t], "left_anti").select(*docs.columns).unionAll(one.select(*docs.columns))
