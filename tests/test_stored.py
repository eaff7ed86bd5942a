"""Stored tables: partition-wise merge and purge, conflicts, replays, retention."""

import datetime as dt
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest

from jobscope.sources.sinks import write_per_key_bucketed
from jobscope.sources.stored import StoredTable, Version, VersionConflict, VolumeExceeded

SCHEMA = "dc string, k int, v string, d timestamp"


def _rows(spark, rows):
    return spark.createDataFrame([(*r, dt.datetime(2024, 1, 1 + r[1] % 9)) for r in rows], SCHEMA)


def _files(root, *parts):
    out = {}
    for folder, _, names in os.walk(os.path.join(root, "data", *parts)):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "rb") as f:
                    out[os.path.join(folder, n)] = f.read()
    return out


def _content(t):
    return sorted(((r.dc, r.k, r.v) for r in t.read().collect()), key=repr)


@pytest.fixture()
def root():
    return os.path.join(tempfile.mkdtemp(prefix="jobscope-stored-"), "t")


def test_upsert_of_one_centre_leaves_the_files_of_the_others(spark, root):
    t = StoredTable(spark, root, "dc")
    t.replace(_rows(spark, [(dc, k, "old") for dc in ("DS-A", "DS-B", "a/b c=1", None) for k in range(5)]))
    before = _files(root)
    t.upsert(_rows(spark, [("DS-A", 1, "n1"), ("DS-A", 1, "n2"), ("DS-A", 9, "new")]), ["dc", "k"], "v")
    after = _files(root)
    assert {p: b for p, b in after.items() if p in before} == before  # nothing is rewritten in place
    assert set(after) > set(before) and all("dc=DS-A" in p for p in set(after) - set(before))
    assert t.current().folders["dc=DS-B/slice=0"] == t._load(1).folders["dc=DS-B/slice=0"]
    want = [(dc, k, "old") for dc in ("DS-B", "a/b c=1", None) for k in range(5)] + [("DS-A", k, "old") for k in (0, 2, 3, 4)]
    assert _content(t) == sorted(want + [("DS-A", 1, "n2"), ("DS-A", 9, "new")], key=repr)
    t.upsert(_rows(spark, [("a/b c=1", 0, "x"), (None, 77, "y")]), ["dc", "k"], "v")
    assert ("a/b c=1", 0, "x") in _content(t) and (None, 77, "y") in _content(t) and len(_content(t)) == 22
    assert t.read(1).count() == 20 and t.versions() == [1, 2, 3]


def test_slices_split_a_hot_partition(spark, root):
    t = StoredTable(spark, root, "dc", slices=8)
    t.replace(_rows(spark, [("HOT", k, "old") for k in range(200)]), ["dc", "k"])
    before = t.current().folders
    assert len(before) == 8
    t.upsert(_rows(spark, [("HOT", 5, "new")]), ["dc", "k"], "v")
    now = t.current().folders
    assert sum(now[s] != before[s] for s in before) == 1 and len(_content(t)) == 200 and ("HOT", 5, "new") in _content(t)
    with pytest.raises(ValueError):
        t.replace(_rows(spark, []))
    with pytest.raises(ValueError):
        t.upsert(_rows(spark, []), ["k"], "v")


def test_purge_rewrites_only_slots_with_old_rows(spark, root):
    t = StoredTable(spark, root, "dc")
    t.replace(spark.createDataFrame([("A", 1, "x", dt.datetime(2020, 1, 1)), ("A", 2, "x", None), ("B", 3, "x", dt.datetime(2024, 5, 1)),
                                     ("C", 4, "x", dt.datetime(2019, 1, 1))], SCHEMA))
    before = t.current().folders
    t.purge("d", 365, "2024-06-01 00:00:00")
    assert _content(t) == [("A", 2, "x"), ("B", 3, "x")]
    assert t.current().folders["dc=B/slice=0"] == before["dc=B/slice=0"] and "dc=C/slice=0" not in t.current().folders
    assert t.purge("d", 365, "2024-06-01 00:00:00").number == 2  # nothing old: no new version


def test_two_writers_cannot_take_the_same_version(spark, root):
    a, b = StoredTable(spark, root), StoredTable(spark, root)
    a.replace(_rows(spark, [("A", 0, "first")]))
    base = a.current()

    def write(t):
        try:
            return t.commit(base, Version(folders=dict(base.folders), schema=base.schema)).number
        except VersionConflict:
            return None

    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(write, (a, b)))
    assert sorted(x for x in got if x) == [2] and a.versions() == [1, 2]
    with ThreadPoolExecutor(3) as pool:  # whole upserts at once: each starts again after a conflict, none is lost
        list(pool.map(lambda k: StoredTable(spark, root).upsert(_rows(spark, [("A", k, "u")]), ["dc", "k"], "v"), (1, 2, 3)))
    assert _content(a) == [("A", 0, "first"), ("A", 1, "u"), ("A", 2, "u"), ("A", 3, "u")]


def test_an_unfinished_manifest_is_no_version(spark, root):
    t = StoredTable(spark, root)
    t.replace(_rows(spark, [("A", 0, "x")]))
    with open(f"{root}/versions/000000002.json", "w") as f:
        f.write('{"number": 2, "fold')
    assert t.current().number == 1 and t.versions() == [1]
    assert t.replace(_rows(spark, [("A", 1, "y")])).number == 3 and _content(t) == [("A", 1, "y")]


def test_replayed_batch_changes_nothing(spark, root):
    t = StoredTable(spark, root, "dc")
    t.upsert(_rows(spark, [("A", 1, "one")]), ["dc", "k"], "v", batch=("feed", 0))
    t.upsert(_rows(spark, [("A", 1, "two")]), ["dc", "k"], "v", batch=("feed", 1))
    assert t.upsert(_rows(spark, [("A", 1, "one")]), ["dc", "k"], "v", batch=("feed", 0)).number == 2
    assert _content(t) == [("A", 1, "two")]
    t.upsert(_rows(spark, [("A", 2, "other")]), ["dc", "k"], "v", batch=("second feed", 0))
    assert t.current().batches == {"feed": 1, "second feed": 0} and len(_content(t)) == 2


def test_retention_by_count_and_days(spark, root):
    t = StoredTable(spark, root, "dc")
    t.replace(_rows(spark, [("A", 0, "x"), ("B", 0, "x")]))
    for k in range(1, 5):
        t.upsert(_rows(spark, [("A", k, "x")]), ["dc", "k"], "v")
    assert t.expire(keep=2) == [1, 2, 3] and t.versions() == [4, 5] and len(_content(t)) == 6
    assert t.read(4).count() == 5  # a kept version stays whole, B's files of version 1 with it
    centres = sorted(p.split("/dc=")[1][0] for p in _files(root))
    assert centres.count("B") == 1 and len({p.split("load=")[1][:32] for p in _files(root)}) == 3  # two loads of A, the first of B
    assert t.expire(days=0.0) == [4] and t.versions() == [5] and len(_content(t)) == 6
    orphan = f"{root}/data/load=crashed/dc=A/slice=0"
    os.makedirs(orphan)
    t.expire(keep=1)
    assert os.path.exists(orphan)  # may be a write under way
    t.expire(keep=1, orphan_days=0.0)
    assert not os.path.exists(orphan) and len(_content(t)) == 6


def test_reserved_columns_and_missing_tables(spark, root):
    t = StoredTable(spark, root)
    with pytest.raises(FileNotFoundError):
        t.read()
    with pytest.raises(ValueError):
        t.replace(spark.createDataFrame([(1,)], "load int"))
    t.replace(_rows(spark, []))
    assert t.read().count() == 0 and t.read().columns == ["dc", "k", "v", "d"]


def test_volume_guard_counts_the_written_rows(spark, root):
    t = StoredTable(spark, root, "dc")
    t.replace(_rows(spark, [("A", 0, "x")]), limit=1)
    before = _files(root)
    with pytest.raises(VolumeExceeded):
        t.replace(_rows(spark, [("A", k, "y") for k in range(3)]), limit=2)
    assert _content(t) == [("A", 0, "x")] and t.versions() == [1] and _files(root) == before


def test_bucketed_files_do_not_grow_with_the_jobs(spark, root):
    rows = spark.range(6000).selectExpr("concat('job', id % 1500) as job", "id as v").unionAll(
        spark.range(500).selectExpr("'hot' as job", "id as v")).unionAll(spark.range(3).selectExpr("cast(null as string)", "id"))
    index = write_per_key_bucketed(rows, root, "job", 4, min_rows=2, max_records_per_file=2000)
    got = {}
    for r in index.collect():
        got[r.job] = got.get(r.job, 0) + r.rows
    assert got == {**{f"job{k}": 4 for k in range(1500)}, "hot": 500, None: 3}
    assert index.select("file").distinct().count() <= 8
    files = [r.file for r in index.where("job = 'hot'").collect()]
    assert spark.read.parquet(*files).where("job = 'hot'").count() == 500
