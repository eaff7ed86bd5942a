"""Tables kept as partition folders plus numbered manifests.

A table is a folder with two parts. ``data/load=<id>/<column>=<value>/slice=<k>/`` holds Parquet files, written
once and never changed; every write has a load folder of its own. ``versions/<n>.json`` names the folders that make up version n, the table's
columns, and for each stream that writes here the last batch it has put in. The
newest readable manifest is the current version.

* An upsert or purge reads and writes only the partition slices that hold a changed
  row; the new manifest points at the old folders for the rest. ``slices`` deals each
  partition value over several folders by a hash of the keys, so a value with a third of all rows is
  not rewritten whole for one changed key.
* A manifest is created exclusively: of two writers that started from the same version one gets
  the next number, the other a :class:`VersionConflict` (``upsert`` and ``purge`` then start again from the new version).
* A replayed stream batch is recognised by the batch number in the manifest and skipped.
* ``expire`` removes manifests beyond the newest ``keep`` (or older than ``days``) and the folders that
  no remaining one names.

Manifests have one entry per (partition value, slice): they pass through the driver and
grow with the number of partitions, not with the rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobscope.operators import relational as R


class VolumeExceeded(RuntimeError):
    """More rows than the caller's limit were written; they were taken away again and nothing was committed."""


class VersionConflict(RuntimeError):
    """Another writer committed the next version first."""


@dataclass
class Version:
    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)  # "<value folder>/slice=<k>" -> load folders
    schema: str | None = None
    batches: dict[str, int] = field(default_factory=dict)
    written_ms: int = 0


class StoredTable:
    """One table; ``partition_by`` and ``slices`` must be the same for all its users."""

    def __init__(self, spark: SparkSession, root: str, partition_by: str | None = None, slices: int = 1):
        if slices < 1:
            raise ValueError("slices must be at least 1")
        self.spark, self.root, self.partition_by, self.slices = spark, root.rstrip("/"), partition_by, slices

    # ------------------------------------------------------------------ manifests

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/versions")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, number: int) -> Version | None:
        """The manifest, or None while (or after) its writer failed to finish it."""
        fs, p = self._fs(f"{self.root}/versions/{number:09d}.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return Version(**json.loads(text))
        except (ValueError, TypeError):
            return None

    def versions(self) -> list[int]:
        return [n for n in self._numbers() if self._load(n) is not None]

    def current(self) -> Version:
        for n in reversed(self._numbers()):
            v = self._load(n)
            if v is not None:
                return v
        return Version()

    def commit(self, base: Version, new: Version) -> Version:
        """Make ``new`` the version after ``base``, unless another one has come in between."""
        used = self._numbers()
        if self.current().number != base.number:
            raise VersionConflict(f"{self.root}: version {base.number} is no longer current")
        new.number = max(used, default=0) + 1
        new.written_ms = int(time.time() * 1000)
        fs, p = self._fs(f"{self.root}/versions/{new.number:09d}.json")
        # a local file system looks for the file first and then creates it, so two writers can pass: the name is taken there by
        # the atomic call, and stays an unfinished manifest until it is written
        local = fs.getUri().getScheme() == "file" and fs.mkdirs(p.getParent())
        if local and not self.spark._jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).createNewFile():
            raise VersionConflict(f"{self.root}: version {new.number} was taken")
        try:
            out = fs.create(p, local)  # elsewhere exclusive: fails where the file exists
        except Exception as e:  # noqa: BLE001 - the JVM's file-exists error, in whatever class the file system raises
            raise VersionConflict(f"{self.root}: version {new.number} was taken") from e
        try:
            out.write(bytearray(json.dumps(new.__dict__).encode("utf-8")))
        finally:
            out.close()
        return new

    # ------------------------------------------------------------------ data

    def _slice(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``df`` with the column ``slice``."""
        k = F.pmod(F.xxhash64(*keys), F.lit(self.slices)) if keys and self.slices > 1 else F.lit(0)
        return df.withColumn("slice", k.cast("int"))

    def _write(self, df: DataFrame, keys: Sequence[str]) -> dict[str, list[str]]:
        """Write rows as new load folders; slot -> folders."""
        load = f"load={uuid.uuid4().hex}"
        by = ([self.partition_by] if self.partition_by else []) + ["slice"]
        self._slice(df, keys).hint("rebalance", *by).write.partitionBy(*by).parquet(f"{self.root}/data/{load}")
        return {slot: [f"{load}/{slot}"] for slot in self._slots(load)}

    def _slots(self, load: str) -> list[str]:
        """Slots a load folder holds."""
        depth = 2 if self.partition_by else 1
        fs, p = self._fs(f"{self.root}/data/{load}/{'/'.join(['*=*'] * depth)}")
        return ["/".join(s.getPath().toUri().getPath().split("/")[-depth:]) for s in fs.globStatus(p) or []]

    def _read_folders(self, version: Version, folders: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(json.loads(version.schema))
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/{_escaped(f)}" for f in folders]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current() if version is None else self._load(version)
        if v is None or v.schema is None:
            raise FileNotFoundError(f"{self.root}: no version {version or ''}")
        return self._read_folders(v, [f for fs in v.folders.values() for f in fs])

    def _plain(self, df: DataFrame) -> DataFrame:
        clash = {"slice", "load"} & {c.lower() for c in df.columns}
        if clash:
            raise ValueError(f"columns reserved for the folder layout: {sorted(clash)}")
        return df

    # ------------------------------------------------------------------ operations

    def replace(self, df: DataFrame, keys: Sequence[str] = (), limit: int | None = None) -> Version:
        """``df`` is the whole new version. ``keys`` are needed when the table has slices.

        M3: with ``limit`` the written rows are counted (from the files' footers, so ``df`` is computed once and a task that ran
        twice counts once) and a larger result is deleted instead of committed.
        """
        if self.slices > 1 and not keys:
            raise ValueError("a table with slices is written by its keys")
        base = self.current()
        new = Version(folders=self._write(self._plain(df), keys), schema=df.schema.json(), batches=dict(base.batches))
        if limit is not None:
            n = self._read_folders(new, [f for fs in new.folders.values() for f in fs]).count()
            if n > limit:
                for load in {f.split("/")[0] for fs in new.folders.values() for f in fs}:
                    fs, p = self._fs(f"{self.root}/data/{load}")
                    fs.delete(p, True)
                raise VolumeExceeded(f"volume guard: {n} rows, limit {limit}")
        return self.commit(base, new)

    def _slots_of(self, df: DataFrame, keys: Sequence[str]) -> set[str]:
        """Slots that the rows of ``df`` belong to, as folder names (one row per slot reaches the driver)."""
        by = ([self.partition_by] if self.partition_by else []) + ["slice"]
        out = set()
        for r in self._slice(df, keys).select(*by).distinct().collect():
            value = [f"{self.partition_by}={_folder_value(r[0])}"] if self.partition_by else []
            out.add("/".join([*value, f"slice={r['slice']}"]))
        return out

    def upsert(self, updates: DataFrame, keys: Sequence[str], order_col: str, batch: tuple[str, int] | None = None,
               tries: int = 5) -> Version:
        """Replace rows by key; only slots with a key of ``updates`` are read and written.

        ``batch`` = (stream, number): a batch already in the current version changes nothing. The partition
        column has to be one of the keys, so a key never changes its folder.
        """
        if self.partition_by and self.partition_by not in keys:
            raise ValueError(f"the keys must contain the partition column {self.partition_by}")
        for _ in range(tries):
            base = self.current()
            if batch and base.batches.get(batch[0], -1) >= batch[1]:
                return base
            new = Version(folders=dict(base.folders), schema=base.schema or self._plain(updates).schema.json(), batches=dict(base.batches))
            touched = [s for s in self._slots_of(updates, keys) if s in base.folders]
            old = self._read_folders(base, [f for s in touched for f in base.folders[s]]) if touched else None
            new.folders.update(self._write(R.upsert(old, updates, keys, order_col), keys))
            if batch:
                new.batches[batch[0]] = batch[1]
            try:
                return self.commit(base, new)
            except VersionConflict:
                continue
        raise VersionConflict(f"{self.root}: no commit in {tries} tries")

    def purge(self, date_col: str, days: int, as_of, keys: Sequence[str] = (), tries: int = 5) -> Version:
        """M1: remove rows older than ``days``; slots without such a row keep their files.

        A slot's rows stay in it, so ``keys`` must be those the table is written by when it has slices.
        """
        for _ in range(tries):
            base = self.current()
            rows = self.read(base.number)
            cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
            touched = [s for s in self._slots_of(rows.where(F.col(date_col) < cutoff), keys) if s in base.folders]
            if not touched:
                return base
            kept = self._write(R.purge(self._read_folders(base, [f for s in touched for f in base.folders[s]]), date_col, days, as_of), keys)
            new = Version(folders={**{s: f for s, f in base.folders.items() if s not in touched}, **kept}, schema=base.schema,
                          batches=dict(base.batches))
            try:
                return self.commit(base, new)
            except VersionConflict:
                continue
        raise VersionConflict(f"{self.root}: no commit in {tries} tries")

    def expire(self, keep: int | None = None, days: float | None = None, orphan_days: float = 1.0) -> list[int]:
        """M2 retention: drop versions beyond the newest ``keep`` and those older than ``days``; the current one stays.

        Folders that no kept version names go with them; those of writes still under way are younger than ``orphan_days`` and
        stay. Returns the dropped numbers.
        """
        numbers = self.versions()
        now = time.time() * 1000
        loaded = {n: self._load(n) for n in numbers}
        drop = [n for i, n in enumerate(numbers[:-1]) if (keep is not None and len(numbers) - i > keep)
                or (days is not None and now - loaded[n].written_ms > days * 86_400_000)]
        live = {f for n in numbers if n not in drop for fs in loaded[n].folders.values() for f in fs}
        named = {f for n in drop for fs in loaded[n].folders.values() for f in fs}
        for n in drop:  # first the manifests, so no version ever names a missing folder
            fs, p = self._fs(f"{self.root}/versions/{n:09d}.json")
            fs.delete(p, False)
        fs, p = self._fs(f"{self.root}/data/load=*")
        for s in fs.globStatus(p) or []:
            load = s.getPath().getName()
            old = now - s.getModificationTime() > orphan_days * 86_400_000
            held = {f"{load}/{slot}" for slot in self._slots(load)}
            gone = {f for f in held - live if f in named or old}
            if gone == held and (held or old):
                fs.delete(s.getPath(), True)
            else:
                for f in gone:
                    fs.delete(self._fs(f"{self.root}/data/{f}")[1], True)
        return drop


def _folder_value(value) -> str:
    """A partition value as Spark names its folder."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    odd = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
    text = str(value)
    return "".join(f"%{ord(c):02X}" if c in odd else c for c in text) if text else "__HIVE_DEFAULT_PARTITION__"


def _escaped(folder: str) -> str:
    """A folder name as a path to read: wildcard characters are taken literally."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in folder)
