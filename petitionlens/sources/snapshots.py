"""Versions of a stored table, told apart by small manifest files.

Every load writes its rows to a folder of its own, ``target/_loads/load=<id>``
(which Spark does not list by itself), and then commits ``target/_manifests/<version>.json``, which lists the loads that
make up the table.  Readers take the newest manifest and read only the loads it
names.  So a load that is killed leaves nothing that can be seen, an overwrite
replaces the table in one step while readers of the old version go on, and an
append rewrites nothing.  A manifest is written aside and renamed, and a rename
onto an existing name is refused: of two loads that began on the same version
one commits and the other learns of it.  This needs a file system whose rename
is atomic (HDFS, local disks).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from petitionlens.schema import CLEAN, SchemaMismatch, require

MANIFESTS = "_manifests"
LOADS = "_loads"


class ConcurrentLoad(RuntimeError):
    """Another load committed the version that this one was about to write."""


@dataclass(frozen=True)
class Manifest:
    """A version of the table: its loads (path, rows) in the order of their commits."""

    version: int
    loads: tuple[tuple[str, int], ...]

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.loads)


class Folder:
    """A folder on whatever file system Spark finds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.at = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.at.getFileSystem(self.conf)

    def _child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.at, name)

    def names(self) -> list[str]:
        if not self.fs.exists(self.at):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at))

    def read(self, name: str) -> str:
        return self.jvm.org.apache.commons.io.IOUtils.toString(self.fs.open(self._child(name)), "UTF-8")

    def create(self, name: str, text: str) -> bool:
        """Write a file that must not exist yet; False if it does."""
        aside = self._child(f".{name}.{uuid.uuid4().hex}")
        out = self.fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at.toUri(), self.conf)
        plain = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(aside, self._child(name), plain)
        except Py4JJavaError as e:
            self.fs.delete(aside, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._child(name), True)


def manifest_name(version: int) -> str:
    return f"{version:010d}.json"


def versions(spark: SparkSession, target: str) -> list[int]:
    """The committed versions, oldest first."""
    return [int(n[:-5]) for n in Folder(spark, f"{target.rstrip('/')}/{MANIFESTS}").names() if n.endswith(".json") and n[0] != "."]


def manifest(spark: SparkSession, target: str, version: int | None = None) -> Manifest | None:
    """The newest version, or a given one; None if the table has none."""
    if version is None:
        known = versions(spark, target)
        if not known:
            return None
        version = known[-1]
    found = json.loads(Folder(spark, f"{target.rstrip('/')}/{MANIFESTS}").read(manifest_name(version)))
    if found["schema"] != CLEAN.simpleString():
        raise SchemaMismatch(f"{target} version {version} was written as {found['schema']}")
    return Manifest(version, tuple((x["path"], x["rows"]) for x in found["loads"]))


def commit(spark: SparkSession, target: str, after: Manifest | None, loads: Sequence[tuple[str, int]]) -> Manifest:
    """Make ``loads`` the version that follows ``after``; raises ConcurrentLoad if there is one already."""
    new = Manifest(after.version + 1 if after else 1, tuple(loads))
    text = json.dumps({"schema": CLEAN.simpleString(), "loads": [{"path": p, "rows": n} for p, n in loads]}, indent=1)
    if not Folder(spark, f"{target.rstrip('/')}/{MANIFESTS}").create(manifest_name(new.version), text):
        raise ConcurrentLoad(f"{target}: version {new.version} was committed by another load")
    return new


def read_snapshot(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The newest version of the table, or a given one."""
    found = manifest(spark, target, version)
    if found is None:
        raise FileNotFoundError(f"{target} has no manifest")
    paths = [f"{target.rstrip('/')}/{p}" for p, n in found.loads if n]
    if not paths:
        return spark.createDataFrame([], CLEAN)
    df = spark.read.schema(CLEAN).option("basePath", f"{target.rstrip('/')}/{LOADS}").parquet(*paths)
    return df.select([F.col(f.name) for f in CLEAN.fields])


def was_committed(spark: SparkSession, target: str, load: str) -> bool:
    """Whether some version that is still kept names ``load``; manifests are read only if its folder exists."""
    if load.rsplit("/", 1)[-1] not in Folder(spark, f"{target.rstrip('/')}/{LOADS}").names():
        return False
    return any(load == p for v in reversed(versions(spark, target)) for p, _ in manifest(spark, target, v).loads)


def write_load(df: DataFrame, target: str, partition_by: Sequence[str] = (), name: str | None = None) -> str:
    """Write ``df`` as a load that no version names yet; returns its folder's name.

    Under a ``name`` of its own a load can be repeated: what an attempt that
    was never committed left there is replaced.
    """
    mode = "overwrite" if name else "errorifexists"
    name = f"{LOADS}/load={name or uuid.uuid4().hex}"
    require(df, CLEAN)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{target.rstrip('/')}/{name}")
    return name


def stored_rows(spark: SparkSession, target: str, load: str) -> int:
    base = target.rstrip("/")
    return spark.read.schema(CLEAN).option("basePath", f"{base}/{LOADS}").parquet(f"{base}/{load}").count()


def expire(spark: SparkSession, target: str, keep: int = 1) -> list[str]:
    """Drop all but the newest ``keep`` versions, and the loads that only they named; returns these.

    Folders that no manifest names are left alone: a load may be writing one.
    """
    if keep < 1:
        raise ValueError("keep at least one version")
    known = versions(spark, target)
    kept = {p for v in known[-keep:] for p, _ in manifest(spark, target, v).loads}
    gone = sorted({p for v in known[:-keep] for p, _ in manifest(spark, target, v).loads} - kept)
    for v in known[:-keep]:
        Folder(spark, f"{target.rstrip('/')}/{MANIFESTS}").delete(manifest_name(v))
    for p in gone:
        Folder(spark, target).delete(p)
    return gone
