"""Tables that are replaced as a whole, at once, and may be bucketed.

A table is a folder of versions.  A new version is written beside the others, and becomes the table
when its pointer is created: an empty file whose name holds a number and the version.  Readers take the
pointer of the highest number.  A write that fails or dies leaves no pointer, so the table stays as it
was; runs side by side each publish a whole version, and the one published last is read.  The version
before stays for plans that still read it; older ones are removed.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

_POINTER = re.compile(r"current-(\d{12})-([0-9a-f]{32})")
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Buckets:
    """Rows of equal ``by`` values share one of ``count`` files, in which they are sorted by ``sort``."""

    count: int
    by: tuple[str, ...]
    sort: tuple[str, ...] = ()


class Folder:
    """A folder in whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        at = self._path(self.path)
        return [f.getPath().getName() for f in self._system.listStatus(at)] if self._system.exists(at) else []

    def state(self) -> list[tuple[str, int, int]]:
        """Names, sizes and times of the files a path or a pattern stands for; other files or new ones differ."""
        found = []
        for status in self._system.globStatus(self._path(self.path)) or []:
            files = self._system.listFiles(status.getPath(), True)
            while files.hasNext():
                f = files.next()
                found.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
        return sorted(found)

    def below(self, name: str) -> str:
        return f"{self.path}/{name}"

    def create(self, name: str) -> None:
        """Create an empty file, which is there at once or not at all."""
        at = self._path(self.below(name))
        self._system.mkdirs(at.getParent())
        self._system.createNewFile(at)

    def remove(self, name: str) -> None:
        self._system.delete(self._path(self.below(name)), True)

    def write(self, name: str, text: str) -> None:
        stream = self._system.create(self._path(self.below(name)))
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str | None:
        at = self._path(self.below(name))
        if not self._system.exists(at):
            return None
        stream = self._system.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def versions(folder: Folder) -> list[tuple[int, str]]:
    """(number, version) of all that were published and are still there, the latest first."""
    found = [_POINTER.fullmatch(name) for name in folder.names()]
    return sorted(((int(m[1]), m[2]) for m in found if m), reverse=True)


def current_version(spark: SparkSession, path: str) -> str | None:
    found = versions(Folder(spark, path))
    return found[0][1] if found else None


def _write(df: DataFrame, path: str, version: str, buckets: Buckets | None) -> None:
    if buckets is None:
        df.write.parquet(path)
        return
    writer = df.write.bucketBy(buckets.count, *buckets.by).option("path", path)
    if buckets.sort:
        writer = writer.sortBy(*buckets.sort)
    writer.saveAsTable(_catalog_name(version))
    Folder(df.sparkSession, path).write("_buckets.json", json.dumps(asdict(buckets)))


def _catalog_name(version: str) -> str:
    return f"regiopanel_{version}"


def _open(spark: SparkSession, path: str, version: str) -> DataFrame:
    """A version as a table; a bucketed one is known to the catalog under a name of its own."""
    text = Folder(spark, path).read("_buckets.json")
    if text is None:
        return spark.read.parquet(path)
    name = _catalog_name(version)
    if not spark.catalog.tableExists(name):
        layout = Buckets(**json.loads(text))
        fields = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        by, order = (", ".join(f"`{c}`" for c in names) for names in (layout.by, layout.sort))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({by}) "
            + (f"SORTED BY ({order}) " if order else "")
            + f"INTO {layout.count} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def replace_table(
    df: DataFrame, path: str, buckets: Buckets | None = None, keep: int = KEPT_VERSIONS
) -> DataFrame:
    """Write a new version of a table, publish it, and return it as read back.

    The result no longer depends on what ``df`` was made of, so lost executors do not
    bring back the work before it.  ``df`` may read the version it replaces.
    """
    spark, folder, version = df.sparkSession, Folder(df.sparkSession, path), uuid.uuid4().hex
    target = folder.below(f"v-{version}")
    try:
        _write(df, target, version, buckets)
    except BaseException:
        folder.remove(f"v-{version}")
        raise
    number = max((n for n, _ in versions(folder)), default=0) + 1
    folder.create(f"current-{number:012d}-{version}")
    for old_number, old in versions(folder)[max(keep, 1) :]:
        if old != version:
            folder.remove(f"current-{old_number:012d}-{old}")
            folder.remove(f"v-{old}")
            spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(old)}")
    return _open(spark, target, version)


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """The version published last; a folder without versions is read as plain files."""
    version = current_version(spark, path)
    if version is None:
        return spark.read.parquet(path)
    return _open(spark, f"{path.rstrip('/')}/v-{version}", version)
