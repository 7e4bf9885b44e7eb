"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# A (geo, day) join may reuse the (geo) partitioning the windows leave behind, so the dense
# panel is not shuffled again; after aggregation one region has at most one row per day.
PANEL_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

SETTINGS = {
    **PANEL_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call sites of every column, for error messages: a fifth of the time a large plan takes to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Spark then drops the shuffle files of a plan when it ends, not when the driver next collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Rows that go to a Python worker at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("regiopanel")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Set on a given session what the panel joins rely on, unless its owner decided."""
    for key, value in PANEL_SETTINGS.items():
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting only a local master may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="regiopanel-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Paths that were stored within each open block of ``passing``, by thread.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is stored within is removed at the end, as nothing reads it any more, except what ``stays``.

    That belongs to the block around, if there is one.
    """
    paths: list[str] = []
    token = _passing.set((*_passing.get(), paths))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def stored(df: DataFrame, name: str, stays: bool = False, batch: int | None = None) -> DataFrame:
    """Write ``df`` to an unused path below the shared folder and read it back.

    For intermediates with several consumers: the work before is done once, is not
    repeated when an executor is lost, and Spark knows the exact size for its joins.  What the
    plan shuffled is released once it is written.  ``batch``: rows that go to a Python worker at once.  The
    session's own settings are put back.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    for paths in _passing.get()[: -1 if stays else None][-1:]:
        paths.append(path)
    settings = {RELEASE: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)
