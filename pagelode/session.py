"""Session factory, the shared work folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def build_session(app_name: str = "pagelode", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Extra settings are passed as keyword pairs
    with dots written as double underscores (``spark__sql__shuffle__partitions="8"``)."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # HTML pages are wide rows; keep Arrow batches for the markup parser small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def limit_arrow_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Let Python workers of this session get at most ``rows`` rows and about ``size`` bytes at a time: for rows that hold whole texts, in
    sessions made elsewhere too. As Python objects a batch of words takes some ten times its size, in every worker."""
    for what, limit in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{what}"
        set_to = int(spark.conf.get(name).rstrip("b"))
        if set_to <= 0 or set_to > limit:
            spark.conf.set(name, str(limit))


def work_folder(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the one the cluster names in
    ``spark.checkpoint.dir``. Only a local master may fall back to a temporary folder,
    because executors on other machines could not read it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            handle = sc._jsc.sc().getCheckpointDir()
            base = handle.get() if handle.isDefined() else None
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="pagelode-")
            sc.setCheckpointDir(base)
        _folders[app] = f"{base.rstrip('/')}/pagelode-{app}"
    return _folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted as each write ends: nothing reads them once its rows lie in a table. Until
    then they stay, for stages that lost executors repeat. Other queries of the session keep the setting they had."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false", "true"):
        yield


@contextmanager
def unions_apart(spark: SparkSession) -> Iterator[None]:
    """Parts of a union that are planned inside keep tasks of their own. Otherwise parts of one partition each become one task."""
    with _setting(spark, "spark.sql.unionOutputPartitioning", "true", "false"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, default: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives the
    loss of executors, and gives later joins real size statistics."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._written_at = path
    return written


def delete_folder(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of tables that ``materialise`` wrote and that nothing reads any more, as loops leave them behind. Whatever was
    made from them has to be written by then."""
    for table in tables:
        path = getattr(table, "_written_at", None)
        if path:
            delete_folder(table.sparkSession, path)
