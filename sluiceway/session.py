"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cpus: int = 8, app: str = "sluiceway", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master may fall back to
    this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sluiceway-")
    return f"{base.rstrip('/')}/sluiceway/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder."""
    at, files = _folder(spark, path)
    return [found.getPath().getName() for found in files.listStatus(at) if found.isDirectory()]


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder: who lists the target's parent sees all of it or nothing."""
    (at, files), (to, _) = _folder(spark, source), _folder(spark, target)
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"{source} could not be moved to {target}")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``fresh_dir`` named, or one inside it."""
    at, files = _folder(spark, path)
    files.delete(at, True)


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streaming jobs: UTC event times, state kept off heap in RocksDB.

    A sibling keeps these settings away from the caller's own queries. A checkpoint fixes the number of state
    partitions for good, so plan for the cores that will come; it is the session's number of shuffle partitions if
    none is given.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # Counting the rows of the state for its metrics would take a lookup before every write.
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return sibling
