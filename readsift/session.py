"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_BASES: dict[str, str] = {}

# Catalog name that tables of stored indexes begin with.
INDEX_TABLE = "readsift_index"
# Spark's setting that a statement deletes its shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None,
    app: str = "readsift",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators are planned for.

    UTC keeps timestamp arithmetic independent of the cluster's zone. Adaptive
    execution packs small shuffle partitions, turns joins whose side proves small
    into broadcasts, or into hash joins without a sort where every partition of that side
    is small, and splits partitions that one hot key makes too large.
    Shuffle partitions are left to the cluster (``conf``); adaptive execution
    only merges them, so a generous number is safe.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_path(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table.

    It lies in the shared folder named by ``spark.checkpoint.dir``, below a folder of this
    application. Only a local master may go without that setting, since its executors see
    the local disk; the folder made then is removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_BASES:
            _LOCAL_BASES[app] = tempfile.mkdtemp(prefix="readsift-")
            atexit.register(shutil.rmtree, _LOCAL_BASES[app], ignore_errors=True)
        base = _LOCAL_BASES[app]
    app = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/readsift/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the staging folder and read it back.

    Cuts the plan where several results share a costly step: the step runs once, survives
    lost executors, and Spark knows the size of what it joins from there on. Sequences take
    about a quarter of their letters on disk.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    write_staged(df, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a statement in this block is deleted when the statement ends.

    Else shuffle files stay until the driver happens to collect its garbage, those of one step on
    top of those of the next. For statements that write a table, whose shuffles serve no other.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def write_staged(df: DataFrame, path: str) -> None:
    """Write a table of the staging folder."""
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all tables this application has staged; results built on them are gone too."""
    for table in spark.catalog.listTables(pattern=f"{INDEX_TABLE}_*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{base.rstrip('/')}/readsift/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
