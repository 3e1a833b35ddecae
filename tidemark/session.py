"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Runtime re-planning does the work of hand-placed hints here: key sets that
# turn out small are broadcast, hot join partitions are split, small ones merged.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles longer methods; wide projections run faster in parts.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


# Folders made for sessions without a checkpoint folder.
_OWN_FOLDERS: set[str] = set()


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where that is not set, a folder of the session's warehouse serves, which all executors write tables to; it goes with the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_tidemark/{spark.sparkContext.applicationId}"
    if own not in _OWN_FOLDERS:
        make_folder(spark, own)
        target = spark._jvm.org.apache.hadoop.fs.Path(own)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
        _OWN_FOLDERS.add(own)
    return own


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and lets several outputs
    share one computation.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, steps: list[Callable[[], object]], width: int) -> list:
    """Run steps that each start Spark jobs, ``width`` at a time, and give their results in order.

    The first failure is raised once all steps have ended. Jobs keep the local properties of the calling thread, such as its pool.
    """
    with ThreadPoolExecutor(max(1, width)) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [w.result() for w in waiting]


def one_row(spark: SparkSession, schema: str, values: tuple) -> DataFrame:
    """A single row built inside Spark, without a Python worker."""
    fields = T.StructType.fromDDL(schema).fields
    texts = [v if v is None or isinstance(v, bool | int) else str(v) for v in values]
    return spark.range(1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(texts, fields, strict=True)]
    )


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the file system Spark itself uses for it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    if not folder_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another place in the same file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"{source} could not be moved to {target}")


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name; whether it was written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        return False
    try:
        stream = fs.create(target, False)
    except Py4JJavaError as failed:
        if "AlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def folder_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))
