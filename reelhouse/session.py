"""Session settings for local runs; a cluster passes its own through spark-submit."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


#: Folders written in each open `scratch` block, innermost last.
_SCRATCH: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scratch", default=())


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reelhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REELHOUSE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder. Only a local session may do without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="reelhouse-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}"


def written(df: DataFrame, purpose: str, keep: bool = False) -> DataFrame:
    """Write a plan once to the shared folder and read it back, where several plans go on from it.

    Inside a `scratch` block the folder goes with the block; with `keep` it goes with the block around that, if there is one.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"{purpose}-{uuid.uuid4().hex}")
    blocks = _SCRATCH.get()
    blocks = blocks[:-1] if keep else blocks
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A block whose written plans are removed at its end, but for those written with `keep`."""
    paths: list[str] = []
    before = _SCRATCH.set((*_SCRATCH.get(), paths))
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        for path in paths:
            remove(spark, path)


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written to its end."""
    files, place = _located(spark, f"{path.rstrip('/')}/_SUCCESS")
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of whatever store holds it; none if there is no such folder."""
    files, place = _located(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _located(spark, path)
    files.delete(place, True)


@contextlib.contextmanager
def held(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """A plan written once, as `written` does, for as long as the block runs; its folder is removed afterwards."""
    path = shared_folder(df.sparkSession, f"{purpose}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove(df.sparkSession, path)
