"""Tables of intermediate results in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="lettersieve-")
    return _own[application]


_made: dict[str, list[str]] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def close(spark: SparkSession) -> int:
    """Removes the folders that this application made, and nothing else; returns their number.

    Results that are still to be computed read them, so call it after the last one.
    """
    made = _made.pop(spark.sparkContext.applicationId, [])
    for folder in made:
        remove(spark, folder)
    return len(made)


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each execution in here go when it ends, and not when the driver happens to collect garbage.

    For steps that write a table and are read from there.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """The same rows from a table in the shared folder, for results that are used repeatedly."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
