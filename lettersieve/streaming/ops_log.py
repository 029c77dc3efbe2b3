"""Actions that arrive continuously: an append-only log and the current documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lettersieve.operators import upkeep
from lettersieve.plans import index_store


def read_action_files(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream of parquet files: all in a folder, or those that a pattern matches."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_to_log(
    ops: DataFrame,
    log: str,
    checkpoint: str,
    after_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Writes each micro-batch of actions to its own directory of the log.

    A batch that is run again after a failure overwrites its own directory, so every action
    is in the log once. ``after_batch`` runs once the batch is in the log; a checkpoint
    that is advanced there never runs ahead of the data.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{log}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        if after_batch is not None:
            after_batch(batch.sparkSession.read.parquet(target), batch_id)

    return (
        ops.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, log: str, schema) -> DataFrame:
    """All actions in the log, whatever order they came in."""
    return spark.read.schema(schema).parquet(log).select(schema.names)


def current_documents(spark: SparkSession, log: str, schema) -> DataFrame:
    """Order is ``seq`` and not arrival, so late actions fall into place."""
    return upkeep.apply_ops(read_log(spark, log, schema))


# Every version names the folder of each bucket of keys; buckets that a batch did not touch keep theirs.
VERSIONS = "version bigint, upto bigint, bucket int, folder string"
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("box", "uid"), F.lit(BUCKETS)).cast("int")


def _newest(spark: SparkSession, root: str) -> tuple[dict[int, str], int, int]:
    """(folder of each bucket, last batch, version): at most ``BUCKETS`` rows come to the driver."""
    try:
        versions = spark.read.schema(VERSIONS).parquet(f"{root}/versions")
        rows = versions.filter(F.col("version") == (versions.agg(F.max("version")).first()[0] or 0)).collect()
    except AnalysisException:
        rows = []
    folders = {row["bucket"]: row["folder"] for row in rows if row["folder"]}
    return folders, max((row["upto"] for row in rows), default=-1), max((row["version"] for row in rows), default=0)


def _read(spark: SparkSession, root: str, folders, schema) -> DataFrame:
    paths = [f"{root}/{folder}" for folder in sorted(folders)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compacted(spark: SparkSession, root: str, schema) -> tuple[DataFrame, int, int]:
    """(last action of each key, last batch in it, version) as of the newest compaction.

    Deletes are kept: a late action that is older than a delete must not bring a key back.
    """
    folders, upto, version = _newest(spark, root)
    return _read(spark, root, folders.values(), schema), upto, version


def compact(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, schema) -> DataFrame:
    """Folds a batch of the log into the last actions and returns what it changed.

    Keys are dealt to buckets by hash, and only the buckets that the batch touches are read and written.
    Changes are the batch's last actions that are the last of their key. The batch's order
    and number of runs do not matter: an action that is in the table already changes it to
    itself. A version counts once its rows are written, after its data.
    """
    folders, upto, version = _newest(spark, root)
    last = upkeep.last_ops(batch.select(schema.names))
    touched = [row[0] for row in last.select(_bucket().alias("bucket")).distinct().collect()]
    known = _read(spark, root, [folders[b] for b in touched if b in folders], schema)
    folder = f"last-{version + 1}-{uuid.uuid4().hex}"
    merged = upkeep.last_ops(known.unionByName(last)).withColumn("bucket", _bucket())
    merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/{folder}")
    folders |= {b: f"{folder}/bucket={b}" for b in touched}
    rows = [(version + 1, max(upto, batch_id), b, folders.get(b)) for b in range(BUCKETS)]
    spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/versions")
    after = _read(spark, root, [folders[b] for b in touched], schema)
    return after.join(last.select("box", "uid", "seq"), ["box", "uid", "seq"], "left_semi")


def indexing(spark: SparkSession, root: str, schema, document: Column) -> Callable[[DataFrame, int], None]:
    """What to do after each batch: compact it, and run what it changed through the index.

    ``document`` makes the fields of an action's document. The index in ``root``/index holds
    the current documents after every batch; a batch that is run again replaces its own.
    """
    index_store.create(spark, f"{root}/index")

    def after_batch(batch: DataFrame, batch_id: int) -> None:
        changes = compact(spark, f"{root}/compacted", batch, batch_id, schema)
        documents = changes.filter("op = 'index'").select("box", "uid", document.alias("fields"))
        removed = changes.filter("op = 'delete'").select("box", "uid")
        index_store.run(index_store.open_store(spark, f"{root}/index"), documents, removed)

    return after_batch
