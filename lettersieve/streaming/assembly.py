"""Documents from a stream of chunks of field values."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# A chunk: one piece of the value of one event of one document, with the time it was sent.
CHUNKS = "box string, uid bigint, seq bigint, key_type string, hdr_name string, chunk bigint, value string, sent_at timestamp"
DOCUMENTS = (
    "box string, uid bigint, chunks array<struct<seq: bigint, key_type: string, hdr_name: string, chunk: bigint, value: string>>"
)
GAP = "5 minutes"
DELAY = "10 minutes"


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(CHUNKS).parquet(folder)


def gathered(chunks: DataFrame, gap: str = GAP, delay: str = DELAY) -> DataFrame:
    """(box, uid, chunks) of each document that is complete.

    A document is complete once no chunk of it was sent for ``gap`` and the watermark, ``delay`` behind the
    newest chunk, has passed that. Its chunks are in the state until then and leave it with the document, so
    the state holds what was sent in about ``gap`` and ``delay``, whatever the stream has seen before.
    """
    piece = F.struct("seq", "key_type", "hdr_name", "chunk", "value")
    return (
        chunks.withWatermark("sent_at", delay)
        .groupBy("box", "uid", F.session_window("sent_at", gap).alias("session"))
        .agg(F.collect_list(piece).alias("chunks"))
        .select("box", "uid", "chunks")
    )


def _to_folders(rows: DataFrame, folder: str, progress: str) -> StreamingQuery:
    # A batch that is run again after a failure overwrites its own folder.
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return (
        rows.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )


def run(spark: SparkSession, root: str, gap: str = GAP, delay: str = DELAY) -> None:
    """Reads what is new in ``root``/in and adds the documents completed by it to ``root``/documents."""
    rows = gathered(read_chunks(spark, f"{root}/in"), gap, delay)
    _to_folders(rows, f"{root}/documents", f"{root}/progress").awaitTermination()


def completed(spark: SparkSession, root: str) -> DataFrame:
    """(box, uid, chunks) of the documents completed so far."""
    try:
        return spark.read.schema(DOCUMENTS).parquet(f"{root}/documents").select("box", "uid", "chunks")
    except AnalysisException:
        return spark.createDataFrame([], DOCUMENTS)


def chunks_of(documents: DataFrame) -> DataFrame:
    """The chunks of completed documents, one row each, for ``documents.join_chunks``.

    A document that was sent again after a pause was completed twice: its chunks are those of both.
    """
    return documents.select("box", "uid", F.inline("chunks"))


def late_chunks(spark: SparkSession, root: str) -> DataFrame:
    """The side table: chunks that came too late for a document that was completed without them.

    The state drops what comes behind the watermark, so this is read from the input: chunks of completed
    documents that are in none of them. Only keys of chunks are compared; values are read for the late ones.
    Chunks of documents that are still open are not late.
    """
    done = completed(spark, root)
    arrived = spark.read.schema(CHUNKS).parquet(f"{root}/in")
    taken = chunks_of(done).select("box", "uid", "seq", "chunk")
    closed = done.select("box", "uid").distinct()
    return arrived.join(closed, ["box", "uid"], "left_semi").join(taken, ["box", "uid", "seq", "chunk"], "left_anti")
