"""Documents from a stream of chunks."""

from pyspark.sql import functions as F

from lettersieve.streaming import assembly


def deliver(spark, root, *rows):
    """Rows (uid, seq, chunk, value, minute)."""
    data = [("b", u, s, "HDR", "Subject", c, v, 60 * m) for u, s, c, v, m in rows]
    df = spark.createDataFrame(data, "box string, uid bigint, seq bigint, key_type string, hdr_name string, chunk bigint, value string, t bigint")
    df.withColumn("sent_at", F.timestamp_seconds("t")).drop("t").write.mode("append").parquet(f"{root}/in")
    assembly.run(spark, root)
    return {r.uid: sorted((c.seq, c.chunk, c.value) for c in r.chunks) for r in assembly.completed(spark, root).collect()}


def test_documents_close_behind_the_watermark_and_late_chunks_go_aside(spark, tmp_path):
    root = str(tmp_path)
    assert deliver(spark, root, (1, 0, 1, "lo", 1), (2, 0, 0, "x", 2)) == {}
    # The rest of document 1 comes in the second delivery, before the watermark; 2 and 3 stay open.
    assert deliver(spark, root, (1, 0, 0, "hel", 1), (3, 0, 0, "y", 9)) == {}
    done = deliver(spark, root, (3, 1, 0, "z", 10), (4, 0, 0, "w", 20))
    assert done == {1: [(0, 0, "hel"), (0, 1, "lo")], 2: [(0, 0, "x")]}
    # Chunks behind the watermark (minute 10) are late; documents that are closed stay as they are.
    done = deliver(spark, root, (2, 0, 1, "late", 2), (5, 0, 0, "v", 40))
    assert done[2] == [(0, 0, "x")] and done[3] == [(0, 0, "y"), (1, 0, "z")] and 5 not in done
    late = assembly.late_chunks(spark, root).collect()
    assert [(r.uid, r.chunk, r.value) for r in late] == [(2, 1, "late")]


def test_nothing_completed(spark, tmp_path):
    assert assembly.completed(spark, str(tmp_path)).collect() == []
