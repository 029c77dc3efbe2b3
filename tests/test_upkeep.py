import random

import pytest
from pyspark.sql import functions as F

from lettersieve.operators import slices, upkeep
from lettersieve.sources import shared
from lettersieve.streaming import ops_log

OPS = "box string, uid bigint, seq bigint, op string, subject string"
KEYS = "box string, uid bigint"
MARKS = "box string, last_indexed_uid bigint"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def random_ops(n=400):
    rng = random.Random(2)
    return [
        (rng.choice("aaab"), rng.randint(1, 25), seq, rng.choice(["index", "index", "delete"]), f"s{seq}")
        for seq in range(n)
    ]


def replayed(ops):
    docs = {}
    for box, uid, seq, op, subject in sorted(ops, key=lambda o: o[2]):
        docs.pop((box, uid), None)
        if op == "index":
            docs[box, uid] = (seq, subject)
    return sorted((box, uid, *doc) for (box, uid), doc in docs.items())


def test_last_action_wins(spark):
    ops = random_ops()
    shuffled = random.Random(1).sample(ops, len(ops))
    assert rows(upkeep.apply_ops(spark.createDataFrame(shuffled, OPS))) == replayed(ops)


def test_index_delete_index_and_unknown_delete(spark):
    ops = [("b", 1, 1, "index", "x"), ("b", 1, 2, "delete", None), ("b", 1, 3, "index", "y"), ("b", 9, 4, "delete", None)]
    assert rows(upkeep.apply_ops(spark.createDataFrame(ops, OPS))) == [("b", 1, 3, "y")]


def test_no_actions(spark):
    assert rows(upkeep.apply_ops(spark.createDataFrame([], OPS))) == []


def test_expunge(spark):
    docs = spark.createDataFrame([("b", 1), ("b", 2), ("c", 1)], KEYS)
    gone = spark.createDataFrame([("b", 1), ("b", 1), ("z", 5)], KEYS)
    assert rows(upkeep.expunge(docs, gone)) == [("b", 2), ("c", 1)]


@pytest.fixture(params=["broadcast", "shuffled"])
def joins(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(slices, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(slices, "SLICE_BITS", 2)


def test_last_uid_and_backlog(spark, joins):
    messages = spark.createDataFrame([(b, u) for b in "abcd" for u in range(1, 21)], KEYS)
    marks = spark.createDataFrame([("a", 15), ("b", 0), ("z", 3)], MARKS)
    indexed = spark.createDataFrame([("a", 20), ("b", 4), ("c", 17)], KEYS)
    boxes = upkeep.boxes_of(messages)
    assert rows(upkeep.last_uid(boxes, marks, indexed)) == [("a", 15), ("b", 0), ("c", 17), ("d", 0)]
    want = [(b, u) for b, low in (("a", 15), ("b", 0), ("c", 17), ("d", 0)) for u in range(low + 1, 21)]
    assert rows(upkeep.index_backlog(messages, marks, indexed)) == want
    everything = upkeep.index_backlog(messages, upkeep.rescan(marks), indexed.limit(0))
    assert rows(everything) == rows(messages)


def test_checkpoints_advance_and_never_go_back(spark):
    marks = spark.createDataFrame([("a", 15), ("b", 2)], MARKS)
    indexed = spark.createDataFrame([("a", 9), ("b", 7), ("b", 6), ("c", 1)], KEYS)
    assert rows(upkeep.advance_checkpoints(marks, indexed)) == [("a", 15), ("b", 7), ("c", 1)]


def test_gaps_in_both_directions(spark):
    messages = spark.createDataFrame([("b", 1), ("b", 2), ("b", 3)], KEYS)
    indexed = spark.createDataFrame([("b", 1), ("b", 3), ("b", 4), ("c", 1)], KEYS)
    assert rows(upkeep.index_gaps(messages, indexed)) == [
        ("b", 2, "missing_from_index"), ("b", 4, "missing_from_source"), ("c", 1, "missing_from_source")
    ]


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    ops = random_ops()
    folder, log, progress = (str(tmp_path / name) for name in ("in", "log", "progress"))
    schema = spark.createDataFrame([], OPS).schema
    batches = []
    shuffled = random.Random(7).sample(ops, len(ops))
    for part in (shuffled[:150], shuffled[150:]):
        spark.createDataFrame(part, OPS).repartition(3).write.mode("append").parquet(folder)
        stream = ops_log.read_action_files(spark, folder, schema, files_per_batch=1)
        query = ops_log.append_to_log(stream, log, progress, lambda df, i: batches.append((i, df.count())))
        query.awaitTermination()
    assert [i for i, _ in batches] == list(range(6))
    assert sum(n for _, n in batches) == len(ops)
    assert rows(ops_log.current_documents(spark, log, schema)) == replayed(ops)


def test_batch_run_again_after_a_failure_is_in_the_log_once(spark, tmp_path):
    ops = random_ops(60)
    folder, log, progress = (str(tmp_path / name) for name in ("in", "log", "progress"))
    schema = spark.createDataFrame([], OPS).schema
    spark.createDataFrame(ops, OPS).repartition(2).write.parquet(folder)

    def fails_once(df, batch_id):
        if batch_id == 1 and not attempts:
            attempts.append(batch_id)
            raise RuntimeError("lost after the log was written")

    attempts = []
    for _ in range(2):
        stream = ops_log.read_action_files(spark, folder, schema, files_per_batch=1)
        query = ops_log.append_to_log(stream, log, progress, fails_once)
        try:
            query.awaitTermination()
        except Exception:
            assert attempts == [1]
    assert ops_log.read_log(spark, log, schema).count() == len(ops)
    assert rows(ops_log.current_documents(spark, log, schema)) == replayed(ops)


def test_running_totals_over_negative_and_sparse_order(spark):
    rng = random.Random(9)
    data = [(g, o, rng.randint(-5, 9)) for g in "xyz" for o in rng.sample(range(-1000, 100_000), 60)]
    df = spark.createDataFrame(data, "g string, o bigint, v bigint")
    amounts = {"total": F.col("v"), "pos": F.lit(1)}
    got = {(r.g, r.o): (r.total, r.pos) for r in slices.running_totals(df, ["g"], "o", amounts, bits=6).collect()}
    for g in "xyz":
        total = 0
        for pos, (_, o, v) in enumerate(sorted(d for d in data if d[0] == g), 1):
            total += v
            assert got[g, o] == (total, pos)


class Session:
    """As much of a session as the choice of a shared folder looks at."""

    def __init__(self, folder, master):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"test-{master}"})


def test_shared_folder_is_the_named_one_and_never_local_on_a_cluster():
    assert shared.shared_folder(Session("hdfs://shared/dir/", "yarn")) == "hdfs://shared/dir"
    with pytest.raises(RuntimeError):
        shared.shared_folder(Session(None, "yarn"))
    own = Session(None, "local[2]")
    assert shared.shared_folder(own) == shared.shared_folder(own)


def test_size_check_counts_rows_and_bytes(spark, monkeypatch):
    df = spark.createDataFrame([("a" * 1000, 1), (None, 2)], "t string, n bigint")
    assert slices.size_of(df) == (2, 1032)
    assert slices.is_small(df)
    monkeypatch.setattr(slices, "BROADCAST_BYTES", 1031)
    assert not slices.is_small(df)
    assert slices.size_of(df.limit(0)) == (0, 0)


def test_close_removes_only_what_the_session_made(spark, tmp_path):
    from pathlib import Path

    class Own(Session):
        def __init__(self):
            super().__init__(str(tmp_path), "yarn")
            self._jvm, self._jsc = spark._jvm, spark._jsc

    own = Own()
    made, other = Path(shared.new_folder(own, "mine")), tmp_path / "other"
    made.mkdir()
    (made / "part").write_text("x")
    other.mkdir()
    assert shared.close(own) == 1 and not made.exists() and other.exists()
    assert shared.close(own) == 0


def test_slices_of_sparse_ids(spark):
    dense = spark.range(1000).withColumnRenamed("id", "o")
    sparse = spark.range(1000).selectExpr("id * 4096 AS o")
    assert slices.bits_for(dense, "o", 64) == 6 and slices.bits_for(sparse, "o", 64) in (17, 18)
    assert slices.bits_for(dense.limit(0), "o") == slices.SLICE_BITS


def test_content_audit_equals_full_comparison(spark):
    schema = "box string, uid bigint, subject string, body string"
    source = {(b, u): (f"s{u}", None if u % 5 == 0 else f"t{u}") for b in "abd" for u in range(1, 60)}
    indexed = dict(source)
    indexed[("a", 5)] = ("s5", "")  # an empty value is no null
    indexed[("b", 7)], indexed[("b", 8)] = source[("b", 8)], source[("b", 7)]
    indexed[("a", 7)], indexed[("a", 8)] = source[("a", 8)], source[("a", 7)]  # the same contents, swapped keys
    del indexed[("d", 31)]
    indexed[("c", 1)] = ("s", "t")
    want = sorted(
        (*k, "missing" if k not in indexed else "stray" if k not in source else "changed")
        for k in source.keys() | indexed.keys()
        if source.get(k) != indexed.get(k)
    )
    frames = [spark.createDataFrame([(*k, *v) for k, v in x.items()], schema) for x in (source, indexed)]
    for bits in (0, 3, 20):
        found = upkeep.content_audit(*frames, ["subject", "body"], bits).collect()
        assert sorted(tuple(r) for r in found if r.kind) == want
    assert upkeep.content_audit(frames[0], frames[0], ["subject", "body"]).collect() == []
