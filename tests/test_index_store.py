import random
import time

import pytest
from pyspark.sql import functions as F

from lettersieve.operators import matching, postings
from lettersieve.plans import index_run, index_store
from lettersieve.sources import index_tables
from lettersieve.streaming import ops_log

DOCS = "box string, uid bigint, fields map<string, array<string>>"
MARKS = "box string, last_indexed_uid bigint"
WORDS = ["alpha", "beta", "gamma", "hot"]


def make(rng, keys):
    return {key: {"subject": [rng.choice(WORDS)], "body": [" ".join(rng.choices(WORDS, k=rng.randint(0, 6)))]} for key in keys}


def frame(spark, docs):
    return spark.createDataFrame([(box, uid, fields) for (box, uid), fields in docs.items()], DOCS)


def hits(index, operator="or"):
    found = matching.search(index, "alpha beta", ["subject", "body"], operator).collect()
    assert len({(r.box, r.uid) for r in found}) == len(found)
    return {(r.box, r.uid): r.score for r in found}


def assert_same(index, fresh):
    """Every table of an index equals the one of an index built in one go."""
    for name in ("postings", "dictionary", "field_stats", "keys"):
        drop = ("term_bucket", "max_uid")
        a, b = (getattr(x, name).drop(*drop) for x in (index, fresh))
        rows = [sorted(map(tuple, x.select(sorted(x.columns)).collect())) for x in (a, b)]
        assert rows[0] == rows[1], name
    highest = {r.box: (r.n_docs, r.max_uid) for r in index.boxes.collect()}
    for r in fresh.boxes.collect():
        assert highest[r.box][0] == r.n_docs and highest[r.box][1] >= r.max_uid
    for operator in ("and", "or"):
        assert hits(index, operator) == hits(fresh, operator)


@pytest.fixture
def start():
    return make(random.Random(3), [(b, u) for b in ("big", "small") for u in range(1, 25 if b == "big" else 6)])


def test_runs_replace_remove_and_survive_the_session(spark, tmp_path, start, monkeypatch):
    rng, root = random.Random(4), str(tmp_path / "store")
    store = index_store.run(index_store.create(spark, root), frame(spark, start))
    state = dict(start)
    for touched, removed in (([("big", 3), ("big", 30), ("new", 1)], [("small", 2), ("none", 9)]), ([("big", 3)], [("new", 1)])):
        new = make(rng, touched)
        gone = spark.createDataFrame(removed, "box string, uid bigint")
        store = index_store.run(store, frame(spark, new), gone)
        state = {k: v for k, v in (state | new).items() if k not in removed or k in new}
    fresh = postings.index_of(frame(spark, state))
    assert_same(store.index, fresh)

    # A run that fails before it is complete has not happened.
    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(index_store, "_commit", fails)
        with pytest.raises(RuntimeError):
            index_store.run(store, frame(spark, make(rng, [("big", 1), ("big", 77)])))
    again = index_store.open_store(spark, root)
    assert again.number == 3
    assert_same(again.index, fresh)
    merged = index_store.merge(again)
    assert_same(merged.index, fresh)
    assert len(spark.read.parquet(f"{root}/runs").collect()) == 4
    reached = {r.box: r.last_indexed_uid for r in merged.checkpoints.collect()}
    assert reached == {"big": 30, "small": 5, "new": 1}


def test_rescan_indexes_every_document_once(spark, tmp_path, start):
    docs = frame(spark, start)
    marks = spark.createDataFrame([("big", 20)], MARKS)
    store = index_store.create(spark, str(tmp_path / "store"))
    store = index_store.run(store, docs.filter("box = 'big' and uid <= 20"), checkpoints=marks)
    store = index_store.index_new(store, docs)
    fresh = postings.index_of(docs)
    assert_same(store.index, fresh)
    store = index_store.rescan(store, docs)
    assert_same(store.index, fresh)
    assert {r.box: r.last_indexed_uid for r in store.checkpoints.collect()} == {"big": 24, "small": 5}


def test_rescan_is_one_part_and_leaves_no_more_than_its_tables(spark, tmp_path, start):
    """Whole rescans keep no losses; highest uids never fall. Documents that a rescan does not see stay."""
    docs, root = frame(spark, start), tmp_path / "store"
    more = frame(spark, make(random.Random(5), [("big", 90)]))
    store = index_store.run(index_store.create(spark, str(root)), docs.filter("uid <= 3"))
    store = index_store.run(index_store.index_new(store, docs), more)
    store = index_store.run(store, docs.limit(0), more.select("box", "uid"))
    store = index_store.rescan(store, docs)
    assert_same(store.index, postings.index_of(docs))
    assert len(store.parts) == 1 and store.number == 5 and store.index.removed is None
    assert not (root / store.parts[0]["part"] / "lost_keys").exists() and not list(root.glob("*/texts"))
    assert {r.box: r.max_uid for r in store.index.boxes.collect()} == {"big": 90, "small": 5}
    store = index_store.rescan(store, docs.filter("uid > 1"))
    assert len(store.parts) == 2 and store.parts[1]["n_lost"] == len(start) - 2
    assert_same(store.index, postings.index_of(docs))


def test_shuffle_files_of_an_index_go_with_their_step(spark, tmp_path, start):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name for name in names if name.startswith("shuffle_") and name.endswith(".data")}

    before, setting = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    index_tables.write_index(frame(spark, start), str(tmp_path / "index"))
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(setting) == "false"


def test_fallback_of_a_box_without_checkpoint_is_stored(spark, tmp_path, start):
    store = index_store.run(index_store.create(spark, str(tmp_path / "store")), frame(spark, start))
    lost = spark.createDataFrame([("big", 24)], MARKS)
    again = index_store.index_new(store, frame(spark, start), lost)
    assert {r.box: r.last_indexed_uid for r in again.checkpoints.collect()} == {"big": 24, "small": 5}
    assert again.index.keys.count() == len(start)


def test_index_new_after_a_rescan(spark, tmp_path):
    """Odd messages say alpha beta, even ones beta: an and-search keeps finding the odd ones."""
    docs = {("b", u): {"subject": ["alpha beta" if u % 2 else "beta"]} for u in range(1, 7)}
    root = str(tmp_path / "index")
    index_tables.write_index(frame(spark, docs), root)
    index = index_tables.read_index(spark, root)
    before = hits(index)
    none = spark.createDataFrame([("b", 0)], MARKS)
    again, marks = index_run.index_new(frame(spark, docs), none, index)
    assert hits(again) == before and set(hits(again, "and")) == {("b", 1), ("b", 3), ("b", 5)}
    assert again.keys.count() == 6 and marks.first().last_indexed_uid == 6


OPS = "box string, uid bigint, seq bigint, op string, subject string"


def test_index_follows_a_stream_of_late_and_repeated_actions(spark, tmp_path):
    from pyspark.sql import functions as F

    rng = random.Random(8)
    ops = [("b", rng.randint(1, 9), seq, rng.choice(["index", "index", "delete"]), rng.choice(WORDS) + f" w{seq}") for seq in range(40)]
    rng.shuffle(ops)
    schema = spark.createDataFrame([], OPS).schema
    document = F.create_map(F.lit("subject"), F.array("subject"))
    after = ops_log.indexing(spark, str(tmp_path), schema, document)
    for number, part in enumerate((ops[:15], ops[15:30], ops[30:])):
        after(spark.createDataFrame(part, OPS), number)
        if number == 1:
            after(spark.createDataFrame(part, OPS), number)  # run again after a failure
    last = {}
    for op in sorted(ops, key=lambda o: o[2]):
        last[op[0], op[1]] = op
    want = {key: {"subject": [op[4]]} for key, op in last.items() if op[3] == "index"}
    store = index_store.open_store(spark, f"{tmp_path}/index")
    assert_same(store.index, postings.index_of(frame(spark, want)))
    known, upto, version = ops_log.compacted(spark, f"{tmp_path}/compacted", schema)
    assert (upto, version, known.count()) == (2, 4, len(last))


def scanned_rows(df):
    """Rows that the scans of files have given in the last run of ``df``."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found, waiting = 0, [leaves.apply(i) for i in range(leaves.size())]
    while waiting:
        leaf = waiting.pop()
        if "QueryStage" in leaf.getClass().getSimpleName():
            below = leaf.plan().collectLeaves()
            waiting += [below.apply(i) for i in range(below.size())]
        elif "FileSourceScan" in leaf.getClass().getSimpleName():
            found += leaf.metrics().apply("numOutputRows").value()
    return found


def test_losses_read_only_the_places_of_their_keys(spark, tmp_path):
    from pyspark.sql import functions as F

    root = str(tmp_path / "index")
    text = F.concat_ws(" ", F.lit("word"), (F.col("id") % 7).cast("string"))
    docs = spark.range(40_000).select(
        F.lit("b").alias("box"), F.col("id").alias("uid"), F.create_map(F.lit("body"), F.array(text)).alias("fields")
    )
    index_tables.write_index(docs, root)
    index = index_tables.read_index(spark, root)
    touched = spark.range(100).select(F.lit("b").alias("box"), (F.col("id") + 5000).alias("uid"))
    read = postings.lists_at(index, touched)
    assert len(read.collect()) == 200  # the document and its one field
    assert scanned_rows(read) < 40_000
    lost = postings.losses(index, touched)
    assert {r.term: r.df for r in lost.dictionary.collect()}["word"] == 100 and lost.keys.count() == 100
    assert lost.field_stats.first().n_docs == 100


def test_parts_are_merged_and_stay_few(spark, tmp_path, start):
    rng, root = random.Random(9), str(tmp_path / "store")
    store, state = index_store.create(spark, root), {}
    for number, size in enumerate((12, 3, 2, 4)):
        new = make(rng, rng.sample([("big", u) for u in range(1, 15)], size))
        gone = [("big", 1 + number)]
        store = index_store.run(store, frame(spark, new), spark.createDataFrame(gone, "box string, uid bigint"), most_parts=2)
        state = {k: v for k, v in (state | new).items() if k not in gone or k in new}
        assert len(store.parts) <= 2
    assert store.number == 4 and store.parts[0]["first"] == 1
    assert_same(index_store.open_store(spark, root).index, postings.index_of(frame(spark, state)))


def test_compaction_writes_the_touched_buckets_only(spark, tmp_path):
    schema = spark.createDataFrame([], OPS).schema
    root = str(tmp_path)
    many = [("b", uid, uid, "index", "x") for uid in range(500)]
    ops_log.compact(spark, root, spark.createDataFrame(many, OPS), 0, schema)
    before, _, _ = ops_log._newest(spark, root)
    ops_log.compact(spark, root, spark.createDataFrame([("b", 3, 900, "delete", "y")], OPS), 1, schema)
    after, upto, version = ops_log._newest(spark, root)
    assert (upto, version) == (1, 2) and sum(before[b] != after[b] for b in after) == 1
    known = ops_log.compacted(spark, root, schema)[0]
    assert known.count() == 500 and known.filter("op = 'delete'").first().uid == 3


def test_tasks_hold_few_postings_and_texts_travel_unsplit(spark, tmp_path, monkeypatch):
    """No task sorts more than its share, which executors hold beside others; odd fields are in the forward table once."""
    assert index_tables.ROWS_PER_TASK <= 2_000_000
    monkeypatch.setattr(index_tables, "ROWS_PER_TASK", 1000)
    values = {"body": [" ".join(f"w{i}" for i in range(500)), None], "empty": [], "": ["a b a"]}
    docs = spark.createDataFrame(
        [("b", uid, values) for uid in range(5)] + [("b", 9, None), ("c", 1, {})],
        "box string, uid bigint, fields map<string, array<string>>",
    )
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    try:
        index_tables.write_index(docs, str(tmp_path / "index"), 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert not (tmp_path / "index" / "word_lists").exists()
    index = index_tables.read_index(spark, str(tmp_path / "index"))
    files = index.postings.groupBy(F.input_file_name()).count().collect()
    assert len(files) == 3 and max(row["count"] for row in files) < 1200
    got = {(r["box"], r["uid"], r["field"]): (r["field_len"], len(r["counts"])) for r in index.forward[0].table.collect()}
    want = {("b", uid, field): size for uid in range(5) for field, size in {"body": (500, 500), "empty": (0, 0), "": (3, 2), None: (0, 0)}.items()}
    assert got == want | {("b", 9, None): (0, 0), ("c", 1, None): (0, 0)}
    assert index.forward[0].table.count() == len(got)
    assert index.keys.count() == 7 and index.postings.count() == 5 * 502
