"""An index that lives in a folder: parts written by runs, and the progress of each box.

Every run writes a part (the tables of ``index_tables``) with the documents it indexed, what
the earlier parts lose by it, and the checkpoints. Then it appends one row to ``runs``; a
run without that row never happened, so a run that failed can simply be run again. Opening
reads ``runs`` and unites the parts that are still live.

A run finds what it takes from earlier parts in their forward tables, so it reads the places of
its own keys and no postings. Beyond ``MOST_PARTS`` live parts, the last ones are merged into one: from the newest
back, as long as a part is not larger than ``RATIO`` times all that came after it. So
parts grow with the logarithm of the documents, and a document is written as often.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lettersieve.operators import upkeep
from lettersieve.operators.postings import Index, Losses, losses, united
from lettersieve.sources import index_tables, shared

CHECKPOINTS = "box string, last_indexed_uid bigint"
# number: order of the runs. part: its folder, which stands for the runs from ``first`` on. n_rows: its documents
# and lost keys. n_lost: its lost keys.
RUNS = "number bigint, first bigint, part string, term_buckets int, n_rows bigint, n_lost bigint"
MOST_PARTS = 8
RATIO = 2
LOSSES = {
    "lost_keys": "box string, uid bigint",
    "lost_dictionary": "box string, field string, term string, term_bucket int, df bigint",
    "lost_field_stats": "box string, field string, n_docs bigint, total_len bigint",
}


@dataclass(frozen=True)
class Store:
    root: str
    number: int
    index: Index | None
    checkpoints: DataFrame
    parts: tuple[Row, ...] = ()


def create(spark: SparkSession, root: str) -> Store:
    """An empty store in a folder that does not hold one."""
    spark.createDataFrame([], RUNS).write.parquet(f"{root}/runs")
    return open_store(spark, root)


def open_store(spark: SparkSession, root: str) -> Store:
    """The index and checkpoints after the last run that was completed."""
    parts = live_parts(spark.read.schema(RUNS).parquet(f"{root}/runs").collect())
    if not parts:
        return Store(root, 0, None, spark.createDataFrame([], CHECKPOINTS))
    marks = spark.read.schema(CHECKPOINTS).parquet(f"{root}/{parts[-1]['part']}/checkpoints")
    return Store(root, parts[-1]["number"], _united(spark, root, parts), marks, tuple(parts))


def live_parts(runs: list[Row]) -> list[Row]:
    """The parts that together stand for all runs: from the last one back, each as far as any reaches."""
    found: list[Row] = []
    number = max((run["number"] for run in runs), default=0)
    while number > 0:
        found.append(min((run for run in runs if run["number"] == number), key=lambda run: run["first"]))
        number = found[-1]["first"] - 1
    return found[::-1]


def _united(spark: SparkSession, root: str, parts: list[Row], net: bool = True) -> Index:
    read = [(run["number"], index_tables.read_index(spark, f"{root}/{run['part']}", run["term_buckets"])) for run in parts]
    lost = [(run["number"], _lost(spark, f"{root}/{run['part']}")) for run in parts if run["n_lost"]]
    return united(read, lost, net) if len(read) > 1 or lost else read[0][1]


def _lost(spark: SparkSession, folder: str) -> Losses:
    return Losses(*[spark.read.schema(s).parquet(f"{folder}/{name}") for name, s in LOSSES.items()])


def run(
    store: Store,
    documents: DataFrame,
    removed: DataFrame | None = None,
    checkpoints: DataFrame | None = None,
    most_parts: int = MOST_PARTS,
) -> Store:
    """The store after indexing ``documents`` (box, uid, fields) and removing some (box, uid).

    A document replaces its older version. Checkpoints, by default the stored ones, advance
    to what was indexed; they are written with the part, before the run counts. A part that replaces or removes
    all documents, as a rescan does, stands for all runs: nothing is kept of what the earlier ones lose.
    """
    spark = documents.sparkSession
    folder = f"part-{store.number + 1}-{uuid.uuid4().hex}"
    path = f"{store.root}/{folder}"
    buckets, earlier = (store.index.term_buckets, store.index.boxes) if store.index else (None, None)
    index_tables.write_index(documents, path, buckets, earlier)
    part = index_tables.read_index(spark, path)
    touched = part.keys if removed is None else part.keys.unionByName(removed.select("box", "uid"))
    number = store.number + 1
    n_lost, first = 0, number
    if store.index is not None and _all_in(store.index.keys, touched):
        first = 1
    elif store.index is not None:
        with shared.brief_shuffles(spark):
            lost = losses(store.index, touched)
            for name, table in zip(LOSSES, (lost.keys, lost.dictionary, lost.field_stats), strict=True):
                table.write.parquet(f"{path}/{name}")
            n_lost = _lost(spark, path).keys.count()
    marks = store.checkpoints if checkpoints is None else checkpoints
    upkeep.advance_checkpoints(marks, part.keys).write.parquet(f"{path}/checkpoints")
    row = (number, first, folder, part.term_buckets, part.keys.count() + n_lost, n_lost)
    return merge_last(_commit(store, spark, row), most_parts)


def _all_in(keys: DataFrame, touched: DataFrame) -> bool:
    with shared.brief_shuffles(keys.sparkSession):
        return keys.join(touched.select("box", "uid"), ["box", "uid"], "left_anti").isEmpty()


def merge_last(store: Store, most_parts: int = MOST_PARTS) -> Store:
    """The store with its last parts in one, if there are more than ``most_parts``."""
    parts = store.parts
    if len(parts) <= most_parts:
        return store
    at, total = len(parts) - 1, parts[-1]["n_rows"]
    while at > 0 and parts[at - 1]["n_rows"] <= RATIO * total:
        at -= 1
        total += parts[at]["n_rows"]
    at = min(at, len(parts) - 2)
    if at == 0:
        return merge(store)
    spark = store.checkpoints.sparkSession
    last = list(parts[at:])
    folder = f"part-{store.number}-{uuid.uuid4().hex}"
    path = f"{store.root}/{folder}"
    # What these parts took from earlier ones stays beside them; what they took from each other too, so that
    # their statistics can stay as they are and the sums over all parts are exact.
    index_tables.write_tables(_united(spark, store.root, last, net=False), path)
    lost = [_lost(spark, f"{store.root}/{run['part']}") for run in last if run["n_lost"]]
    for name, schema in LOSSES.items():
        tables = [getattr(x, name.removeprefix("lost_")) for x in lost]
        none = spark.createDataFrame([], schema)
        reduce(DataFrame.unionByName, tables, none).write.parquet(f"{path}/{name}")
    store.checkpoints.write.parquet(f"{path}/checkpoints")
    n_lost = sum(run["n_lost"] for run in last)
    buckets = index_tables.read_layout(spark, path)
    return _commit(store, spark, (store.number, last[0]["first"], folder, buckets, total, n_lost))


def index_new(store: Store, documents: DataFrame, checkpoints: DataFrame | None = None) -> Store:
    """A run over the documents above the last uid of their box.

    The last uid of a box without checkpoint is its highest indexed one, and is stored.
    """
    spark = documents.sparkSession
    marks = store.checkpoints if checkpoints is None else checkpoints
    indexed = store.index.boxes.select("box", F.col("max_uid").alias("uid")) if store.index else None
    indexed = spark.createDataFrame([], "box string, uid bigint") if indexed is None else indexed
    known = upkeep.last_uid(marks.select("box").union(indexed.select("box")).distinct(), marks, indexed)
    stored = known.select("box", F.col("last_uid").alias("last_indexed_uid"))
    return run(store, upkeep.index_backlog(documents, stored, indexed, documents.columns), checkpoints=stored)


def rescan(store: Store, documents: DataFrame) -> Store:
    """A run over all documents: everything counts as not indexed and is replaced."""
    return run(store, documents, checkpoints=upkeep.rescan(store.checkpoints))


def merge(store: Store) -> Store:
    """The same index in one part, so that searches read one set of tables."""
    spark = store.checkpoints.sparkSession
    folder = f"part-{store.number}-{uuid.uuid4().hex}"
    path = f"{store.root}/{folder}"
    index_tables.write_tables(store.index, path)
    store.checkpoints.write.parquet(f"{path}/checkpoints")
    n_rows = spark.read.parquet(f"{path}/keys").count()
    return _commit(store, spark, (store.number, 1, folder, index_tables.read_layout(spark, path), n_rows, 0))


def _commit(store: Store, spark: SparkSession, row: tuple) -> Store:
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(f"{store.root}/runs")
    return open_store(spark, store.root)
