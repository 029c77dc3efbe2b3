"""Writing and reading the index tables in a folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.operators import postings as P
from lettersieve.sources import shared

# Rows that a task sorts: some 300 MB, so that tasks of four cores fit beside each other in an executor without spilling.
ROWS_PER_TASK = 1_500_000
ROWS_PER_FOLDER = 200_000_000
MIN_TERM_BUCKETS = 8
MAX_TERM_BUCKETS = 4096

BY_TERM = ("term_bucket", "term", "box")

SCHEMAS = {
    "postings": "box string, field string, term string, uid bigint, tf bigint, field_len bigint, term_bucket int",
    "dictionary": "box string, field string, term string, df bigint, term_bucket int",
    "field_stats": "box string, field string, n_docs bigint, total_len bigint, max_uid bigint",
    "keys": "box string, uid bigint",
    "words": "field string, term string, term_bucket int",
    "boxes": "box string, n_docs bigint, max_uid bigint",
}
FORWARD = "box string, uid bigint, field string, field_len bigint, counts array<struct<term: string, tf: bigint>>, place int"
POSTINGS_OF_PLACE = 2_000_000
# About as many bytes of text make a posting; the number of places is chosen before texts are split.
BYTES_OF_POSTING = 8
MAX_PLACES = 4096


def write_index(
    documents: DataFrame, root: str, term_buckets: int | None = None, earlier: DataFrame | None = None
) -> None:
    """Builds the index tables of documents (box, uid, fields). Texts are split into words once.

    ``earlier(box, max_uid)`` are highest uids of an index that this one goes with or follows: they never fall.
    Texts go once their words are written, and shuffle files after each step. Each step reads what the step before it has written, so a lost executor costs its own
    tasks only. Texts go to their place before they are split: they are a fraction of their word lists. Postings
    are range-partitioned: a word that is in most documents spreads over as many files as it needs. Rows are
    sorted by word and box, for pruning by either.
    Tasks are sized by the number of postings, and so are folders unless ``term_buckets``
    says how many there have to be to go with another index.
    """
    with shared.brief_shuffles(documents.sparkSession):
        _write_index(documents, root, term_buckets, earlier)


def _write_index(documents: DataFrame, root: str, term_buckets: int | None, earlier: DataFrame | None) -> None:
    spark = documents.sparkSession
    documents.select("box", "uid", "fields").write.parquet(f"{root}/texts")
    documents = spark.read.parquet(f"{root}/texts")
    _write_forward(documents, root, places_for(_n_bytes(documents) // BYTES_OF_POSTING), P.forward_of)
    documents.select("box", "uid").write.parquet(f"{root}/keys")
    shared.remove(spark, f"{root}/texts")
    lists = spark.read.schema(FORWARD).parquet(f"{root}/forward").filter("field is not null")
    # Of the words themselves nothing is read to count them.
    n_postings = lists.agg(F.sum(F.size("counts.tf").cast("bigint"))).first()[0] or 0
    term_buckets = term_buckets or layout_for(n_postings)
    spark.range(1).select(F.lit(term_buckets).alias("term_buckets")).write.parquet(f"{root}/layout")
    _write_by_term(P.postings_of(lists), f"{root}/postings", term_buckets, n_postings, ["uid"])
    dictionary = P.dictionary_of(spark.read.schema(SCHEMAS["postings"]).parquet(f"{root}/postings"))
    _write_by_term(dictionary, f"{root}/dictionary", term_buckets, n_postings, [])
    words = P.words_of(spark.read.schema(SCHEMAS["dictionary"]).parquet(f"{root}/dictionary").drop("term_bucket"))
    _write_by_term(words, f"{root}/words", term_buckets, n_postings, [], ["term_bucket", "term"])
    P.field_stats_of(lists).write.parquet(f"{root}/field_stats")
    boxes = P.boxes_of(spark.read.schema(SCHEMAS["keys"]).parquet(f"{root}/keys"))
    if earlier is not None:
        known = earlier.select(F.col("box").alias("_box"), F.col("max_uid").alias("_max"))
        highest = F.greatest("max_uid", "_max").alias("max_uid")
        boxes = boxes.join(known, F.col("box").eqNullSafe(F.col("_box")), "left").select("box", "n_docs", highest)
    boxes.write.parquet(f"{root}/boxes")


def _n_bytes(documents: DataFrame) -> int:
    sizes = F.transform(F.flatten(F.map_values("fields")), lambda value: F.octet_length(value).cast("bigint"))
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda n, size: n + F.coalesce(size, F.lit(0)))
    return documents.agg(F.sum(total)).first()[0] or 0


def write_tables(index: P.Index, root: str) -> None:
    """Writes an index whose tables are known, such as one of several parts, as one."""
    with shared.brief_shuffles(index.keys.sparkSession):
        _write_tables(index, root)


def _write_tables(index: P.Index, root: str) -> None:
    spark = index.keys.sparkSession
    n_postings = index.dictionary.agg(F.sum("df")).first()[0] or 0
    term_buckets = index.term_buckets or layout_for(n_postings)
    spark.range(1).select(F.lit(term_buckets).alias("term_buckets")).write.parquet(f"{root}/layout")
    _write_by_term(index.postings.drop("term_bucket"), f"{root}/postings", term_buckets, n_postings, ["uid"])
    _write_by_term(index.dictionary.drop("term_bucket"), f"{root}/dictionary", term_buckets, n_postings, [])
    words = P.words_of(spark.read.schema(SCHEMAS["dictionary"]).parquet(f"{root}/dictionary").drop("term_bucket"))
    _write_by_term(words, f"{root}/words", term_buckets, n_postings, [], ["term_bucket", "term"])
    for name in ("field_stats", "keys", "boxes"):
        getattr(index, name).write.parquet(f"{root}/{name}")
    if index.forward:
        rows = [f.table.drop("place").withColumn("_part", F.lit(f.number).cast("bigint")) for f in index.forward]
        forward = P.live(reduce(DataFrame.unionByName, rows), index.removed, "_part").drop("_part")
        _write_forward(forward, root, places_for(n_postings))


def places_for(n_postings: int) -> int:
    """Number of folders of the forward table: some million postings each, within limits."""
    return max(8, min(MAX_PLACES, 1 << (n_postings // POSTINGS_OF_PLACE).bit_length()))


def _write_forward(rows: DataFrame, root: str, places: int, lists: Callable[..., DataFrame] | None = None) -> None:
    """Writes rows (box, uid, ..) by place, or the ``lists`` that are made of them once they are there."""
    rows.sparkSession.range(1).select(F.lit(places).alias("places")).write.parquet(f"{root}/forward_layout")
    placed = (
        rows.withColumn("place", P.place_of(places))
        .repartitionById(places, F.col("place"))
        .sortWithinPartitions("place", "box", "uid")
    )
    placed = lists(placed, ("box", "uid", "place")) if lists else placed
    placed.write.partitionBy("place").parquet(f"{root}/forward")


def layout_for(n_postings: int) -> int:
    """Number of term buckets: as many as make folders of some hundred files, within limits."""
    wanted = n_postings // ROWS_PER_FOLDER
    return max(MIN_TERM_BUCKETS, min(MAX_TERM_BUCKETS, 1 << wanted.bit_length()))


def _write_by_term(
    df: DataFrame, path: str, term_buckets: int, n_rows: int, more: list[str], order: Sequence[str] = BY_TERM
) -> None:
    tasks = max(-(-n_rows // ROWS_PER_TASK), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (
        df.withColumn("term_bucket", P.term_bucket(F.col("term"), term_buckets))
        .repartitionByRange(tasks, *order, *more)
        .sortWithinPartitions(*order)
        .write.partitionBy("term_bucket")
        .parquet(path)
    )


def read_layout(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/layout").first().term_buckets


@cache
def _places(application: str, root: str) -> int:
    return SparkSession.active().read.parquet(f"{root}/forward_layout").first().places


def read_places(spark: SparkSession, root: str) -> int:
    return _places(spark.sparkContext.applicationId, root)


def read_index(spark: SparkSession, root: str, term_buckets: int | None = None) -> P.Index:
    """The stored index; ``term_buckets`` spares reading the layout if it is known."""
    found = {name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in SCHEMAS.items()}
    forward = P.ForwardPart(spark.read.schema(FORWARD).parquet(f"{root}/forward"), read_places(spark, root))
    return P.Index(**found, term_buckets=term_buckets or read_layout(spark, root), forward=(forward,))
