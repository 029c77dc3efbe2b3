"""The inverted index as plain tables.

postings(box, field, term, uid, tf, field_len)       one row per word of a document field
dictionary(box, field, term, df)                     documents per word
field_stats(box, field, n_docs, total_len, max_uid)  documents having words in the field
keys(box, uid)                                       all documents
words(field, term)                                   the distinct words of all boxes
boxes(box, n_docs, max_uid)                          one row per box
forward(box, uid, field, field_len, counts)          the words of each document, by place (stored indexes)

``max_uid`` bounds the uids from above and never falls, also when documents go.

Stored postings and dictionaries have a column ``term_bucket``, a hash of the word, that
names the folder a row is in. The forward table is in folders by ``place``, a hash of the box and a run of
2**PLACE_BITS uids, and sorted by key: the words of some documents are read without the rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.functions import text
from lettersieve.operators import slices
from lettersieve.sources.shared import stored


PLACE_BITS = 10


@dataclass(frozen=True)
class ForwardPart:
    """The forward table of the part that run ``number`` wrote, and its number of places."""

    table: DataFrame
    places: int
    number: int = 0


@dataclass(frozen=True)
class Index:
    postings: DataFrame
    dictionary: DataFrame
    field_stats: DataFrame
    keys: DataFrame
    words: DataFrame
    boxes: DataFrame
    term_buckets: int | None = None  # None: not stored by term bucket
    forward: tuple[ForwardPart, ...] = ()
    # (box, uid, number): the parts of runs before ``number`` have lost the document.
    removed: DataFrame | None = None


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def place_of(places: int) -> Column:
    return F.pmod(F.xxhash64("box", F.shiftright(F.col("uid"), PLACE_BITS)), F.lit(places)).cast("int")


def forward_of(documents: DataFrame, key: Sequence[str] = ("box", "uid")) -> DataFrame:
    """(key, field, field_len, counts): the words of each document, and one row without field for it itself."""
    entry = "array<struct<key: string, value: array<string>>>"
    mark = F.array(F.struct(F.lit(None).alias("key"), F.array().alias("value"))).cast(entry)
    entries = F.concat(F.coalesce(F.map_entries("fields").cast(entry), F.array().cast(entry)), mark)
    counts = F.coalesce("counts", F.array().cast("array<struct<term: string, tf: bigint>>"))
    return _lists_of(documents.select(*key, F.inline(entries).alias("field", "field_values")), key).select(
        *key, "field", "field_len", counts.alias("counts")
    )


def lists_at(index: Index, keys: DataFrame) -> DataFrame:
    """The forward rows of some (box, uid), of the part that has each now; only their places are read."""
    small = slices.is_small(keys)
    found = []
    for part in index.forward:
        # There are at most as many places as the part has folders.
        places = [row[0] for row in keys.select(place_of(part.places)).distinct().collect()]
        here = part.table.filter(F.col("place").isin(*places)) if places else part.table.filter(F.lit(False))
        wanted = F.broadcast(keys) if small else keys
        rows = here.drop("place").join(wanted, ["box", "uid"], "left_semi")
        found.append(rows.withColumn("number", F.lit(part.number).cast("bigint")))
    rows = reduce(DataFrame.unionByName, found)
    return live(rows, index.removed, "number").drop("number")


def live(rows: DataFrame, removed: DataFrame | None, number: str) -> DataFrame:
    """Rows (box, uid, .., ``number`` of their part) without those that a later run has removed."""
    if removed is None:
        return rows
    gone = removed.select(F.col("box").alias("_box"), F.col("uid").alias("_uid"), F.col("number").alias("_by"))
    gone = F.broadcast(gone) if slices.is_small(gone) else gone
    lost = (F.col("box") == F.col("_box")) & (F.col("uid") == F.col("_uid")) & (F.col(number) < F.col("_by"))
    return rows.join(gone, lost, "left_anti")


def word_lists(documents: DataFrame, key: Sequence[str] = ("box", "uid")) -> DataFrame:
    """(key, field, field_len, counts, n_terms): one narrow pass over the texts, no shuffle."""
    lists = _lists_of(documents.select(*key, F.explode("fields").alias("field", "field_values")), key)
    return lists.withColumn("n_terms", F.coalesce(F.size("counts"), F.lit(0)).cast("bigint"))


def _lists_of(values: DataFrame, key: Sequence[str]) -> DataFrame:
    return values.select(*key, "field", text.words_of_all(F.col("field_values")).alias("tokens")).select(
        *key,
        "field",
        F.size("tokens").cast("bigint").alias("field_len"),
        text.term_counts(F.col("tokens")).alias("counts"),
    )


def postings_of(lists: DataFrame) -> DataFrame:
    # Not a plain column: explode would test a plain one for being empty before that, and
    # by doing so split and count the texts twice.
    counts = F.coalesce("counts", F.array().cast("array<struct<term: string, tf: bigint>>"))
    return lists.select("box", "uid", "field", "field_len", F.explode(counts).alias("entry")).select(
        "box",
        "field",
        F.col("entry.term").alias("term"),
        "uid",
        F.col("entry.tf").alias("tf"),
        "field_len",
    )


def build_postings(documents: DataFrame) -> DataFrame:
    return postings_of(word_lists(documents))


def dictionary_of(postings: DataFrame) -> DataFrame:
    return postings.groupBy("box", "field", "term").agg(F.count("*").alias("df"))


def field_stats_of(lists: DataFrame) -> DataFrame:
    return (
        lists.filter("field_len > 0")
        .groupBy("box", "field")
        .agg(
            F.count("*").alias("n_docs"),
            F.sum("field_len").alias("total_len"),
            F.max("uid").alias("max_uid"),
        )
    )


def words_of(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("field", "term", *[c for c in dictionary.columns if c == "term_bucket"]).distinct()


def boxes_of(keys: DataFrame) -> DataFrame:
    return keys.groupBy("box").agg(F.count("*").alias("n_docs"), F.max("uid").alias("max_uid"))


def index_of(documents: DataFrame) -> Index:
    """An index that is computed where it is used; for documents too few to store one."""
    lists = word_lists(documents)
    postings, keys = postings_of(lists), documents.select("box", "uid")
    dictionary = dictionary_of(postings)
    return Index(postings, dictionary, field_stats_of(lists), keys, words_of(dictionary), boxes_of(keys))


@dataclass(frozen=True)
class Losses:
    """What an index loses when documents go: their keys, and their share of the statistics.

    keys(box, uid), dictionary(box, field, term, df), field_stats(box, field, n_docs, total_len).
    """

    keys: DataFrame
    dictionary: DataFrame
    field_stats: DataFrame


def losses(index: Index, touched: DataFrame) -> Losses:
    """What ``index`` loses by new versions or removals of the (box, uid) in ``touched``.

    Only keys that the index has count. The words of lost documents are read from the forward
    table, at the places of the touched keys; an index without one is searched for them.
    Statistics are exact in both ways.
    """
    touched = touched.select("box", "uid").distinct()
    if index.forward:
        rows = stored(lists_at(index, stored(touched, "touched")), "lost-lists")
        gone = rows.filter("field is null").select("box", "uid")
        words = rows.select("box", "field", F.explode("counts").alias("entry")).select("box", "field", "entry.term")
        counted = words.groupBy("box", "field", "term").agg(F.count("*").alias("df"))
        if index.term_buckets:
            counted = counted.withColumn("term_bucket", term_bucket(F.col("term"), index.term_buckets))
        lengths = rows.filter("field is not null and field_len > 0")
    else:
        gone = index.keys.join(touched, ["box", "uid"], "left_semi")
        lost = index.postings.join(gone, ["box", "uid"], "left_semi")
        buckets = [c for c in lost.columns if c == "term_bucket"]
        counted = lost.groupBy("box", "field", "term", *buckets).agg(F.count("*").alias("df"))
        lengths = lost.groupBy("box", "field", "uid").agg(F.max("field_len").alias("field_len"))
    sums = lengths.groupBy("box", "field").agg(F.count("*").alias("n_docs"), F.sum("field_len").alias("total_len"))
    return Losses(gone, counted, sums)


def without(index: Index, lost: Losses) -> Index:
    """``index`` after ``lost``: no row of a lost document, and exact statistics.

    Highest uids stay as they are: they are upper bounds. The keys are broadcast if they are checked to be few.
    """
    gone = F.broadcast(lost.keys) if slices.is_small(lost.keys) else lost.keys
    dictionary = index.dictionary.unionByName(lost.dictionary.withColumn("df", -F.col("df")))
    stats = index.field_stats.unionByName(
        lost.field_stats.select(
            "box",
            "field",
            (-F.col("n_docs")).alias("n_docs"),
            (-F.col("total_len")).alias("total_len"),
            F.lit(0).cast("bigint").alias("max_uid"),
        )
    )
    fewer = lost.keys.groupBy("box").agg((-F.count("*")).alias("n_docs"), F.lit(0).cast("bigint").alias("max_uid"))
    return replace(
        index,
        postings=index.postings.join(gone, ["box", "uid"], "left_anti"),
        dictionary=_summed_dictionary(dictionary),
        field_stats=_summed_stats(stats),
        keys=index.keys.join(gone, ["box", "uid"], "left_anti"),
        boxes=_summed_boxes(index.boxes.unionByName(fewer)),
        forward=(),
        removed=None,
    )


def _summed_dictionary(dictionary: DataFrame) -> DataFrame:
    summed = dictionary.groupBy([c for c in dictionary.columns if c != "df"]).agg(F.sum("df").alias("df"))
    return summed.filter("df > 0")


def _summed_stats(stats: DataFrame) -> DataFrame:
    return (
        stats.groupBy("box", "field")
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len"), F.max("max_uid").alias("max_uid"))
        .filter("n_docs > 0")
    )


def _summed_boxes(boxes: DataFrame) -> DataFrame:
    return (
        boxes.groupBy("box")
        .agg(F.sum("n_docs").alias("n_docs"), F.max("max_uid").alias("max_uid"))
        .filter("n_docs > 0")
    )


def merge_indexes(parts: Sequence[Index]) -> Index:
    """One index of several parts that have no document in common, such as one for each run.

    Statistics are merged exactly, so scores are those of an index built in one go.
    """
    if len(parts) == 1:
        return parts[0]
    buckets = {part.term_buckets for part in parts}

    def union(name: str) -> DataFrame:
        tables = [getattr(part, name) for part in parts]
        if len(buckets) > 1:
            tables = [table.drop("term_bucket") for table in tables]
        return reduce(DataFrame.unionByName, tables)

    return Index(
        postings=union("postings"),
        dictionary=_summed_dictionary(union("dictionary")),
        field_stats=_summed_stats(union("field_stats")),
        keys=union("keys"),
        words=union("words").distinct(),
        boxes=_summed_boxes(union("boxes")),
        term_buckets=buckets.pop() if len(buckets) == 1 else None,
    )


def united(parts: Sequence[tuple[int, Index]], lost: Sequence[tuple[int, Losses]], net: bool = True) -> Index:
    """One index of the parts that runs have written, and of what later runs took from earlier ones.

    All removed keys are one table with the last run that removed each, so however many runs
    there were, rows meet it in one join. ``net=False`` leaves the statistics as the parts have them, so that
    they can be written with the losses beside them.
    """
    removed = None
    if lost:
        keys = [x.keys.select("box", "uid", F.lit(number).cast("bigint").alias("number")) for number, x in lost]
        removed = stored(reduce(DataFrame.unionByName, keys).groupBy("box", "uid").agg(F.max("number").alias("number")), "removed")
    buckets = {part.term_buckets for _, part in parts}
    one = buckets.pop() if len(buckets) == 1 else None

    def union(name: str, more: Sequence[DataFrame] = ()) -> DataFrame:
        tables = [*[getattr(part, name) for _, part in parts], *more]
        return reduce(DataFrame.unionByName, tables if one else [t.drop("term_bucket") for t in tables])

    def living(name: str) -> DataFrame:
        tables = [getattr(p, name).withColumn("_part", F.lit(n).cast("bigint")) for n, p in parts]
        rows = reduce(DataFrame.unionByName, tables if one else [t.drop("term_bucket") for t in tables])
        return live(rows, removed, "_part").drop("_part")

    taken = [x for _, x in lost] if net else []
    none = F.lit(0).cast("bigint")
    fewer_words = [x.dictionary.withColumn("df", -F.col("df")) for x in taken]
    fewer_fields = [
        x.field_stats.select(
            "box", "field", (-F.col("n_docs")).alias("n_docs"), (-F.col("total_len")).alias("total_len"), none.alias("max_uid")
        )
        for x in taken
    ]
    fewer_docs = [x.keys.groupBy("box").agg((-F.count("*")).alias("n_docs")).withColumn("max_uid", none) for x in taken]
    return Index(
        postings=living("postings"),
        dictionary=_summed_dictionary(union("dictionary", fewer_words)),
        field_stats=_summed_stats(union("field_stats", fewer_fields)),
        keys=living("keys"),
        words=union("words").distinct(),
        boxes=_summed_boxes(union("boxes", fewer_docs)),
        term_buckets=one,
        forward=tuple(replace(f, number=n) for n, p in parts for f in p.forward),
        removed=removed,
    )


def updated(index: Index, part: Index, touched: DataFrame) -> Index:
    """``index`` after a run: the keys in ``touched`` go, the documents of ``part`` come.

    ``touched`` has to hold all keys of ``part``; those without a document there are removed.
    """
    return merge_indexes([without(index, losses(index, touched)), part])


def replace_postings(postings: DataFrame, touched: DataFrame, documents: DataFrame) -> DataFrame:
    """Postings after an update: those of touched keys go, those of new versions come.

    ``touched`` holds the (box, uid) that were indexed again or deleted.
    """
    kept = postings.drop("term_bucket").join(touched.select("box", "uid"), ["box", "uid"], "left_anti")
    return kept.unionByName(build_postings(documents))
