"""Ranking hits, many queries at once, and result sets as uid ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lettersieve.functions import scoring, text
from lettersieve.operators import batch_scores, slices
from lettersieve.operators.matching import HEADER_KINDS, contributions, search, word_join
from lettersieve.operators.postings import Index
from lettersieve.sources.shared import stored

# Fixed value: the most hits a search returns for one box.
RESULT_CAP = 10_000
# Parts of a box that a batch of searches works on, so that a box of any size is spread over tasks.
SPREAD = 1024


def _best_first() -> list[Column]:
    return [F.desc("score"), F.asc("uid")]


def top_per_box(
    hits: DataFrame,
    limit: int | None = None,
    group: Sequence[str] = ("box",),
    uidnext: DataFrame | None = None,
    bits: int = slices.SLICE_BITS,
    by_slice: bool = True,
) -> DataFrame:
    """The best hits of each group with their ``rank``, by score, then uid; all without ``limit``.

    Two exact steps: the best of every uid slice, then the best of those. So even a box
    with billions of hits leaves at most ``limit`` rows per slice for the final window.
    ``uidnext(box, uidnext)`` lowers the limit of a box to its next free uid. Without ``by_slice`` the first step
    is left out, for hits of which every task has left about the best of each group only.
    """
    if limit is None:
        return _cut_at_uidnext(_all_ranked(hits, group, bits), uidnext)
    best = hits
    if by_slice:
        # Some hits come with their slices and are partitioned by them already.
        sliced = hits if "_slice" in hits.columns else hits.withColumn("_slice", slices.slice_of("uid", bits))
        in_slice = W.partitionBy(*group, "_slice").orderBy(*_best_first())
        best = sliced.withColumn("_rank", F.row_number().over(in_slice)).filter(F.col("_rank") <= limit)
    overall = W.partitionBy(*group).orderBy(*_best_first())
    ranked = (
        best.withColumn("rank", F.row_number().over(overall))
        .filter(F.col("rank") <= limit)
        .withColumn("rank", F.col("rank").cast("bigint"))
        .drop("_slice", "_rank")
    )
    return _cut_at_uidnext(ranked, uidnext)


def _cut_at_uidnext(ranked: DataFrame, uidnext: DataFrame | None) -> DataFrame:
    if uidnext is None:
        return ranked
    return (
        ranked.join(uidnext.select("box", "uidnext"), "box").filter(F.col("rank") <= F.col("uidnext")).drop("uidnext")
    )


def _all_ranked(hits: DataFrame, group: Sequence[str], bits: int) -> DataFrame:
    """All hits with their rank: hits with a better score, and the place by uid among equal ones.

    Scores are rounded to six digits, so a group has a bounded number of different scores,
    whatever the number of its hits; equal scores are numbered by uid slices.
    """
    hits = stored(hits.drop("_slice"), "hits")
    placed = slices.position(hits, [*group, "score"], "uid", "_place", bits)
    better = W.partitionBy(*group).orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    before = (
        hits.groupBy(*group, "score")
        .agg(F.count("*").alias("_n"))
        .select(*group, "score", F.coalesce(F.sum("_n").over(better), F.lit(0)).alias("_better"))
    )
    return placed.join(before, [*group, "score"]).select(
        *hits.columns, (F.col("_better") + F.col("_place")).cast("bigint").alias("rank")
    )


def search_top(
    index: Index,
    value: str,
    fields: Sequence[str] | None = text.DEFAULT_FIELDS,
    operator: str = "or",
    boxes: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """(box, uid, score, rank): a search as a mail client asks for it, best hits first.

    Every box returns the ``limit`` best hits, or as many as its next uid if that is less.
    """
    hits = search(index, value, fields, operator, boxes, by_slice=True)
    return top_per_box(hits, limit, uidnext=None if limit is None else uidnext_of(index, boxes))


def uidnext_of(index: Index, boxes: Sequence[str] | None = None) -> DataFrame:
    """(box, uidnext): the uid that the next message of a box will get, from one row per box."""
    known = index.boxes if boxes is None else index.boxes.filter(F.col("box").isin(*boxes))
    return known.select("box", (F.col("max_uid") + 1).alias("uidnext"))


def argument_fields(args: DataFrame, allowlist: DataFrame | None = None) -> DataFrame:
    """Adds ``field`` to arguments (query_id, kind, header): one row per field to search.

    ``field`` is null where the index cannot answer: other kinds than text, body and
    headers, and headers missing from ``allowlist(header)``. Those are the caller's residual.
    """
    kind = F.col("kind")
    if allowlist is not None:
        allowed = allowlist.select(F.lower("header").alias("_name"), F.lit(True).alias("_allowed")).distinct()
        if slices.is_small(allowed):
            allowed = F.broadcast(allowed)
        args = args.join(allowed, F.lower("header") == F.col("_name"), "left")
        kind = F.when(~kind.isin(*HEADER_KINDS) | F.col("_allowed"), kind)
    found = (
        F.when(kind == "text", F.array(*map(F.lit, text.DEFAULT_FIELDS)))
        .when(kind == "body", F.array(F.lit("body")))
        .when(kind.isin(*HEADER_KINDS), F.array(text.field_name(F.col("header"))))
    )
    return args.select("*", F.explode_outer(found).alias("field")).drop("_name", "_allowed")


def batch_terms(
    queries: DataFrame, fields: Sequence[str] | DataFrame = text.DEFAULT_FIELDS, operator: str = "or"
) -> DataFrame:
    """(query_id, field, term, n_terms, operator) from (query_id, value).

    Queries may bring their own ``operator`` column. ``fields`` holds for all queries, or is
    a table (query_id, field) as ``argument_fields`` gives it.
    """
    own = F.col("operator") if "operator" in queries.columns else F.lit(operator)
    found = queries.select(
        "query_id", own.alias("operator"), F.array_distinct(text.words(F.col("value"))).alias("terms")
    ).select("query_id", "operator", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    if isinstance(fields, DataFrame):
        searched = fields.select("query_id", "field").dropna().distinct()
        found = found.join(searched, "query_id")
    else:
        found = found.withColumn("field", F.explode(F.array(*map(F.lit, fields))))
    return found.select("query_id", "field", "term", "n_terms", "operator")


def _candidates(index: Index, terms: DataFrame) -> DataFrame:
    """(box, uid, field) of the fields that hold the rarest word of a query of ``terms``, all of whose words are known.

    A field with every word of a query holds its rarest one, so no hit of such a query is elsewhere.
    """
    totals = stored(word_join(index, terms)(index.dictionary).groupBy("field", "term").agg(F.sum("df").alias("df")), "totals")
    known = slices.join_salted(terms, totals, ["field", "term"], ["query_id"])
    rarest = (
        known.groupBy("query_id", "field", "n_terms")
        .agg(F.min(F.struct("df", "term")).alias("least"), F.count("*").alias("n"))
        .filter("n = n_terms")
        .select("field", "least.term")
    )
    found = word_join(index, rarest)(index.postings)
    return stored(found.select("box", "uid", "field").distinct(), "candidates")


def _batch_scores(index: Index, terms: DataFrame, within: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Hits of the queries of ``terms`` in all fields, or in those ``within`` names."""
    postings = index.postings
    if within is not None:
        near = F.broadcast(within) if slices.is_small(within) else within
        postings = postings.join(near, ["box", "uid", "field"], "left_semi")
    restrict = word_join(index, terms)
    w = contributions(index, restrict(postings), restrict(index.dictionary))
    needed = F.when(F.col("operator") == "or", 1).otherwise(F.col("n_terms")).alias("needed")
    asked = terms.select("query_id", "field", "term", needed)
    if slices.is_small(asked):
        return _scores_in_tasks(w, asked, limit)
    place = ["box", "_slice"]
    scored = (
        slices.join_salted(w.withColumn("_slice", _spread()), asked, ["field", "term"], ["box", "uid"], False)
        .repartition(*place)
        .groupBy("query_id", *place, "uid", "field")
        .agg(F.sum("w").alias("score"), F.count("*").alias("n_found"), F.max("needed").alias("needed"))
        .filter("n_found >= needed")
    )
    return scored.groupBy("query_id", *place, "uid").agg(scoring.rounded(F.max("score")).alias("score"))


def _spread() -> Column:
    return F.pmod(F.xxhash64("uid"), F.lit(SPREAD))


def _scores_in_tasks(w: DataFrame, asked: DataFrame, limit: int | None) -> DataFrame:
    """Hits from contributions that are shuffled by document and not repeated for the queries that ask for them.

    A batch that was checked to be small goes to every task. A table with a row for each query and word of a document
    would be many times the postings; here a task sums them up in arrays. Where a task can hold the best hits of a box, it gives
    no others, and hits have no ``_slice``.
    """
    spark = w.sparkSession
    words, batch = batch_scores.numbered(asked.toArrow())
    numbers = spark.createDataFrame(words)
    placed = (
        w.join(F.broadcast(numbers), ["field", "term"])
        .select("box", "uid", "field", "word", "w")
        .repartition(F.col("box"), _spread())
        .sortWithinPartitions("box", "uid", "field")
    )
    schema = T.StructType([asked.schema["query_id"], *placed.schema.fields[:2], T.StructField("score", T.DoubleType())])
    run = batch_scores.scorer(batch, to_arrow_schema(schema), limit)
    hits = placed.mapInArrow(run, schema).withColumn("score", scoring.rounded(F.col("score")))
    held = limit is not None and len(batch.ids) * limit <= batch_scores.HELD // 2
    return hits if held else hits.withColumn("_slice", _spread())


def batch_hits(index: Index, terms: DataFrame, limit: int | None = None) -> DataFrame:
    """Hits (query_id, box, uid, score) of many queries, given by ``batch_terms``, some with their ``_slice``.

    Slices are ``SPREAD`` parts of a box by a hash of the uid; the slice step of ``top_per_box`` works on them. A word's
    contribution to a document is computed and shuffled once, however many queries ask for it. Queries that need
    every word are answered within the documents that hold their rarest one. With ``limit`` tasks leave out hits
    beyond it, so there are no slices if all do.
    """
    terms = stored(terms, "batch")
    any_word = F.col("operator") == "or"
    has_or, has_and = terms.agg(F.max(any_word), F.max(~any_word)).first()
    found = []
    if has_or or not has_and:
        found.append(_batch_scores(index, terms.filter(any_word), limit=limit))
    if has_and:
        every = stored(terms.filter(~any_word), "batch-and")
        found.append(_batch_scores(index, every, _candidates(index, every), limit))
    if any("_slice" in hits.columns for hits in found):
        found = [hits.withColumn("_slice", _spread()) if "_slice" not in hits.columns else hits for hits in found]
    return found[0].unionByName(found[1]) if len(found) > 1 else found[0]


def search_batch(index: Index, terms: DataFrame, limit: int | None = None) -> DataFrame:
    """(query_id, box, uid, score, rank): the best hits of every query in every box, all without ``limit``.

    With a limit a box returns no more than its next uid says, as a single search does.
    """
    hits = batch_hits(index, terms, limit)
    uidnext = None if limit is None else uidnext_of(index)
    return top_per_box(hits, limit, ["query_id", "box"], uidnext, by_slice="_slice" in hits.columns)


def _ranges(hits: DataFrame, bits: int) -> DataFrame:
    # Ranges are found inside uid slices. Only a range that touches a slice edge may go on
    # in the next slice: those, at most two per slice, meet in one window per box. All
    # others stay with their slice, where no range follows directly on another.
    sliced = (
        hits.groupBy("box", "uid")
        .agg(F.max("score").alias("score"))
        .withColumn("_slice", slices.slice_of("uid", bits))
    )
    in_slice = W.partitionBy("box", "_slice").orderBy("uid")
    local = (
        sliced.withColumn("_island", F.col("uid") - F.row_number().over(in_slice))
        .groupBy("box", "_slice", "_island")
        .agg(F.min("uid").alias("uid_lo"), F.max("uid").alias("uid_hi"), F.max("score").alias("max_score"))
    )
    start = F.shiftleft(F.col("_slice"), bits)
    end = start + F.lit((1 << bits) - 1)
    at_edge = (F.col("uid_lo") == start) | (F.col("uid_hi") == end)
    place = ["box", "_place"]
    by_lo = W.partitionBy(*place).orderBy("uid_lo")
    begins = F.coalesce((F.col("uid_lo") != F.lag("uid_hi").over(by_lo) + 1).cast("int"), F.lit(1))
    return (
        local.withColumn("_place", F.when(at_edge, F.lit(-1)).otherwise(F.col("_slice")))
        .withColumn("_begins", begins)
        .withColumn("_island", F.sum("_begins").over(by_lo))
        .groupBy(*place, "_island")
        .agg(F.min("uid_lo").alias("uid_lo"), F.max("uid_hi").alias("uid_hi"), F.max("max_score").alias("max_score"))
        .select("box", "uid_lo", "uid_hi", "max_score")
    )


def uid_ranges(hits: DataFrame, bits: int = slices.SLICE_BITS) -> DataFrame:
    """(box, uid_lo, uid_hi): hits as closed ranges of consecutive uids, duplicates merged."""
    unscored = hits.select("box", "uid", F.lit(None).cast("double").alias("score"))
    return _ranges(unscored, bits).drop("max_score")


def hits_by_box(hits: DataFrame, bits: int = slices.SLICE_BITS) -> DataFrame:
    """One row per box: (box, n_hits, n_ranges, min_uid, max_uid, max_score).

    The uids themselves stay in rows (``uid_ranges``): a box's hits are never gathered.
    """
    return (
        _ranges(hits, bits)
        .groupBy("box")
        .agg(
            F.sum(F.col("uid_hi") - F.col("uid_lo") + 1).alias("n_hits"),
            F.count("*").alias("n_ranges"),
            F.min("uid_lo").alias("min_uid"),
            F.max("uid_hi").alias("max_uid"),
            F.max("max_score").alias("max_score"),
        )
    )
