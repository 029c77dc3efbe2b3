"""Searching the index: which documents match, and how well.

A hit is ``(box, uid, score)``. Searching reads postings only, never the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.functions import scoring, text
from lettersieve.operators import slices
from lettersieve.operators.postings import Index, term_bucket
from lettersieve.sources.shared import stored

KEY = ["box", "uid"]
# The kinds of header arguments. All search the field of the header.
HEADER_KINDS = ("header", "header_address", "header_compress_lwsp")
# More words than this are matched by a join and not by a literal list in the scan.
LITERAL_TERMS = 500
LITERAL_BYTES = 1 << 20


@dataclass(frozen=True)
class Arg:
    """One search argument. ``kind`` is text, body, a header kind or any other kind.

    Arguments of other kinds cannot be answered from the index. ``children`` are arguments
    nested in this one; they share its search value, and its negation holds for them.
    """

    kind: str
    header: str | None = None
    negated: bool = False
    children: tuple[Arg, ...] = ()


def flat_args(args: Sequence[Arg], negated: bool = False) -> list[Arg]:
    """All arguments that say something themselves, nested ones included.

    A negation is carried down: an argument is negated if an odd number of arguments from
    itself up to the root are.
    """
    found = []
    for arg in args:
        below = negated != arg.negated
        found += flat_args(arg.children, below)
        if not arg.children:
            found.append(replace(arg, negated=below))
    return found


def is_indexed(arg: Arg, allowed_headers: Sequence[str] | None = None) -> bool:
    """Whether the index can answer an argument. No allowlist means all headers are indexed."""
    if arg.kind in HEADER_KINDS:
        return allowed_headers is None or arg.header.lower() in {name.lower() for name in allowed_headers}
    return arg.kind in ("text", "body")


def search_fields(
    spark: SparkSession, args: Sequence[Arg], allowed_headers: Sequence[str] | None = None
) -> list[str]:
    """The fields to search: the union over all arguments the index can answer."""
    names: list[str] = []
    headers: list[str] = []
    for arg in flat_args(args):
        if not is_indexed(arg, allowed_headers):
            continue
        if arg.kind == "text":
            names += text.DEFAULT_FIELDS
        elif arg.kind == "body":
            names.append("body")
        else:
            headers.append(arg.header)
    return list(dict.fromkeys(names + [_evaluate(spark, text.field_name(F.lit(h))) for h in headers]))


def query_words(spark: SparkSession, value: str) -> list[str]:
    """Distinct words of a search value, split by the same expression as the documents."""
    return _evaluate(spark, F.array_distinct(text.words(F.lit(value))))


def _evaluate(spark: SparkSession, expression: Column):
    # The value of a constant expression, such as the words of one search value. Over a row
    # of literals the optimizer computes it; no job runs.
    return spark.sql("SELECT * FROM VALUES (0)").select(expression).first()[0]


def word_filter(
    index: Index, terms: Sequence[str], fields: Sequence[str] | None = None, boxes: Sequence[str] | None = None
) -> Callable[[DataFrame], DataFrame]:
    """How to restrict an index table to some words, fields and boxes, by literal conditions.

    Folders of other term buckets are not listed, and row groups of other words and boxes
    are skipped by their statistics.
    """
    if len(terms) > LITERAL_TERMS:
        every = index.postings.sparkSession.createDataFrame([(term,) for term in terms], "term string")
        in_words = word_join(index, every)
        terms = None
    buckets = [term_bucket(F.lit(term), index.term_buckets) for term in terms or () if index.term_buckets]

    def restrict(df: DataFrame) -> DataFrame:
        for name, values in (("field", fields), ("box", boxes), ("term", terms), ("term_bucket", buckets or None)):
            if values is not None:
                df = df.filter(F.col(name).isin(*values))
        return df if terms is not None else in_words(df)

    return restrict


def word_join(
    index: Index, words: DataFrame, condition: Column | None = None
) -> Callable[[DataFrame], DataFrame]:
    """How to restrict an index table to the words of a table with ``term`` or ``field, term``.

    Few words become literal conditions in the scan. More are joined: broadcast if checked
    to be small, else salted; only the term buckets they are in are read. If ``condition`` says
    which rows of the table have one of the words, more words are not joined: rows are tested in the scan.
    """
    keys = [name for name in ("field", "term") if name in words.columns]
    words = stored(words.select(keys).distinct(), "words")
    n_rows, n_bytes = slices.size_of(words)
    if n_rows <= LITERAL_TERMS and n_bytes <= LITERAL_BYTES:
        few = words.collect()
        fields = sorted({row.field for row in few}) if "field" in keys else None
        literal = word_filter(index, sorted({row.term for row in few}), fields)
        pairs = len(few) == len({row.term for row in few}) * len(fields or [None])
        # Literal lists allow every field with every word; a join takes out what is not asked for.
        return literal if pairs else lambda df: literal(df).join(F.broadcast(words), keys, "left_semi")
    if condition is not None:
        return lambda df: df.filter(condition)
    if index.term_buckets:
        found = words.select(term_bucket(F.col("term"), index.term_buckets).alias("bucket")).distinct()
        buckets = [row.bucket for row in found.collect()]

    def restrict(df: DataFrame) -> DataFrame:
        if index.term_buckets:
            df = df.filter(F.col("term_bucket").isin(*buckets))
        spread_by = [name for name in KEY if name in df.columns]
        return slices.join_salted(df, words, keys, spread_by, slices.fits(n_rows, n_bytes))

    return restrict


def contributions(index: Index, postings: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(box, field, term, uid, w): the score that each posting adds.

    ``postings`` and ``dictionary`` are the rows of the words searched for.
    """
    weights = dictionary.join(index.field_stats, ["box", "field"]).select(
        "box",
        "field",
        "term",
        scoring.idf(F.col("n_docs"), F.col("df")).alias("idf"),
        (F.col("total_len") / F.col("n_docs")).alias("avg_len"),
        "max_uid",
    )
    rows = postings.select("box", "field", "term", "uid", "tf", "field_len")
    # There is one weight for each dictionary row, which is cheaper to count.
    joined = slices.join_by_box(rows, weights, ["box", "field", "term"], "max_uid", slices.is_small(dictionary))
    w = scoring.term_score(F.col("idf"), F.col("tf"), F.col("field_len"), F.col("avg_len"))
    return joined.select("box", "field", "term", "uid", w.alias("w"))


def field_scores(
    index: Index,
    value: str,
    fields: Sequence[str] | None = text.DEFAULT_FIELDS,
    operator: str = "or",
    boxes: Sequence[str] | None = None,
    by_slice: bool = False,
) -> DataFrame:
    """(box, uid, field, score) of the fields that match one search value.

    ``or``: any word is in the field. ``and``: every word is in the field. ``fields=None``
    searches every field there is. ``by_slice`` adds the uid slice and shuffles on it.
    """
    if operator not in ("and", "or"):
        raise ValueError(f"operator must be 'and' or 'or', not {operator!r}")
    terms = query_words(index.postings.sparkSession, value)
    restrict = word_filter(index, terms, fields, boxes)
    found = contributions(index, restrict(index.postings), restrict(index.dictionary))
    if by_slice:
        found = found.withColumn("_slice", slices.slice_of("uid"))
    document = [*KEY, "_slice"] if by_slice else KEY
    # Postings are unique on (box, field, term, uid), so rows count distinct words. One
    # shuffle serves this aggregate, the one over fields and, by slice, the ranking.
    scored = (
        found.repartition("box", document[-1])
        .groupBy(*document, "field")
        .agg(F.sum("w").alias("score"), F.count("*").alias("n_terms"))
    )
    if operator == "and":
        scored = scored.filter(F.col("n_terms") == len(terms))
    return scored.drop("n_terms")


def search(
    index: Index,
    value: str,
    fields: Sequence[str] | None = text.DEFAULT_FIELDS,
    operator: str = "or",
    boxes: Sequence[str] | None = None,
    by_slice: bool = False,
) -> DataFrame:
    """Hits of one search value; the score is the best one over the fields."""
    scored = field_scores(index, value, fields, operator, boxes, by_slice)
    document = [*KEY, "_slice"] if by_slice else KEY
    return scored.groupBy(*document).agg(scoring.rounded(F.max("score")).alias("score"))


def search_text(index: Index, value: str, operator: str = "or") -> DataFrame:
    """Free text: no field is named, so the default fields are searched."""
    return search(index, value, text.DEFAULT_FIELDS, operator)


def search_body(index: Index, value: str, operator: str = "or") -> DataFrame:
    return search(index, value, ["body"], operator)


def search_header(index: Index, header: str, value: str, operator: str = "or") -> DataFrame:
    """One header, named as in the message: the name is normalised like the indexed ones."""
    return search_args(index, [Arg("header", header)], value, operator)


def search_args(
    index: Index,
    args: Sequence[Arg],
    value: str,
    operator: str = "or",
    allowed_headers: Sequence[str] | None = None,
    boxes: Sequence[str] | None = None,
) -> DataFrame:
    """One value over the union of the fields of several, possibly nested, arguments.

    An argument that is negated gives the complement; its siblings must be negated as well,
    as they are one search. Raises ``LookupError`` if no argument can be answered from the
    index: the caller has to scan the messages.
    """
    usable = [arg for arg in flat_args(args) if is_indexed(arg, allowed_headers)]
    if not usable:
        raise LookupError("no argument can be answered from the index")
    if len({arg.negated for arg in usable}) > 1:
        raise ValueError("combine negated and plain arguments by combine_args")
    fields = search_fields(index.postings.sparkSession, usable)
    hits = search(index, value, fields, operator, boxes)
    if not usable[0].negated:
        return hits
    keys = index.keys if boxes is None else index.keys.filter(F.col("box").isin(*boxes))
    return negate(keys, hits).withColumn("score", F.lit(0.0))


def negate(keys: DataFrame, hits: DataFrame) -> DataFrame:
    """(box, uid) of the documents that are not among the hits."""
    return keys.select(*KEY).join(hits.select(*KEY), KEY, "left_anti")


def combine(first: DataFrame, second: DataFrame, operator: str) -> DataFrame:
    """Hits of two different searches combined; scores add up."""
    if operator not in ("and", "or"):
        raise ValueError(f"operator must be 'and' or 'or', not {operator!r}")
    tagged = first.select(*KEY, "score").unionByName(second.select(*KEY, "score"))
    both = tagged.groupBy(*KEY).agg(scoring.rounded(F.sum("score")).alias("score"), F.count("*").alias("n"))
    if operator == "and":
        both = both.filter("n = 2")
    return both.select(*KEY, "score")


def contains(column: str, value: str) -> Column:
    """Case-insensitive substring test on raw text."""
    return F.contains(F.lower(column), F.lower(F.lit(value)))


def residual_split(
    hits: DataFrame | None, messages: DataFrame, residual: Column | None, operator: str = "and"
) -> DataFrame:
    """(box, uid) of messages matching the indexed arguments and (or) the residual condition.

    ``hits`` is None when the index could answer nothing: then this is a plain scan. The
    residual is evaluated in the scan and only keys of matching messages are shuffled.
    """
    if operator not in ("and", "or"):
        raise ValueError(f"operator must be 'and' or 'or', not {operator!r}")
    rest = messages if residual is None else messages.filter(residual)
    rest = rest.select(*KEY)
    if hits is None:
        return rest
    found = hits.select(*KEY)
    return rest.unionByName(found).distinct() if operator == "or" else rest.join(found, KEY, "left_semi")


def residual_of_hits(hits: DataFrame, texts_of: Callable[[DataFrame], DataFrame], residual: Column) -> DataFrame:
    """(box, uid) of the hits whose message passes the residual condition too.

    As ``residual_split`` with ``and``, but only the messages of hits are read and tested: ``texts_of`` gives the
    messages of some (box, uid).
    """
    return texts_of(hits.select(*KEY)).filter(residual).select(*KEY)


@dataclass(frozen=True)
class Node:
    """A tree of conditions: ``op`` is and, or, not, or the name of a condition."""

    op: str
    parts: tuple[Node, ...] = ()

    def holds(self, met: Column) -> Column:
        """The tree over a column with the names of the conditions that are met."""
        below = [part.holds(met) for part in self.parts]
        if self.op == "not":
            return ~below[0]
        if self.op in ("and", "or"):
            return reduce(and_ if self.op == "and" else or_, below)
        return F.array_contains(met, self.op)

    def names(self) -> set[str]:
        if self.op in ("and", "or", "not"):
            return {name for part in self.parts for name in part.names()}
        return {self.op}


def search_tree(
    tree: Node, answered: dict[str, DataFrame], residual: dict[str, Column], messages: DataFrame
) -> DataFrame:
    """(box, uid) of the messages for which a tree of conditions holds.

    ``answered`` names the conditions with hits from the index, ``residual`` those that are
    tested on ``messages``, all in one scan. Every message brings the few names of what it
    meets, so one shuffle of keys decides the whole tree, under and, or and not alike.
    """
    unknown = tree.names() - answered.keys() - residual.keys()
    if unknown:
        raise LookupError(f"conditions without an answer: {sorted(unknown)}")
    tested = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in sorted(residual.items())]))
    met = messages.select(*KEY, tested.cast("array<string>").alias("met"), F.lit(True).alias("is_message"))
    for name, hits in sorted(answered.items()):
        met = met.unionByName(
            hits.select(*KEY, F.array(F.lit(name)).alias("met"), F.lit(False).alias("is_message"))
        )
    gathered = met.groupBy(*KEY).agg(
        F.array_distinct(F.flatten(F.collect_set("met"))).alias("met"), F.max("is_message").alias("is_message")
    )
    return gathered.filter(F.col("is_message") & tree.holds(F.col("met"))).select(*KEY)


def with_certainty(hits: DataFrame, auto_fuzzy: bool = True) -> DataFrame:
    """Index hits are definite, or only candidates if exact matches were asked for."""
    return hits.withColumn("certainty", F.lit("definite" if auto_fuzzy else "maybe"))


def verify_maybe(
    hits: DataFrame, texts_of: Callable[[DataFrame], DataFrame], exact: Column
) -> DataFrame:
    """Definite hits, and those candidates whose raw text passes the exact test.

    ``texts_of`` gives the messages of some (box, uid): only the texts of candidates are
    tested, never those of all messages.
    """
    definite = hits.filter("certainty = 'definite'")
    candidates = hits.filter("certainty = 'maybe'")
    checked = texts_of(candidates.select(*KEY)).filter(exact).select(*KEY)
    return definite.unionByName(candidates.join(checked, KEY, "left_semi"))


def _count_matches(index: Index, fields: Sequence[str], condition: Column) -> DataFrame:
    # The condition is tested once per word of a field, whatever the number of boxes. The words that meet it grow
    # with the dictionary: many are neither broadcast nor shuffled, their postings are found by the same condition.
    wanted = F.col("field").isin(*fields) & condition
    found = word_join(index, index.words.filter(wanted), wanted)(index.postings)
    return found.groupBy(*KEY).agg(F.count("*").alias("n_matches"))


def search_wildcard(index: Index, pattern: str, fields: Sequence[str]) -> DataFrame:
    """(box, uid, n_matches): documents with a word like ``*part*`` in one of the fields."""
    condition = F.col("term").like(text.like_pattern(pattern.lower()))
    return _count_matches(index, fields, condition)


def search_fuzzy(index: Index, word: str, fields: Sequence[str], max_distance: int = 1) -> DataFrame:
    """(box, uid, n_matches): documents with a word at most ``max_distance`` edits away."""
    wanted = F.lower(F.lit(word))
    near = F.abs(F.length("term") - F.length(wanted)) <= max_distance
    close = F.levenshtein(F.col("term"), wanted, max_distance) >= 0
    return _count_matches(index, fields, near & close)
