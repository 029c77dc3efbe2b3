"""Tables that find words of the dictionary by a part of them or by a near spelling.

``grams`` holds the character trigrams of each word, with marks for its begin and end. A wildcard pattern
asks for the trigrams that every match must have; words that have all of them are tested with the pattern.
A pattern without a whole trigram tests every word.

``pieces`` holds each word cut into ``PARTS`` pieces of nearly equal length. ``DISTANCE`` edits cannot touch all of
them, so a word within that distance has one piece of the other, moved by no more places than there are edits.
Near words are found by an equality join on pieces and then measured: three rows for a word of any length.

Both tables are sorted by their key, so that a search reads the row groups of its own keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.functions.text import like_pattern
from lettersieve.operators import slices
from lettersieve.operators.matching import KEY, word_join
from lettersieve.operators.postings import Index

BEGIN, END = "\x02", "\x03"
GRAM = 3
DISTANCE = 2
PARTS = DISTANCE + 1

SCHEMAS = {
    "grams": "gram string, term string",
    "pieces": "size int, part int, piece string, term string",
}


@dataclass(frozen=True)
class Lookup:
    terms: DataFrame
    grams: DataFrame | None = None
    pieces: DataFrame | None = None


def grams_of(words: DataFrame) -> DataFrame:
    """(gram, term) of distinct ``words(term)``."""
    marked = F.concat(F.lit(BEGIN), F.col("term"), F.lit(END))
    starts = F.sequence(F.lit(1), F.length(marked) - (GRAM - 1))
    grams = F.transform(starts, lambda at: F.substring(marked, at, F.lit(GRAM)))
    # A word of n characters has n marked trigrams; the empty word has none.
    return words.filter(F.length("term") > 0).select(F.explode(F.array_distinct(grams)).alias("gram"), "term")


def _piece(size: Column, part: int) -> tuple[Column, Column]:
    """Where a piece of a word of ``size`` characters starts, from 0, and its length; the last pieces are the longer ones."""
    short = F.lit(PARTS) - size % PARTS
    length = F.floor(size / PARTS).cast("int")
    start = length * part + F.greatest(F.lit(0), F.lit(part) - short)
    return start, length + (F.lit(part) >= short).cast("int")


def pieces_of(words: DataFrame) -> DataFrame:
    """(size, part, piece, term) of distinct ``words(term)``."""
    size = F.length("term")
    found = []
    for part in range(PARTS):
        start, length = _piece(size, part)
        found.append(F.struct(F.lit(part).alias("part"), F.substring("term", start + 1, length).alias("piece")))
    return words.select(size.alias("size"), F.inline(F.array(*found)), "term")


def _asked_pieces(words: DataFrame, distance: int) -> DataFrame:
    """(word, size, part, piece): what a word at most ``distance`` edits from ``words(word)`` may have in common with it."""
    size, own = F.col("size"), F.length("word")
    sizes = F.explode(F.sequence(F.greatest(F.lit(0), own - distance), own + distance)).alias("size")
    found = []
    for part in range(PARTS):
        start, length = _piece(size, part)
        for moved in range(-distance, distance + 1):
            at = start + moved
            piece = F.struct(F.lit(part).alias("part"), F.substring("word", at + 1, length).alias("piece"))
            found.append(F.when((at >= 0) & (at + length <= own), piece))
    pieces = F.explode(F.array_distinct(F.array_compact(F.array(*found)))).alias("found")
    return words.select("word", sizes).select("word", "size", pieces).select("word", "size", "found.part", "found.piece")


def write_lookup(words: DataFrame, root: str, tables: Sequence[str] = tuple(SCHEMAS)) -> None:
    """Writes the tables of ``words(term, ...)``: the words, and those of ``SCHEMAS`` that ``tables`` names."""
    words.select("term").distinct().write.parquet(f"{root}/terms")
    terms = words.sparkSession.read.schema("term string").parquet(f"{root}/terms")
    made = {"grams": (grams_of, ["gram", "term"]), "pieces": (pieces_of, ["piece", "term"])}
    for name in tables:
        rows_of, order = made[name]
        rows_of(terms).repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{root}/{name}")


def read_lookup(spark: SparkSession, root: str, tables: Sequence[str] = tuple(SCHEMAS)) -> Lookup:
    found = {name: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}") for name in tables}
    return Lookup(terms=spark.read.schema("term string").parquet(f"{root}/terms"), **found)


def pattern_grams(pattern: str) -> list[str]:
    """Trigrams that every word matching a ``*`` pattern has."""
    found = set()
    parts = (BEGIN + pattern + END).split("*")
    for part in parts:
        found |= {part[at : at + GRAM] for at in range(len(part) - GRAM + 1)}
    return sorted(found)


def terms_like(lookup: Lookup, pattern: str) -> DataFrame:
    """(term): the words that match a ``*`` pattern."""
    pattern = pattern.lower()
    asked = pattern_grams(pattern)
    candidates = lookup.terms
    if asked:
        candidates = (
            lookup.grams.filter(F.col("gram").isin(*asked))
            .groupBy("term")
            .agg(F.count("*").alias("n"))
            .filter(F.col("n") == len(asked))
            .select("term")
        )
    return candidates.filter(F.col("term").like(like_pattern(pattern)))


def terms_near(lookup: Lookup, asked: DataFrame, distance: int = 1) -> DataFrame:
    """(word, term): for each ``asked(word)`` the words of the dictionary at most ``distance`` edits away."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"distance must be from 0 to {DISTANCE}, not {distance}")
    words = asked.select(F.lower("word").alias("word")).distinct()
    close = F.levenshtein(F.col("word"), F.col("term"), distance) >= 0
    wanted = _asked_pieces(words, distance)
    wanted = F.broadcast(wanted) if slices.is_small(wanted) else wanted
    return lookup.pieces.join(wanted, ["size", "part", "piece"]).select("word", "term").distinct().filter(close)


def _counted(index: Index, fields: list[str], terms: DataFrame) -> DataFrame:
    words = index.words.filter(F.col("field").isin(*fields)).join(terms, "term", "left_semi")
    return word_join(index, words)(index.postings).groupBy(*KEY).agg(F.count("*").alias("n_matches"))


def search_wildcard(index: Index, lookup: Lookup, pattern: str, fields: list[str]) -> DataFrame:
    """(box, uid, n_matches): as ``matching.search_wildcard``, without a test of every word."""
    return _counted(index, fields, terms_like(lookup, pattern))


def search_fuzzy(index: Index, lookup: Lookup, word: str, fields: list[str], max_distance: int = 1) -> DataFrame:
    """(box, uid, n_matches): as ``matching.search_fuzzy``, by an equality join."""
    asked = index.words.sparkSession.range(1).select(F.lit(word).alias("word"))
    return _counted(index, fields, terms_near(lookup, asked, max_distance).select("term").distinct())
