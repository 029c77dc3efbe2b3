"""Hits from search responses given as JSON texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.sources.shared import stored

DEFAULT_PATH = "hits.hits"
SOURCE = "_source"


def _first_or_self(raw: Column) -> Column:
    # A value may come alone or as an array, whose first element counts; an array that is
    # empty or begins with null has none.
    parsed = F.from_json(raw, "array<string>")
    return F.when(parsed.isNotNull(), F.get(parsed, 0)).otherwise(raw)


def decode_hits(responses: DataFrame, column: str = "value", path: str = DEFAULT_PATH) -> DataFrame:
    """(box, uid, score) of every complete hit in responses, one JSON text per row.

    Each hit is read on its own: a hit without uid, box or score is dropped and cannot
    lend its values to the next one. ``path`` leads to the array of hits.
    """
    schema = f"array<struct<_score: string, {SOURCE}: struct<uid: string, box: string>>>"
    for key in reversed(path.split(".")):
        schema = f"struct<`{key}`: {schema}>"
    parsed = F.from_json(F.col(column), schema)
    for key in path.split("."):
        parsed = parsed[key]
    hit = responses.select(F.explode(parsed).alias("hit"))
    decoded = hit.select(
        _first_or_self(F.col(f"hit.{SOURCE}.box")).alias("box"),
        _first_or_self(F.col(f"hit.{SOURCE}.uid")).try_cast("bigint").alias("uid"),
        F.col("hit._score").try_cast("double").alias("score"),
    )
    return decoded.dropna()


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY or the type of a single value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _first_of_variant(hit: Column, path: str, kind: str) -> Column:
    value = F.try_variant_get(hit, path, "variant")
    return F.when(_kind(value) == "ARRAY", F.try_variant_get(value, "$[0]", kind)).otherwise(
        F.try_variant_get(value, "$", kind)
    )


def walk_hits(responses: DataFrame, column: str = "value") -> DataFrame:
    """(box, uid, score) of every complete hit, at whatever depth of objects and arrays it is.

    A hit is an object with a score and a source. Objects and arrays are opened level by level, each level a
    table in the shared folder, until none is left: as many rounds as the deepest response has levels. Single
    values are dropped at once, and hits are opened like all others, so hits inside of hits are found. A text
    that is no JSON, or has a key twice in one object, has no hits.
    """
    spark = responses.sparkSession
    level = responses.select(F.try_parse_json(column).alias("node")).filter(_kind(F.col("node")).isin("OBJECT", "ARRAY"))
    level, found = stored(level, "walk"), None
    while not level.isEmpty():
        hit = F.col("node")
        decoded = level.filter(_kind(hit) == "OBJECT").select(
            _first_of_variant(hit, f"$.{SOURCE}.box", "string").alias("box"),
            _first_of_variant(hit, f"$.{SOURCE}.uid", "bigint").alias("uid"),
            F.try_variant_get(hit, "$._score", "double").alias("score"),
        )
        found = decoded.dropna() if found is None else found.unionByName(decoded.dropna())
        below = level.lateralJoin(spark.tvf.variant_explode(F.col("node").outer())).select(F.col("value").alias("node"))
        level = stored(below.filter(_kind(F.col("node")).isin("OBJECT", "ARRAY")), "walk")
    if found is None:
        return spark.createDataFrame([], "box string, uid bigint, score double")
    return found


def read_responses(spark, path: str) -> DataFrame:
    """Responses from text files, one response per line."""
    return spark.read.text(path)
