"""Column expressions for field names, field values and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on them, so they are kept exactly as specified.
FIELD_NAME_SPECIALS = '.#*"'  # each becomes "_" in a field name
CONTROL_TEXTS = {"\x1c": "0x1C", "\x1d": "0x1D", "\x1e": "0x1E", "\x1f": "0x1F"}
WORD_PATTERN = r"[\p{L}\p{N}]+"
DEFAULT_FIELDS = ("from", "to", "subject", "body")


def field_name(raw: Column) -> Column:
    """The name a header is indexed and searched under."""
    return F.translate(F.lower(raw), FIELD_NAME_SPECIALS, "_" * len(FIELD_NAME_SPECIALS))


def clean_value(value: Column) -> Column:
    """Replace the separator control bytes by their hexadecimal texts."""
    for byte, text in CONTROL_TEXTS.items():
        value = F.replace(value, F.lit(byte), F.lit(text))
    return value


def words(value: Column) -> Column:
    """All words of a text, in order, lower-cased. Null gives an empty array."""
    found = F.regexp_extract_all(F.lower(clean_value(value)), F.lit(WORD_PATTERN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def words_of_all(values: Column) -> Column:
    """Words of every value of a repeated field."""
    return F.flatten(F.transform(values, words))


def _let(value: Column, use) -> Column:
    # Binds an array to a lambda variable, so that it is computed once per row.
    return F.transform(F.array(value), use)[0]


def term_counts(tokens: Column) -> Column:
    """Distinct words of one row with their counts, as array<struct<term, tf>>.

    Sorting the words puts equal ones side by side; the distance between two starts is
    the count. All inside the row: no explode, no shuffle.
    """

    def count_runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return _let(
            starts,
            lambda begin: F.transform(
                begin,
                lambda i, k: F.struct(
                    F.get(ordered, i).alias("term"),
                    (F.coalesce(F.get(begin, k + 1), F.size(ordered)) - i).cast("bigint").alias("tf"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, _let(F.sort_array(tokens), count_runs))


def like_pattern(pattern: str) -> str:
    """A `*` wildcard pattern as a LIKE pattern; LIKE's own specials are escaped."""
    escaped = pattern.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("*", "%")
