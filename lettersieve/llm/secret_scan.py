"""Secret scan with a trigram inverted index.

Every rule is a regular expression. Its Boolean trigram query, in disjunctive form, is derived
from the expression (see ``trigram_query``). The index has one posting (trigram,
row) per trigram asked for and row that holds it, in lower case. Postings are intersected per
clause, clauses are united per rule, and only the rows that a rule's query returns are
verified with its expression. A rule without mandatory trigrams scans every row.

Defined results: a null or empty text has no spans. Rows are found by a hash of id and text,
so repeated rows and rows without id are each verified; a hash collision only adds a
candidate. Columns of the caller keep their names; an empty table gives an empty table. Long texts are scanned
whole: positions are running sums taken in two levels, and redaction cuts a text into pieces once, so
neither grows an array match by match or counts characters from the beginning for every match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettersieve.llm.common import free_name, let
from lettersieve.llm.trigram_query import trigram_query
from lettersieve.sources.shared import stored

# Arrays are gone through in stretches of this length, texts in pieces of so many characters.
STRETCH = 256
PIECE = 4096


@dataclass(frozen=True)
class Rule:
    """One kind of secret.

    A match counts if ``group`` has at least ``at_least`` characters.
    """

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 1


# The base rules.
_KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = Rule(
    "assign",
    rf"""(?i:({_KEYWORDS}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    2,
    12,
)
ACCESS = Rule("access", "AKIA[A-Z0-9]+", 0, 18)
HEX = Rule("hex", "[0-9a-f]{16,}")
BASE = (ASSIGN, ACCESS, HEX)
# A private key goes on to its END line. Where two dashes or the end of the text come before that, it goes on over
# the long lines of base64 that follow, over the two header lines of an encrypted key, and over one last
# short line that is no word. Line ends may be escaped, quoted or blanks. Loops are possessive, for they need no way back.
_KEY_BEGIN = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
_KEY_END = r"[^-]*+(?:-[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----"
_KEY_GAP = r"""(?:[ \t\r\n>"'+,]|\\[nr])++"""
_KEY_LINE = r"""[A-Za-z0-9+/=]{40,}+|(?:Proc-Type|DEK-Info): [^\r\n\\"']*+"""
_KEY_SHORT = r"[A-Za-z0-9+/]{0,39}(?:[0-9+/]|[a-z][A-Z])[A-Za-z0-9+/]{0,39}={0,2}|[A-Za-z0-9+/]{1,39}={1,2}"
_KEY_REST = f"(?:{_KEY_END}|(?:{_KEY_GAP}(?:{_KEY_LINE}))*+(?:{_KEY_GAP}(?:{_KEY_SHORT}))?)"
# Further public token formats, which the method adds.
ADDED = (
    Rule("pem", _KEY_BEGIN + _KEY_REST),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED


def clauses(rule: Rule) -> list[list[str]]:
    """The rule's trigram query: all trigrams of one of these lists have to be there."""
    return trigram_query(rule.pattern)


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(doc_id, text)


def postings(docs: DataFrame, grams: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(gram, row): the inverted index of ``docs`` for the trigrams asked for."""
    rows = docs.select(row_key(doc_id, text).alias("row"), F.lower(F.col(text)).alias("lower"))
    held = F.array(*[F.when(F.contains("lower", F.lit(g)), F.lit(g)) for g in grams])
    return rows.select("row", F.explode(held).alias("gram")).filter("gram is not null").select("gram", "row")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kinds): the rules whose trigram query a row satisfies.

    Each posting is tagged with the clauses that ask for it, a list of fixed size, and a
    clause holds where all of its postings meet.
    """
    asked: dict[str, list[str]] = {}
    need: dict[str, int] = {}
    for rule in rules:
        for number, grams in enumerate(clauses(rule)):
            need[f"{rule.kind}/{number}"] = len(grams)
            for gram in grams:
                asked.setdefault(gram, []).append(f"{rule.kind}/{number}")
    tags = F.create_map(*[F.lit(x) for g, c in asked.items() for x in (g, ",".join(c))])
    needed = F.create_map(*[F.lit(x) for c, n in need.items() for x in (c, n)])
    tagged = index.distinct().select("row", F.explode(F.split(tags[F.col("gram")], ",")).alias("clause"))
    met = tagged.groupBy("row", "clause").agg(F.count("*").alias("n")).filter(F.col("n") == needed[F.col("clause")])
    return met.groupBy("row").agg(F.collect_set(F.substring_index("clause", "/", 1)).alias("kinds"))


def before_each(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each integer of an array what ``combine`` makes of 0 and all before it; the last entry has all.

    Stretches are gone through one by one and then together, so the arrays that grow stay short.
    """

    def gone_through(items: Column) -> Column:
        start = F.struct(F.lit(0).alias("now"), F.array().cast("array<int>").alias("seen"))
        step = lambda s, x: F.struct(
            combine(s["now"], x).cast("int").alias("now"), F.concat(s["seen"], F.array(s["now"])).alias("seen")
        )
        return F.aggregate(items, start, step)

    def joined(all_values: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_values), F.lit(STRETCH))
        parts = F.transform(starts, lambda at: gone_through(F.slice(all_values, at, F.lit(STRETCH))))

        def from_parts(found: Column) -> Column:
            tops = gone_through(F.transform(found, lambda part: part["now"]))
            return let(
                tops,
                lambda top: F.concat(
                    F.flatten(
                        F.zip_with(
                            found, top["seen"], lambda part, t: F.transform(part["seen"], lambda v: combine(t, v).cast("int"))
                        )
                    ),
                    F.array(top["now"]),
                ),
            )

        return let(parts, from_parts)

    return let(values, lambda v: F.when(F.size(v) == 0, F.array(F.lit(0))).otherwise(joined(v)))


def spans(text: Column, rule: Rule) -> Column:
    """Array of (start, kind order, end, kind) of a rule's matches in a text, in code points.

    The pieces between the matches and the matches themselves give the positions by running
    sums of their lengths.
    """
    order = next(i for i, known in enumerate((*RULES, rule)) if known.kind == rule.kind)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    sizes = F.struct(
        F.transform(matches, F.length).alias("hit"), F.transform(counted, F.length).alias("part"), gaps.alias("gap")
    )

    def placed(s: Column) -> Column:
        steps = F.zip_with(F.slice(s["gap"], 1, F.size(s["hit"])), s["hit"], lambda g, h: g + h)
        ends = F.slice(before_each(steps, lambda a, b: a + b), 2, F.greatest(F.size(s["hit"]), F.lit(1)))
        found = F.transform(
            F.arrays_zip(ends.alias("end"), s["hit"].alias("hit"), s["part"].alias("part")),
            lambda x: F.struct(
                (x["end"] - x["hit"]).alias("start"),
                F.lit(order).alias("rank"),
                x["end"].alias("end"),
                F.lit(rule.kind).alias("kind"),
                x["part"].alias("part"),
            ),
        )
        long = F.filter(found, lambda x: x["part"] >= rule.at_least)
        return F.transform(long, lambda x: F.struct(x["start"], x["rank"], x["end"], x["kind"]))

    # Only texts with a match pay for the second and third pass.
    return F.when(text.rlike(rule.pattern), let(sizes, placed)).otherwise(_no_spans())


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")


def scan(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    doc_id: str = "doc_id",
    text: str = "text",
    name: str = "spans",
) -> DataFrame:
    """``docs`` with ``name``: all spans (start, rank, end, kind) of a text by start, then rule.

    The candidates are a table in the shared folder: Spark broadcasts it if it is below its
    own size bound, else rows and candidates meet in a shuffle by row hash, which is even
    because a hash stands for one id and text.
    """
    indexed = tuple(rule for rule in rules if clauses(rule))
    grams = sorted({g for rule in indexed for c in clauses(rule) for g in c})
    row, kinds, whole = (free_name(docs, x) for x in ("row", "kinds", "whole"))
    found = stored(candidates(postings(docs, grams, doc_id, text), indexed), "candidates").select(
        F.col("row").alias(row), F.col("kinds").alias(kinds)
    )
    joined = docs.withColumn(row, row_key(doc_id, text)).join(found, row, "left")
    body = F.coalesce(F.col(text), F.lit(""))
    parts = [
        F.when(F.array_contains(kinds, rule.kind), spans(body, rule)).otherwise(_no_spans())
        if rule in indexed
        else spans(body, rule)
        for rule in rules
    ]
    return joined.withColumn(name, F.array_sort(F.concat(*parts))).drop(row, kinds, whole)


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


def written(found: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of spans in order, joined by commas."""
    if kinds is not None:
        found = F.filter(found, lambda s: reduce(or_, [s["kind"] == k for k in kinds]))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, base counts, digest of the base spans, and all spans."""
    base = tuple(rule.kind for rule in BASE)
    found = F.col("spans")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(found, kind).alias(f"n_{kind}") for kind in base],
        F.sha2(written(found, base), 256).alias("base_sha256"),
        written(found).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; spans that touch or overlap become one mark."""
    name = free_name(docs, "spans")
    found = scan(docs, doc_id=doc_id, text=text, name=name)

    def clean(spans_: Column) -> Column:
        reached = before_each(F.transform(spans_, lambda s: s["end"]), F.greatest)
        # Where a span begins beyond all before it, what lies between stays, and a mark follows.
        cuts = F.filter(
            F.zip_with(reached, spans_, lambda at, s: F.struct(at.alias("at"), s["start"].alias("upto"))),
            lambda c: c["upto"].isNull() | (c["upto"] > c["at"]) | ((c["at"] == 0) & (c["upto"] == 0)),
        )
        pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

        def between(held: Column, at: Column, upto: Column) -> Column:
            first = F.floor(at / PIECE).cast("int")
            last = F.floor((upto - 1) / PIECE).cast("int")
            part = F.array_join(F.slice(held, first + 1, F.greatest(last - first + 1, F.lit(0))), "")
            return F.when(upto > at, F.substring(part, at - first * PIECE + 1, upto - at)).otherwise("")

        def joined(held: Column) -> Column:
            end = F.length(F.col(text))
            kept = F.transform(
                cuts,
                lambda c: F.concat(
                    between(held, c["at"], F.coalesce(c["upto"], end)), F.when(c["upto"].isNull(), "").otherwise(mark)
                ),
            )
            return F.array_join(kept, "")

        return let(pieces, joined)

    return found.withColumn(text, F.when(F.size(name) > 0, let(F.col(name), clean)).otherwise(F.col(text))).drop(name)
