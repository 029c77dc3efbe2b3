"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lettersieve.llm import (
    bpe,
    embedding_dedup,
    language,
    licenses,
    mixing,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    simhash,
    token_alignment,
    url_filter,
    warc_fixity,
)
from lettersieve.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_packing": _over("documents", packing.digest),
    "op2_mixing": _over("documents", mixing.digest),
    "op3_secret_scan": _over("documents", secret_scan.digest),
    "op4_warc_fixity": _over("pages", warc_fixity.digest),
    "op5_quality": lambda spark, sf_dir: quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op6_simhash": _over("documents", simhash.digest),
    "op7_language": _over("documents", language.digest),
    "op8_licenses": _over("documents", licenses.digest),
    "op9_url_filter": _over("pages", url_filter.digest),
    "op10_embedding_dedup": _over("embeddings", embedding_dedup.digest),
    "op11_bpe": _over("documents", bpe.digest),
    "op12_token_alignment": _over("documents", token_alignment.digest),
    "op13_periodic_runs": _over("documents", periodic_runs.digest),
    "language_of_pages": _over("pages", language.pages_digest),
}


def _spans_sql(rank: int, rule: secret_scan.Rule) -> str:
    """Spans of one rule: lengths of the pieces between the matches and of the matches add up."""
    # SQL's engine never goes back, so it knows no possessive loops and needs none.
    pattern = "'" + re.sub(r"([*+?}])\+", r"\1", rule.pattern).replace("'", "''") + "'"
    return f"""
        SELECT r, {rank} AS rank, '{rule.kind}' AS kind,
               CAST(list_sum(list_transform(gaps[1:k], lambda g: length(g)))
                    + coalesce(list_sum(list_transform(hits[1:k - 1], lambda h: length(h))), 0) AS BIGINT) AS begins,
               hits[k] AS hit
        FROM (SELECT r, hits, gaps, parts, unnest(range(1, len(hits) + 1)) AS k
              FROM (SELECT r, regexp_extract_all(body, {pattern}) AS hits, string_split_regex(body, {pattern}) AS gaps,
                           regexp_extract_all(body, {pattern}, {rule.group}) AS parts
                    FROM texts WHERE regexp_matches(body, {pattern})))
        WHERE length(parts[k]) >= {rule.at_least}"""


def _secret_sql() -> str:
    base = ", ".join(f"'{rule.kind}'" for rule in secret_scan.BASE)
    spans = " UNION ALL ".join(_spans_sql(i, rule) for i, rule in enumerate(secret_scan.RULES))
    written = "string_agg(kind || ':' || begins || ':' || (begins + length(hit)), ',' ORDER BY begins, rank)"
    counts = ", ".join(
        f"CAST(count(*) FILTER (kind = '{rule.kind}') AS BIGINT) AS n_{rule.kind}" for rule in secret_scan.BASE
    )
    kept = ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in secret_scan.BASE)
    return f"""
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
             spans AS ({spans}),
             per_row AS (SELECT r, {counts}, {written} FILTER (kind IN ({base})) AS base, {written} AS every
                         FROM spans GROUP BY r)
        SELECT doc_id, {kept}, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
        FROM texts LEFT JOIN per_row USING (r)"""


ORACLE: dict[str, str] = {"op3_secret_scan": _secret_sql(), "op4_warc_fixity": warc_fixity.ORACLE}
