"""BM25 as column expressions (Robertson & Zaragoza 2009; the idf variant with +1 inside
the logarithm, as surveyed by Kamphuis et al. 2020)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the scoring function.
K1 = 1.2
B = 0.75
SCORE_DIGITS = 6


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(1.0 + (n_docs - df + 0.5) / (df + 0.5))


def term_score(idf_: Column, tf: Column, field_len: Column, avg_len: Column) -> Column:
    return idf_ * tf * (K1 + 1.0) / (tf + K1 * (1.0 - B + B * field_len / avg_len))


def rounded(score: Column) -> Column:
    """Ranking uses the rounded score, so that ties break the same way everywhere."""
    return F.round(score, SCORE_DIGITS)
