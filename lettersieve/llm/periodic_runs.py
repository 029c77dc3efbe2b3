"""Periodic runs of words: suffix-tree extensions of Lyndon roots.

A run is a stretch of words with smallest period q and a length of at least ``max(shortest,
2q)`` that no neighbouring word extends. By the runs theorem every run has a Lyndon root, for
one of the two orders of the words, that is the longest Lyndon word at its position. So each
position and order gives one candidate (its longest Lyndon word, by next smaller suffixes),
which is extended to the left and right by longest common extensions. Those come from Ukkonen suffix trees of
the words and of their reversal, as lowest common ancestors in constant time on the Euler tour.

Trees are built only where runs can be: a run of ``shortest`` = m words or more begins with
h = ceil(m / 2) words that occur again one period later, so each of its words is in a stretch whose
h-word windows are repeated in the document, with gaps of at most h - 1 windows. Every run lies inside one
such stretch with all of its neighbours that could extend it; other words are never touched.

The table is only mapped: a document is one row and its runs depend on nothing else. A text of
n words takes some 400 n bytes in its task where it repeats itself throughout, and next to nothing elsewhere.

Defined results: null, empty and blank texts have no words and no runs; equal rows get equal
results, ties between runs go to the smaller start, then period; an empty table gives an empty table. Texts
are processed whole. Columns of the caller stay; new ones whose name is taken get underscores
before it. In ``digest`` a document without id is not rewritten.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lettersieve.llm.common import free_name, ships_its_code
from lettersieve.llm.suffix_tree import Extensions

ships_its_code(__name__)

SHORTEST = 12
_WORD = regex.compile(r"[^\x20\x09-\x0D]+")

Run = tuple[int, int, int]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text or "")


def numbered_words(words: list[str]) -> np.ndarray:
    """Words as numbers from 1 on, equal for equal words."""
    known: dict[str, int] = {}
    return np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int64, len(words))


def repeated_stretches(numbers: np.ndarray, window: int) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of words in which runs can lie."""
    if len(numbers) <= window:
        return []
    names = numbers
    size = 1
    while size < window:  # windows of 1, 2, 4, .. words, the last step overlaps: equal names are equal windows
        step = min(size, window - size)
        pairs = names[: len(names) - step] * (int(names.max()) + 1) + names[step:]
        _, names = np.unique(pairs, return_inverse=True)
        size += step
    again = np.flatnonzero(np.bincount(names)[names] > 1)
    if not len(again):
        return []
    breaks = np.flatnonzero(np.diff(again) > window)
    begins = again[np.concatenate([[0], breaks + 1])]
    ends = again[np.concatenate([breaks, [len(again) - 1]])] + window
    return list(zip(begins.tolist(), ends.tolist(), strict=True))


def longest_lyndon(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position: the way to the next smaller suffix."""
    ranks = rank.tolist()
    n = len(ranks) - 1
    length = np.empty(n, np.int64)
    after: list[int] = [n]
    for i in range(n - 1, -1, -1):
        while ranks[after[-1]] > ranks[i]:
            after.pop()
        length[i] = after[-1] - i
        after.append(i)
    return length


def runs_of(numbers: np.ndarray, shortest: int = SHORTEST) -> list[Run]:
    """All (start, length, period), by start, then period."""
    found: list[Run] = []
    for begin, end in repeated_stretches(numbers, -(-shortest // 2)):
        _, dense = np.unique(numbers[begin:end], return_inverse=True)
        found += [(begin + s, n, q) for s, n, q in _runs_inside((dense + 1).tolist(), shortest)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _runs_inside(text: list[int], shortest: int) -> list[Run]:
    n = len(text)
    forward, backward = Extensions(text), Extensions(text[::-1])
    at = np.arange(n)
    candidates = set()
    for rank in (forward.rank, forward.reverse_rank):
        period = longest_lyndon(rank)
        right = forward.lce(at, at + period)
        # Words before i and before i + period, read backwards: suffixes n - i and n - i - period of the reversal.
        left = backward.lce(n - at, n - at - period)
        length = left + period + right
        keep = np.flatnonzero((length >= 2 * period) & (length >= shortest))
        candidates.update(zip((at - left)[keep].tolist(), length[keep].tolist(), period[keep].tolist(), strict=True))
    return sorted(candidates)


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay: those in no run beyond its first period."""
    marks = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        marks[start + period] += 1
        marks[start + length] -= 1
    return np.cumsum(marks[:n]) == 0


def collapsed(words: list[str], runs: list[Run]) -> str:
    return " ".join(words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()) if runs else " ".join(words)


def longest(runs: list[Run]) -> Run | None:
    return min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)


def rewritten(words: list[str], doc_id: int | None) -> list[str]:
    """The query's test pattern: one document in ten gets a periodic tail, by a checksum of its id."""
    if doc_id is None or not words:
        return words
    checksum = zlib.crc32(str(doc_id).encode())
    if checksum % 10:
        return words
    g, n = checksum // 10, len(words)
    begin = g % n
    period = 1 + (n - begin) // (3 + g % 8)
    return words[:begin] + [words[begin + (i - begin) % period] for i in range(begin, n)]


def _per_row(docs: DataFrame, fields: list[T.StructField], inputs: list[str], values: Callable[..., tuple]) -> DataFrame:
    """``docs`` with ``fields``, the values of which a function gives for the inputs of each row."""
    places = [docs.columns.index(name) for name in inputs]
    schema = T.StructType([*docs.schema.fields, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [values(*[v.as_py() for v in row]) for row in zip(*[batch.column(p) for p in places], strict=True)]
            new = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return docs.mapInArrow(run, schema)


_RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
)


def find_runs(docs: DataFrame, text: str = "text", name: str = "runs", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with ``name``: the runs (start, length, period) of each text, by start, then period."""

    def values(value: str | None) -> tuple:
        runs = runs_of(numbered_words(words_of(value)), shortest)
        return ([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs],)

    return _per_row(docs, [T.StructField(free_name(docs, name), _RUNS)], [text], values)


def without_repeats(docs: DataFrame, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """``docs`` with each run cut to its first period; texts with runs have their words joined by one space."""

    def values(value: str | None) -> tuple:
        words = words_of(value)
        runs = runs_of(numbered_words(words), shortest)
        return (collapsed(words, runs) if runs else value,)

    new = free_name(docs, "collapsed")
    made = _per_row(docs, [T.StructField(new, T.StringType())], [text], values)
    return made.withColumn(text, made[f"`{new}`"]).drop(new)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, number of runs, the longest one, digests of all runs and of the kept words."""
    names = ("n_runs", "start", "length", "period", "exponent_milli")
    fields = [T.StructField(n, T.LongType()) for n in names]
    fields += [T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")]

    def values(doc_id: int | None, text: str | None) -> tuple:
        words = rewritten(words_of(text), doc_id)
        runs = runs_of(numbered_words(words))
        best = longest(runs)
        shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        written = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(runs), *shown, sha(written), sha(collapsed(words, runs))

    return _per_row(docs.select("doc_id", "text"), fields, ["doc_id", "text"], values).drop("text")
