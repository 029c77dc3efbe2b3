"""Language identification by Bayesian fusion of evidence.

For each row the posterior of a language adds up, in logarithms,
* the text: a multinomial model over byte trigrams of words (hashed to ``BUCKETS`` buckets) per
  language, and a uniform model for ``und``, text of no known language. Trigrams overlap,
  so a text's log-likelihood is divided by the trigram length;
* the declared markup language and the address suffix: how often each value occurs with a
  language that the text model found, over the whole corpus;
* the prior of the host: the languages found on the host, smoothed towards its domain,
  which is smoothed towards the corpus.
The tables of counts come from grouped aggregates over all rows. They are joined, and Spark
broadcasts those below its own size bound.

The text model is fitted on rows with a declared language, about ``SAMPLE`` per language (a
row is taken if the hash of its id falls below SAMPLE / rows of that language), whole texts.
The sample is bounded: it covers the ``MOST_LANGUAGES`` declared values with the most rows (ties by
name), however few rows each has. A language takes 256 KB of the model and one score in each row, so the
model that is collected and broadcast is at most 64 MB, whatever is declared. Rows that declare
another value are judged like all others, by the languages of the model and ``und``.

A row is rejected (``kept`` false) if its most probable language is ``und``, if it has no
letter-like trigram to judge by, or if its language is not among the accepted ones.

Defined results: null, empty and letterless texts get ``und`` and are rejected. Null evidence
says nothing (factor one). Without labelled rows every text is ``und``. Texts are read whole,
in windows of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettersieve.llm.common import free_name, row_hash, ships_its_code, without_rows
from lettersieve.sources.shared import stored

ships_its_code(__name__)

GRAM = 3
BUCKETS = 1 << 16
SAMPLE = 1500
MOST_LANGUAGES = 255
SMOOTHING = 0.05
PRIOR_WEIGHT = 20.0
EVIDENCE_WEIGHT = 1.0
WINDOW = 1 << 20
UNKNOWN = "und"


# Bytes of words: letters, everything beyond ASCII, and the blank between words.
_WORDY = np.array([chr(b).isalpha() or b >= 0x80 or b == 0x20 for b in range(256)])


def _codes(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams of a text in lower case, window by window.

    Trigrams with digits or punctuation are left out: numbers and keys have no language.
    """
    data = f" {' '.join(text.lower().split())} ".encode()
    for at in range(0, max(1, len(data) - GRAM + 1), WINDOW):
        b = np.frombuffer(data[at : at + WINDOW + GRAM - 1], dtype=np.uint8).astype(np.uint32)
        if len(b) < GRAM:
            return
        wordy = _WORDY[b]
        code = ((b[:-2] << 16) | (b[1:-1] << 8) | b[2:])[wordy[:-2] & wordy[1:-1] & wordy[2:]]
        yield ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities: one row per bucket, one column per language and a last one for und."""

    languages: tuple[str, ...]
    weights: np.ndarray

    def score(self, text: str | None) -> tuple[int, list[float]]:
        """(trigrams, log-likelihood per class) of a text."""
        total, n = np.zeros(self.weights.shape[1]), 0
        if text and any(c.isalpha() for c in text):
            for codes in _codes(text):
                used, times = np.unique(codes, return_counts=True) if len(codes) > 4 * BUCKETS else (codes, None)
                rows = self.weights[used]
                total += rows.sum(axis=0, dtype=np.float64) if times is None else times @ rows
                n += len(codes)
        return n, (total / GRAM).tolist()


def sample(docs: DataFrame, doc_id: str, text: str, declared: str, per_language: int = SAMPLE, most: int = MOST_LANGUAGES) -> DataFrame:
    """(language, text): about ``per_language`` labelled rows of each of the ``most`` most declared languages."""
    label = F.lower(F.col(declared))
    named = docs.filter(label.isNotNull() & (label != "") & (label != UNKNOWN))
    counted = named.groupBy(label.alias("language")).agg(F.count("*").alias("n"))
    known = counted.orderBy(F.desc("n"), "language").limit(most).collect()
    if not known:
        return docs.select(label.alias("language"), F.col(text).alias("text")).filter(F.lit(False))
    share = F.create_map(*[F.lit(x) for row in known for x in (row["language"], min(1.0, per_language / row["n"]))])
    place = F.pmod(F.xxhash64(doc_id, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return named.filter(place < share[label]).select(label.alias("language"), F.col(text).alias("text"))


def fit(labelled: DataFrame) -> TextModel:
    """Trains the text model; what comes to the driver is at most BUCKETS counts per language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sums.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))
                for codes in _codes(text or ""):
                    own += np.bincount(codes, minlength=BUCKETS)
        for language, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(used)), pa.array(used.astype(np.int32)), pa.array(own[used])],
                names=["language", "bucket", "n"],
            )

    counts = (
        labelled.mapInArrow(count, "language string, bucket int, n bigint")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(counts["language"].unique()))
    weights = np.full((BUCKETS, len(languages) + 1), np.log(1.0 / BUCKETS), dtype=np.float32)
    for i, (_, own) in enumerate(counts.groupby("language", sort=True)):
        sums = np.zeros(BUCKETS)
        sums[own["bucket"].to_numpy()] = own["n"].to_numpy()
        weights[:, i] = np.log((sums + SMOOTHING) / (sums.sum() + SMOOTHING * BUCKETS))
    return TextModel(languages, weights)


def with_scores(docs: DataFrame, model: TextModel, text: str, keep: Sequence[str], n: str, scores: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the number of trigrams and the log-likelihoods."""
    languages, weights = model.languages, docs.sparkSession.sparkContext.broadcast(model.weights)
    columns = [text, *[c for c in keep if c != text]]
    chosen = docs.select(*[F.col(f"`{c}`") for c in columns])
    kept = [columns.index(c) for c in keep]
    schema = T.StructType([*[chosen.schema.fields[i] for i in kept], T.StructField(n, T.LongType()), T.StructField(scores, T.ArrayType(T.DoubleType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TextModel(languages, weights.value)
        for batch in batches:
            found = [known.score(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in kept],
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array([x[1] for x in found], pa.list_(pa.float64())),
                ],
                names=names,
            )

    return chosen.mapInArrow(run, schema)


def domain_of(host: Column) -> Column:
    """The last two labels of a host name; a name without dots is its own domain."""
    return F.substring_index(F.lower(host), ".", -2)


def _best(scores: Column, classes: Sequence[str]) -> Column:
    """The class with the highest score; the first of those that tie."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def _counts(found: DataFrame, key: Column, classes: Sequence[str]) -> DataFrame:
    return found.groupBy(key.alias("value")).agg(
        F.array(*[F.sum(F.when(F.col("best") == c, 1.0).otherwise(0.0)) for c in classes]).alias("counts")
    )


def _likelihood(found: DataFrame, column: str, classes: Sequence[str]) -> DataFrame:
    """(value, logs): log P(value | class) of a kind of evidence, add-one smoothed over its values."""
    per_value = _counts(found.filter(F.col(column).isNotNull()), F.col(column), classes)
    size = range(len(classes))
    values, *totals = per_value.agg(
        F.count("*"), *[F.coalesce(F.sum(F.col("counts")[i]), F.lit(0.0)) for i in size]
    ).first()
    logs = [F.log((F.col("counts")[i] + 1.0) / (totals[i] + values + 1.0)) for i in size]
    return per_value.select("value", F.array(*logs).alias("logs"))


def _priors(found: DataFrame, classes: Sequence[str]) -> tuple[DataFrame, Column]:
    """((value, logs) of each host, prior logs of rows without host)."""
    size = len(classes)
    corpus = found.agg(*[F.sum(F.when(F.col("best") == c, 1.0).otherwise(0.0)).alias(c) for c in classes]).first()
    n = sum(corpus[c] or 0.0 for c in classes)
    top = [((corpus[c] or 0.0) + 1.0) / (n + size) for c in classes]

    def smoothed(counts: str, parent: list[Column]) -> list[Column]:
        own = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return [(F.col(counts)[i] + PRIOR_WEIGHT * parent[i]) / (own + PRIOR_WEIGHT) for i in range(size)]

    hosts = _counts(found.filter("host is not null"), F.col("host"), classes).withColumn("domain", domain_of(F.col("value")))
    domains = hosts.groupBy("domain").agg(
        F.array(*[F.sum(F.col("counts")[i]) for i in range(size)]).alias("above")
    )
    parent = domains.select("domain", F.array(*smoothed("above", [F.lit(p) for p in top])).alias("parent"))
    logs = hosts.join(parent, "domain").select(
        "value", F.transform(F.array(*smoothed("counts", [F.col("parent")[i] for i in range(size)])), lambda p: F.log(p)).alias("logs")
    )
    return logs, F.array(*[F.lit(float(np.log(p))) for p in top])


def identify(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    declared: str | None = None,
    suffix: str | None = None,
    host: str | None = None,
    keep: Sequence[str] = ("doc_id",),
    accepted: Sequence[str] | None = None,
    names: tuple[str, str, str] = ("language", "confidence", "kept"),
    model: TextModel | None = None,
) -> DataFrame:
    """Columns ``keep`` of ``docs`` with language, confidence (its posterior) and kept.

    Texts are scored once; the scores with the kept columns are a table in the shared folder.
    """
    absent = F.lit(None).cast("string")
    evidence = {
        free_name(docs, name): (F.lower(F.col(column)) if column else absent)
        for name, column in (("e_declared", declared), ("e_suffix", suffix), ("e_host", host))
    }
    e_declared, e_suffix, e_host = evidence
    marked = docs.withColumns(evidence)
    if model is None:
        model = fit(sample(docs, doc_id, text, declared)) if declared else TextModel((), np.zeros((BUCKETS, 1), np.float32))
    classes = (*model.languages, UNKNOWN)
    n, scores = free_name(docs, "e_n"), free_name(docs, "e_scores")
    rows = stored(with_scores(marked, model, text, [*keep, *evidence], n, scores), "language-scores")
    found = rows.filter(F.col(n) > 0).select(
        _best(F.col(scores), classes).alias("best"),
        F.col(e_declared).alias("declared"),
        F.col(e_suffix).alias("suffix"),
        F.col(e_host).alias("host"),
    )
    priors, corpus = _priors(found, classes)
    nothing = F.array(*[F.lit(0.0)] * len(classes))
    fused, seen_logs = rows, []
    for column, logs in (
        (e_declared, _likelihood(found, "declared", classes)),
        (e_suffix, _likelihood(found, "suffix", classes)),
        (e_host, priors),
    ):
        value, seen = free_name(fused, "e_value"), free_name(fused, f"{column}_logs")
        # A table of its own: Spark broadcasts a small one, and can split a hot host otherwise.
        fused = fused.join(
            stored(logs, "language-evidence").select(F.col("value").alias(value), F.col("logs").alias(seen)), F.col(column) == F.col(value), "left"
        ).drop(value)
        seen_logs.append(seen)
    total = F.transform(
        F.arrays_zip(
            F.col(scores).alias("t"),
            F.coalesce(F.col(seen_logs[0]), nothing).alias("d"),
            F.coalesce(F.col(seen_logs[1]), nothing).alias("s"),
            F.coalesce(F.col(seen_logs[2]), corpus).alias("h"),
        ),
        lambda x: x["t"] + EVIDENCE_WEIGHT * (x["d"] + x["s"]) + x["h"],
    )
    spread = F.aggregate(total, F.lit(0.0), lambda a, x: a + F.exp(x - F.array_max(total)))
    language, confidence, kept = names
    judged = F.col(n) > 0
    best = F.when(judged, _best(total, classes)).otherwise(UNKNOWN)
    allowed = best != UNKNOWN
    if accepted is not None:
        allowed = allowed & best.isin(*accepted)
    return fused.select(
        *[F.col(f"`{c}`") for c in keep],
        best.alias(language),
        F.when(judged, F.round(1.0 / spread, 6)).otherwise(F.lit(0.0)).alias(confidence),
        allowed.alias(kept),
    )


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, declared, language, confidence, kept. The source stands for the host."""
    return identify(
        docs.select("doc_id", "text", "lang", "source"),
        declared="lang",
        host="source",
        keep=("doc_id", "lang"),
    ).withColumnRenamed("lang", "declared")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, suffix, host) of web pages: lang attribute, top-level label, visible text."""
    html = F.coalesce("html", F.lit(""))
    body = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"://([^/?#:]*)", 1))
    declared = F.lower(F.regexp_extract(html, r"""(?i)<html[^>]*\blang\s*=\s*["']?([a-z]{2,3})""", 1))
    return pages.select(
        "page_id",
        body.alias("text"),
        F.nullif(declared, F.lit("")).alias("declared"),
        F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
    )


def pages_digest(pages: DataFrame) -> DataFrame:
    """Per page: page_id, declared, language, confidence, kept."""
    found = stored(page_evidence(pages), "page-evidence")
    return identify(found, doc_id="page_id", declared="declared", suffix="suffix", host="host", keep=("page_id", "declared"))


def only_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns doc_id, text, lang, source and more) whose language is known."""
    row = free_name(docs, "row")
    marked = docs.withColumn(row, row_hash("doc_id", "text", "lang", "source"))
    found = identify(
        marked.select("doc_id", "text", "lang", "source", row), declared="lang", host="source", keep=("doc_id", row)
    )
    rejected = found.filter("not kept").select(F.col(row).alias("_row"), F.col("doc_id").alias("_id")).distinct()
    return without_rows(marked, stored(rejected, "rejected"), row, "doc_id").select(*[F.col(f"`{c}`") for c in docs.columns])
