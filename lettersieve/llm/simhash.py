"""Near-duplicates by SimHash with a pigeonring filter.

The 64 bits of a fingerprint are a ring of ``SEGMENTS`` segments. If two fingerprints differ
in at most ``DISTANCE`` bits, some segment starts a chain in which the first l segments
together differ in at most l * DISTANCE / SEGMENTS bits, for every l. The first two links of
that chain (13 bits equal, the next 13 with at most one bit changed) are an equality join on
26 bits: one side is stored under its own bits, the other probes with each bit flipped. The
rest of the chain is checked in the join condition, and only pairs whose chain holds to the end
get the full Hamming check.

Only distinct fingerprints are joined, so copies of a text are one row here, whatever their
number; every pair of different fingerprints within the distance is found. Components
come from the star steps of ``components``.

Defined results: a null or blank text has fingerprint zero and links like any other; rows
without id take part, and their group is named after its smallest id (null if it has none).
Very long texts are hashed in blocks of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lettersieve.llm.common import free_name, row_hash, same_row, ships_its_code, without_rows
from lettersieve.llm.components import connected
from lettersieve.sources.shared import stored

ships_its_code(__name__)

DISTANCE = 4
WIDTHS = (13, 13, 13, 13, 12)
SEGMENTS = len(WIDTHS)
SHINGLE = 4
SEED = 42
BLOCK = 1 << 15

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text (UTF-8) as a signed 64-bit number."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        pairs = zip(starts[at : min(n, at + BLOCK)].tolist(), last[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in pairs], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fp", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the fingerprint of each row as ``name``, without the columns in ``drop``."""
    columns = docs.columns
    at, kept = columns.index(text), [i for i, c in enumerate(columns) if c not in drop]
    schema = T.StructType([*[docs.schema.fields[i] for i in kept], T.StructField(name, T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            found = pa.array((fingerprint(t.as_py()) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], found], names=names)

    return docs.mapInArrow(run, schema)


def _offset(i: int) -> int:
    return sum(WIDTHS[:i])


def segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, _offset(i)).bitwiseAND(F.lit((1 << WIDTHS[i]) - 1).cast("bigint"))


def _key(start: int, first: Column, second: Column) -> Column:
    return F.lit(start << 32).cast("bigint").bitwiseOR(F.shiftleft(first, 13)).bitwiseOR(second)


def _differing(i: int) -> Column:
    return F.bit_count(segment(F.col("x").bitwiseXOR(F.col("y")), i))


def chain_holds(start: int) -> Column:
    """Whether the chain from segment ``start`` stays within its budget after each link."""
    holds, total = F.lit(True), F.lit(0)
    for length in range(1, SEGMENTS + 1):
        total = total + _differing((start + length - 1) % SEGMENTS)
        holds = holds & (total <= length * DISTANCE // SEGMENTS)
    return holds


def links(prints: DataFrame) -> DataFrame:
    """(a, b): all pairs a < b of distinct fingerprints ``prints(fp)`` that differ in 1 to 4 bits."""
    fp = F.col("fp")
    stored_keys, probes = [], []
    for start in range(SEGMENTS):
        nxt = (start + 1) % SEGMENTS
        first, second = segment(fp, start), segment(fp, nxt)
        stored_keys.append(_key(start, first, second))
        flips = [0, *[1 << bit for bit in range(WIDTHS[nxt])]]
        probes += [_key(start, first, second.bitwiseXOR(F.lit(flip).cast("bigint"))) for flip in flips]
    kept = prints.select(fp.alias("x"), F.explode(F.array(*stored_keys)).alias("key"))
    asked = prints.select(fp.alias("y"), F.explode(F.array(*probes)).alias("key"))
    start = F.shiftright("key", 32)
    chain = F.lit(False)
    for i in range(SEGMENTS):
        chain = chain | ((start == i) & chain_holds(i))
    # By Spark's estimate a side is no larger than before its keys were listed, so it would broadcast 70 rows a print.
    candidates = kept.join(asked.hint("merge"), "key").filter(F.col("x") < F.col("y")).filter(chain)
    within = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= DISTANCE
    return candidates.filter(within).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def groups(fingerprinted: DataFrame, doc_id: str = "doc_id", fp: str = "fp") -> DataFrame:
    """(fp, root, component_id) of each distinct fingerprint; ``root`` names the group by a fingerprint."""
    prints = stored(fingerprinted.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("least")), "fingerprints")
    joined = prints.join(connected(links(prints.select("fp"))).withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.join(named, "root").select("fp", "root", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint in hex, component_id."""
    found = stored(with_fingerprints(docs.select("doc_id", "text"), drop=("text",)), "fp-of-docs")
    return found.join(groups(found), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group of near-duplicates, one per group.

    Ids that are null come last. Texts are read for their fingerprints and again for the rows
    that stay; in between there are names of rows only. Rows that repeat are kept once.
    """
    row = free_name(docs, "row")
    marked = docs.withColumn(row, row_hash(doc_id, text))
    names = marked.select(F.col(row).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    narrow = stored(with_fingerprints(names, "_text", drop=("_text",)), "fp-names")
    rooted = narrow.join(groups(narrow, "_id").select("fp", "root"), "fp")
    return firsts_of_groups(marked, rooted, row, doc_id).select(*[F.col(f"`{c}`") for c in docs.columns])


def firsts_of_groups(marked: DataFrame, rooted: DataFrame, row: str, doc_id: str) -> DataFrame:
    """The rows of ``marked`` that come first in their group of ``rooted(_row, _id, root)``, one per group."""
    known = stored(
        rooted.groupBy("root", "_row", "_id").agg(F.count("*").alias("n")), "fp-roots"
    )
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    # A table of its own, so that the join by group can split a large group.
    first = stored(known.groupBy("root").agg(F.min(order).alias("first")), "fp-firsts")
    judged = known.join(first, "root").select(
        "_row", "_id", "n", ((F.col("first.row") == F.col("_row")) & F.col("first.id").eqNullSafe(F.col("_id"))).alias("stays")
    )
    gone = stored(judged.filter("not stays or n > 1").select("_row", "_id", "stays"), "fp-gone")
    # Duplicates grow with the documents: both sides are shuffled at every size.
    kept = without_rows(marked, gone.hint("merge"), row, doc_id)
    again = gone.filter("stays")
    if not again.isEmpty():
        repeats = marked.alias("l").join(again.alias("r"), same_row("l", "r", row, doc_id), "left_semi")
        kept = kept.unionByName(repeats.dropDuplicates([row, doc_id]))
    return kept
