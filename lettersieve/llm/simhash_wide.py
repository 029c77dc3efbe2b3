"""Near-duplicates at a shingle similarity: SimHash with directed probes into a pigeonring.

``simhash`` finds every pair within 4 of 64 bits. Texts that share 80 % of their shingles differ in
about 15 % of all bits, which no equal segment of useful width survives, so this form of the
operator works as follows.

* A fingerprint is a ring of ``Plan.segments`` segments of ``Plan.bits`` bits over the set of a text's
  ``SHINGLE``-word shingles. It is stored under each segment.
* Near-duplicates differ in bits whose sums lie close to zero. Each text therefore asks, per
  segment, for the ``PROBES`` most probable variants of its own bits, the unchanged one first.
* A meeting starts a chain: the differences of the probe and of the segments that follow may not
  exceed their proportional share of the budget (``SHARE`` of the bits) after any of ``LINKS`` links.
* What is left gets the full Hamming check over the ring, and then the exact Jaccard similarity of the
  shingle sets, which are built for the texts in question only. No pair below ``SIMILARITY`` links.

The number of segments follows from the probability that a pair of exactly ``SIMILARITY`` meets in one, so that
at least ``RECALL`` of such pairs meet; closer pairs meet more often. Segments get wider with the logarithm
of the number of texts, which keeps chance meetings per text constant.

Equal shingle sets are one node, so copies are one row whatever their number. Under a key that more than ``HOT``
nodes share (a group of near copies), all meet one pivot only (the node that shares most keys). Each node is compared with
its best pivot first, and with the others unless both it and they were near something by then. What was near something has
its set built, and all of these that lie in different groups meet by their rare shingles, whatever their keys: similar sets
share a shingle near the start of both, if shingles are ordered by how few sets hold them. Texts without a set (chance
meetings) meet all under their key as they are, up to ``WORK`` pairs for each of them; beyond, they get their sets too.

Defined results: null and blank texts are one node, equal to each other and to nothing else. Texts of
fewer words than a shingle are one shingle. Null ids come last in their group. Repeated rows are copies. Very
long texts are hashed in blocks; their sets are arrays of one row. Shingles are told by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lettersieve.llm.common import free_name, row_hash, same_row, ships_its_code
from lettersieve.llm.components import connected
from lettersieve.llm.simhash import SEED, firsts_of_groups
from lettersieve.sources.shared import stored

ships_its_code(__name__)

SIMILARITY = 0.8
SHINGLE = 5
RECALL = 0.93
PROBES = 8
SHARE = 0.21
LINKS = 3
HOT = 1
WORK = 64
BLOCK = 1 << 12
TEXTS = 256
# Widths of segments; two of them and a count of flips share one number.
LEAST_BITS, MOST_BITS = 24, 28

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Sets of flips, by position among the bits in order of their cost, of which the cheapest PROBES are always some.
_FLIPS = [(), (0,), (1,), (2,), (3,), (4,), (5,), (6,), (0, 1), (0, 2), (0, 3), (1, 2), (0, 1, 2)]
_FLIP_BITS = 7
# A segment's probes are one number: the places of the cheapest bits, then which sets of flips are used.
_PLACE = 5


@dataclass(frozen=True)
class Plan:
    bits: int
    segments: int

    @property
    def words(self) -> int:
        return -(-self.bits * self.segments // 64)

    def budget(self, links: int) -> int:
        return math.floor(links * self.bits * SHARE)


def plan_for(n: int, recall: float = RECALL) -> Plan:
    """A plan for ``n`` texts.

    A pair of similarity 0.8 meets in a segment of 24 bits with probability 0.126 (simulated with normal
    sums of correlation 0.889, either side asking), and each further bit takes an eighth of that.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(n, 1)))))
    meets = 0.126 * 0.875 ** (bits - 24)
    return Plan(bits, math.ceil(math.log(1 - recall) / math.log(1 - meets)))


def shingle_set(text: bytes | None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), last.tolist(), strict=False)
    return np.unique(np.fromiter((digest(joined[i:j], SEED) for i, j in spans), np.uint64, len(last)))


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th independent 64 bits of each hash (SplitMix64)."""
    z = hashes + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def bit_sums(hashes: np.ndarray, plan: Plan) -> np.ndarray:
    """Per bit of the ring, in standard deviations: shingles that set it less those that do not."""
    counts = np.zeros(plan.words * 64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK]
        wide = np.stack([_mixed(part, k) for k in range(plan.words)], axis=1)
        counts += np.unpackbits(wide.astype(">u8").view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    n = max(1, len(hashes))
    return (2 * counts[: plan.segments * plan.bits] - len(hashes)) / math.sqrt(n)


def ring_and_probes(sums: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """(segments, probes) of texts with the given sums, (texts, segments) both; ``_probe_of`` reads the probes."""
    sums = sums.reshape(-1, plan.segments, plan.bits)
    weight = np.int64(1) << np.arange(plan.bits, dtype=np.int64)
    own = (sums > 0) @ weight
    # Log-odds that a bit stays, for a near-duplicate at the least similarity (logistic form of the normal law).
    rho = 2 * SIMILARITY / (1 + SIMILARITY)
    a = np.abs(sums) * rho / math.sqrt(1 - rho * rho)
    cost = 1.5976 * a + 0.07056 * a**3
    order = np.argsort(cost, axis=2, kind="stable")[:, :, :_FLIP_BITS]
    cheap = np.take_along_axis(cost, order, axis=2)
    member = np.array([[i in flips for flips in _FLIPS] for i in range(_FLIP_BITS)])
    # The empty set costs nothing and comes first in any order that keeps ties.
    best = np.argsort(cheap @ member, axis=2, kind="stable")[:, :, :PROBES]
    places = (order << (_PLACE * np.arange(_FLIP_BITS))).sum(axis=2)
    return own, places + (np.int64(1) << (_PLACE * _FLIP_BITS + best)).sum(axis=2)


def _probe_of(i: int, own: Column, probes: Column) -> Column:
    """The variant of ``own`` by the i-th set of flips; null if the segment does not ask for it."""

    def bit(j: int) -> Column:
        place = F.shiftright(probes, _PLACE * j).bitwiseAND(F.lit((1 << _PLACE) - 1).cast("bigint")).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    asked = F.shiftright(probes, _PLACE * _FLIP_BITS + i).bitwiseAND(F.lit(1).cast("bigint")) == 1
    value = own
    for j in _FLIPS[i]:
        value = value.bitwiseXOR(bit(j))
    return F.when(asked, value)


def printed(names: DataFrame, plan: Plan) -> DataFrame:
    """(_row, _id, name, segments, probes) of ``names(_row, _id, _text)``; ``name`` tells shingle sets apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                called, sums = [], np.zeros((batch.num_rows, plan.segments * plan.bits))
                for i, text in enumerate(batch.column(2).cast(pa.binary())):
                    hashes = shingle_set(text.as_py())
                    called.append(xxhash.xxh3_128_hexdigest(hashes.astype("<u8").tobytes()))
                    sums[i] = bit_sums(hashes, plan)
                own, probes = ring_and_probes(sums, plan)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(called),
                        pa.array(list(own.astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(list(probes), pa.list_(pa.int64())),
                    ],
                    names=["_row", "_id", "name", "segments", "probes"],
                )

    kind = names.schema["_id"].dataType.simpleString()
    return names.mapInArrow(run, f"_row bigint, _id {kind}, name string, segments array<int>, probes array<bigint>")


def _met(nodes: DataFrame, probing: bool, plan: Plan, name: str) -> DataFrame:
    """(key, node as ``name``, and as ``{name}_next``: flips in the key, the two segments that follow)."""

    def at(i: int) -> Column:
        return F.get("segments", F.pmod(F.col("s") + i, F.lit(plan.segments))).cast("bigint")

    each = nodes.select(F.col("node").alias(name), "segments", F.posexplode("probes").alias("s", "probes"))
    values = [_probe_of(i, at(0), F.col("probes")) for i in range(len(_FLIPS))] if probing else [at(0)]
    each = each.select(name, "segments", "s", F.explode(F.array(*values)).alias("v")).filter("v is not null")
    flips = F.bit_count(at(0).bitwiseXOR(F.col("v"))).cast("bigint")
    chain = F.shiftleft(flips, 2 * MOST_BITS).bitwiseOR(F.shiftleft(at(1), MOST_BITS)).bitwiseOR(at(2))
    return each.select(
        F.shiftleft(F.col("s").cast("bigint"), 32).bitwiseOR(F.col("v")).alias("key"),
        name,
        chain.alias(f"{name}_next"),
    )


def _chain_holds(plan: Plan) -> Column:
    differing = F.col("x_next").bitwiseXOR(F.col("y_next"))
    segment = F.lit((1 << MOST_BITS) - 1).cast("bigint")
    first = F.shiftrightunsigned(differing, 2 * MOST_BITS)
    second = first + F.bit_count(F.shiftrightunsigned(differing, MOST_BITS).bitwiseAND(segment))
    third = second + F.bit_count(differing.bitwiseAND(segment))
    return (first <= plan.budget(1)) & (second <= plan.budget(2)) & (third <= plan.budget(LINKS))


def _pair() -> list[Column]:
    return [F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")]


def _other(name: str) -> Column:
    """The node of the pair (a, b) that is not ``name``."""
    return F.when(F.col("a") == F.col(name), F.col("b")).otherwise(F.col("a"))


def _sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, hashes): the shingle sets of ``wanted(node)``."""
    # A table of its own: Spark knows its size, and texts are not shuffled for a few names.
    named = stored(
        wanted.join(nodes.select("node", "first"), "node").select(
            "node", F.col("first._row").alias("_row"), F.col("first._id").alias("_id")
        ),
        "wide-wanted",
    )
    found = texts.alias("l").join(named.alias("r"), same_row("l", "r", "_row", "_id")).select("r.node", "l._text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                hashes = shingle_set(text.as_py()).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node.as_py()], pa.int64()), pa.array([hashes], pa.list_(pa.int64()))], names=["node", "hashes"]
                )

    # Rows that repeat have equal sets.
    return stored(found.mapInArrow(build, "node bigint, hashes array<bigint>").dropDuplicates(["node"]), "wide-sets")


def _sharing_rare(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): all pairs of ``members(node, root, free)`` that may be similar, of different roots and at least one free.

    Sets are ordered by how few of them hold a shingle. The first shingle that two similar sets share lies near the
    start of both: at most a ninth of the smaller one and a fifth of the larger one come before it (prefix filter), and
    what follows it in both has to suffice (positional filter). No pair of ``SIMILARITY`` is lost.
    """
    each = sets.join(members, "node", "left_semi").select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    # What one set alone holds comes first in its order, and is only counted.
    common = each.withColumn("held", F.count("*").over(W.partitionBy("hash"))).filter("held > 1")
    ordered = stored(
        common.groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("held", "hash"))).alias("entries"))
        .withColumn("alone", F.col("n") - F.size("entries"))
        .join(members, "node"),
        "wide-rare",
    )

    def starts(share: float, name: str) -> DataFrame:
        long = F.col("n") - F.ceil(F.col("n") * share - 1e-6) + 1
        return (
            ordered.select("*", F.posexplode("entries").alias("at", "entry"))
            .withColumn("at", F.col("at") + F.col("alone"))
            .filter(F.col("at") < long)
            .select("entry.hash", *[F.col(c).alias(f"{name}_{c}") for c in ("n", "root", "free", "at")], F.col("node").alias(name))
        )

    needed = SIMILARITY / (1 + SIMILARITY) * (F.col("x_n") + F.col("y_n")) - 1e-6
    after = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))
    return (
        starts(2 * SIMILARITY / (1 + SIMILARITY), "x")
        .join(starts(SIMILARITY, "y"), "hash")
        .filter((F.col("x_n") <= F.col("y_n")) & (F.col("x_root") != F.col("y_root")))
        .filter((F.col("x_free") | F.col("y_free")) & (after >= needed))
        .select(*_pair())
        .distinct()
    )


def _near(pairs: DataFrame, nodes: DataFrame, plan: Plan) -> DataFrame:
    """The ``pairs(a, b)`` within the Hamming budget."""
    ring = nodes.select("node", "segments")
    apart = F.aggregate(
        F.zip_with("l", "r", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    return stored(
        pairs.distinct()
        .join(ring.select(F.col("node").alias("a"), F.col("segments").alias("l")), "a")
        .join(ring.select(F.col("node").alias("b"), F.col("segments").alias("r")), "b")
        .filter(apart <= plan.budget(plan.segments))
        .select("a", "b"),
        "wide-near",
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def confirmed(near: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs of ``near(a, b)`` whose shingle sets are similar enough; ``sets(node, hashes)`` holds those of all."""
    common = F.size(F.array_intersect("l", "r"))
    return (
        near.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("l")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("r")), "b")
        .filter(common >= SIMILARITY * (F.size("l") + F.size("r") - common))
        .select("a", "b")
    )


def _ahead(met: DataFrame) -> DataFrame:
    """(a, b) of ``met`` to compare first: what is under no hot key, and each node with its best pivot."""
    under = met.filter("key is not null")
    best = under.groupBy("y").agg(F.max(F.struct("shared", (-_other("y")).alias("less"))).alias("best"))
    return (
        met.filter("key is null")
        .select("a", "b")
        .union(best.select(F.col("y"), (-F.col("best.less")).alias("x")).select(*_pair()))
        .distinct()
    )


def links(nodes: DataFrame, texts: DataFrame, plan: Plan, hot_above: int = HOT) -> DataFrame:
    """(a, b): similar ``nodes(node, first, segments, probes)``; in hot keys enough of them to connect what is.

    ``texts(_row, _id, _text)`` holds the row ``first`` of each node.
    """
    kept, asked = _met(nodes, False, plan, "x"), _met(nodes, True, plan, "y")
    crowded = kept.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_above)
    held = stored(kept.select("key", "x").join(crowded, "key"), "wide-held")
    # The pivot is the node that shares most: near copies have most in common with the text they come from.
    shares = held.groupBy("x").agg(F.sum("n").alias("shared"))
    hot = stored(
        held.join(shares, "x")
        .groupBy("key")
        .agg(F.max(F.struct("shared", (-F.col("x")).alias("less"))).alias("best"))
        .select("key", (-F.col("best.less")).alias("pivot"), "best.shared"),
        "wide-hot",
    )
    # Everyone under a hot key meets its pivot alone, whatever the chain says.
    is_hot = F.col("pivot").isNotNull()
    stands = kept.join(hot, "key", "left").filter(F.col("pivot").isNull() | (F.col("pivot") == F.col("x")))
    met = stored(
        stands.join(asked, "key")
        .filter((F.col("x") != F.col("y")) & (is_hot | _chain_holds(plan)))
        .select(*_pair(), F.when(is_hot, F.col("key")).alias("key"), "y", "shared"),
        "wide-met",
    )
    ahead = stored(_ahead(met), "wide-ahead")
    near = _near(ahead, nodes, plan)
    some_hot = not hot.isEmpty()
    if some_hot:
        # Nodes that are near others get their sets; two of them need not be compared here, they meet by rare shingles.
        far = [met.join(_ends(near).withColumnRenamed("node", c), c, "left_anti").select("a", "b") for c in ("a", "b")]
        near = near.union(_near(far[0].union(far[1]).distinct().join(ahead, ["a", "b"], "left_anti"), nodes, plan))
    sets = _sets(_ends(near), nodes, texts)
    first = stored(confirmed(near, sets), "wide-first")
    if not some_hot:
        return first
    # Who is in one group with the pivot, by whatever links, meets the others only; those of one group meet no more.
    roots = sets.select("node").join(connected(first), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    under = stored(_under_hot(met, held, stored(roots, "wide-roots")), "wide-under")
    by_key = under.groupBy("key").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.expr(c)).alias(name) for c, name in (("not built", "u"), ("kept", "k"), ("kept and not built", "ku"))],
    )
    # Chance meetings have no sets yet; only a costly key needs them.
    meeting = by_key.filter("k * u > 0").withColumn("costly", F.expr(f"ku * n + (k - ku) * u > {WORK} * u"))
    left = under.join(meeting.select("key", "costly"), "key")
    crowd = stored(left.filter("costly and not built").select("node").distinct(), "wide-crowd")
    if not crowd.isEmpty():
        sets = sets.union(_sets(crowd, nodes, texts))
    pivots = under.select(F.col("pivot").alias("node"), F.col("pivot_root").alias("root"), F.lit(False).alias("free"))
    members = stored(
        under.select("node", "root", "free")
        .union(pivots)
        .groupBy("node", "root")
        .agg(F.max("free").alias("free"))
        .join(sets.select("node"), "node", "left_semi"),
        "wide-members",
    )
    # What met and has no sets was found too far apart.
    again = stored(
        _of_one_key(left.filter("not costly"))
        .join(met, ["a", "b"], "left_anti")
        .union(_sharing_rare(members, sets).join(near, ["a", "b"], "left_anti"))
        .distinct(),
        "wide-again",
    )
    if again.isEmpty():
        return first
    found = _near(again, nodes, plan)
    lacking = stored(_ends(found).join(sets.select("node"), "node", "left_anti"), "wide-lacking")
    if not lacking.isEmpty():
        sets = sets.union(_sets(lacking, nodes, texts))
    return stored(confirmed(found, sets).union(first), "wide-links")


def _under_hot(met: DataFrame, held: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, node, root, pivot, pivot_root, free, kept, built): who met the pivot of a hot key, whether outside its group,
    whether stored there, whether with a set; ``roots(node, root)`` has all that have one."""
    under = met.filter("key is not null").select("key", "y", _other("y").alias("pivot"))
    for name in ("y", "pivot"):
        under = under.join(roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root")), name, "left")
    stands = held.select("key", F.col("x").alias("y"), F.lit(True).alias("stands"))
    root, pivot_root = F.coalesce("y_root", "y"), F.coalesce("pivot_root", "pivot")
    return under.join(stands, ["key", "y"], "left").select(
        "key",
        F.col("y").alias("node"),
        root.alias("root"),
        "pivot",
        pivot_root.alias("pivot_root"),
        (root != pivot_root).alias("free"),
        F.col("stands").isNotNull().alias("kept"),
        F.col("y_root").isNotNull().alias("built"),
    )


def _of_one_key(under: DataFrame) -> DataFrame:
    """(a, b): what is stored under a key and what asks for it, at least one of them without a set."""
    x = under.filter("kept").select("key", F.col("node").alias("x"), F.col("built").alias("x_built"))
    y = under.select("key", F.col("node").alias("y"), F.col("built").alias("y_built"))
    met = [x.filter("not x_built").join(y, "key"), x.filter("x_built").join(y.filter("not y_built"), "key")]
    return met[0].union(met[1]).filter("x != y").select(*_pair()).distinct()


def rooted(names: DataFrame, hot_above: int = HOT) -> DataFrame:
    """(_row, _id, root) of ``names(_row, _id, _text)``: ``root`` is the same for all rows of a group."""
    plan = plan_for(names.count())
    narrow = stored(printed(names, plan), "wide-prints")
    nodes = stored(
        narrow.groupBy("name")
        .agg(
            F.min(F.struct("_row", "_id")).alias("first"),
            F.any_value("segments").alias("segments"),
            F.any_value("probes").alias("probes"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "wide-nodes",
    )
    roots = connected(links(nodes, names, plan, hot_above))
    named = nodes.select("name", "node").join(roots, "node", "left").select("name", F.coalesce("root", "node").alias("root"))
    return narrow.select("_row", "_id", "name").join(named, "name").select("_row", "_id", "root")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot_above: int = HOT) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group of near-duplicates, one per group."""
    row = free_name(docs, "row")
    marked = docs.withColumn(row, row_hash(doc_id, text))
    names = marked.select(F.col(row).alias("_row"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    return firsts_of_groups(marked, rooted(names, hot_above), row, doc_id).select(*[F.col(f"`{c}`") for c in docs.columns])
