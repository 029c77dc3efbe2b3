"""Near-duplicate vectors by counted collisions on one-dimensional projections.

A vector has ``COUNTED`` projections on fixed random directions. In each projection the vectors
are sorted, and those within ``WINDOW`` of a query's value collide with it; pairs that collide
in at least as many projections as the calibrated count are verified by their cosine in double
precision. A collision on one projection alone is far too common to be shuffled (about a
quarter of all pairs of unrelated vectors), so a few further projections come first: rows are
sorted into cells of ``CELL`` on ``leads`` projections together, and windows are counted inside
cells. This is repeated in ``rounds`` with other projections. The number of leads grows with
the logarithm of the number of vectors, which keeps cells small, and the rounds follow from
the probability that a pair of exactly the least cosine meets in a round and passes the count,
so that at least ``RECALL`` of such pairs are found. Closer pairs are found more often.

Equal vectors are one row here, with their number. A cell with many rows (a large group of near
copies) is dealt out as pairs of blocks of ``BLOCK`` rows; blocks report counts of links and the
edges of a spanning forest, never all pairs. A pair is counted in the first round that finds it.

Defined results: null, empty or zero vectors and those with a null, infinite or NaN component
link with nothing and are kept, each as its own component. Magnitudes do not matter, however large or small. Vectors of different lengths never
link. A null id takes part in links; a group's name is its smallest id. Repeated rows are
copies of each other. Nothing is dropped: recall below one comes from the projections only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettersieve.llm.common import ships_its_code
from lettersieve.llm.components import connected
from lettersieve.sources.shared import stored

ships_its_code(__name__)

COSINE = 0.95
RECALL = 0.97
COUNTED = 16
WINDOW_SIGMAS = 1.5
CELL_SIGMAS = 4.0
FOUND = 256
BLOCK = 512
PASS = 0.99
SEED = 20


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


@dataclass(frozen=True)
class Plan:
    """Widths, counts and rounds for a least cosine and a number of vectors."""

    cosine: float
    leads: int
    rounds: int
    window: float
    cell: float
    least: int

    def directions(self, dim: int, round_: int) -> np.ndarray:
        rng = np.random.default_rng([SEED, dim, round_])
        return rng.standard_normal((dim, self.leads + COUNTED))

    def shifts(self, round_: int) -> np.ndarray:
        return np.random.default_rng([SEED, 1, round_]).uniform(0, self.cell, self.leads)


def plan_for(n: int, cosine: float = COSINE, recall: float = RECALL) -> Plan:
    """Calibrates a plan: ``n`` distinct vectors, pairs of exactly ``cosine`` found with ``recall``."""
    distance = math.sqrt(2 - 2 * cosine)
    cell, window = CELL_SIGMAS * distance, WINDOW_SIGMAS * distance

    def together(d: float) -> float:
        # Same cell of width c under a random shift: mean of max(0, 1 - |d z| / c).
        z = np.linspace(-8, 8, 4001)
        density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        return float(np.sum(np.maximum(0, 1 - np.abs(d * z) / cell) * density) * (z[1] - z[0]))

    near, far = together(distance), together(math.sqrt(2.0))
    leads = max(1, math.ceil(math.log(max(n, 2) / FOUND) / math.log(1 / far))) if n > FOUND else 1
    hit = 2 * _normal(WINDOW_SIGMAS) - 1
    tail, least = 0.0, COUNTED
    for k in range(COUNTED, -1, -1):
        tail += math.comb(COUNTED, k) * hit**k * (1 - hit) ** (COUNTED - k)
        least = k
        if tail >= PASS:
            break
    one = near**leads * tail
    rounds = max(1, math.ceil(math.log(1 - recall) / math.log(1 - one))) if one < 1 else 1
    return Plan(cosine, leads, rounds, window, cell, least)


def collisions(left: np.ndarray, right: np.ndarray, window: float) -> np.ndarray:
    """Collisions of each query (row of ``left``) with each row of ``right`` over their projections.

    In each projection ``right`` is sorted; a query's window is a run of ranks.
    """
    n, m = len(left), len(right)
    total = np.zeros(n * m, dtype=np.int32)
    for k in range(left.shape[1]):
        order = np.argsort(right[:, k], kind="stable")
        values = right[order, k]
        low = np.searchsorted(values, left[:, k] - window, "left")
        size = np.searchsorted(values, left[:, k] + window, "right") - low
        start = np.cumsum(size) - size
        ranks = np.arange(size.sum()) - np.repeat(start - low, size)
        # A pair occurs once per projection, so a plain indexed addition is enough.
        total[np.repeat(np.arange(n) * m, size) + order[ranks]] += 1
    return total.reshape(n, m)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1. The largest component is scaled first, so that no square over- or underflows."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    # Two steps: the inverse of a subnormal number is infinite.
    scaled = np.ldexp(vectors, -np.frexp(largest)[1])
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _cells(projected: np.ndarray, plan: Plan, round_: int) -> np.ndarray:
    return np.floor((projected[:, : plan.leads] + plan.shifts(round_)) / plan.cell).astype(np.int64)


def _found_before(x: np.ndarray, y: np.ndarray, plan: Plan, round_: int) -> np.ndarray:
    """Whether an earlier round has found the pairs of rows (x[i], y[i])."""
    found = np.zeros(len(x), dtype=bool)
    for r in range(round_):
        rest = np.flatnonzero(~found)
        if not len(rest):
            break
        directions = plan.directions(x.shape[1], r)
        a, b = x[rest] @ directions, y[rest] @ directions
        same = (_cells(a, plan, r) == _cells(b, plan, r)).all(axis=1)
        near = (np.abs(a[:, plan.leads :] - b[:, plan.leads :]) <= plan.window).sum(axis=1) >= plan.least
        found[rest] = same & near
    return found


def block_links(
    x: np.ndarray, y: np.ndarray, plan: Plan, round_: int, same: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of unit vectors that this round finds first and the cosine confirms.

    ``same``: y is x, and only i < j counts.
    """
    directions = plan.directions(x.shape[1], round_)[:, plan.leads :]
    passed = collisions(x @ directions, y @ directions, plan.window) >= plan.least
    if same:
        passed = np.triu(passed, 1)
    i, j = np.nonzero(passed)
    if not len(i):
        return i, j
    keep = []
    for at in range(0, len(i), 1 << 14):
        a, b = x[i[at : at + (1 << 14)]], y[j[at : at + (1 << 14)]]
        close = np.flatnonzero(np.einsum("ij,ij->i", a, b) >= plan.cosine)
        keep.append(at + close[~_found_before(a[close], b[close], plan, round_)])
    kept = np.concatenate(keep)
    return i[kept], j[kept]


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the given edges connect, fewer than n."""
    parent = list(range(n))

    def root(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    edges = []
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        p, q = root(a), root(b)
        if p != q:
            parent[p] = q
            edges.append((a, b))
    return edges


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """The vectors of a list column without nulls, as views of one array."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def valid(vector: str = "embedding"):
    """Whether a vector has a direction: finite components, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _in_cells(classes: DataFrame, plan: Plan) -> DataFrame:
    """(node, copies, vector, round, cell): each vector once per round, under its cell's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vector"))
            sizes = np.array([len(v) for v in vectors])
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                unit = _unit(np.stack([vectors[r] for r in rows]))
                part = batch.take(pa.array(rows))
                for r in range(plan.rounds):
                    cells = _cells(unit @ plan.directions(int(dim), r)[:, : plan.leads], plan, r)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns,
                            pa.array(np.full(len(rows), r, dtype=np.int32)),
                            pa.array([f"{dim}:" + ",".join(map(str, c)) for c in cells.tolist()]),
                        ],
                        names=["node", "copies", "vector", "round", "cell"],
                    )

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(run, f"node bigint, copies bigint, vector {kind}, round int, cell string")


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows dealt to (round, cell, pair of blocks), left and right; cells with one row go.

    A cell of n rows has n / BLOCK blocks, so a row is in as many pairs as its cell has blocks.
    """
    size = rows.groupBy("round", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = (
        rows.join(size, ["round", "cell"])
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pair = dealt.withColumn("with", other).withColumns(
        {
            "first": F.least("own", "with"),
            "second": F.greatest("own", "with"),
            "left": F.col("own") <= F.col("with"),
        }
    )
    return pair.select(
        F.xxhash64("round", "cell", "first", "second").alias("task"),
        "round", "cell", "first", "second", "left", "node", "copies", "vector",
    )


def _counted(blocks: DataFrame, plan: Plan) -> DataFrame:
    """(node, links, other): links counted by a block pair for a node, or an edge of its forest."""

    def count(rows: list[tuple]) -> Iterator[tuple[int, int, int | None]]:
        round_, same = rows[0][0], rows[0][2] == rows[0][3]
        sides = [[r for r in rows if r[4] == side] for side in (True, False)]
        left = rows if same else sides[0]
        right = rows if same else sides[1]
        if not left or not right or (same and len(left) < 2):
            return
        x = _unit(np.stack([r[7] for r in left]))
        y = x if same else _unit(np.stack([r[7] for r in right]))
        i, j = block_links(x, y, plan, round_, same)
        if not len(i):
            return
        nodes = [r[5] for r in left] + ([] if same else [r[5] for r in right])
        copies = np.array([r[6] for r in left] + ([] if same else [r[6] for r in right]), dtype=np.int64)
        j = j if same else j + len(left)
        links = np.zeros(len(nodes), dtype=np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        for k in np.flatnonzero(links).tolist():
            yield nodes[k], int(links[k]), None
        for a, b in _forest(i, j, len(nodes)):
            yield nodes[a], 0, nodes[b]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int, int | None]] = []
        for batch in batches:
            plain = [batch.column(c).to_pylist() for c in ("round", "cell", "first", "second", "left", "node", "copies")]
            for row in zip(*plain, _vectors(batch.column("vector")), strict=True):
                if held and row[:4] != held[0][:4]:
                    out.extend(count(held))
                    held = []
                held.append(row)
            if len(out) > 10_000:
                yield _links_batch(out)
                out = []
        if held:
            out.extend(count(held))
        yield _links_batch(out)

    spread = blocks.repartition(*_partitions(blocks), "task").sortWithinPartitions("task", "round", "cell", "first", "second")
    return spread.mapInArrow(run, "node bigint, links bigint, other bigint")


def _partitions(df: DataFrame) -> tuple[int]:
    return (int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),)


def _links_batch(rows: list[tuple[int, int, int | None]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], names=["node", "links", "other"]
    )


def near_links(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors``."""
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    # Equal vectors are told by 128 bits of their components; each class of them then gets a number.
    rows = stored(
        named.withColumn("ok", valid("vector")).withColumn(
            "name", F.when(F.col("ok"), F.md5(F.to_json(F.struct("vector"))))
        ),
        "vectors",
    )
    classes = stored(
        rows.filter("ok")
        .groupBy("name")
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.any_value("vector").alias("vector"))
        .select("name", F.monotonically_increasing_id().alias("node"), "copies", "vector", "least"),
        "vector-classes",
    )
    plan = plan_for(classes.count(), cosine, recall)
    counted = stored(_counted(_blocks(_in_cells(classes.select("node", "copies", "vector"), plan)), plan), "collisions")
    edges = counted.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    roots = connected(edges)
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        classes.select("name", "node", "copies", "least")
        .join(roots, "node", "left")
        .join(links, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    names = known.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = known.join(names, "root").select(
        "name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id"
    )
    component = F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.join(per_class, "name", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, ~F.col("ok")).alias("kept"),
    )


def digest(vectors: DataFrame) -> DataFrame:
    return near_links(vectors)
