import math

import numpy as np
import pytest

from lettersieve.llm import embedding_dedup
from lettersieve.llm.embedding_dedup import collisions, near_links, plan_for

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(vectors):
    """(links, component) of each vector by all pairs."""
    unit = np.stack([v / np.linalg.norm(v) for v in vectors.astype(np.float64)])
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    root = np.arange(len(vectors))
    for _ in range(len(vectors)):
        least = np.array([min(root[i], *root[np.flatnonzero(close[i])]) if close[i].any() else root[i] for i in range(len(root))])
        if (least == root).all():
            break
        root = least
    return close, root


def pairs_at(cosine, n, dim, rng):
    """n pairs of unit vectors with exactly this cosine."""
    a = rng.standard_normal((n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((n, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + math.sqrt(1 - cosine * cosine) * b


def test_collisions_count_windows():
    rng = np.random.default_rng(1)
    x, y = np.round(rng.standard_normal((40, 5)), 1), np.round(rng.standard_normal((60, 5)), 1)
    want = ((y[None] >= x[:, None] - 0.5) & (y[None] <= x[:, None] + 0.5)).sum(axis=2)
    assert (collisions(x, y, 0.5) == want).all()


@pytest.mark.parametrize("n", [100, 10_000, 10**8])
def test_plan_has_the_recall_it_says(n):
    """Drawn pairs of exactly the least cosine, under the plan for n vectors."""
    plan = plan_for(n)
    a, b = pairs_at(0.951, 1500, 64, np.random.default_rng(n))
    found = embedding_dedup._found_before(a, b, plan, plan.rounds)
    assert found.mean() > 0.95


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(7)
    a, b = pairs_at(0.96, 150, 64, rng)
    centre = rng.standard_normal(64)
    group = centre + 0.02 * rng.standard_normal((700, 64))  # more rows than a block holds
    rest = rng.standard_normal((400, 64))
    vectors = np.concatenate([a, b, group, rest, rest[:20]]).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:1], vectors[:1]])
    ids = rng.permutation(len(vectors)) * 3
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, vectors, strict=True)]
    found = {r["vec_id"]: r for r in near_links(spark.createDataFrame(rows, SCHEMA)).collect()}
    order = np.argsort(ids)
    close, root = plain(vectors[order])
    links = close.sum(axis=1)
    got = np.array([found[i]["n_links"] for i in ids[order]])
    assert (got <= links).all() and got.sum() >= 0.95 * links.sum()
    names = np.array([found[i]["component_id"] for i in ids[order]])
    same = (names == ids[order][root]).mean()
    assert same > 0.95
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 0.0], 0), (5, [float("nan"), 1.0, 0.0], 0),
        (6, [float("inf"), 1.0, 0.0], 0), (10, v, 0), (11, v, None), (11, v, 1), (12, [2.0, 4.0, 6.0], 1),
        (13, [1.0, 2.0], 1), (14, [-1.0, -2.0, -3.0], 1), (None, v, 0), (None, None, None),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS copies", "3 AS vector")
    found = sorted(((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"]) for r in near_links(vectors).collect()), key=str)
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 13, 14)]
    want += [(10, 4, 10, True), (11, 4, 10, False), (11, 4, 10, False), (12, 4, 10, False), (-1, 4, 10, False), (-1, 0, None, True)]
    assert found == sorted(want, key=str)
    assert near_links(vectors.limit(0)).collect() == []


def test_magnitudes_do_not_matter(spark):
    v = [0.3, -0.4, 0.5, 0.1]
    rows = [(i, [x * scale for x in v]) for i, scale in enumerate((1.0, 2.0, 1e-200, 1e200, 1e-300, 1e300))]
    rows += [(10, [1e-310, 0.0, 0.0, 0.0]), (11, [5.0, 0.0, 0.0, 0.0]), (12, [0.0, 0.0, 1e308, 1e308])]
    found = {r["vec_id"]: r for r in embedding_dedup.near_links(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert [found[i]["n_links"] for i in range(6)] == [5] * 6 and {found[i]["component_id"] for i in range(6)} == {0}
    assert found[10]["n_links"] == found[11]["n_links"] == 1 and found[11]["component_id"] == 10
    assert found[12]["n_links"] == 0
