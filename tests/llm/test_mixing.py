import math
import re

import pytest

from lettersieve.llm import mixing
from lettersieve.llm.common import n_words

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected_targets(sizes, weights, cap=3.0):
    target, free, rest = {}, set(sizes), float(sum(sizes.values()))
    while free:
        unit = rest / sum(weights[s] for s in free)
        over = [s for s in free if weights[s] * unit > cap * sizes[s]]
        if not over:
            return target | {s: weights[s] * unit for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            rest -= target[s]
            free.discard(s)
    return target


def test_words(odd_docs):
    rows = odd_docs.select("text", n_words(odd_docs["text"]).alias("n")).collect()
    assert all(r["n"] == len(WORD.findall(r["text"] or "")) for r in rows)


def test_mix_meets_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.digest(docs).collect()
    by_id = {r["doc_id"]: r for r in docs.collect()}
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        source = by_id[r["doc_id"]]["source"]
        assert r["size"] == len(WORD.findall(by_id[r["doc_id"]]["text"] or ""))
        assert r["taken"] <= 3 * r["size"]
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
        longest[source] = max(longest.get(source, 0), r["size"])
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes))}
    target = expected_targets(sizes, weights)
    for r in rows:
        source = by_id[r["doc_id"]]["source"]
        assert r["source_size"] == sizes[source] and math.isclose(r["target"], target[source], rel_tol=1e-12)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= longest[source]
    again = mixing.digest(docs.repartition(5)).collect()
    assert sorted(again) == sorted(rows)


def test_rates_are_tilted_and_balanced(spark):
    sizes = {"a": [1, 2, 3, 10, 40], "b": [5, 5, 5], "c": [100, 1]}
    rows = spark.createDataFrame(
        [(i, s, n) for s, ns in sizes.items() for i, n in enumerate(ns)], "doc_id bigint, source string, size bigint"
    )
    goals = spark.createDataFrame([("a", 1.0), ("b", 9.0), ("c", 5.0)], "source string, weight double")
    found = mixing.mix(rows, goals).collect()
    target = expected_targets({s: sum(n) for s, n in sizes.items()}, {"a": 1.0, "b": 9.0, "c": 5.0})
    for source in sizes:
        own = [r for r in found if r["source"] == source]
        assert math.isclose(sum(r["rate"] * r["size"] for r in own), target[source], rel_tol=1e-6)
        # The logarithm of every rate below the cap is the same multiple of the size.
        tilts = [math.log(r["rate"]) / r["size"] for r in own if r["rate"] < 3]
        assert all(math.isclose(t, tilts[0], rel_tol=1e-6, abs_tol=1e-9) for t in tilts)


def test_hot_sizes_are_split_alike(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(i, "hot", 10) for i in range(500)] + [(i, "b", i % 5) for i in range(100)],
        "doc_id bigint, source string, size bigint",
    )
    sums = {}
    for limit in (7, 1000):
        monkeypatch.setattr(mixing, "CELL_ROWS", limit)
        found = mixing.mix(rows).collect()
        sums[limit] = {s: sum(r["copies"] * r["size"] for r in found if r["source"] == s) for s in ("hot", "b")}
    assert sums[7] == pytest.approx(sums[1000], abs=10)


def test_odd_rows(odd_docs, no_docs):
    rows = mixing.digest(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.digest(no_docs).collect() == []


def test_repeated_takes_what_the_mix_says(spark, odd_docs, clashing_docs, no_docs, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    copies = {r["doc_id"]: r["copies"] for r in mixing.digest(docs).collect()}
    taken = mixing.repeated(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in taken} == {i: n for i, n in copies.items() if n}
    found = mixing.repeated(clashing_docs)
    assert found.columns == clashing_docs.columns
    words = sum(len(WORD.findall(r["text"] or "")) for r in found.collect())
    assert words == sum(r["taken"] for r in mixing.digest(odd_docs).collect())
    assert mixing.repeated(no_docs).collect() == []
