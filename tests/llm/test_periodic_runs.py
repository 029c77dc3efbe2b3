import hashlib
import random
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from lettersieve.llm import periodic_runs as operator
from lettersieve.llm.suffix_tree import Extensions


def plain_runs(x, shortest=12):
    """All runs by their definition: stretches that agree with themselves q later."""
    found = set()
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            y = x[start : i + q]
            smallest = next(p for p in range(1, len(y) + 1) if y[p:] == y[: len(y) - p])
            if len(y) >= max(shortest, 2 * q) and smallest == q:
                found.add((start, len(y), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = regex.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    shown = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (
        doc_id,
        len(runs),
        *shown,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def check(docs):
    key = lambda r: tuple((x is None, x) for x in r)
    want = [plain_row(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, operator.digest(docs).collect()), key=key) == sorted(want, key=key)


def test_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(F.length("text") < 6000)
    check(docs)


def test_odd_texts(spark, odd_docs):
    check(odd_docs.filter("text is null or length(text) < 10000"))
    rows = [(i, t) for i in range(40) for t in ("a b " * 9, "x " * 12, "x " * 11, "a b c d e f " * 2 + "z", "a a b " * 5 + "a a")]
    check(spark.createDataFrame(rows, "doc_id bigint, text string"))


def test_long_text(spark, odd_docs):
    found = operator.digest(odd_docs.filter("doc_id = 3")).first()
    assert (found["start"], found["length"], found["period"]) == (0, 44_000, 11)


def test_empty_table(spark, no_docs):
    assert operator.digest(no_docs).collect() == []
    assert operator.find_runs(no_docs).collect() == []


def test_clashing_columns(spark, odd_docs):
    docs = odd_docs.withColumns({n: F.lit(f"own {n}") for n in ("runs", "collapsed", "start")})
    found = operator.find_runs(docs)
    assert found.columns == [*docs.columns, "_runs"]
    assert {r["runs"] for r in found.collect()} == {"own runs"}
    cut = operator.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert cut.filter("doc_id = 3").first()["text"] == "the quick fox sees a lazy dog near an old mill"
    assert cut.filter("doc_id = 8").first()["text"] == docs.filter("doc_id = 8").first()["text"]


@pytest.mark.parametrize("seed", range(4))
def test_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(400):
        n, k, shortest = rng.randrange(70), rng.choice([1, 2, 3, 5]), rng.choice([2, 3, 5, 12])
        x = [rng.randrange(1, k + 1) for _ in range(n)]
        if n > 4 and rng.random() < 0.4:
            a, p = rng.randrange(n), rng.randrange(1, n)
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        assert operator.runs_of(np.array(x, dtype=np.int64), shortest) == plain_runs(x, shortest)


def test_extensions_and_ranks():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randrange(1, 40)
        x = [rng.randrange(1, 4) for _ in range(n)]
        tree = Extensions(x)
        suffixes = [x[i:] for i in range(n + 1)]
        assert [int(tree.rank[i]) for i in range(n + 1)] == [sorted(suffixes).index(s) for s in suffixes]
        turned = [[-c for c in s] for s in suffixes]
        assert [int(tree.reverse_rank[i]) for i in range(n + 1)] == [sorted(turned).index(s) for s in turned]
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        i, j = (np.array(c) for c in zip(*pairs, strict=True))
        want = [next((k for k in range(n) if x[a + k : a + k + 1] != x[b + k : b + k + 1] or a + k >= n or b + k >= n), n) for a, b in pairs]
        assert tree.lce(i, j).tolist() == want
