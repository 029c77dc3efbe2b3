import random

import xxhash

from lettersieve.llm import components, simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{index: smallest index reachable} by all pairs."""
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(prints))]


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(prints)
    names = {}
    for (doc_id, _), root in zip(rows, roots, strict=True):
        if doc_id is not None:
            names[root] = min(names.get(root, doc_id), doc_id)
    want = [(d, format(p, "016x"), names.get(r)) for (d, _), p, r in zip(rows, prints, roots, strict=True)]
    found = [tuple(r) for r in simhash.digest(docs).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(found, key=key) == sorted(want, key=key)


def test_equals_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert simhash.digest(no_docs).collect() == []


def test_blocks_of_a_long_text(monkeypatch):
    text = " ".join(str(i * i) for i in range(1000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.fingerprint(text) == whole


def test_all_links_and_no_others(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for k in range(1, 7):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), k)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = {tuple(r) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 4}
    assert found == want and want


def test_listed_keys_are_never_broadcast(spark, tmp_path):
    """A stored table of prints looks small to Spark, also with 70 keys listed for each of its rows."""
    spark.range(1000).selectExpr("xxhash64(id) AS fp").write.parquet(str(tmp_path / "prints"))
    plan = simhash.links(spark.read.parquet(str(tmp_path / "prints")))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Broadcast" not in plan


def test_one_of_each(clashing_docs, no_docs):
    kept = simhash.one_of_each(clashing_docs)
    assert kept.columns == clashing_docs.columns
    rows = kept.collect()
    given = [(r["doc_id"], r["text"]) for r in clashing_docs.collect()]
    roots = plain_components([plain_fingerprint(t) for _, t in given])
    firsts = [
        min((d for (d, _), r in zip(given, roots, strict=True) if r == root and d is not None), default=None)
        for root in set(roots)
    ]
    key = lambda d: (d is None, d)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted(firsts, key=key)
    assert simhash.one_of_each(no_docs).collect() == []


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 240)] + [(7, 7), (3, 2), (2, 3), (-5, -6)]
    found = components.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = {i: 0 for i in range(101)} | {i: 200 for i in range(200, 240)} | {-5: -6, -6: -6}
    assert len(found) == len(want) and {r["node"]: r["root"] for r in found} == want
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
