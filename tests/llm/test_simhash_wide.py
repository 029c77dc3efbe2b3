import random

import pytest
from pyspark.sql import functions as F

from lettersieve.llm import simhash_wide

DOCS = "doc_id bigint, text string"


def plain_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similar(a, b):
    return a == b or bool(a or b) and len(a & b) >= 0.8 * len(a | b)


def plain_roots(sets, linked=similar):
    root = list(range(len(sets)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            if linked(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(sets))]


def at_similarity(rng, n, least):
    """Two texts of n words whose shingle similarity is just above ``least``."""
    left = [str(rng.getrandbits(40)) for _ in range(n)]
    right, held = list(left), list(left)
    for at in rng.sample(range(n), n):
        right[at] = "changed" + str(rng.getrandbits(20))
        if not len(plain_set(" ".join(left)) & plain_set(" ".join(right))) >= least * len(
            plain_set(" ".join(left)) | plain_set(" ".join(right))
        ):
            break
        held = list(right)
    return " ".join(left), " ".join(held)


@pytest.mark.parametrize("n", [60, 300])
def test_recall_at_the_least_similarity(spark, n):
    rng = random.Random(n)
    pairs = [at_similarity(rng, n, 0.8) for _ in range(250)]
    docs = spark.createDataFrame([(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)], DOCS)
    kept = {r["doc_id"] for r in simhash_wide.one_of_each(docs).collect()}
    assert {d for d in kept if d % 2 == 0} == set(range(0, 500, 2))
    assert sum(2 * i + 1 not in kept for i in range(250)) >= 0.9 * 250


def test_leaves_texts_below_the_similarity(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(100):
        words = [str(rng.getrandbits(40)) for _ in range(200)]
        other = list(words)
        for at in range(5, 200, 20):
            other[at] = "x" + str(rng.getrandbits(20))
        texts += [" ".join(words), " ".join(other)]
    assert not any(similar(plain_set(texts[i]), plain_set(texts[i + 1])) for i in range(0, 200, 2))
    assert simhash_wide.one_of_each(spark.createDataFrame(list(enumerate(texts)), DOCS)).count() == 200


def test_given_documents(spark, sf_dir):
    """Every row kept or gone as brute force says, but for the recall of pairs near the least similarity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    roots = plain_roots([plain_set(t) for _, t in rows])
    want = {rows[r][0] for r in roots}
    got = {r["doc_id"] for r in simhash_wide.one_of_each(docs).collect()}
    assert want <= got
    gone = len(rows) - len(want)
    assert len(rows) - len(got) >= 0.9 * gone


@pytest.mark.parametrize("hot_above", [1000, 2])
def test_large_groups_of_near_copies(spark, hot_above):
    """Chains and stars of near copies, hot keys or not, form the groups of brute force."""
    rng = random.Random(11)
    texts = []
    for _ in range(4):
        words = [str(rng.getrandbits(40)) for _ in range(200)]
        for step in range(25):
            near = list(words)
            near[rng.randrange(200)] = f"y{step}"
            texts.append(" ".join(near))
            if step % 8 == 7:
                words[rng.randrange(200)] = f"z{step}"
    texts += [str(i) * 3 for i in range(20)]
    roots = plain_roots([plain_set(t) for t in texts])
    got = simhash_wide.one_of_each(spark.createDataFrame(list(enumerate(texts)), DOCS), hot_above=hot_above)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(roots))


def test_odd_and_clashing_rows(clashing_docs, no_docs):
    kept = simhash_wide.one_of_each(clashing_docs)
    assert kept.columns == clashing_docs.columns
    given = [(r["doc_id"], r["text"]) for r in clashing_docs.collect()]
    roots = plain_roots([plain_set(t) for _, t in given])
    firsts = [
        min((d for (d, _), r in zip(given, roots, strict=True) if r == root and d is not None), default=None)
        for root in set(roots)
    ]
    key = lambda d: (d is None, d)
    assert sorted((r["doc_id"] for r in kept.collect()), key=key) == sorted(firsts, key=key)
    assert simhash_wide.one_of_each(no_docs).collect() == []
    named = clashing_docs.select("doc_id", "text", *[F.lit(1).alias(c) for c in ("name", "node", "key", "segments", "probes", "_row", "root")])
    assert simhash_wide.one_of_each(named).count() == len(firsts)


def test_blocks_of_a_long_text(monkeypatch):
    hashes = simhash_wide.shingle_set(" ".join(str(i * i) for i in range(3000)).encode())
    plan = simhash_wide.plan_for(10)
    whole = simhash_wide.bit_sums(hashes, plan)
    monkeypatch.setattr(simhash_wide, "BLOCK", 7)
    assert (simhash_wide.bit_sums(hashes, plan) == whole).all()


def test_plans_keep_their_recall():
    plans = [simhash_wide.plan_for(n) for n in (0, 1, 10**7, 10**9, 10**12)]
    assert [p.bits for p in plans] == [24, 24, 24, 28, 28]
    assert all(a.segments <= b.segments for a, b in zip(plans, plans[1:]))


def test_near_copies_meet_in_proportion(spark, monkeypatch):
    """Copies of a text, each changed in one place, are no more pairs to confirm than they have probes."""
    confirmed, met = simhash_wide.confirmed, []

    def counting(pairs, *more):
        met.append(pairs.distinct().count())
        return confirmed(pairs, *more)

    monkeypatch.setattr(simhash_wide, "confirmed", counting)
    rng = random.Random(5)
    n, words = 800, [str(rng.getrandbits(40)) for _ in range(200)]
    texts = [" ".join([*words[: i % 200], f"new{i}", *words[i % 200 + 1 :]]) for i in range(n)]
    assert simhash_wide.one_of_each(spark.createDataFrame(list(enumerate(texts)), DOCS)).count() == 1
    assert sum(met) <= simhash_wide.plan_for(n).segments * simhash_wide.PROBES * n


def test_far_copies_of_one_text_meet_in_proportion(spark, monkeypatch):
    """Copies with one to nine of 150 words changed, half of them similar to none: few pairs of them are compared."""
    stored, made = simhash_wide.stored, {"wide-near": 0, "wide-again": 0}

    def counting(df, name="step"):
        table = stored(df, name)
        if name in made:
            made[name] += table.count()
        return table

    monkeypatch.setattr(simhash_wide, "stored", counting)
    rng = random.Random(13)
    n, base, texts = 1000, [str(rng.getrandbits(40)) for _ in range(150)], []
    for i in range(n):
        words = list(base)
        for k, at in enumerate(rng.sample(range(150), 1 + i % 9)):
            words[at] = rng.choice(["and", "of", "the", "in", f"new{i}x{k}"])
        texts.append(" ".join(words))
    firsts = set(plain_roots([plain_set(t) for t in texts]))
    kept = {r["doc_id"] for r in simhash_wide.one_of_each(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert firsts <= kept and n - len(kept) >= 0.9 * (n - len(firsts))
    assert 200 < len(firsts) < 800
    assert sum(made.values()) <= 30 * n, made


def test_chance_meetings_need_no_texts(spark, monkeypatch):
    """Unrelated texts that happen to share keys are told apart by their fingerprints; their shingles are not moved."""
    sets, wanted = simhash_wide._sets, []

    def counting(nodes_wanted, *more):
        wanted.append(nodes_wanted.count())
        return sets(nodes_wanted, *more)

    monkeypatch.setattr(simhash_wide, "_sets", counting)
    monkeypatch.setattr(simhash_wide, "LEAST_BITS", 14)
    rng = random.Random(8)
    texts = [" ".join(str(rng.getrandbits(40)) for _ in range(20)) for _ in range(1500)]
    assert simhash_wide.one_of_each(spark.createDataFrame(list(enumerate(texts)), DOCS)).count() == 1500
    assert sum(wanted) <= 150


@pytest.mark.parametrize("work", [0, 64])
def test_groups_under_costly_keys(spark, monkeypatch, work):
    """Texts that share much and chains of near copies of them: the same groups by keys and by rare shingles."""
    monkeypatch.setattr(simhash_wide, "WORK", work)
    rng = random.Random(21)
    base, texts = [str(rng.getrandbits(40)) for _ in range(200)], []
    for family in range(6):
        words = list(base)
        for at in rng.sample(range(0, 200, 5), 9):
            words[at] = f"f{family}w{at}"
        for step in range(12):
            near = list(words)
            near[rng.randrange(200)] = f"y{family}s{step}"
            texts.append(" ".join(near))
            if step % 4 == 3:
                words[rng.randrange(200)] = f"z{family}s{step}"
    roots = plain_roots([plain_set(t) for t in texts])
    assert len(set(roots)) > 1
    got = simhash_wide.one_of_each(spark.createDataFrame(list(enumerate(texts)), DOCS))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(set(roots))


def test_probes_are_the_cheapest_variants(spark):
    rng = random.Random(2)
    plan = simhash_wide.plan_for(10)
    sums = [[rng.gauss(0, 1) for _ in range(plan.segments * plan.bits)] for _ in range(3)]
    own, probes = simhash_wide.ring_and_probes(simhash_wide.np.array(sums), plan)
    rows = [(i, own[i].tolist(), probes[i].tolist()) for i in range(3)]
    nodes = spark.createDataFrame(rows, "node bigint, segments array<int>, probes array<bigint>")
    got = {}
    for r in simhash_wide._met(nodes, True, plan, "y").collect():
        got.setdefault((r["y"], r["key"] >> 32), []).append(r["key"] & (1 << 32) - 1)
    rho = 1.6 / 1.8
    for (i, s), values in got.items():
        part = sums[i][s * plan.bits : (s + 1) * plan.bits]
        a = [abs(x) * rho / (1 - rho * rho) ** 0.5 for x in part]
        cost = [1.5976 * x + 0.07056 * x**3 for x in a]
        total = {v: sum(c for k, c in enumerate(cost) if (v ^ int(own[i][s])) >> k & 1) for v in values}
        assert len(values) == len(set(values)) == simhash_wide.PROBES and int(own[i][s]) in values
        singles = sorted(cost)
        assert max(total.values()) <= singles[simhash_wide.PROBES - 2] + 1e-9
    assert len(got) == 3 * plan.segments
