import math
import random
import re
from collections import Counter
from fractions import Fraction

import pytest

from lettersieve.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def check(docs, labels):
    rows = quality.digest(docs, labels).collect()
    texts = [(r["doc_id"], *plain_counts(r["text"])) for r in docs.collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r[:6]) for r in rows), key=key) == sorted(texts, key=key)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    return rows


def test_equals_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, None, None), (None, 1, 0), (5, 0, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int")
    check(odd_docs, labels)
    assert quality.digest(no_docs, labels).collect() == []
    check(odd_docs, labels.limit(0))


@pytest.mark.parametrize("k,n,delta", [(0, 10, 0.05), (3, 50, 0.01), (40, 4000, 0.001), (9, 10, 0.2)])
def test_bound_is_exact(k, n, delta):
    p = quality.upper_bound(k, n, delta)
    tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert tail == pytest.approx(delta, rel=1e-6)
    assert quality.upper_bound(n, n, delta) == 1.0


@pytest.mark.parametrize("k,n", [(0, 1), (0, 500), (7, 9), (30, 1000), (995, 1000), (100, 5000)])
@pytest.mark.parametrize("p", [1e-6, 0.02, 0.3, 0.9])
def test_binomial_probability_is_exact(k, n, p):
    q = Fraction(p)
    exact = sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1)) if n < 100 else None
    if exact is None:
        logs = [math.log(math.comb(n, i)) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        exact = math.fsum(math.exp(x) for x in logs)
    assert quality.at_most(k, n, p) == pytest.approx(float(exact), rel=1e-8, abs=1e-12)


def test_last_rule_that_passes():
    # With n = 400, rate 0.02 and level 0.05, up to three false rejections pass.
    passing = max(k for k in range(20) if quality.at_most(k, 400, 0.02) <= 0.05)
    assert quality.last_passing(Counter({4: passing, 9: 1}), 400, 0.02, 0.05) == (8, passing)
    assert quality.last_passing(Counter({4: passing + 1}), 400, 0.02, 0.05) == (3, 0)
    assert quality.last_passing(Counter({4: passing}), 400, 0.02, 0.05) == (500, passing)
    assert quality.last_passing(Counter(), 20, 0.02, 0.05) == (-1, 0)
    assert quality.last_passing(Counter(), 0, 0.02, 0.05) == (-1, 0)


def test_steps_are_ordered_by_what_they_gain():
    bad = {("symbols", 40): 9, ("symbols", 0): 11, ("repeats", 70): 5, ("repeats", 0): 15, ("capitals", 3): 2, ("capitals", 0): 18}
    others = {("symbols", 40): 1, ("symbols", 0): 999, ("repeats", 0): 1000, ("capitals", 3): 200, ("capitals", 0): 800}
    order = quality.ordered_steps(bad, others)
    assert order.index(("repeats", 70)) < order.index(("symbols", 40))
    assert all(signal not in ("capitals", "dup_lines", "long_words") for signal, _ in order)
    for name in ("symbols", "repeats"):
        own = [g for signal, g in order if signal == name]
        assert own == list(range(100, 100 - len(own), -1))
    assert quality.ordered_steps({}, others) == []


def test_false_rejections_stay_below_the_bound():
    """Over many drawn holdouts, the true rate exceeds alpha no more often than delta says."""
    rng = random.Random(3)
    alpha, delta, failures = 0.05, 0.1, 0
    for _ in range(1000):
        # A good document is first rejected by rule r with a chance of a thousandth each.
        good = Counter(r for r in (rng.randrange(1000) for _ in range(400)) if r < 500)
        last, _ = quality.last_passing(good, 400, alpha, delta)
        failures += (last + 1) / 1000 > alpha
    assert failures <= 1000 * delta * 1.3


def test_thresholds_equal_brute_force(spark):
    """Two strata and a null one, against rules applied one after the other to all documents."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(6000):
        stratum = ("a", "b", None)[i % 3]
        kind = rng.choice(["good", "bad", "other"])
        symbols = rng.choice([0, 0, 10, 25, 40]) if kind == "bad" else rng.choice([0] * 60 + [10, 25])
        repeats = rng.choice([0, 30]) if kind == "bad" else rng.choice([0] * 90 + [30])
        rows.append((i, stratum, 100, 500, symbols, 0, repeats, 10, 400, 5))
        if kind != "other":
            labels.append((i, int(kind == "good"), 0))
    schema = "doc_id bigint, stratum string, " + ", ".join(f"{c} bigint" for c in quality._COUNTS)
    features = spark.createDataFrame(rows, schema)
    found = quality.thresholds(features, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    got = {(r["stratum"], r["signal"]): (r["cutoff"], r["n"], r["rejected"]) for r in found}
    quality_of, want = {i: q for i, q, _ in labels}, {}
    for stratum in ("a", "b", None):
        own = [(quality_of.get(r[0]), {"symbols": 2 * r[4], "repeats": r[6], "capitals": 2}) for r in rows if r[1] == stratum]
        tables = [Counter((s, x.get(s, 0)) for q, x in own if q == kind for s in quality.SIGNALS) for kind in (0, None)]
        good = [x for q, x in own if q == 1]
        cuts, best = {}, None
        for signal, g in quality.ordered_steps(*tables):
            cuts[signal] = g
            lost = sum(any(x.get(s, 0) >= c for s, c in cuts.items()) for x in good)
            if quality.upper_bound(lost, len(good), quality.DELTA / 3) > quality.ALPHA:
                break
            best = (dict(cuts), lost)
        for signal, g in best[0].items() if best else ():
            want[stratum, signal] = (g, len(good), best[1])
    assert got == want and want


def test_junk_goes_and_good_documents_stay(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.digest(docs, labels).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.6
