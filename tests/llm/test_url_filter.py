import math

import pytest

from lettersieve.llm import url_filter
from lettersieve.llm.url_filter import END, START

SCHEMA = "page_id bigint, url string"


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    end = min((path.index(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def plain_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def plain_model(names, order=url_filter.ORDER):
    """log P(char | context) by the recursive definition, from counted strings."""
    counts = {}
    for name, n in names:
        s = START * order + name + END
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts.setdefault(s[i - k : i], {}).setdefault(s[i], 0)
                counts[s[i - k : i]][s[i]] += n

    def chance(context, char):
        lower = 1 / url_filter.ALPHABET if not context else None
        below = lower if lower is not None else chance(context[1:], char)
        seen = counts.get(context, {})
        total, kinds = sum(seen.values()), len(seen)
        return (seen.get(char, 0) + kinds * below) / (total + kinds) if total else below

    return lambda name: [
        math.log(chance(s[i - order : i], s[i]))
        for s in [START * order + name + END]
        for i in range(order, len(s))
    ]


ODD = [
    (1, None), (2, ""), (3, "no address"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/x?q=/en/#a"),
    (6, "http://example.com/en"), (7, "http://example.com?x=/en/"), (8, "http://a.net/es/"), (9, "http://xnet/fr/"),
    (10, "http://net/fr/a"), (11, "x://y://z.com/p"), (12, "http://b.org/" + "a/" * 3000), (12, "http://b.org/x"),
    (None, "http://b.org/x"), (13, "http://\U0001f600.org/é\n/x"),
]


def test_hosts_paths_and_rules(spark):
    rows = url_filter.ruled(spark.createDataFrame(ODD, SCHEMA)).collect()
    want = []
    for page, url in ODD:
        host, path = plain_split(url)
        rule = plain_rule(host, path)
        want.append((page, host, path, rule and rule.text, rule and rule.verdict))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_scores_and_verdicts_equal_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    more = pages.select((pages["page_id"] + 10**6).alias("page_id"), "url")
    rows = url_filter.judge(pages.select("page_id", "url").union(more)).collect()
    names = spark.createDataFrame([(r["host"] + r["path"],) for r in rows], "name string").distinct()
    held = {r["name"] for r in names.filter(url_filter.held_out(names["name"])).collect()}
    learn = {"allow": {}, "block": {}}
    scores = []
    for r in rows:
        rule, name = plain_rule(r["host"], r["path"]), r["host"] + r["path"]
        assert r["rule"] == (rule and rule.text)
        if rule and name not in held:
            learn[rule.verdict][name] = learn[rule.verdict].get(name, 0) + 1
    accepted, rejected = (plain_model(learn[k].items()) for k in ("allow", "block"))
    for r in rows:
        name = r["host"] + r["path"]
        if r["score"] is not None:
            ratio = [b - a for a, b in zip(accepted(name), rejected(name), strict=True)]
            assert r["score"] == pytest.approx(sum(ratio) / len(ratio), abs=1e-6)
            if r["rule"] is not None and plain_rule(r["host"], r["path"]).verdict == "allow":
                scores.append(r["score"])
    open_rows = [r for r in rows if r["rule"] is None]
    blocked = [r["score"] for r in open_rows if r["verdict"] == "block"]
    allowed = [r["score"] for r in open_rows if r["verdict"] == "allow"]
    assert not blocked or not allowed or min(blocked) > max(allowed)
    limit = min(blocked, default=math.inf)
    assert sum(s >= limit for s in scores) <= url_filter.FALSE_BLOCK * len(scores)


def test_odd_rows(spark):
    pages = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "'own' AS name", "'own' AS verdict")
    rows = url_filter.judge(pages).collect()
    assert len(rows) == len(ODD) and all(r["verdict"] in ("allow", "block") for r in rows)
    assert {r["verdict"] for r in rows if r["host"] + r["path"] == ""} == {"block"}
    assert url_filter.judge(pages.limit(0)).collect() == []
    # Nothing to learn from: what no rule judges is allowed.
    alone = spark.createDataFrame([(1, "http://b.org/x")], SCHEMA)
    assert [r["verdict"] for r in url_filter.judge(alone).collect()] == ["allow"]


def test_threshold(spark):
    scores = spark.createDataFrame([(i / 100, 1) for i in range(100)], "score double, n int")
    limit = url_filter.threshold(scores, 0.05)
    assert sum(i / 100 > limit for i in range(100)) <= 5 and sum(i / 100 > limit - 0.02 for i in range(100)) > 5
