import random

import pytest
from pyspark.sql import functions as F

from lettersieve.functions.text import like_pattern
from lettersieve.operators import matching, range_sets, slices, word_lookup
from lettersieve.plans import session_index
from lettersieve.sources import shared

WORDS = ["a", "ab", "abc", "abcd", "bcd", "xabcx", "aaa", "aaaa", "été", "étés", "ete", "%x", "a_b", "\U0001f600z",
         "q" * 23, "q" * 24, "q" * 25, "q" * 26, "q" * 27, "q" * 24 + "z", "receive", "recieve", "recive"]


@pytest.fixture(scope="module")
def lookup(spark):
    root = shared.new_folder(spark, "test-lookup")
    word_lookup.write_lookup(spark.createDataFrame([(w,) for w in WORDS + WORDS[:3]], "term string"), root)
    return word_lookup.read_lookup(spark, root)


def test_patterns_equal_a_test_of_every_word(lookup):
    for pattern in ("*abc*", "abc*", "*bcd", "a*d", "AB", "a", "*", "*a*", "", "été*", "*%*", "a_b", "*aaa*", "*zzz*", "*ec*ve"):
        got = sorted(r.term for r in word_lookup.terms_like(lookup, pattern).collect())
        want = sorted(r.term for r in lookup.terms.filter(F.col("term").like(like_pattern(pattern.lower()))).collect())
        assert got == want, pattern
    assert word_lookup.pattern_grams("*a*") == []
    assert word_lookup.pattern_grams("ab*cde") == ["\x02ab", "cde", "de\x03"]


def test_near_words_equal_all_pairs(spark, lookup):
    asked = spark.createDataFrame([(w,) for w in [*WORDS, "", "Zq", "q" * 28, "ecrive"]], "word string")
    for distance in (0, 1, 2):
        got = sorted(tuple(r) for r in word_lookup.terms_near(lookup, asked, distance).collect())
        every = asked.select(F.lower("word").alias("word")).crossJoin(lookup.terms)
        want = sorted(tuple(r) for r in every.filter(F.levenshtein("word", "term") <= distance).collect())
        assert got == want and want
    with pytest.raises(ValueError):
        word_lookup.terms_near(lookup, asked, 3)


def test_range_sets_equal_expanded_sets(spark):
    rng = random.Random(2)
    sides = [[(b, lo := rng.randrange(1, 120), lo + rng.randrange(-1, 20)) for b in "xyz"[: 2 + k] for _ in range(9)] for k in (0, 1)]
    left, right = (spark.createDataFrame(s, "box string, uid_lo bigint, uid_hi bigint") for s in sides)
    a, b = ({(x, u) for x, lo, hi in s for u in range(lo, hi + 1)} for s in sides)
    for name, want in (("union", a | b), ("intersection", a & b), ("difference", a - b)):
        for bits in (1, 4, 20):
            got = [tuple(r) for r in range_sets.combined(left, right, name, bits).collect()]
            covered = [(x, u) for x, lo, hi in got for u in range(lo, hi + 1)]
            assert len(covered) == len(set(covered)) and set(covered) == want
            # Ranges do not touch: each is as long as can be.
            assert not {(x, hi + 1) for x, _, hi in got} & {(x, lo) for x, lo, _ in got}
    assert range_sets.combined(left.limit(0), right.limit(0), "union").collect() == []
    with pytest.raises(ValueError):
        range_sets.combined(left, right, "both")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_words_are_tested_in_the_scan(spark, sf_dir, monkeypatch):
    index = session_index.open_index(spark, sf_dir)
    searches = (
        lambda: matching.search_wildcard(index, "*th*", ["subject", "body"]),
        lambda: matching.search_fuzzy(index, "ertion", ["subject", "body"], 2),
    )
    want = [sorted(search().collect()) for search in searches]
    monkeypatch.setattr(matching, "LITERAL_TERMS", 0)
    for search, rows in zip(searches, want, strict=True):
        got = search()
        assert "Join" not in _plan(got)
        assert sorted(got.collect()) == rows and rows


def test_repeated_rows_are_not_broadcast(spark):
    # 64 times as many rows as Spark's own estimate says.
    rows = spark.range(200).selectExpr("string(id % 5) AS term", "id AS uid", "'x' AS box")
    other = shared.stored(spark.range(3).selectExpr("string(id) AS term", "id AS n"), "other")
    salted = slices.join_salted(rows, other, ["term"], ["uid"], small=False)
    sliced = slices.join_by_box(
        rows, other.selectExpr("term", "n", "bigint(5000000) AS max_uid"), ["term"], "max_uid", small=False
    )
    for joined in (salted, sliced):
        assert "Broadcast" not in _plan(joined)
        assert joined.count() == 120


def test_lookup_tables_grow_with_the_words_only(spark):
    words = spark.createDataFrame([("q" * n,) for n in range(1, 60)] + [("w" * 40 + "x",)], "term string")
    root = shared.new_folder(spark, "test-pieces")
    word_lookup.write_lookup(words, root, ["pieces"])
    found = word_lookup.read_lookup(spark, root, ["pieces"])
    assert found.grams is None
    assert found.pieces.count() == 60 * word_lookup.PARTS
    assert found.pieces.groupBy("term").agg(F.sum(F.length("piece")).alias("n")).filter("n <> length(term)").count() == 0
    asked = spark.createDataFrame([("w" * 39 + "yx",), ("q" * 57,)], "word string")
    got = sorted(tuple(r) for r in word_lookup.terms_near(found, asked, 2).collect())
    assert got == sorted([("w" * 39 + "yx", "w" * 40 + "x"), *[("q" * 57, "q" * n) for n in (55, 56, 57, 58, 59)]])
