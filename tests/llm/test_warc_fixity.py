import random

import pytest
from pyspark.sql import functions as F

from lettersieve.llm import warc_fixity

RECORD = "archive bigint, offset bigint, record_id bigint, length bigint, hash string"


def test_layout_and_record_bytes(spark):
    pages = spark.createDataFrame([(0, "http://a/é", "é!"), (1, None, None), (256, "u", "x")], "page_id bigint, url string, html string")
    rows = warc_fixity.placed(warc_fixity.hashed(pages, "page_id", "url", "html", warc_fixity.archive_of("page_id"))).collect()
    at = {r["record_id"]: r for r in rows}
    first = "WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: http://a/é\r\nContent-Length: 3\r\n\r\né!\r\n\r\n".encode()
    assert at[0]["length"] == len(first) and at[1]["offset"] == len(first) and at[256]["archive"] == 1


def test_levels_end_in_one_node():
    for archive, offset in [(0, 0), (1, 5), (17, 1 << 30), (5000, 100)]:
        top = warc_fixity.levels(archive, offset)[-1]
        assert top.offset_bits is None and (archive + 1) >> top.archive_bits == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_a_full_comparison(spark, seed):
    rng = random.Random(seed)
    good = {}
    for archive in range(-1, 40):
        at = 0
        for _ in range(rng.randrange(1, 30)):
            size = rng.randrange(80, 9000)
            good[archive, at] = (len(good), size, f"h{rng.random()}")
            at += size
    other = dict(good)
    for place in rng.sample(sorted(good), 12):
        record, size, _ = other.pop(place)
        if rng.random() < 0.6:
            other[place] = (record, size, "damaged")
    other[3, 10**9] = (10**6, 5, "new")
    frames = [spark.createDataFrame([(*p, *r) for p, r in side.items()], RECORD) for side in (good, other)]
    found = {(r["archive"], r["offset"]): r["status"] for r in warc_fixity.audit(*frames).collect()}
    want = {p: "missing" for p in good.keys() - other.keys()} | {p: "extra" for p in other.keys() - good.keys()}
    want |= {p: "changed" for p in good.keys() & other.keys() if good[p] != other[p]}
    assert found == want
    assert warc_fixity.audit(frames[0], frames[0]).collect() == []


def test_descends_only_into_differing_branches(spark, monkeypatch):
    rows = [(a, o * 20000, a * 100 + o, 20000, f"h{a}-{o}") for a in range(20) for o in range(20)]
    good = spark.createDataFrame(rows, RECORD)
    other = good.withColumn("hash", F.when(F.col("record_id") == 1207, "x").otherwise(F.col("hash")))
    read = []
    monkeypatch.setattr(warc_fixity, "_children", lambda n, u, b, f=warc_fixity._children: read.append(f(n, u, b)) or read[-1])
    assert [r["record_id"] for r in warc_fixity.audit(good, other).collect()] == [1207]
    assert all(frame.count() <= 16 for frame in read)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "u", None), (None, None, None), (7, "u", "x" * 10**6), (5, "lost", "x"), (9, "u", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("hash", F.lit("own"))
    found = {r["page_id"]: r["status"] for r in warc_fixity.digest(pages).collect()}
    assert found == {7: "changed", 5: "missing"}
    assert warc_fixity.digest(pages.limit(0)).collect() == []
