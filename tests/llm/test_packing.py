from itertools import combinations

import pytest

from lettersieve.llm import packing
from lettersieve.llm.packing import Bin


def padded(lengths, ends):
    return sum(min(e for e in ends if e >= n) for n in lengths)


@pytest.mark.parametrize("buckets", [1, 2, 3, 9])
def test_boundaries_are_optimal(buckets):
    lengths = [1, 1, 2, 2, 2, 3, 8, 8, 9, 20, 21, 50]
    distinct = sorted(set(lengths))
    bins = [Bin(n, lengths.count(n), n * lengths.count(n), n) for n in distinct]
    best = min(
        padded(lengths, [*inner, distinct[-1]])
        for k in range(buckets)
        for inner in combinations(distinct[:-1], min(k, len(distinct) - 1))
    )
    ends = packing.boundaries(bins, buckets)
    assert len(ends) <= buckets and padded(lengths, ends) == best


def test_bins_are_exact_first_then_in_order(spark):
    rows = spark.createDataFrame([(n,) for n in [0, 1, 511, 512, 1023, 1024, 1025, 4096, 10**9]], "length bigint")
    found = [r[0] for r in rows.select(packing.bin_of(rows["length"])).collect()]
    assert found[:5] == [0, 1, 511, 512, 1023] and found == sorted(found)


def check_batches(rows, docs, budget):
    assert len(rows) == len(docs)
    batches = {}
    for r in rows:
        assert r["length"] <= r["boundary"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    last = {}
    for (bucket, batch), held in batches.items():
        boundary = held[0]["boundary"]
        assert len(held) == 1 or len(held) * boundary <= budget
        assert sorted(r["place"] for r in held) == list(range(len(held)))
        last[bucket] = max(last.get(bucket, 0), batch)
    for (bucket, batch), held in batches.items():
        if batch < last[bucket]:  # only the last batch of a bucket may have room left
            assert (len(held) + 1) * held[0]["boundary"] > budget


def test_batches_keep_the_budget(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.digest(docs).collect()
    check_batches(rows, docs.collect(), packing.BUDGET)
    assert sorted(packing.digest(docs.repartition(7)).collect()) == sorted(rows)


def test_cells_do_not_change_what_fits(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 3)
    rows = spark.createDataFrame([(i, i % 7) for i in range(200)], "doc_id bigint, length bigint")
    check_batches(packing.pack(rows, buckets=3, budget=20).collect(), rows.collect(), 20)


def test_odd_rows(odd_docs, no_docs):
    rows = packing.digest(odd_docs).collect()
    check_batches(rows, odd_docs.collect(), packing.BUDGET)
    assert {r["doc_id"]: r["length"] for r in rows}[3] == 44000
    assert packing.digest(no_docs).collect() == []
