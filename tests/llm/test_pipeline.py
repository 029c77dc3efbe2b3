import __spark_entry__ as entry
import corpus_pipeline
from lettersieve.llm import language, mixing, packing
from test_simhash_wide import plain_roots, plain_set


def test_stages_follow_each_other(spark, sf_dir, tmp_path):
    """Every stage against a plain version of what it may do to its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = docs.collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "secret_scan", "mixing", "packing",
    ]
    before = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf_dir).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        if name != "packing":
            assert after.dtypes == docs.dtypes
        rows, old = after.collect(), {r["doc_id"]: r for r in before.collect()}
        if name == "language_id":
            judged = {r["doc_id"] for r in language.digest(before).filter("kept").collect()}
            assert {r["doc_id"] for r in rows} == judged and len(rows) == len(judged)
        if name == "simhash_near_dedup":
            given_rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
            firsts = {given_rows[r][0] for r in plain_roots([plain_set(t) for _, t in given_rows])}
            kept = {r["doc_id"] for r in rows}
            assert firsts <= kept and len(kept) == len(rows)
            assert len(given_rows) - len(kept) >= 0.9 * (len(given_rows) - len(firsts))
        if name in ("language_id", "simhash_near_dedup", "mixing"):
            assert all(r == old[r["doc_id"]] for r in rows)
        if name == "secret_scan":
            assert len(rows) == len(old) and all(r["n_chars"] == len(r["text"]) for r in rows)
            assert any(r["text"] != old[r["doc_id"]]["text"] for r in rows)
        if name == "mixing":
            copies = {r["doc_id"]: r["copies"] for r in mixing.digest(before).collect()}
            assert sorted(r["doc_id"] for r in rows) == sorted(d for d, n in copies.items() for _ in range(n))
        if name == "packing":
            assert sorted(rows) == sorted(packing.digest(before).collect())
        before = after
    assert len(given) > len(old) > 0


def test_odd_documents_pass(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "unused")
        docs.collect()


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
