import re
import textwrap

from lettersieve.llm import licenses

# The licence lines that the synthetic documents hold.
LINES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "All rights reserved.": "reserved",
}


def test_planted_lines_and_nothing_else(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    want = set()
    for r in docs.collect():
        for i, line in enumerate((r["text"] or "").split("\n")):
            want |= {(r["doc_id"], i, family) for known, family in LINES.items() if line == known}
    found = licenses.digest(docs).filter("confirmed").collect()
    assert want and {(r["doc_id"], r["paragraph"], r["family"]) for r in found} >= want
    texts = {r["doc_id"]: r["text"].split("\n") for r in docs.collect()}
    for r in found:
        assert re.search("licen|rights reserved|cc by", texts[r["doc_id"]][r["paragraph"]].lower())


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["paragraph"], r["family"]) for r in licenses.digest(odd_docs).filter("confirmed").collect()]
    assert rows == [(12, 0, "Apache-2.0")]
    assert licenses.digest(no_docs).collect() == []


def test_held_out_variants_and_hard_sentences(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bodies = licenses.paragraphs(docs)
    model = licenses.fit(spark, bodies)
    held = licenses.labelled(bodies).filter("not train").withColumnRenamed("family", "true_family")
    rows = model.scored(held).select("true_family", "family").collect()
    positive = [r for r in rows if r["true_family"] != licenses.OTHER]
    assert sum(r["true_family"] == r["family"] for r in positive) / len(positive) > 0.9
    negative = [r for r in rows if r["true_family"] == licenses.OTHER]
    assert sum(r["family"] != licenses.OTHER for r in negative) / len(negative) < 0.02


def test_terms_and_similarity(spark):
    rows = spark.createDataFrame([("a, B c",), ("x",), ("",)], "body string")
    assert [r[0] for r in rows.select(licenses.terms(rows["body"])).collect()] == [["a", "b", "c", "a b", "b c"], ["x"], []]
    alike = spark.createDataFrame([("Text. Released under the MIT License. More",), ("nothing",), ("",)], "body string")
    assert [r[0] for r in alike.select(licenses.similarity(alike["body"], "MIT")).collect()] == [1.0, 0.0, 0.0]


def test_wrapped_notices(spark, sf_dir):
    def wrap(text, lead=""):
        return "\n".join(textwrap.wrap(text, 72, initial_indent=lead, subsequent_indent=lead))

    templates = {family: [t for t in texts if len(t) > 72] for family, texts in licenses.TEMPLATES.items()}
    rows, want = [], set()
    for family, texts in templates.items():
        for text in texts:
            for lead in ("", " * ", "# "):
                rows.append((len(rows), f"A title\n\n{lead}Some words first\n{wrap(text, lead)}\n\nother text"))
                want.add((len(rows) - 1, 2, family))
    assert len(want) >= 15
    both = wrap(templates["CC-BY-SA"][0]) + "\n" + wrap(templates["CC-BY-NC"][0])
    rows.append((1000, both.replace("under a ", "under\na ")))
    want |= {(1000, 0, "CC-BY-SA"), (1000, 0, "CC-BY-NC")}
    # A line that is confirmed alone is no finding of its block too, and blank lines part blocks.
    rows += [(1001, "one\nAll rights reserved.\ntwo"), (1002, "all rights\n\nreserved"), (1003, ""), (1004, None), (1005, "\n\n")]
    rows.append((1006, "\r\n\r\nCopyright, all rights\r\nreserved."))
    want |= {(1006, 2, "reserved")}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = licenses.wrapped(licenses.blocks(docs)).filter("doc_id != 1001").collect()
    assert {(r["doc_id"], r["paragraph"], r["known"]) for r in found} == want and len(found) == len(want)
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("-doc_id - 1 as doc_id", "text")
    confirmed = licenses.digest(corpus.union(docs)).filter("confirmed and doc_id >= 0").collect()
    # A block is left out where the notice's first line is confirmed already.
    got = {(r["doc_id"], r["family"]) for r in confirmed}
    assert got == {(i, family) for i, _, family in want} | {(1001, "reserved")}
    assert [r["paragraph"] for r in confirmed if r["doc_id"] in (0, 1001, 1006)].count(1) == 1
    assert all(r["similarity"] >= licenses.CONFIRM and 0 <= r["probability"] <= 1 for r in confirmed)
