import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettersieve.llm import language


def test_held_out_accuracy(spark, sf_dir):
    """Fitted on half of the documents without any other evidence, judged on the other half."""
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    model = language.fit(language.sample(docs.filter("doc_id % 2 = 0"), "doc_id", "text", "lang"))
    rows = docs.filter("doc_id % 2 = 1").collect()
    found = [max(zip(model.score(r["text"])[1], (*model.languages, "und"), strict=True))[1] for r in rows]
    assert np.mean([a == r["lang"] for a, r in zip(found, rows, strict=True)]) > 0.97


def test_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language.digest(docs).collect()
    assert len(rows) == docs.count() and all(r["kept"] and r["language"] == r["declared"] for r in rows)


def test_score_equals_a_plain_sum():
    weights = np.log(np.random.default_rng(1).dirichlet(np.ones(language.BUCKETS), 3).T).astype(np.float32)
    model = language.TextModel(("a", "b"), weights)
    text = "  Ein  kurzer\nText é "
    data = " ein kurzer text é ".encode()
    plain = np.zeros(3)
    for i in range(len(data) - 2):
        code = (data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % (1 << 32) >> 16
        plain += weights[code]
    n, scores = model.score(text)
    assert n == len(data) - 2 and np.allclose(scores, plain / 3, rtol=1e-6)


def test_windows_do_not_change_the_score(monkeypatch):
    weights = np.log(np.random.default_rng(1).dirichlet(np.ones(language.BUCKETS), 2).T).astype(np.float32)
    model = language.TextModel(("a",), weights)
    text = "abc déf " * 50
    whole = model.score(text)
    monkeypatch.setattr(language, "WINDOW", 11)
    parts = model.score(text)
    assert parts[0] == whole[0] and np.allclose(parts[1], whole[1])


def test_evidence_equals_brute_force(spark):
    """Counts, smoothing and posterior by hand, for a fixed text model."""
    weights = np.full((language.BUCKETS, 3), -9.0, dtype=np.float32)
    weights[:, 1], weights[:, 2] = -9.01, -30.0
    model = language.TextModel(("aa", "bb"), weights)
    rows = [
        (1, "some text here", "aa", "net", "x.site.net"),
        (2, "some text here", "aa", "net", "x.site.net"),
        (3, "more", "bb", "net", "y.site.net"),
        (4, "more", None, None, None),
        (5, None, "aa", "net", "x.site.net"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, d string, s string, h string")
    found = language.identify(docs, declared="d", suffix="s", host="h", model=model).collect()
    classes = ("aa", "bb", "und")
    texts = {r[0]: np.array(model.score(r[1])[1]) for r in rows}
    judged = [r for r in rows if r[1]]
    best = {r[0]: classes[int(np.argmax(texts[r[0]]))] for r in judged}

    def counts(column, value):
        return np.array([sum(r[column] == value and best[r[0]] == c for r in judged) for c in classes], dtype=float)

    def likelihood(column, value):
        if value is None:
            return np.zeros(3)
        values = {r[column] for r in judged if r[column] is not None}
        totals = sum(counts(column, v) for v in values)
        return np.log((counts(column, value) + 1) / (totals + len(values) + 1))

    top = (np.array([sum(b == c for b in best.values()) for c in classes]) + 1) / (len(judged) + 3)
    domain = sum(counts(4, h) for h in ("x.site.net", "y.site.net"))
    weight = language.PRIOR_WEIGHT
    above = (domain + weight * top) / (domain.sum() + weight)

    def prior(host):
        if host is None:
            return np.log(top)
        own = counts(4, host)
        return np.log((own + weight * above) / (own.sum() + weight))

    by_id = {r["doc_id"]: r for r in found}
    for r in judged:
        total = texts[r[0]] + likelihood(2, r[2]) + likelihood(3, r[3]) + prior(r[4])
        chances = np.exp(total - total.max())
        assert by_id[r[0]]["language"] == classes[int(np.argmax(total))]
        assert math.isclose(by_id[r[0]]["confidence"], 1 / chances.sum(), abs_tol=1e-5)
    assert (by_id[5]["language"], by_id[5]["kept"]) == ("und", False)


def test_unknown_text_is_rejected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    strange = [(-1, "китайский и русский текст без перевода " * 5), (-2, "12345 67890 !!!"), (-3, "zqxjkvw qqzzx vvkkq " * 20)]
    added = spark.createDataFrame(strange, "doc_id bigint, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")}
    )
    rows = {r["doc_id"]: r for r in language.digest(docs.union(added)).collect()}
    assert [rows[i]["language"] for i in (-1, -2, -3)] == ["und"] * 3


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, "no address", "<html lang='de'><p>")], pages.schema)
    rows = {r["page_id"]: r for r in language.pages_digest(pages.union(odd)).collect()}
    assert len(rows) == pages.count() + 2 and not rows[-1]["kept"] and not rows[-2]["kept"]
    agree = [r["language"] == r["declared"] for i, r in rows.items() if i >= 0]
    assert np.mean(agree) > 0.9


@pytest.mark.parametrize("operator", [language.digest, language.only_known])
def test_odd_rows(odd_docs, clashing_docs, no_docs, operator):
    found = operator(clashing_docs)
    rows = found.collect()
    if operator is language.only_known:
        assert found.columns == clashing_docs.columns
        ids = [r["doc_id"] for r in rows]
        assert not {1, 2, 8, 11} & set(ids) and ids.count(5) == 2 and {3, 4, 6} <= set(ids)
    else:
        assert len(rows) == odd_docs.count()
    assert operator(no_docs).collect() == []


def test_every_declared_language_is_known(spark):
    letters = [chr(0x4E00 + i) for i in range(400)]
    rows = []
    for i in range(40):
        words = ["".join(letters[10 * i + (j * k) % 10] for k in range(1, 5)) for j in range(1, 9)]
        # The later, the fewer rows; the last has one.
        rows += [(f"l{i:02d}", " ".join(words[n % 3 :] * 3)) for n in range(40 - i)]
    docs = spark.createDataFrame([(n, *r, "one") for n, r in enumerate(rows)], "doc_id bigint, lang string, text string, source string")
    found = language.digest(docs).collect()
    assert len(found) == len(rows)
    assert [r for r in found if r["declared"] != r["language"] or not r["kept"]] == []
    assert language.only_known(docs).count() == len(rows)


def test_a_thousand_declared_values(spark):
    """The model stays bounded, and frequent languages are known among values that occur once."""
    words = {"aa": "balu kelo mira tonu", "bb": "strych zwerg quond phlox"}
    rows = [(name, f"{text} " * 5, name) for name, text in words.items() for _ in range(20)]
    rows += [(f"x{i:04d}", f"{words['aa']} " * 5, "aa") for i in range(1000)]
    docs = spark.createDataFrame([(n, *r[:2], "one", r[2]) for n, r in enumerate(rows)], "doc_id bigint, lang string, text string, source string, truth string")
    model = language.fit(language.sample(docs, "doc_id", "text", "lang"))
    assert {"aa", "bb"} <= set(model.languages) and len(model.languages) == language.MOST_LANGUAGES
    assert model.weights.nbytes <= 1 << 26
    few = language.fit(language.sample(docs, "doc_id", "text", "lang", most=2))
    assert few.languages == ("aa", "bb")
    found = language.identify(docs, declared="lang", host="source", keep=("doc_id", "truth"), model=few).collect()
    assert len(found) == len(rows) and all(r["language"] == r["truth"] and r["kept"] for r in found)
    assert len(language.digest(docs).collect()) == len(rows)
