import hashlib
import itertools
import random
import re
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lettersieve.llm import secret_scan
from lettersieve.llm.trigram_query import trigram_query, trigrams

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def base_spans(text):
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def check(docs):
    texts = sorted((r["doc_id"] or -1, r["text"] or "") for r in docs.collect())
    rows = sorted((r["doc_id"] or -1, r) for r in secret_scan.digest(docs).collect())
    want = []
    for doc_id, text in texts:
        spans = base_spans(text)
        written = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        n = [sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")]
        want.append((doc_id, *n, hashlib.sha256(written.encode()).hexdigest()))
    assert sorted((i, *r[1:5]) for i, r in rows) == sorted(want)
    return [r for _, r in rows]


def test_equals_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in check(odd_docs)}
    assert (rows[10]["n_assign"], rows[10]["n_access"], rows[10]["n_hex"]) == (1, 1, 1)
    assert secret_scan.digest(no_docs).collect() == []


def test_hard_texts(spark):
    texts = [
        "password=token=abcdefghijkl",
        "password: secret: abcdefghijkl",
        "API_KEY='abcdefghijklm' apikey=\"nnnnnnnnnnnnn\"",
        "\U0001f600\U0001f600 Token = 0123456789abcdef0123 é",
        "AKIA" + "A" * 13 + " AKIA" + "A" * 14,
        "deadbeefdeadbee deadbeefdeadbeef" * 3,
        "0123456789abcdef " * 300,
        "ſecret=abcdefghijklmno toKen=abcdefghijklmno",
        "pass\nword=abcdefghijklmnop",
    ]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_added_rules(spark):
    texts = ["-----BEGIN RSA PRIVATE KEY-----", "x ghp_" + "a1" * 18, "xoxb-1234567890-abc", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kinds = {r["doc_id"]: {s.split(":")[0] for s in r["spans"].split(",")} for r in secret_scan.digest(docs).collect()}
    assert [("pem", "github", "slack", "jwt")[i] in kinds[i] for i in range(4)] == [True] * 4


def test_queries_come_from_the_patterns():
    assert secret_scan.clauses(secret_scan.ACCESS) == [["aki", "kia"]]
    assert secret_scan.clauses(secret_scan.HEX) == []
    found = secret_scan.clauses(secret_scan.ASSIGN)
    assert sorted(trigrams("secret")) in found and sorted(trigrams("api_key")) in found and len(found) == 6
    # Another pattern, another query.
    changed = replace(secret_scan.ASSIGN, pattern=secret_scan.ASSIGN.pattern.replace("secret", "hidden"))
    now = secret_scan.clauses(changed)
    assert sorted(trigrams("hidden")) in now and sorted(trigrams("secret")) not in now
    assert secret_scan.clauses(secret_scan.Rule("x", "gh[po]_[a-z]{3,}")) == [["gho", "ho_"], ["ghp", "hp_"]]
    assert trigram_query("AK?IA") == [["aia"], ["aki", "kia"]]
    assert trigram_query("(abcd)+x|efg") == [["abc", "bcd"], ["efg"]]
    assert trigram_query("abc.def") == [["abc", "def"]] and trigram_query("(abc)?d") == [] and trigram_query("a(") == []


@pytest.mark.parametrize("seed", range(4))
def test_queries_hold_for_every_match(seed):
    """Whatever a random pattern matches has all trigrams of one of its clauses."""
    rng = random.Random(seed)

    def pattern(depth):
        kind = rng.randrange(7 if depth else 3)
        if kind < 2:
            return "".join(rng.choices("abAB", k=rng.randrange(1, 5)))
        if kind == 2:
            return rng.choice(["[ab]", "[a-d]", ".", "a?", "[^a]"])
        if kind == 3:
            return f"(?:{pattern(depth - 1)}|{pattern(depth - 1)})"
        if kind == 4:
            return f"(?:{pattern(depth - 1)})" + rng.choice(["*", "+", "?", "{2}", "{1,3}", "++"])
        return pattern(depth - 1) + pattern(depth - 1)

    for _ in range(300):
        p = pattern(3)
        query = trigram_query(p)
        for _ in range(10):
            text = "".join(rng.choices("abcdABx", k=12))
            for m in re.finditer(p, text):
                held = trigrams(m[0].lower())
                assert not query or any(set(c) <= held for c in query), (p, m[0], query)


def test_index_returns_rows_that_hold_a_clause(spark):
    rows = [(1, "my APIkEy"), (2, "api"), (3, "PASSWD"), (4, None), (5, "api key")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    grams = sorted({g for c in secret_scan.clauses(secret_scan.ASSIGN) for g in c})
    found = secret_scan.candidates(secret_scan.postings(docs, grams), (secret_scan.ASSIGN,))
    keyed = docs.select("doc_id", secret_scan.row_key("doc_id", "text").alias("row")).join(found, "row")
    assert {r["doc_id"]: r["kinds"] for r in keyed.collect()} == {1: ["assign"], 3: ["assign"]}


def test_running_values_over_stretches(spark):
    values = [random.Random(1).randrange(9) for _ in range(1000)]
    row = spark.createDataFrame([(values,), ([],)], "v array<int>")
    sums = [r[0] for r in row.select(secret_scan.before_each(F.col("v"), lambda a, b: a + b)).collect()]
    assert sums == [[0, *itertools.accumulate(values)], [0]]


def test_long_text_is_redacted_in_seconds(spark):
    text = "0123456789abcdef éé " * 250_000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    start = time.time()
    found = secret_scan.redacted(docs).first()["text"]
    assert found == "[secret] éé " * 250_000
    assert time.time() - start < 60


def test_redacted(clashing_docs, no_docs):
    found = secret_scan.redacted(clashing_docs)
    assert found.columns == clashing_docs.columns and found.count() == clashing_docs.count()
    before = {r["doc_id"]: r["text"] for r in clashing_docs.collect()}
    for row in found.collect():
        text = before[row["doc_id"]]
        if row["doc_id"] == 10:
            assert row["text"] == "[secret]' [secret] [secret] \U0001f600 token:short"
        elif row["doc_id"] is not None:
            assert row["text"] == text
    assert secret_scan.redacted(no_docs).collect() == []


def test_whole_private_keys_are_redacted(spark):
    body = [("MIIEpAIBAAKCAQEA+/x" * 4)[:64]] * 300 + ["c2hvcnQ="]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    head = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,00FF", ""]
    key = "\n".join([begin, *body, end])
    cases = [
        (f"before\n{key}\nafter it", "before\n[secret]\nafter it"),
        (f"x {key} y\r\n{key.replace(chr(10), chr(13) + chr(10))} z", "x [secret] y\r\n[secret] z"),
        ("\n".join([begin, *head, *body, end, "after"]), "[secret]\nafter"),
        ('{"k": "' + key.replace("\n", "\\n") + '\\n"}', '{"k": "[secret]\\n"}'),
        ("a - b\n" + key.replace("\n", " ") + " --- c", "a - b\n[secret] --- c"),
        # No END line: the base64 lines go, the prose after them stays.
        ("\n".join([begin, *body, "and then prose goes on"]), "[secret]\nand then prose goes on"),
        ("\n".join([begin, *head, *body]), "[secret]"),
        ("\n".join(["cut", begin, *body[:2], body[0][:9]]), "cut\n[secret]"),
        ("\n".join([begin, body[0], "", key, "end"]), "[secret]\n\n[secret]\nend"),
        (f"the line {begin} starts a key", "the line [secret] starts a key"),
    ]
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    assert [found[i] for i in range(len(cases))] == [want for _, want in cases]
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.digest(docs).collect()}
    assert f"pem:7:{7 + len(key)}" in spans[0].split(",")
