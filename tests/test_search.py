import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lettersieve.operators import batch_scores, matching, postings, ranking, slices
from lettersieve.operators.matching import HEADER_KINDS, Arg, Node
from lettersieve.plans import index_run, session_index
from lettersieve.sources import index_tables, shared

DOCS = "box string, uid bigint, fields map<string, array<string>>"
WORDS = ["alpha", "beta", "gamma", "delta", "hot"]


def make_documents():
    rng = random.Random(11)
    rows = []
    for box, count in (("big", 40), ("small", 7), ("one", 1)):
        for uid in rng.sample(range(1, 90), count):
            text = lambda n: " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, n)))
            rows.append((box, uid, {"subject": [text(3)], "body": [text(12) + " Hot!"], "x_foo": [text(2), text(2)]}))
    return rows


ROWS = make_documents()


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="module")
def index(spark, documents):
    root = shared.new_folder(spark, "test-index")
    index_tables.write_index(documents, root)
    return index_tables.read_index(spark, root)


@pytest.fixture(params=["broadcast", "shuffled"])
def joins(request, monkeypatch):
    """Runs a test with small sides broadcast, and with all of them over the limit."""
    if request.param == "shuffled":
        monkeypatch.setattr(slices, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(slices, "SALTS", 3)
        monkeypatch.setattr(matching, "LITERAL_TERMS", -1)
    return request.param


def tokens(value):
    return re.findall(r"\w+", value.lower())


def brute_force(value, fields, operator="or"):
    """{(box, uid): score} straight from the formula."""
    query = set(tokens(value))
    lists = {
        (box, uid, field): [t for v in values for t in tokens(v)]
        for box, uid, doc in ROWS
        for field, values in doc.items()
    }
    scores = {}
    for (box, uid, field), words in lists.items():
        if field not in fields:
            continue
        peers = [w for (b, _, f), w in lists.items() if b == box and f == field and w]
        found = query & set(words)
        if not found or (operator == "and" and found != query):
            continue
        average = sum(map(len, peers)) / len(peers)
        score = 0.0
        for term in found:
            df = sum(term in w for w in peers)
            tf = words.count(term)
            idf = math.log(1 + (len(peers) - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / average))
        scores[box, uid] = max(scores.get((box, uid), 0.0), score)
    return scores


def as_dict(hits):
    rows = hits.collect()
    found = {(r.box, r.uid): r.score for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("operator", ["or", "and"])
@pytest.mark.parametrize("value", ["alpha", "hot beta beta", "Gamma-delta", "unknown", "!!"])
def test_search_equals_brute_force(index, joins, value, operator):
    fields = ["subject", "body", "x_foo"]
    got = as_dict(matching.search(index, value, fields, operator))
    want = brute_force(value, fields, operator)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_computed_index_equals_stored(index, documents):
    computed = postings.index_of(documents)
    for name in ("postings", "dictionary", "keys"):
        a, b = getattr(index, name).drop("term_bucket"), getattr(computed, name)
        assert a.count() == b.count()
        assert a.exceptAll(b.select(a.columns)).isEmpty()
    assert as_dict(matching.search(computed, "hot", ["body"])) == as_dict(matching.search(index, "hot", ["body"]))


def test_search_in_boxes_and_all_fields(index):
    assert {box for box, _ in as_dict(matching.search(index, "hot", ["body"], boxes=["small"]))} == {"small"}
    every = as_dict(matching.search(index, "alpha", None))
    assert every == as_dict(matching.search(index, "alpha", ["subject", "body", "x_foo"]))


def test_header_is_sanitised_like_the_field(index):
    got = as_dict(matching.search_header(index, "X.Foo", "alpha"))
    assert got and got.keys() == brute_force("alpha", ["x_foo"]).keys()


def test_fields_of_arguments(spark):
    nested = [Arg("or", children=(Arg("header", "Subject"), Arg("body"))), Arg("header", "X.Foo"), Arg("flags")]
    assert matching.search_fields(spark, nested) == ["body", "subject", "x_foo"]
    assert matching.search_fields(spark, [Arg("text")]) == ["from", "to", "subject", "body"]
    assert matching.search_fields(spark, nested, ["subject"]) == ["body", "subject"]
    assert not matching.is_indexed(Arg("header", "X-Secret"), ["subject"])


def test_all_header_kinds_search_the_field(index, spark):
    want = as_dict(matching.search_header(index, "X.Foo", "alpha"))
    for kind in HEADER_KINDS:
        assert as_dict(matching.search_args(index, [Arg(kind, "X.Foo")], "alpha")) == want
        assert not matching.is_indexed(Arg(kind, "X-Secret"), ["subject"])
    rows = [(i, kind, "X.Foo") for i, kind in enumerate(HEADER_KINDS)]
    args = spark.createDataFrame(rows, "query_id int, kind string, header string")
    assert [r.field for r in ranking.argument_fields(args).collect()] == ["x_foo"] * 3


def test_negation_is_carried_down(index):
    every = {(box, uid) for box, uid, _ in ROWS}
    both = [Arg("body"), Arg("header", "subject")]
    plain = as_dict(matching.search_args(index, both, "alpha")).keys()
    under = [Arg("or", negated=True, children=tuple(both))]
    assert as_dict(matching.search_args(index, under, "alpha")).keys() == every - plain
    twice = [Arg("or", negated=True, children=(Arg("or", negated=True, children=tuple(both)),))]
    assert as_dict(matching.search_args(index, twice, "alpha")).keys() == plain
    mixed = [Arg("or", negated=True, children=(Arg("body"), Arg("header", "subject", negated=True)))]
    with pytest.raises(ValueError):
        matching.search_args(index, mixed, "alpha")


def test_nothing_answerable_is_refused(index):
    with pytest.raises(LookupError):
        matching.search_args(index, [Arg("header", "X-Secret"), Arg("flags")], "x", allowed_headers=["subject"])
    with pytest.raises(ValueError):
        matching.search_args(index, [Arg("body"), Arg("body", negated=True)], "x")


def test_negation_is_the_complement(index):
    hits = as_dict(matching.search_body(index, "alpha"))
    rest = as_dict(matching.search_args(index, [Arg("body", negated=True)], "alpha"))
    assert not hits.keys() & rest.keys()
    assert hits.keys() | rest.keys() == {(box, uid) for box, uid, _ in ROWS}


def test_combining_searches(index):
    one = as_dict(matching.search_body(index, "alpha"))
    two = as_dict(matching.search_header(index, "subject", "beta"))
    hits = [matching.search_body(index, "alpha"), matching.search_header(index, "subject", "beta")]
    both = as_dict(matching.combine(*hits, "and"))
    any_ = as_dict(matching.combine(*hits, "or"))
    assert both.keys() == one.keys() & two.keys()
    assert any_.keys() == one.keys() | two.keys()
    assert all(abs(any_[k] - one.get(k, 0) - two.get(k, 0)) < 2e-6 for k in any_)


def raw(spark):
    rows = [(box, uid, doc["body"][0]) for box, uid, doc in ROWS]
    return spark.createDataFrame(rows, "box string, uid bigint, body string")


def test_residual_and_verification(spark, index):
    messages = raw(spark)
    condition = matching.contains("body", "Alpha beta")
    exact = {(box, uid) for box, uid, doc in ROWS if "alpha beta" in doc["body"][0].lower()}
    hits = matching.search_body(index, "beta alpha", "and")
    assert {tuple(r) for r in matching.residual_split(hits, messages, condition).collect()} == exact
    assert {tuple(r) for r in matching.residual_split(None, messages, condition).collect()} == exact
    candidates = matching.with_certainty(hits, auto_fuzzy=False)
    asked = []

    def texts_of(keys):
        asked.extend(tuple(r) for r in keys.collect())
        return messages.join(keys, ["box", "uid"], "left_semi")

    assert as_dict(matching.verify_maybe(candidates, texts_of, condition)).keys() == exact
    assert set(asked) == as_dict(hits).keys()
    definite = matching.with_certainty(hits)
    assert matching.verify_maybe(definite, texts_of, condition).count() == hits.count()
    union = matching.residual_split(hits, messages, condition, "or").collect()
    assert len(union) == hits.count() and {tuple(r) for r in union} == as_dict(hits).keys() | exact


def test_tree_of_conditions_equals_brute_force(spark, index):
    messages = raw(spark)
    tests = {"text": matching.contains("body", "alpha beta"), "hot": matching.contains("body", "hot hot")}
    answered = {"a": matching.search_body(index, "alpha"), "s": matching.search_header(index, "subject", "beta")}
    everything = {(box, uid) for box, uid, _ in ROWS}
    found = {name: as_dict(hits).keys() for name, hits in answered.items()}
    for name, part in (("text", "alpha beta"), ("hot", "hot hot")):
        found[name] = {(box, uid) for box, uid, doc in ROWS if part in doc["body"][0].lower()}

    def plain(node):
        below = [plain(part) for part in node.parts]
        if node.op == "not":
            return everything - below[0]
        if node.op == "and":
            return set.intersection(*map(set, below))
        return set().union(*below) if node.op == "or" else set(found[node.op])

    leaf = {name: Node(name) for name in found}
    for tree in (
        Node("or", (leaf["a"], leaf["text"])),
        Node("and", (leaf["a"], Node("not", (leaf["hot"],)))),
        Node("not", (Node("or", (leaf["s"], Node("and", (leaf["text"], leaf["a"])))),)),
    ):
        got = matching.search_tree(tree, answered, tests, messages).collect()
        assert {tuple(r) for r in got} == plain(tree) and len(got) == len(plain(tree))
    with pytest.raises(LookupError):
        matching.search_tree(Node("or", (Node("x"), leaf["a"])), answered, tests, messages)


def test_wildcard_and_fuzzy(index, joins):
    def matches(test, fields):
        return {
            (box, uid): n
            for box, uid, doc in ROWS
            if (n := sum(len({t for v in doc[f] for t in tokens(v) if test(t)}) for f in fields))
        }

    def counted(df):
        return {(r.box, r.uid): r.n_matches for r in df.collect()}

    fields = ["subject", "body"]
    assert counted(matching.search_wildcard(index, "*LT*", fields)) == matches(lambda t: "lt" in t, fields)
    assert counted(matching.search_wildcard(index, "be*", fields)) == matches(lambda t: t.startswith("be"), fields)
    assert counted(matching.search_wildcard(index, "*%*", fields)) == {}
    assert counted(matching.search_fuzzy(index, "bata", fields)) == matches(lambda t: t == "beta", fields)
    assert counted(matching.search_fuzzy(index, "zzzz", fields)) == {}


def test_top_with_many_slices(spark, index):
    hits = matching.search_body(index, "alpha hot").cache()
    for limit in (1, 3, 1000, None):
        got = {(r.box, r.rank): r.uid for r in ranking.top_per_box(hits, limit, bits=2).collect()}
        want = {}
        for box in ("big", "small", "one"):
            best = sorted((r for r in hits.collect() if r.box == box), key=lambda r: (-r.score, r.uid))[:limit]
            want |= {(box, i + 1): r.uid for i, r in enumerate(best)}
        assert got == want


def test_cap_is_next_uid_or_ten_thousand(spark):
    hits = spark.range(1, 30_001).select(F.lit("b").alias("box"), F.col("id").alias("uid"), F.lit(1.0).alias("score"))
    for uidnext, cap in ((5, 5), (20_000, 10_000)):
        boxes = spark.createDataFrame([("b", uidnext)], "box string, uidnext bigint")
        assert ranking.top_per_box(hits, ranking.RESULT_CAP, uidnext=boxes, bits=10).count() == cap
    assert ranking.top_per_box(hits, bits=10).agg(F.max("rank")).first()[0] == 30_000


def test_batch_of_one_equals_single_search(spark, index, joins):
    data = [
        (1, "alpha beta", ["subject", "body"], "or"),
        (2, "hot alpha", ["body"], "and"),
        (3, "hot hot", ["body"], "and"),
        (4, "", ["body"], "or"),
    ]
    queries = spark.createDataFrame(data, "query_id bigint, value string, fields array<string>, operator string")
    fields = queries.select("query_id", F.explode("fields").alias("field"))
    found = ranking.search_batch(index, ranking.batch_terms(queries, fields)).collect()
    assert {r.query_id for r in found} == {1, 2, 3}
    for query_id, value, names, operator in data[:3]:
        want = ranking.top_per_box(matching.search(index, value, names, operator)).collect()
        got = {(r.box, r.uid, r.score, r.rank) for r in found if r.query_id == query_id}
        assert got == {(r.box, r.uid, r.score, r.rank) for r in want}


def test_batch_scores_are_summed_without_a_row_for_each_query_and_word(spark, index, monkeypatch):
    """Also where a task takes few documents at a time and holds few hits; repeated and nameless queries count too."""
    data = [(1, "alpha beta hot", "or"), (2, "beta beta", "or"), (2, "beta alpha", "or"), (None, "hot alpha", "and"), (3, "beta", "and")]
    queries = spark.createDataFrame(data, "query_id bigint, value string, operator string")
    terms = ranking.batch_terms(queries, ["subject", "body"])
    with monkeypatch.context() as patch:
        patch.setattr(slices, "BROADCAST_ROWS", 0)
        want = {limit: sorted(map(str, ranking.search_batch(index, terms, limit).collect())) for limit in (None, 2)}
    assert want[2] and len(want[2]) < len(want[None])
    for cells, held in ((batch_scores.CELLS, batch_scores.HELD), (5, 40), (1, 2)):
        monkeypatch.setattr(batch_scores, "CELLS", cells)
        monkeypatch.setattr(batch_scores, "HELD", held)
        for limit in (None, 2):
            found = ranking.search_batch(index, terms, limit)
            assert sorted(map(str, found.collect())) == want[limit], (cells, held, limit)
    text = plan(ranking.search_batch(index, terms.filter("operator = 'or'"), 2))
    assert not re.search(r"Aggregate\(keys=\[query_id", text)


def test_fields_of_a_table_of_arguments(spark):
    args = spark.createDataFrame(
        [(1, "text", None), (2, "header", "X.Foo"), (2, "body", None), (3, "flags", None), (4, "header", "Secret")],
        "query_id bigint, kind string, header string",
    )
    allowed = spark.createDataFrame([("x.FOO",), ("To",)], "header string")

    def resolved(allowlist):
        return {(r.query_id, r.field) for r in ranking.argument_fields(args, allowlist).collect()}

    common = {(1, "from"), (1, "to"), (1, "subject"), (1, "body"), (2, "x_foo"), (2, "body"), (3, None)}
    assert resolved(None) == common | {(4, "secret")}
    assert resolved(allowed) == common | {(4, None)}


def ranges(spark, pairs, bits):
    df = spark.createDataFrame(pairs, "box string, uid bigint")
    return sorted(tuple(r) for r in ranking.uid_ranges(df, bits).collect())


def test_uid_ranges(spark):
    assert ranges(spark, [("b", u) for u in (3, 3, 4, 7)], 20) == [("b", 3, 4), ("b", 7, 7)]
    rng = random.Random(5)
    for bits, density in ((1, 30), (2, 60), (3, 95)):
        uids = sorted(u for u in range(1, 100) if rng.randint(0, 99) < density)
        pairs = [(b, u) for u in uids for b in "xy" for _ in range(rng.randint(1, 2))]
        want = []
        for u in uids:
            if want and want[-1][1] == u - 1:
                want[-1][1] = u
            else:
                want.append([u, u])
        assert ranges(spark, pairs, bits) == sorted((b, lo, hi) for b in "xy" for lo, hi in want)


def test_hits_by_box(index):
    hits = matching.search_body(index, "hot")
    got = {r.box: r for r in ranking.hits_by_box(hits).collect()}
    assert got["big"].n_hits == 40 and got["one"].n_ranges == 1
    assert got["big"].max_score == max(r.score for r in hits.collect() if r.box == "big")


def test_replaced_postings_equal_new_build(spark, index, documents):
    gone = documents.filter("box = 'big' and uid % 3 = 0")
    new = spark.createDataFrame([("big", 500, {"body": ["brand new"]}), ("one", 1, {"body": ["again"]})], DOCS)
    kept = documents.join(gone, ["box", "uid"], "left_anti").join(new, ["box", "uid"], "left_anti")
    touched = gone.select("box", "uid").union(new.select("box", "uid"))
    got = postings.replace_postings(index.postings, touched, new)
    want = postings.build_postings(kept.unionByName(new)).select(got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_runs_add_up_to_one_index(spark, index, documents):
    marks = spark.createDataFrame([], "box string, last_indexed_uid bigint")
    start = documents.filter("box = 'big' and uid <= 30")
    root = shared.new_folder(spark, "test-part")
    index_tables.write_index(start, root)
    first = index_tables.read_index(spark, root)
    merged, reached = index_run.index_new(documents, marks, first)
    highest = {}
    for box, uid, _ in ROWS:
        highest[box] = max(uid, highest.get(box, 0))
    assert {r.box: r.last_indexed_uid for r in reached.collect()} == highest
    for value, operator in (("alpha beta", "or"), ("hot alpha", "and")):
        got = as_dict(matching.search(merged, value, ["body", "x_foo"], operator))
        assert got == as_dict(matching.search(index, value, ["body", "x_foo"], operator))
    queries = spark.createDataFrame([(1, "alpha")], "query_id bigint, value string")
    found = ranking.search_batch(merged, ranking.batch_terms(queries, ["body"]))
    assert as_dict(found) == as_dict(matching.search(index, "alpha", ["body"]))
    # A run without new messages changes nothing.
    again, still = index_run.index_new(documents, reached, merged)
    assert {r.box: r.last_indexed_uid for r in still.collect()} == highest
    assert as_dict(matching.search_body(again, "alpha")) == as_dict(matching.search_body(index, "alpha"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_reads_pruned_postings_and_no_text(index):
    text = plan(matching.search_body(index, "alpha"))
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert schemas and not any("value" in schema or "body" in schema for schema in schemas)
    assert "term_bucket" in re.findall(r"PartitionFilters: \[([^\]]*)\]", text)[0]
    assert "EqualTo(term,alpha)" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_top_search_shuffles_postings_once(index):
    queries = index.keys.sparkSession.createDataFrame([(1, "alpha"), (2, "beta")], "query_id bigint, value string")
    text = plan(ranking.search_batch(index, ranking.batch_terms(queries), 10))
    assert "term_bucket" in re.findall(r"PartitionFilters: \[([^\]]*)\]", text)[0]
    # One for the postings, one for the hits that are left of each slice.
    assert text.count("Exchange hashpartitioning") == 2
    text = plan(ranking.search_top(index, "alpha", ["body"], limit=ranking.RESULT_CAP))
    # The uids of a box come from the table with one row per box, never from the keys.
    assert text.count("REPARTITION_BY_COL") == 1 and "/keys]" not in text


def test_constants_need_no_job(spark):
    spark.sparkContext.setJobGroup("constants", "constants")
    assert matching.query_words(spark, "It's Alpha, alpha") == ["it", "s", "alpha"]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("constants")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_patterns_are_tested_on_distinct_words(spark, index):
    words = {(r.field, r.term) for r in index.words.collect()}
    dictionary = {(r.field, r.term) for r in index.dictionary.collect()}
    assert words == dictionary and index.words.count() == len(words)
    text = plan(index.words.filter(F.col("term").like("%a%")))
    assert "/words]" in text


def test_index_build_shuffles_no_text(spark, sf_dir):
    from lettersieve.sources import tables

    def shuffled(text):
        # What stands below the exchanges: lists of words, and never the text they come from.
        return [line for line in text.split("\n") if "Exchange" in line]

    text = plan(tables.message_word_lists(spark, sf_dir))
    assert shuffled(text) and text.index("Exchange") < text.index("regexp_extract_all")


def test_verification_reads_texts_after_the_keys(spark, sf_dir):
    from lettersieve.sources import tables

    keys = tables.message_keys(spark, sf_dir).select("box", "uid").limit(3)
    found = tables.messages_of(spark, sf_dir, keys)
    assert found.count() == 3 and "BroadcastHashJoin" in plan(found)


def test_batch_and_stays_in_documents_with_the_rarest_word(spark, sf_dir, monkeypatch):
    stored = session_index.open_index(spark, sf_dir)
    rare = stored.dictionary.filter("field = 'body' and term <> 'the'").groupBy("term").agg(F.sum("df").alias("n"))
    word = rare.orderBy("n", "term").first().term
    asked = [(1, f"the {word}", "and"), (2, "the of", "and"), (3, "the zzzz9", "and"), (4, "the zzzz9", "or"), (5, word, "or")]
    queries = spark.createDataFrame(asked, "query_id bigint, value string, operator string")
    read = []
    plain = ranking.contributions

    def counted(index, rows, dictionary):
        read.append(rows.select("box", "uid").distinct().count())
        return plain(index, rows, dictionary)

    monkeypatch.setattr(ranking, "contributions", counted)
    # Both ways: queries broadcast, and shuffled with salts.
    for most in (slices.BROADCAST_ROWS, 0):
        monkeypatch.setattr(slices, "BROADCAST_ROWS", most)
        got = {}
        for r in ranking.batch_hits(stored, ranking.batch_terms(queries)).collect():
            got.setdefault(r.query_id, set()).add((r.box, r.uid, r.score))
        for number, value, operator in asked:
            want = {(r.box, r.uid, r.score) for r in matching.search(stored, value, operator=operator).collect()}
            assert got.get(number, set()) == want, (number, most)
        assert got[2] and 3 not in got
    read.clear()
    ranking.batch_hits(stored, ranking.batch_terms(queries.filter("query_id = 1"), ["body"]))
    held = stored.postings.filter(F.col("field").eqNullSafe("body") & (F.col("term") == word)).count()
    assert read == [held]
