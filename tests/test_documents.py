import json

from pyspark.sql import functions as F

from lettersieve.functions import text
from lettersieve.operators import documents
from lettersieve.sources import bulk, responses

EVENTS = "box string, uid bigint, seq bigint, key_type string, hdr_name string, value string"


def events(spark, *rows):
    return spark.createDataFrame([("b", 1, i, *row) for i, row in enumerate(rows)], EVENTS)


def assembled(spark, *rows, parts="first"):
    found = documents.assemble(events(spark, *rows), parts).collect()
    return found[0].fields if found else None


def test_headers_are_lower_cased_and_body_is_kept(spark):
    fields = assembled(
        spark,
        ("HDR", "Return-Path", "<ann@example.org>"),
        ("HDR", "Subject", "Test #3"),
        ("HDR", "MIME-Version", "1.0"),
        ("BODY_PART", None, "This is the body of test #3.\n"),
    )
    assert fields == {
        "return-path": ["<ann@example.org>"],
        "subject": ["Test #3"],
        "mime-version": ["1.0"],
        "body": ["This is the body of test #3.\n"],
    }


def test_repeated_header_keeps_order(spark):
    fields = assembled(spark, *[("HDR", "Received", v) for v in ("one", "three", "two")])
    assert fields == {"received": ["one", "three", "two"]}


def test_only_first_body_part_unless_all(spark):
    rows = [("BODY_PART", None, "a"), ("MIME_HDR", "Content-Type", "x"), ("BODY_PART", None, "b")]
    assert assembled(spark, *rows) == {"body": ["a"], "content-type": ["x"]}
    assert assembled(spark, *rows, parts="all") == {"body": ["a", "b"], "content-type": ["x"]}


def test_empty_value_stays_empty_name_goes(spark):
    assert assembled(spark, ("HDR", "Subject", ""), ("HDR", "", "x")) == {"subject": [""]}


def test_names_are_sanitised_and_collide(spark):
    assert assembled(spark, ("HDR", 'X.Foo#Bar*"', "v")) == {"x_foo_bar__": ["v"]}
    both = events(spark, ("HDR", "X.A", "1"), ("MIME_HDR", "X#A", "2"), ("BODY_PART", None, "t"))
    assert documents.assemble(both).first().fields == {"x_a": ["1", "2"], "body": ["t"]}
    catalog = {row.field: row for row in documents.field_catalog(both).collect()}
    assert (catalog["x_a"].n_docs, catalog["x_a"].n_occurrences, catalog["x_a"].n_raw_names) == (1, 2, 2)
    assert (catalog["body"].n_docs, catalog["body"].n_raw_names) == (1, 0)


def test_header_named_body_shares_the_field(spark):
    rows = [("HDR", "Body", "h1"), ("BODY_PART", None, "p1"), ("BODY_PART", None, "p2"), ("MIME_HDR", "body", "h2")]
    assert assembled(spark, *rows) == {"body": ["h1", "p1", "h2"]}
    long = documents.field_values(events(spark, *rows)).orderBy("pos").collect()
    assert [(r.pos, r.value) for r in long] == [(1, "h1"), (2, "p1"), (3, "h2")]
    long = documents.field_values(events(spark, *rows), "all").orderBy("pos").collect()
    assert [(r.pos, r.value) for r in long] == [(1, "h1"), (2, "p1"), (3, "p2"), (4, "h2")]


def test_control_bytes_and_binary_parts(spark):
    rows = [("HDR", "Subject", "a\x1cb\x1d\x1e\x1f"), ("BODY_PART_BINARY", None, "zz")]
    assert assembled(spark, *rows) == {"subject": ["a0x1Cb0x1D0x1E0x1F"]}


def test_no_events(spark):
    assert assembled(spark) is None
    assert documents.field_values(events(spark)).count() == 0


def test_large_uid(spark):
    df = spark.createDataFrame([("b", 4294967295, 0, "HDR", "Subject", "x")], EVENTS)
    assert documents.assemble(df).first().uid == 4294967295


def test_long_form_with_many_slices_equals_assembled(spark):
    rows = [("HDR", f"h{i % 3}", str(i)) if i % 4 else ("BODY_PART", None, str(i)) for i in range(50)]
    for parts in ("first", "all"):
        want = assembled(spark, *rows, parts=parts)
        got = {}
        for row in documents.field_values(events(spark, *rows), parts, bits=2).orderBy("field", "pos").collect():
            got.setdefault(row.field, []).append(row.value)
            assert row.pos == len(got[row.field])
        assert got == want


def test_changed_values(spark):
    df = spark.createDataFrame([("s", "a\x1cb"), ("s", "plain"), ("t", "")], "field string, value string")
    got = {r.field: (r.n_values, r.n_changed, r.n_bytes_after) for r in documents.changed_values(df).collect()}
    assert got == {"s": (2, 1, 11), "t": (1, 0, 0)}


OPS = "box string, uid bigint, seq bigint, op string, subject string"


def test_export_is_valid_json(spark):
    tricky = 'quote " backslash \\ tab \t newline \n bell \x07 sep \x1c'
    df = spark.createDataFrame([("b", 4294967295, 1, "index", tricky), ("b", 2, 2, "delete", None)], OPS)
    lines = [r.lines for r in bulk.export_lines(df, bulk.document_line(["subject"])).orderBy("seq").collect()]
    action, document = lines[0].split("\n")
    assert json.loads(action) == {"index": {"_index": "b", "_type": "mail", "_id": 4294967295}}
    assert json.loads(document) == {"uid": 4294967295, "box": "b", "subject": tricky.replace("\x1c", "0x1C")}
    assert json.loads(lines[1]) == {"delete": {"_index": "b", "_type": "mail", "_id": 2}}


def test_export_of_assembled_documents(spark):
    df = documents.assemble(events(spark, ("HDR", "A", "{x}"), ("HDR", "A", "y"))).withColumns(
        {"op": F.lit("index"), "seq": F.lit(1)}
    )
    document = bulk.export_lines(df, bulk.document_line_of_map()).first().lines.split("\n")[1]
    assert json.loads(document) == {"uid": 1, "box": "b", "a": ["{x}", "y"]}


def test_written_export_is_bounded_and_in_order(spark, tmp_path):
    sizes = spark.range(1, 41).select(F.lit("b").alias("box"), F.col("id").alias("uid"), F.lit(10).alias("bytes"))
    lines = bulk.assign_batches(sizes, 100).withColumn("lines", F.col("uid").cast("string"))
    bulk.write_export(lines, str(tmp_path / "out"), buckets=2)
    folders = sorted(p.name for p in (tmp_path / "out").glob("bucket=*"))
    assert folders and set(folders) <= {"bucket=0", "bucket=1"}
    got = bulk.read_export(spark, str(tmp_path / "out"))
    assert sorted((r.batch, r.uid, r.lines) for r in got.collect()) == [((u - 1) // 10, u, str(u)) for u in range(1, 41)]
    for file in (tmp_path / "out").glob("bucket=*/*.parquet"):
        rows = [(r.batch, r.uid) for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows)


def test_export_of_batches(spark):
    docs = documents.assemble(events(spark, ("HDR", "A", "12345"), ("BODY_PART", None, "é")))
    row = bulk.export_batches(docs, 100).first()
    assert row.batch == 0 and json.loads(row.lines.split("\n")[1]) == {"uid": 1, "box": "b", "a": ["12345"], "body": ["é"]}
    assert docs.select(bulk.map_bytes()).first()[0] == 7


def test_chunks_are_joined_in_order(spark):
    rows = [(0, "HDR", "S", 1, "b"), (0, "HDR", "S", 0, "a"), (0, "HDR", "S", 2, ""), (1, "HDR", "T", 0, ""), (2, "BODY_PART", None, 0, None), (2, "BODY_PART", None, 1, "x")]
    df = spark.createDataFrame([("b", 1, *r) for r in rows], "box string, uid bigint, seq bigint, key_type string, hdr_name string, chunk int, value string")
    assert documents.assemble(documents.join_chunks(df)).first().fields == {"s": ["ab"], "t": [""], "body": ["x"]}


def test_batches_keep_their_bound(spark):
    import random

    rng = random.Random(3)
    rows = [(b, uid, rng.randint(0, 60)) for b in "xy" for uid in rng.sample(range(200), 80)]
    df = spark.createDataFrame(rows, "box string, uid bigint, bytes bigint")
    got = bulk.assign_batches(df, 100, bits=3).collect()
    assert len(got) == len(rows)
    for box in "xy":
        upto = 0
        for row in sorted((r for r in got if r.box == box), key=lambda r: r.uid):
            assert row.batch == upto // 100
            upto += row.bytes
        for batch in {r.batch for r in got if r.box == box}:
            sizes = [r.bytes for r in sorted((r for r in got if r.box == box and r.batch == batch), key=lambda r: r.uid)]
            assert sum(sizes[:-1]) <= 100


def decode(spark, *texts, path="hits.hits"):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return sorted(tuple(r) for r in responses.decode_hits(df, path=path).collect())


def test_hits_with_array_values_and_incomplete_hits(spark):
    one = '{"hits":{"hits":[{"_score":1.5,"_source":{"uid":[3],"box":["b"]}}]}}'
    two = (
        '{"took":3,"hits":{"total":2,"hits":[{"_score":2,"_source":{"box":"b1"}},'
        '{"_id":"7","_score":0.5,"_source":{"uid":7,"box":"b2"}},{"_source":{"uid":8,"box":"b2"}}]}}'
    )
    assert decode(spark, one, two, "not json", "{}") == [("b", 3, 1.5), ("b2", 7, 0.5)]
    assert decode(spark, '{"found":[{"_score":-1,"_source":{"uid":4294967295,"box":"b"}}]}', path="found") == [
        ("b", 4294967295, -1.0)
    ]


def test_responses_from_files(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"hits":{"hits":[{"_score":1,"_source":{"uid":1,"box":"b"}}]}}\n')
    read = responses.read_responses(spark, str(tmp_path / "r.json"))
    assert responses.decode_hits(read).count() == 1


def test_words_and_counts(spark):
    df = spark.createDataFrame([("Été b, a-B 7a",), ("",), (None,), ("--",)], "value string")
    rows = df.select("value", text.words(F.col("value")).alias("w")).select(
        "value", "w", text.term_counts(F.col("w")).alias("c")
    )
    got = {r.value: (r.w, None if r.c is None else [tuple(x) for x in r.c]) for r in rows.collect()}
    assert got["Été b, a-B 7a"] == (["été", "b", "a", "b", "7a"], [("7a", 1), ("a", 1), ("b", 2), ("été", 1)])
    assert got[""] == got[None] == got["--"] == ([], None)


def test_arrays_without_a_first_value_make_a_hit_incomplete(spark):
    hit = '{{"hits":{{"hits":[{{"_score":1,"_source":{{"uid":{uid},"box":{box}}}}}]}}}}'
    cases = [("7", "[]"), ("7", "[null]"), ("[]", '"b"'), ("[null,3]", '"b"'), ("null", '"b"'), ("[4]", '["b","c"]'), ("5", '"[x"')]
    assert decode(spark, *[hit.format(uid=u, box=b) for u, b in cases]) == [("[x", 5, 1.0), ("b", 4, 1.0)]


def test_hits_at_any_depth(spark):
    hit = '{{"_score":{s},"_source":{{"uid":{u},"box":{b}}}}}'
    one, two, three = (hit.format(s=s, u=u, b=b) for s, u, b in ((1.5, "[3]", '"a"'), (2, '"4"', '["b","c"]'), (0.5, 5, '"a"')))
    inner = '{"_score":3.5,"_source":{"uid":6,"box":"d","hits":[' + three + "]}}"
    texts = [
        '{"hits":{"hits":[' + one + "]}}",
        '[[null,7,"x",{"responses":[{"r":[' + two + "]}]}]]",
        '{"a":{"b":{"c":{"d":' + inner + "}}}}",
        '{"_score":1,"_source":{"uid":[],"box":"a"}}',
        '{"_score":null,"_source":{"uid":1,"box":"a"}}',
        '{"_score":1,"_source":7}',
        "[]", "{}", "null", "no json", None, '{"a":1,"a":2}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = sorted(tuple(r) for r in responses.walk_hits(df).collect())
    assert got == [("a", 3, 1.5), ("a", 5, 0.5), ("b", 4, 2.0), ("d", 6, 3.5)]
    assert responses.walk_hits(df.limit(0)).collect() == []


def test_text_export_is_one_line_for_each_action_and_document(spark, tmp_path):
    rows = [("b", u, {"subject": [f"line\nbreak\r{u}"]}) for u in range(1, 30)]
    docs = spark.createDataFrame(rows, "box string, uid bigint, fields map<string,array<string>>")
    bulk.write_text(bulk.export_batches(docs, 40), str(tmp_path / "out"), buckets=3)
    lines = [json.loads(r.line) for r in bulk.read_text(spark, str(tmp_path / "out")).collect()]
    assert len(lines) == 58 and {x["uid"]: x["subject"] for x in lines if "uid" in x} == {u: f["subject"] for _, u, f in rows}
    for file in (tmp_path / "out").glob("bucket=*/*.txt"):
        text_lines = [json.loads(x) for x in file.read_text(newline="").split("\n") if x]
        for action, document in zip(text_lines[::2], text_lines[1::2], strict=True):
            assert action["index"]["_id"] == document["uid"]
