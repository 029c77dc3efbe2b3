"""The registered queries. Each takes (spark, sf_dir) and covers the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.operators import documents, matching, postings, range_sets, ranking, slices, upkeep, word_lookup
from lettersieve.operators.matching import HEADER_KINDS, Arg, Node
from lettersieve.plans import index_run, index_store
from lettersieve.plans.session_index import open_index
from lettersieve.sources import bulk, index_tables, responses, shared, tables
from lettersieve.streaming import assembly, ops_log

VALUE = "the of ertion"
SECOND_VALUE = "la queeux"
MULTI_VALUE = "the src3 example"
ALLOWLIST_VALUE = "list the"
BATCH_LIMIT = 20_000
TOP = 10
DELIVERIES = 3
MISSED = "click"
MARKED = tables.MARKED
EXPORT_LIMIT = 3_000
UPDATED_VALUE = "the of click"
STREAM_VALUE = "click signup 7"
ALLOWED_HEADERS = ("From", "Subject")
RESIDUAL_VALUE = "en-list"
EXACT_VALUE = "the of"
RANGE_PATTERNS = ("*ertion*", "*th*")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


# Documents


@query
def assemble_documents(spark, sf_dir):
    return documents.field_values(tables.build_events(spark, sf_dir))


@query
def assemble_documents_all_parts(spark, sf_dir):
    return documents.field_values(tables.build_events(spark, sf_dir), parts="all")


@query
def body_first_part(spark, sf_dir):
    return documents.body_first_part(tables.build_events(spark, sf_dir))


@query
def normalize_fields(spark, sf_dir):
    return documents.normalized_names(tables.build_events(spark, sf_dir))


@query
def sanitize_values(spark, sf_dir):
    return documents.changed_values(tables.marked_values(spark, sf_dir))


@query
def field_catalog(spark, sf_dir):
    return documents.field_catalog(tables.build_events(spark, sf_dir))


@query
def bulk_export(spark, sf_dir):
    return bulk.export_lines(tables.ops(spark, sf_dir), bulk.document_line(["subject", "body"]))


@query
def bulk_batches(spark, sf_dir):
    # Stored, as batches take two passes over the sizes: the texts are read once.
    sizes = shared.stored(tables.messages(spark, sf_dir, bulk.value_bytes(tables.MESSAGE_COLUMNS).alias("bytes")))
    return bulk.assign_batches(sizes, BATCH_LIMIT).select("box", "uid", "batch")


def search_responses(messages: DataFrame) -> DataFrame:
    """Responses of ten hits at most, as JSON texts in a column ``value``.

    Odd uids come as arrays. Boxes come plain or as arrays, and of every seven hits one lacks
    its box, one has an empty array and one an array with a null.
    """
    uid = F.col("uid").cast("string")
    uid_json = F.when(F.col("uid") % 2 == 1, F.concat(F.lit("["), uid, F.lit("]"))).otherwise(uid)
    kind = F.col("uid") % 7
    box_json = (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.lit(',"box":[]'))
        .when(kind == 2, F.lit(',"box":[null]'))
        .when(kind == 3, F.concat(F.lit(',"box":"'), "box", F.lit('"')))
        .otherwise(F.concat(F.lit(',"box":["'), "box", F.lit('"]')))
    )
    score = (F.col("bytes") / F.lit(8.0)).cast("string")
    hit = F.concat(F.lit('{"_score":'), score, F.lit(',"_source":{"uid":'), uid_json, box_json, F.lit("}}"))
    grouped = messages.groupBy("box", F.expr("uid div 10").alias("page")).agg(F.collect_list(hit).alias("found"))
    return grouped.select(
        F.concat(F.lit('{"took":1,"hits":{"hits":['), F.array_join("found", ","), F.lit("]}}")).alias("value")
    )


@query
def decode_hits(spark, sf_dir):
    return responses.decode_hits(search_responses(tables.messages(spark, sf_dir, F.octet_length("body").alias("bytes"))))


@query
def assemble_chunks(spark, sf_dir):
    """Documents from events whose values arrive in pieces."""
    return documents.field_values(documents.join_chunks(tables.chunk_events(spark, sf_dir)))


@query
def bulk_export_batches(spark, sf_dir):
    """Assembled documents written for export and read again: batch number and lines."""
    path = shared.new_folder(spark, "export")
    assembled = shared.stored(documents.assemble(tables.build_events(spark, sf_dir)))
    bulk.write_export(bulk.export_batches(assembled, EXPORT_LIMIT), path)
    return bulk.read_export(spark, path).select("box", "uid", "batch", "lines")


def nested_responses(messages: DataFrame) -> DataFrame:
    """``search_responses`` with the list of hits at three depths, among values that are no hits."""
    plain = search_responses(messages).select(F.expr("substring(value, 26, length(value) - 27)").alias("list"))
    kind = F.pmod(F.xxhash64("list"), F.lit(3))
    return plain.select(
        F.when(kind == 0, F.concat(F.lit('{"took":1,"hits":{"hits":'), "list", F.lit("}}")))
        .when(kind == 1, F.concat(F.lit('[null,{"responses":[{"status":200,"hits":{"max":null,"hits":'), "list", F.lit("}},7]}]")))
        .otherwise(F.concat(F.lit('{"groups":[[{"key":"_score","top":{"found":['), "list", F.lit(']}}],["uid",{}]],"_score":null}')))
        .alias("value")
    )


@query
def decode_hits_nested(spark, sf_dir):
    """Hits at any depth of the responses."""
    sizes = tables.messages(spark, sf_dir, F.octet_length("body").alias("bytes"))
    return responses.walk_hits(nested_responses(sizes))


@query
def bulk_export_text(spark, sf_dir):
    """Assembled documents written as text files of JSON lines and read again, line by line."""
    path = shared.new_folder(spark, "export-text")
    assembled = shared.stored(documents.assemble(tables.build_events(spark, sf_dir)))
    bulk.write_text(bulk.export_batches(assembled, EXPORT_LIMIT), path)
    return bulk.read_text(spark, path)


@query
def assemble_stream(spark, sf_dir):
    """Documents from chunks that come as a stream in three deliveries, out of order and across their borders."""
    root = shared.new_folder(spark, "assembly")
    chunks = tables.sent_chunks(spark, sf_dir)
    arrived = F.unix_timestamp("arrived_at")
    first, last = chunks.agg(F.min(arrived), F.max(arrived)).first()
    place = (arrived - F.lit(first or 0)) * DELIVERIES / F.lit((last or 0) - (first or 0) + 1)
    parts = shared.stored(chunks.withColumn("part", F.floor(place)), "deliveries")
    columns = spark.createDataFrame([], assembly.CHUNKS).columns
    for number in range(DELIVERIES):
        parts.filter(F.col("part") == number).select(columns).write.mode("append").parquet(f"{root}/in")
        assembly.run(spark, root)
    # A chunk of a later day closes all documents; its own stays open.
    later = parts.agg((F.max("sent_at") + F.expr("interval 1 day")).alias("sent_at"))
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in parts.select(columns).schema if f.name != "sent_at"]
    later.select(*absent, "sent_at").select(columns).write.mode("append").parquet(f"{root}/in")
    assembly.run(spark, root)
    return documents.field_values(documents.join_chunks(assembly.chunks_of(assembly.completed(spark, root))))


# Upkeep


def _apply_ops_columns(df: DataFrame) -> DataFrame:
    return df.select("box", "uid", "seq", "subject", "body")


@query
def apply_ops(spark, sf_dir):
    return _apply_ops_columns(upkeep.apply_ops(tables.ops(spark, sf_dir).drop("ts")))


@query
def expunge(spark, sf_dir):
    keys = tables.message_keys(spark, sf_dir).select("box", "uid")
    return upkeep.expunge(keys, tables.expunges(spark, sf_dir))


@query
def apply_ops_stream(spark, sf_dir):
    root = shared.new_folder(spark, "ops-log")
    schema = tables.table(spark, sf_dir, "events").schema
    # As a pattern the path may be one file or a folder of files; a stream takes no plain file.
    events = ops_log.read_action_files(spark, f"{sf_dir}/{{events}}.parquet", schema)
    ops = tables.ops_from_events(events).drop("ts")
    ops_log.append_to_log(ops, f"{root}/log", f"{root}/progress").awaitTermination()
    return _apply_ops_columns(ops_log.current_documents(spark, f"{root}/log", ops.schema))


@query
def last_uid(spark, sf_dir):
    keys = tables.message_keys(spark, sf_dir)
    return upkeep.last_uid(upkeep.boxes_of(keys), tables.checkpoints(spark, sf_dir), keys)


def _backlog_of_first_run(spark, sf_dir) -> DataFrame:
    # The first run: nothing is indexed yet, so only checkpoints count.
    keys = tables.message_keys(spark, sf_dir)
    return upkeep.index_backlog(keys, tables.checkpoints(spark, sf_dir), keys.filter(F.lit(False)))


@query
def index_backlog(spark, sf_dir):
    return _backlog_of_first_run(spark, sf_dir)


@query
def advance_checkpoints(spark, sf_dir):
    return upkeep.advance_checkpoints(tables.checkpoints(spark, sf_dir), _backlog_of_first_run(spark, sf_dir))


@query
def rescan(spark, sf_dir):
    keys = tables.message_keys(spark, sf_dir)
    return upkeep.index_backlog(keys, upkeep.rescan(tables.checkpoints(spark, sf_dir)), keys.filter(F.lit(False)))


@query
def index_gaps(spark, sf_dir):
    """The index lost the expunged messages and has documents of unknown boxes."""
    keys = tables.message_keys(spark, sf_dir).select("box", "uid")
    indexed = upkeep.expunge(keys, tables.expunges(spark, sf_dir))
    strays = upkeep.apply_ops(tables.ops(spark, sf_dir).select("box", "uid", "seq", "op"))
    return upkeep.index_gaps(keys, indexed.unionByName(strays.select("box", "uid")))


@query
def content_audit(spark, sf_dir):
    """What an index that missed all actions of one kind has wrong: missing, changed and stray documents."""
    actions = tables.ops(spark, sf_dir).drop("ts")
    current = upkeep.apply_ops(actions)
    indexed = upkeep.apply_ops(actions.filter(F.col("subject") != MISSED))
    return upkeep.content_audit(current, indexed, ["subject", "body"])


@query
def update_postings(spark, sf_dir):
    """Postings after the flagged messages were removed and the action documents indexed."""
    index = open_index(spark, sf_dir)
    updated = apply_ops(spark, sf_dir)
    touched = tables.expunges(spark, sf_dir).unionByName(updated.select("box", "uid"))
    return postings.replace_postings(index.postings, touched, updated.select("box", "uid", _action_fields().alias("fields")))


def _stored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    with shared.brief_shuffles(spark):
        return shared.stored(tables.message_documents(spark, sf_dir), "messages")


@query
def search_after_runs(spark, sf_dir):
    """Search after two indexing runs: messages up to the checkpoints first, then the rest."""
    everything = _stored_messages(spark, sf_dir)
    checkpoints = tables.checkpoints(spark, sf_dir)
    reached = checkpoints.withColumn("max_uid", F.col("last_indexed_uid"))
    before = slices.join_by_box(everything, reached, ["box"], "max_uid").filter("uid <= last_indexed_uid")
    root = shared.new_folder(spark, "index-first")
    index_tables.write_index(before.select(everything.columns), root)
    index, _ = index_run.index_new(everything, checkpoints, index_tables.read_index(spark, root))
    return matching.search_body(index, VALUE)


def _runs(spark: SparkSession, sf_dir: str) -> tuple[index_store.Store, DataFrame]:
    """A stored index after two runs: messages up to the checkpoints, then the rest; and all messages."""
    everything = _stored_messages(spark, sf_dir)
    checkpoints = tables.checkpoints(spark, sf_dir)
    reached = checkpoints.withColumn("max_uid", F.col("last_indexed_uid"))
    before = slices.join_by_box(everything, reached, ["box"], "max_uid").filter("uid <= last_indexed_uid")
    store = index_store.create(spark, shared.new_folder(spark, "index-store"))
    store = index_store.run(store, before.select(everything.columns), checkpoints=checkpoints)
    return index_store.index_new(store, everything), everything


@query
def stored_checkpoints(spark, sf_dir):
    """The checkpoints that a store opened anew has after two runs."""
    store, _ = _runs(spark, sf_dir)
    return index_store.open_store(spark, store.root).checkpoints


@query
def search_after_rescan(spark, sf_dir):
    """Search after everything was indexed a second time: every document is there once."""
    store = index_store.rescan(*_runs(spark, sf_dir))
    found = [matching.search_body(store.index, VALUE, op).withColumn("operator", F.lit(op)) for op in ("and", "or")]
    return found[0].unionByName(found[1])


def _action_fields() -> Column:
    return F.create_map(F.lit("subject"), F.array("subject"), F.lit("body"), F.array("body"))


@query
def search_after_updates(spark, sf_dir):
    """Search in an index after flagged messages were removed and action documents indexed."""
    first = open_index(spark, sf_dir)
    documents_ = shared.stored(apply_ops(spark, sf_dir).select("box", "uid", _action_fields().alias("fields")))
    touched = tables.expunges(spark, sf_dir).unionByName(documents_.select("box", "uid"))
    index = postings.updated(first, postings.index_of(documents_), touched)
    return matching.search(index, UPDATED_VALUE, ["subject", "body"])


@query
def search_after_many_runs(spark, sf_dir):
    """As ``search_after_updates``, by a store: four runs over the messages and one that removes and replaces."""
    everything = _stored_messages(spark, sf_dir)
    store = index_store.create(spark, shared.new_folder(spark, "index-runs"))
    for number in range(4):
        store = index_store.run(store, everything.filter(F.col("uid") % 4 == number), most_parts=2)
    documents_ = shared.stored(apply_ops(spark, sf_dir).select("box", "uid", _action_fields().alias("fields")))
    store = index_store.run(store, documents_, tables.expunges(spark, sf_dir), most_parts=2)
    return matching.search(store.index, UPDATED_VALUE, ["subject", "body"])


@query
def expunged_words(spark, sf_dir):
    """What the dictionary loses by the flagged messages, from the forward table."""
    lost = postings.losses(open_index(spark, sf_dir), tables.expunges(spark, sf_dir))
    return lost.dictionary.drop("term_bucket")


@query
def search_after_stream(spark, sf_dir):
    """Search in an index that follows a stream of actions, which come in three batches out of order."""
    root = shared.new_folder(spark, "stream")
    events = tables.table(spark, sf_dir, "events")
    part = (F.col("event_id") % 3).alias("part")
    schema = tables.ops_from_events(events).drop("ts").schema
    after = ops_log.indexing(spark, root, schema, _action_fields())
    for number in range(3):  # the stream goes on from its progress, so each delivery is a batch
        events.filter(part == number).write.mode("append").parquet(f"{root}/in")
        ops = tables.ops_from_events(ops_log.read_action_files(spark, f"{root}/in", events.schema)).drop("ts")
        ops_log.append_to_log(ops, f"{root}/log", f"{root}/progress", after).awaitTermination()
    store = index_store.open_store(spark, f"{root}/index")
    return matching.search(store.index, STREAM_VALUE, ["subject", "body"])


# Index and search


@query
def search_assembled(spark, sf_dir):
    """From events to hits: assembled, indexed, searched."""
    root = shared.new_folder(spark, "index-assembled")
    index_tables.write_index(documents.assemble(tables.build_events(spark, sf_dir)), root)
    return matching.search(index_tables.read_index(spark, root), VALUE, ["subject", "x-reply_part", "body"])


@query
def build_postings(spark, sf_dir):
    return postings.postings_of(tables.message_word_lists(spark, sf_dir))


@query
def term_dictionary(spark, sf_dir):
    return open_index(spark, sf_dir).dictionary.drop("term_bucket")


@query
def field_stats(spark, sf_dir):
    return open_index(spark, sf_dir).field_stats


@query
def search_text(spark, sf_dir):
    return matching.search_text(open_index(spark, sf_dir), VALUE)


@query
def search_body(spark, sf_dir):
    return matching.search_body(open_index(spark, sf_dir), VALUE)


@query
def search_header(spark, sf_dir):
    return matching.search_header(open_index(spark, sf_dir), "Subject", VALUE)


@query
def search_multi_field(spark, sf_dir):
    nested = [Arg("none", children=(Arg("header", "From"), Arg("header", "Subject"))), Arg("body")]
    return matching.search_args(open_index(spark, sf_dir), nested, MULTI_VALUE)


@query
def search_operator(spark, sf_dir):
    index = open_index(spark, sf_dir)
    found = [matching.search_text(index, VALUE, op).withColumn("operator", F.lit(op)) for op in ("and", "or")]
    return found[0].unionByName(found[1])


@query
def search_not(spark, sf_dir):
    hits = matching.search_args(open_index(spark, sf_dir), [Arg("body", negated=True)], VALUE, "and")
    return hits.select("box", "uid")


@query
def search_header_kinds(spark, sf_dir):
    """Addresses and compressed white space are other kinds of header search, on the same fields."""
    args = [Arg("header_address", "From"), Arg("header_compress_lwsp", "Subject")]
    return matching.search_args(open_index(spark, sf_dir), args, MULTI_VALUE, allowed_headers=ALLOWED_HEADERS)


@query
def search_not_nested(spark, sf_dir):
    """The negation of a parent holds for the arguments below it."""
    args = [Arg("or", negated=True, children=(Arg("header", "Subject"), Arg("body")))]
    return matching.search_args(open_index(spark, sf_dir), args, VALUE, "and").select("box", "uid")


@query
def search_combine_args(spark, sf_dir):
    index = open_index(spark, sf_dir)
    first = matching.search_body(index, VALUE, "and")
    second = matching.search_header(index, "Subject", SECOND_VALUE)
    found = [matching.combine(first, second, op).withColumn("operator", F.lit(op)) for op in ("and", "or")]
    return found[0].unionByName(found[1])


@query
def search_header_allowlist(spark, sf_dir):
    args = [Arg("header", "Subject"), Arg("header", "To")]
    return matching.search_args(open_index(spark, sf_dir), args, ALLOWLIST_VALUE, allowed_headers=ALLOWED_HEADERS)


@query
def residual_split(spark, sf_dir):
    """BODY is answered by the index; the header To is not indexed, so the messages of hits are tested."""
    hits = matching.search_body(open_index(spark, sf_dir), VALUE, "and")
    residual = matching.contains("h_to", RESIDUAL_VALUE)
    return matching.residual_of_hits(hits, lambda keys: tables.messages_of(spark, sf_dir, keys), residual)


@query
def residual_or(spark, sf_dir):
    """BODY from the index, or a header that is not indexed and not another one: one scan decides."""
    hits = matching.search_body(open_index(spark, sf_dir), VALUE, "and")
    tests = {"to": matching.contains("h_to", RESIDUAL_VALUE), "from": matching.contains("h_from", "src1")}
    both = Node("and", (Node("not", (Node("to"),)), Node("from")))
    messages = tables.messages(spark, sf_dir, "h_to", "h_from")
    return matching.search_tree(Node("or", (Node("body"), both)), {"body": hits}, tests, messages)


@query
def residual_scan(spark, sf_dir):
    """No argument can be answered by the index: a plain scan of the messages."""
    residual = matching.contains("h_to", RESIDUAL_VALUE)
    return matching.residual_split(None, tables.messages(spark, sf_dir, "h_to"), residual)


@query
def verify_maybe(spark, sf_dir):
    hits = matching.with_certainty(matching.search_body(open_index(spark, sf_dir), EXACT_VALUE, "and"), False)
    return matching.verify_maybe(
        hits, lambda keys: tables.messages_of(spark, sf_dir, keys), matching.contains("body", EXACT_VALUE)
    )


@query
def search_wildcard(spark, sf_dir):
    return matching.search_wildcard(open_index(spark, sf_dir), "*Erti*", ["subject", "body"])


@query
def search_fuzzy(spark, sf_dir):
    return matching.search_fuzzy(open_index(spark, sf_dir), "ertion", ["subject", "body"], 1)


def _lookup(spark, index, fields, table) -> word_lookup.Lookup:
    root = shared.new_folder(spark, "lookup")
    word_lookup.write_lookup(index.words.filter(F.col("field").isin(*fields)), root, [table])
    return word_lookup.read_lookup(spark, root, [table])


@query
def search_wildcard_grams(spark, sf_dir):
    """As search_wildcard, with words found by their trigrams."""
    index = open_index(spark, sf_dir)
    fields = ["subject", "body"]
    return word_lookup.search_wildcard(index, _lookup(spark, index, fields, "grams"), "*Erti*", fields)


@query
def search_fuzzy_spellings(spark, sf_dir):
    """As search_fuzzy at distance 2, with words found by shared pieces."""
    index = open_index(spark, sf_dir)
    fields = ["subject", "body"]
    return word_lookup.search_fuzzy(index, _lookup(spark, index, fields, "pieces"), "ertion", fields, 2)


# Ranking and results


@query
def score_hits(spark, sf_dir):
    """Scores by field, before the best field is taken."""
    scored = matching.field_scores(open_index(spark, sf_dir), VALUE)
    return scored.withColumn("score", F.round("score", 6))


@query
def search_topk(spark, sf_dir):
    """The ten best hits of each box."""
    return ranking.search_top(open_index(spark, sf_dir), VALUE, ["body"], limit=TOP)


@query
def search_capped(spark, sf_dir):
    """As ``search_topk``, with the usual cap: the next uid of the box, or 10,000 if less."""
    return ranking.search_top(open_index(spark, sf_dir), VALUE, limit=ranking.RESULT_CAP)


@query
def hits_by_box(spark, sf_dir):
    return ranking.hits_by_box(matching.search_body(open_index(spark, sf_dir), VALUE))


@query
def uid_ranges(spark, sf_dir):
    return ranking.uid_ranges(matching.search_wildcard(open_index(spark, sf_dir), "*ertion*", ["body"]))


@query
def range_algebra(spark, sf_dir):
    """Union, intersection and difference of the ranges of two searches."""
    index = open_index(spark, sf_dir)
    left, right = (
        shared.stored(ranking.uid_ranges(matching.search_wildcard(index, pattern, ["body"])), "ranges")
        for pattern in RANGE_PATTERNS
    )
    found = [
        range_sets.combined(left, right, name).select(F.lit(name).alias("operation"), "box", "uid_lo", "uid_hi")
        for name in range_sets.OPERATIONS
    ]
    return found[0].union(found[1]).union(found[2])


@query
def search_multi_box(spark, sf_dir):
    """One text search over all boxes; statistics and the best hits are per box."""
    hits = matching.search(open_index(spark, sf_dir), VALUE, operator="and")
    return ranking.top_per_box(hits)


@query
def search_batch(spark, sf_dir):
    """The best hits of each query in each box: as many as the box's next uid says, or 10,000 if that is less."""
    terms = ranking.batch_terms(tables.query_batch(spark, sf_dir))
    return ranking.search_batch(open_index(spark, sf_dir), terms, ranking.RESULT_CAP)


@query
def search_batch_top(spark, sf_dir):
    """The ten best hits of each query in each box."""
    terms = ranking.batch_terms(tables.query_batch(spark, sf_dir))
    return ranking.search_batch(open_index(spark, sf_dir), terms, TOP)


@query
def search_batch_body_and(spark, sf_dir):
    """Every body that holds all words of a query of the batch."""
    terms = ranking.batch_terms(tables.query_batch(spark, sf_dir), ["body"], "and")
    return ranking.search_batch(open_index(spark, sf_dir), terms)


def batch_arguments(queries: DataFrame) -> DataFrame:
    """(query_id, arg_no, kind, header): the arguments of each query of the batch.

    Every query has three: a subject header of one of the header kinds, a body or a text, and one that the index
    cannot answer (flags, or a header that is not in the allowlist).
    """
    even = F.col("query_id") % 2 == 0
    kind = F.element_at(F.array(*map(F.lit, HEADER_KINDS)), (F.col("query_id") % 3 + 1).cast("int"))
    second = F.when(even, "body").otherwise("text")
    third = F.when(even, "flags").otherwise("header")
    arguments = F.array(
        F.struct(F.lit(1).alias("arg_no"), kind.alias("kind"), F.lit("SUBJECT").alias("header")),
        F.struct(F.lit(2).alias("arg_no"), second.alias("kind"), F.lit(None).cast("string").alias("header")),
        F.struct(F.lit(3).alias("arg_no"), third.alias("kind"), F.when(~even, "X.Secret").alias("header")),
    )
    return queries.select("query_id", F.inline(arguments))


def _allowlist(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, ALLOWED_HEADERS))).alias("header"))


@query
def split_arguments(spark, sf_dir):
    """Which field each argument searches; none where the messages have to be tested."""
    args = batch_arguments(tables.query_batch(spark, sf_dir))
    found = ranking.argument_fields(args, _allowlist(spark)).withColumn("is_indexed", F.col("field").isNotNull())
    return found.fillna("", ["header", "field"])


@query
def search_batch_arguments(spark, sf_dir):
    """The batch with its own fields for each query, every word needed."""
    queries = tables.query_batch(spark, sf_dir)
    fields = ranking.argument_fields(batch_arguments(queries), _allowlist(spark))
    return ranking.search_batch(open_index(spark, sf_dir), ranking.batch_terms(queries, fields, "and"))
