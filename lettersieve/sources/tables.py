"""The given tables read as messages, build events, actions, checkpoints and queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lettersieve.functions import text
from lettersieve.operators import postings, slices
from lettersieve.sources.shared import stored

# Characters of the texts that ``marked_values`` replaces by separator control bytes.
MARKED = ".,|#"
CHECKPOINTED_SENDERS = ("%0@%", "%2@%", "%4@%")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, box, uid): uids count the documents of a source by doc_id.

    Reads two columns only; no text is shuffled to number the messages.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("source").alias("box"))
    return slices.position(docs, ["box"], "doc_id", "uid", slices.bits_for(docs, "doc_id")).select("doc_id", "box", "uid")


MESSAGE_COLUMNS = ("h_from", "h_to", "subject", "body")


def _message_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts_of(table(spark, sf_dir, "documents"))


def _texts_of(docs: DataFrame, *more: Column | str) -> DataFrame:
    return docs.select(
        "doc_id",
        *more,
        F.concat("source", F.lit("@example.org")).alias("h_from"),
        F.concat("lang", F.lit("-list@example.org")).alias("h_to"),
        F.substring_index("text", "\n", 1).alias("subject"),
        F.col("text").alias("body"),
    )


def messages(spark: SparkSession, sf_dir: str, *columns: Column | str) -> DataFrame:
    """(box, uid, doc_id, h_from, h_to, subject, body), or the given columns for the last four.

    Given columns are computed from the four before anything is shuffled, so that a query
    which needs, say, the size of a text does not shuffle the text.
    """
    docs = _message_texts(spark, sf_dir).select("doc_id", *(columns or MESSAGE_COLUMNS))
    # doc_id is unique, so this join is even whatever the sizes of the boxes and of the
    # files. A merge join can spill, and its shuffle spreads the work on texts that follows
    # even where the texts come from a few files with one row group each.
    return docs.join(message_keys(spark, sf_dir).hint("merge"), "doc_id").select("box", "uid", *docs.columns)


# Field names of the message columns above.
MESSAGE_FIELDS = dict(zip(text.DEFAULT_FIELDS, MESSAGE_COLUMNS, strict=True))


def message_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in document form: (box, uid, fields MAP<STRING, ARRAY<STRING>>)."""
    entries = [x for field, column in MESSAGE_FIELDS.items() for x in (F.lit(field), F.array(column))]
    # Texts are shuffled as they are, and a subject is taken from its text after that.
    numbered = message_keys(spark, sf_dir).hint("merge")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text").join(numbered, "doc_id")
    texts = _texts_of(docs, "box", "uid")
    return texts.select("box", "uid", F.create_map(*entries).alias("fields"))


def message_word_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word lists of all messages: texts are split in the scan, only lists are shuffled."""
    entries = [x for field, column in MESSAGE_FIELDS.items() for x in (F.lit(field), F.array(column))]
    documents = _message_texts(spark, sf_dir).select("doc_id", F.create_map(*entries).alias("fields"))
    lists = postings.word_lists(documents, ["doc_id"])
    joined = lists.join(message_keys(spark, sf_dir).hint("merge"), "doc_id")
    return joined.select("box", "uid", *[c for c in lists.columns if c != "doc_id"])


def message_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, value) of all messages, for work that does not ask whose value it is."""
    pairs = [
        F.struct(F.lit(field).alias("field"), F.col(column).alias("value"))
        for field, column in MESSAGE_FIELDS.items()
    ]
    return _message_texts(spark, sf_dir).select(F.inline(F.array(*pairs)))


def marked_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, value) as ``message_values``, with control bytes in place of some punctuation."""
    marked = F.translate("value", MARKED, "".join(text.CONTROL_TEXTS))
    return message_values(spark, sf_dir).withColumn("value", marked)


def messages_of(spark: SparkSession, sf_dir: str, keys: DataFrame) -> DataFrame:
    """The messages of some (box, uid), with their texts.

    Keys are turned into document ids, all narrow. A small set of ids, by its counted size,
    is broadcast to the scan; beyond that the texts are shuffled by id once.
    """
    wanted = stored(message_keys(spark, sf_dir).join(keys.distinct(), ["box", "uid"], "left_semi"), "wanted")
    ids = F.broadcast(wanted) if slices.is_small(wanted) else wanted.hint("merge")
    return _message_texts(spark, sf_dir).join(ids, "doc_id").select("box", "uid", "doc_id", *MESSAGE_COLUMNS)


def build_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(box, uid, seq, key_type, hdr_name, value): field events of messages."""
    role = F.col("role")
    return table(spark, sf_dir, "conversations").select(
        F.md5((F.col("conv_id") % 10).cast("string")).alias("box"),
        (F.col("conv_id") + 1).alias("uid"),
        F.col("turn").alias("seq"),
        F.when(role == "user", "BODY_PART").when(role == "assistant", "MIME_HDR").otherwise("HDR").alias("key_type"),
        F.when(role == "assistant", "X-Reply.Part").when(role != "user", "Subject").alias("hdr_name"),
        F.col("text").alias("value"),
    )


def chunk_events(spark: SparkSession, sf_dir: str, size: int = 37) -> DataFrame:
    """``build_events`` with every value cut into pieces: also (chunk, value)."""
    pieces = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("value") / size), F.lit(1)) - 1)
    events = build_events(spark, sf_dir).withColumn("chunk", F.explode(pieces))
    return events.withColumn("value", F.substring("value", (F.col("chunk") * size + 1).cast("int"), F.lit(size)))


def sent_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``chunk_events`` with the time each chunk was sent and, up to two minutes later, arrived.

    Messages are sent one every ten seconds, in the order of their uids.
    """
    sent = F.col("uid") * 10 + F.col("seq") % 8
    delay = F.pmod(F.xxhash64("box", "uid", "seq", "chunk"), F.lit(120))
    return chunk_events(spark, sf_dir).withColumns(
        {"sent_at": F.timestamp_seconds(sent), "arrived_at": F.timestamp_seconds(sent + delay)}
    )


def ops_from_events(events: DataFrame) -> DataFrame:
    """(box, uid, seq, ts, op, subject, body). Stateless, so it also runs on a stream."""
    return events.select(
        F.md5((F.col("user_id") % 20).cast("string")).alias("box"),
        (F.col("user_id") + 1).alias("uid"),
        F.col("event_id").alias("seq"),
        "ts",
        F.when(F.col("event_type") == "error", "delete").otherwise("index").alias("op"),
        F.col("event_type").alias("subject"),
        F.col("props").alias("body"),
    )


def ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops_from_events(table(spark, sf_dir, "events"))


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(box, last_indexed_uid) for some boxes: half of the messages are indexed.

    A box is one source, so the count of its documents is its highest uid.
    """
    sender = F.concat("source", F.lit("@example.org"))
    wanted = F.lit(False)
    for pattern in CHECKPOINTED_SENDERS:
        wanted = wanted | sender.like(pattern)
    return (
        table(spark, sf_dir, "documents")
        .filter(wanted)
        .groupBy(F.md5("source").alias("box"))
        .agg(F.expr("count(*) div 2").alias("last_indexed_uid"))
    )


def expunges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(box, uid) of messages to remove."""
    flagged = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id")
    return message_keys(spark, sf_dir).join(flagged, "doc_id", "left_semi").select("box", "uid")


def query_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, value): each benchmark text as a search value."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("value"))
