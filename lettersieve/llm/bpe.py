"""BPE encoding and decoding through a table of distinct words.

Texts are split by the tokenizer's own rule. Each block of documents (see ``blocks``) asks for
the ids of its distinct words, numbered in their order. The asked words are shuffled by word and
sorted, so that every distinct word of the corpus is encoded once, and its ids go back to all
blocks that asked, under the word's number. There they are put to the words' positions. A word
that occurs everywhere is one row per block, not one per occurrence, and no group is gathered
beyond a block.

Decoding joins ids with the table id -> piece. That table has as many rows as the vocabulary, so
each task looks the pieces up in its own copy; the joined bytes of a row are read as UTF-8,
invalid parts become U+FFFD.

The vocabulary is a file of the ``tokenizers`` library (byte-level BPE with the usual split by
letters, digits, other marks and white space). Its path is a parameter and the file is read on
the driver; it travels to the tasks as a broadcast whose size is that of the file.

Defined results: null and empty texts have no ids; ``decode`` of null or no ids is the empty
text. Strings of special tokens in a text are special tokens, as in the library. Equal words
get equal ids, repeated rows and ties are encoded one by one, an empty table gives an empty
table. Texts of any length are encoded whole; one row has to fit a task. Other columns stay as they
are; if one of them is named like the new column, the new one has underscores before its name. A block carries a mark of its
words; one whose rows were read in another order the second time encodes its words itself, so
results never depend on the order of rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lettersieve.llm import blocks
from lettersieve.llm.common import free_name, ships_its_code

ships_its_code(__name__)

ROWS = 10_000

# Fixed value: the split rule of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Only characters in which no two versions of Unicode differ; texts with others are split by the library.
_PLAIN = "\x00-\u0557\u2010-\u2052\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_alphabet() -> dict[str, int]:
    """Byte of each character in which byte-level vocabularies write it.

    Printable bytes stand for themselves; the others, in order, take the characters from U+0100 on.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_table(vocabulary: str) -> list[bytes]:
    """Bytes of every id; ids without an entry are empty."""
    read = json.loads(vocabulary)
    alphabet = byte_alphabet()
    entries = dict(read["model"]["vocab"])
    found = [b""] * (1 + max([*entries.values(), *(t["id"] for t in read["added_tokens"])]))
    for entry, number in entries.items():
        found[number] = bytes(alphabet[c] for c in entry)
    for token in read["added_tokens"]:
        found[token["id"]] = token["content"].encode()
    return found


class Splitter:
    """Words of a text in order; joined they are the text."""

    def __init__(self, vocabulary: str):
        from tokenizers import pre_tokenizers

        special = [t["content"] for t in json.loads(vocabulary)["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.marks = special
        self.rule = regex.compile(SPLIT)
        self.other = regex.compile(f"[^{_PLAIN}]")
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def plain(self, text: str) -> list[str]:
        if text.isascii() or self.other.search(text) is None:
            return self.rule.findall(text)
        return [text[i:j] for _, (i, j) in self.library.pre_tokenize_str(text)]

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not any(mark in text for mark in self.marks):
            return self.plain(text)
        found: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            found += ([part] if i % 2 else self.plain(part)) if part else []
        return found


def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(vocabulary)
    made.no_padding()
    made.no_truncation()
    return made


def _ids_of(tokenizer, words: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def _width(vocabulary: str) -> str:
    return "<u2" if len(piece_table(vocabulary)) <= 1 << 16 else "<u4"


class Decoder:
    """Looks up the pieces of ids; ids outside the table have none."""

    def __init__(self, vocabulary: str):
        self.pieces = pa.array([*piece_table(vocabulary), b""], pa.binary())
        self.none = len(self.pieces) - 1

    def text(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        joined = self.pieces.take(pa.array(np.where((ids >= 0) & (ids < self.none), ids, self.none).astype(np.int32)))
        offsets = np.frombuffer(joined.buffers()[1], np.int32)
        begin, end = int(offsets[joined.offset]), int(offsets[joined.offset + len(joined)])
        return joined.buffers()[2].slice(begin, end - begin).to_pybytes().decode("utf-8", "replace") if end > begin else ""


class Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


def _mark(words: list[str]) -> str:
    """Names the sorted words of a block."""
    return hashlib.blake2b("\x00".join(words).encode(), digest_size=16).hexdigest()


def asked_words(docs: DataFrame, vocabulary, text: str, block_bytes: int) -> DataFrame:
    """(word, block, number): the distinct words of every block in their order; number -1 has the block's mark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(vocabulary.value)

        def rows(block: int, found: set[str]) -> Iterator[pa.RecordBatch]:
            words = sorted(found)
            words.append(_mark(words))
            numbers = np.append(np.arange(len(words) - 1, dtype=np.int32), np.int32(-1))
            for at in range(0, len(words), ROWS):
                part = pa.array(words[at : at + ROWS], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part, pa.repeat(pa.scalar(block, pa.int64()), len(part)), pa.array(numbers[at : at + ROWS])],
                    ["word", "block", "number"],
                )

        current, words = -1, set()
        for block, part in blocks.cut(batches, 0, block_bytes):
            if block != current and current >= 0:
                yield from rows(current, words)
                words = set()
            current = block
            for value in part.column(0):
                words.update(splitter.words(value.as_py()))
        if current >= 0:
            yield from rows(current, words)

    return docs.select(text).mapInArrow(run, "word string, block bigint, number int")


def encoded_words(asked: DataFrame, vocabulary) -> DataFrame:
    """(block, number, ids) of (word, block, number): the rows of a word meet, and it is encoded once.

    ``ids`` are the ids as little-endian numbers, of two bytes where the vocabulary allows; the
    mark of a block stays as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary.value)
        width = _width(vocabulary.value)
        last, last_ids = None, b""
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode()
            words = coded.dictionary.to_pylist()
            known = words[0] == last  # rows are sorted, so only the first word can be one of the batch before
            ids = [np.array(i, width).tobytes() for i in _ids_of(tokenizer, words[1:] if known else words)]
            ids = ([last_ids] if known else []) + ids
            last, last_ids = words[-1], ids[-1]
            found = pa.array(ids, pa.binary()).take(coded.indices)
            marks = pc.less(batch.column(2), 0)
            if pc.any(marks).as_py():
                found = pc.if_else(marks, batch.column(0).cast(pa.binary()), found)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), found], ["block", "number", "ids"])

    return (
        asked.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(run, "block bigint, number int, ids binary")
    )


def word_table(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """(word, ids): the distinct words of the texts."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_vocabulary()))
    words = asked_words(docs, vocabulary, text, blocks.BLOCK_BYTES).filter("number >= 0").select("word").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(vocabulary.value)
        for batch in batches:
            ids = _ids_of(tokenizer, batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["word", "ids"])

    return words.mapInArrow(run, "word string, ids array<int>")


def _block_ids(words: list[str], answers: pa.Table, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, how many for each word) of the sorted words of a block."""
    numbers = answers.column("number").to_numpy()
    ids = answers.column("ids")
    marks = np.flatnonzero(numbers < 0).tolist()
    if marks and ids[marks[0]].as_py() == _mark(words).encode():
        order = np.argsort(numbers)[1:]
        values = ids.take(pa.array(order)).to_pylist()
        width = _width(vocabulary)
        flat = np.frombuffer(b"".join(values), width).astype(np.int32)
        return flat, np.fromiter(map(len, values), np.int64, len(values)) // int(width[-1])
    found = _ids_of(_tokenizer(vocabulary), words)
    return np.fromiter((i for f in found for i in f), np.int32), np.array([len(f) for f in found], np.int64)


def _placed(docs: DataFrame, vocabulary, text: str, kept: list[int], fields, finish, block_bytes: int) -> DataFrame:
    """The ``kept`` columns of ``docs`` and ``fields``, which ``finish(offsets, ids)`` gives for rows in order."""
    at = docs.columns.index(text)
    schema = T.StructType([*[docs.schema.fields[i] for i in kept], *fields])
    carried = sorted({at, *kept})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in blocks.cut(batches, at, block_bytes):
            part = pa.RecordBatch.from_arrays([part.column(i) for i in carried], [str(i) for i in carried])
            for piece in blocks.pieces(part, carried.index(at)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([blocks.packed(piece)], pa.binary())], ["block", "rows"]
                )

    def place(packs: pa.Table, answers: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not packs.num_rows:
            return to_arrow_schema(schema).empty_table()
        splitter = Splitter(vocabulary.value)
        numbers = Numbers()
        held = []
        for value in packs.column("rows"):
            rows = blocks.unpacked(value.as_py())
            ends, order = [0], []
            for t in rows.column(str(at)):
                split = splitter.words(t.as_py())
                order.append(np.fromiter(map(numbers.__getitem__, split), np.int32, len(split)))
                ends.append(ends[-1] + len(split))
            held.append((rows.select([str(i) for i in kept]), np.array(ends), np.concatenate([*order, np.zeros(0, np.int32)])))
        words = sorted(numbers)
        flat, counts = _block_ids(words, answers, vocabulary.value)
        rank = np.empty(len(words), np.int64)
        rank[np.fromiter((numbers[w] for w in words), np.int64, len(words))] = np.arange(len(words))
        del numbers, words
        starts = np.cumsum(counts) - counts
        done = []
        for rows, ends, order in held:
            order = rank[order]
            sizes = counts[order]
            after = np.concatenate([[0], np.cumsum(sizes)])
            ids = flat[np.repeat(starts[order] - after[:-1], sizes) + np.arange(after[-1])] if len(order) else flat[:0]
            made = finish(after[ends], ids)
            done.append(pa.Table.from_arrays([*[c.combine_chunks() for c in rows.columns], *made], names=schema.names))
        return pa.concat_tables(done)

    packs = docs.mapInArrow(pack, "block bigint, rows binary")
    answers = encoded_words(asked_words(docs, vocabulary, text, block_bytes), vocabulary)
    return packs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(place, schema)


def encode(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    name: str = "ids",
    keep_text: bool = True,
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``name``: the token ids of each text. Without ``keep_text`` the text is left out."""
    name = free_name(docs, name)
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_vocabulary()))
    kept = [i for i, c in enumerate(docs.columns) if keep_text or c != text]

    def lists(offsets: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]

    field = T.StructField(name, T.ArrayType(T.IntegerType()))
    return _placed(docs, vocabulary, text, kept, [field], lists, block_bytes)


def decode(rows: DataFrame, path: str | None = None, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with ``name``: the text of each row's ids."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(read_vocabulary(path or default_vocabulary()))
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField(free_name(rows, name), T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary.value)
        for batch in batches:
            values = [v.values.to_numpy(zero_copy_only=False) if v.is_valid else np.zeros(0) for v in batch.column(at)]
            texts = pa.array([decoder.text(v) for v in values], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, number of tokens, digests of its ids and of the text they decode to."""
    docs = docs.select("doc_id", "text")
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(default_vocabulary()))

    tables: list = []

    def digests(offsets: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
        if not tables:  # once per task
            decoder = Decoder(vocabulary.value)
            tables.extend((decoder, [str(i).encode() for i in range(decoder.none)]))
        decoder, written = tables
        coded, decoded = [], []
        for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            own = ids[begin:end]
            coded.append(hashlib.sha256(b",".join([written[i] for i in own.tolist()])).hexdigest())
            decoded.append(hashlib.sha256(decoder.text(own).encode()).hexdigest())
        return [pa.array(np.diff(offsets).astype(np.int64)), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return _placed(docs, vocabulary, "text", [0], fields, digests, blocks.BLOCK_BYTES)
