"""Alignment of two tokenizers: groups of tokens that end at the same bytes, links, and their counts.

Both tokenizers read a space and the text, A a byte-level BPE of the ``tokenizers`` library, B a
``sentencepiece`` model, which adds the space itself. The places where tokens end come from A's character offsets
and B's spans. These are coarse cuts: a span that is narrower or wider than the bytes of its token (a
character that is cut into several tokens, a byte-fallback token, the added space) is refined by the
decoded bytes of the token. Places where both end cut the tokens into groups, and each A and B
occurrence of a group is a link.

A text is aligned in chunks. A chunk begins with a space behind something that is no white
space; neither tokenizer has a token across such a place (A by its split rule, B because no entry
of its model has the space mark behind another character, which is checked when the model is
read). Equal chunks of a block are aligned once.

Counts of id pairs: each block of documents (see ``blocks``) gives every pair of its documents once
with the number of documents; the sums over all blocks and the highest count per A id go back to
the blocks that have the pair, where each document adds up its links. So a pair that occurs in
every document is one row per block. What is scored grows with the corpus: counts are corpus-wide.

Defined results: null and empty texts, and texts that a tokenizer does not keep byte by byte, have no
tokens and give zeros and ''. Strings of special tokens are plain text. Repeated rows are each a
document of their own. An empty table gives an empty table; texts of any length are aligned whole. Columns of
the caller stay in ``align``; new ones whose name is taken get underscores before it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lettersieve.llm import blocks
from lettersieve.llm.bpe import Numbers, default_vocabulary, piece_table, read_vocabulary
from lettersieve.llm.common import free_name, ships_its_code
from lettersieve.sources.shared import stored

ships_its_code(__name__)

BLOCK_BYTES = 16 << 20
LOOKED_UP = 20_000
JOINED = 500
ROWS = 10_000
_MARK = "▁"
# A space behind something that is no white space, unless it ends the text, begins a chunk.
_CUT = regex.compile(rf"(?<=[^\s{_MARK}]) (?=.)", regex.S)
_UNUSUAL = re.compile(rf"[\s{_MARK}] | \Z")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def chunks(text: str) -> list[str]:
    """The chunks of space + text, each without the space it begins with."""
    return _CUT.split(text) if text[0] == " " or _UNUSUAL.search(text) else text.split(" ")


def _flat(lists: list[list], kind=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """(values, how many of each list)."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), kind, int(sizes.sum())), sizes


def _gathered(order: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of the values of the lists ``order`` in the flat values of lists of these sizes."""
    own = sizes[order]
    starts = (np.cumsum(sizes) - sizes)[order]
    return np.repeat(starts - (np.cumsum(own) - own), own) + np.arange(own.sum())


class Tokenizers:
    """The two tokenizers with the decoded bytes of their entries."""

    def __init__(self, vocabulary: str, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.a_bytes = piece_table(vocabulary)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        if any(_MARK in self.b.id_to_piece(i).lstrip(_MARK) for i in range(self.b.get_piece_size())):
            raise ValueError("the model has entries with a space inside")
        self.lengths = [np.fromiter(map(len, table), np.int64, len(table)) for table in (self.a_bytes, self.b_bytes)]
        # Each id as it is written behind a token of its own side, and where a side begins.
        self.written = [
            [[f"{mark}{i}" for i in range(len(table))] for mark in marks]
            for table, marks in ((self.a_bytes, ",;"), (self.b_bytes, ",|"))
        ]

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(number) else piece.replace(_MARK, " ").encode()


class Chunks:
    """The different chunks of a block, each aligned once, and the id pairs that they link.

    Per chunk: whether both tokenizers keep its bytes, numbers of tokens and groups, the groups as
    text, and its links as numbers of pairs with how often they are linked.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.of = tokenizers
        self.numbers = Numbers()
        self.pairs = Numbers()
        self.kept = np.zeros(0, bool)
        self.sums = np.zeros((0, 3), np.int64)
        self.shown: list[str] = []
        self.sizes = np.zeros(0, np.int64)
        self.linked = np.zeros((0, 2), np.int64)

    def learn(self) -> None:
        """Aligns the chunks that were numbered since the last time."""
        names = list(islice(self.numbers, len(self.shown), None))
        for at in range(0, len(names), LOOKED_UP):
            self._learn(names[at : at + LOOKED_UP])

    def _units(self, names: list[str]) -> list[list[int]]:
        """Chunks that are encoded in one text: those that a space behind them ends."""
        ends = [bool(name) and not name[-1].isspace() and _MARK not in name for name in names]
        plain = [i for i, name in enumerate(names) if ends[i] and name.isascii()]
        other = [i for i, name in enumerate(names) if ends[i] and not name.isascii()]
        joined = [own[at : at + JOINED] for own in (plain, other) for at in range(0, len(own), JOINED)]
        return joined + [[i] for i in range(len(names)) if not ends[i]]

    def _read_a(self, text: str, raw: bytes):
        """(ids, ends) of A's tokens, or nothing if they do not keep the bytes."""
        found = self.of.a.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2)
        return self._cut(0, raw, ids, spans[:, 0], spans[:, 1], len(raw) == len(text))

    def _read_b(self, text: str, raw: bytes):
        found = [(p.id, p.begin, p.end) for p in self.of.b.encode(text[1:], return_type="proto").pieces]
        ids, begin, end = np.array(found, np.int64).reshape(-1, 3).T
        # Spans count the text without the space before it.
        return self._cut(1, raw, ids, begin + 1, end + 1, True)

    def _cut(self, side: int, raw: bytes, ids: np.ndarray, begin: np.ndarray, end: np.ndarray, coarse: bool):
        """Where tokens end. Spans say it if they are as long as the tokens, one behind the other.

        Elsewhere (characters of several bytes or tokens, byte-fallback tokens) the decoded bytes do.
        """
        table = (self.of.a_bytes, self.of.b_bytes)[side]
        if b"".join([table[i] for i in ids.tolist()]) != raw:
            return None
        upto = np.cumsum(self.of.lengths[side][ids])
        if coarse and (end == upto).all() and (begin[1:] == end[:-1]).all():
            return ids, end
        return ids, upto

    def _learn(self, names: list[str]) -> None:
        count = len(names)
        kept = np.zeros(count, bool)
        order, sides, base = [], ([], []), 0
        waiting = self._units(names)
        while waiting:
            unit = waiting.pop()
            text = "".join([f" {names[i]}" for i in unit])
            raw = text.encode()
            a, b = self._read_a(text, raw), self._read_b(text, raw)
            if a is None or b is None:
                if len(unit) > 1:
                    waiting += [[i] for i in unit]
                continue
            for side, (ids, ends) in zip(sides, (a, b), strict=True):
                side.append((ids, ends + base))
            order += unit
            base += len(raw)
        kept[order] = True
        place = np.array(order, np.int64)
        lengths = np.fromiter((1 + len(names[i].encode()) for i in order), np.int64, len(order))
        starts = np.cumsum(lengths) - lengths

        def joined(side: list, k: int) -> np.ndarray:
            return np.concatenate([x[k] for x in side]) if side else np.zeros(0, np.int64)

        a_ids, a_ends, b_ids, b_ends = joined(sides[0], 0), joined(sides[0], 1), joined(sides[1], 0), joined(sides[1], 1)
        both = np.intersect1d(a_ends, b_ends)
        a_group, b_group = np.searchsorted(both, a_ends), np.searchsorted(both, b_ends)
        group_chunk = place[np.searchsorted(starts, both, "left") - 1]
        a_chunk, b_chunk = group_chunk[a_group], group_chunk[b_group]
        self._show(count, a_ids, a_group, a_chunk, b_ids, b_group, b_chunk)
        self._link(count, len(both), group_chunk, a_ids, a_group, b_ids, b_group)
        sums = [np.bincount(c, minlength=count) for c in (a_chunk, b_chunk, group_chunk)]
        self.sums = np.concatenate([self.sums, np.stack(sums, axis=1)])
        self.kept = np.concatenate([self.kept, kept])

    def _show(self, count, a_ids, a_group, a_chunk, b_ids, b_group, b_chunk) -> None:
        """Writes the groups of each chunk: ids of A, ids of B, a mark where another side or group begins."""
        group = np.concatenate([a_group, b_group])
        side = np.repeat([0, 1], [len(a_ids), len(b_ids)])
        ids = np.concatenate([a_ids, b_ids])
        chunk = np.concatenate([a_chunk, b_chunk])
        order = np.lexsort((side, group, chunk))
        group, side, ids, chunk = group[order], side[order], ids[order], chunk[order]
        new = np.ones(len(ids), np.int64)
        new[1:] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        tables = self.of.written
        pieces = [tables[s][n][i] for s, n, i in zip(side.tolist(), new.tolist(), ids.tolist(), strict=True)]
        ends = np.cumsum(np.bincount(chunk, minlength=count)).tolist()
        self.shown += ["".join(pieces[i:j])[1:] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def _link(self, count, n_groups, group_chunk, a_ids, a_group, b_ids, b_group) -> None:
        """Links each A with each B token of its group."""
        in_b = np.bincount(b_group, minlength=n_groups)
        per_a = in_b[a_group]
        first_b = np.cumsum(in_b) - in_b
        b_at = np.repeat(first_b[a_group] - (np.cumsum(per_a) - per_a), per_a) + np.arange(per_a.sum())
        keys = np.repeat(a_ids, per_a) << 32 | b_ids[b_at]
        chunk = group_chunk[np.repeat(a_group, per_a)]
        used, place = np.unique(keys, return_inverse=True)
        numbers = np.fromiter(map(self.pairs.__getitem__, used.tolist()), np.int64, len(used))[place]
        cells, times = np.unique(chunk << 40 | numbers, return_counts=True)
        linked = np.stack([cells & ((1 << 40) - 1), times], axis=1)
        self.linked = np.concatenate([self.linked, linked])
        self.sizes = np.concatenate([self.sizes, np.bincount(cells >> 40, minlength=count)])

    def texts(self, values: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """((n_a, n_b, n_groups, digest, different pairs) of each text, then numbers and times of all their pairs)."""
        parts = [chunks(v) if v else [] for v in values]
        order = [list(map(self.numbers.__getitem__, own)) for own in parts]
        self.learn()
        for i, own in enumerate(order):
            if own and not self.kept[own].all():
                order[i] = self._whole(values[i])
        flat, sizes = _flat(order)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(self.sums[flat], axis=0)])
        sums = np.diff(sums[ends], axis=0).tolist()
        shown = self.shown
        shas = [hashlib.sha256(";".join([shown[k] for k in own]).encode()).hexdigest() if own else "" for own in order]
        at = _gathered(flat, self.sizes)
        doc = np.repeat(np.repeat(np.arange(len(values)), sizes), self.sizes[flat])
        width = max(1, len(self.pairs))
        cells, place = np.unique(doc * width + self.linked[at, 0], return_inverse=True)
        times = np.bincount(place, self.linked[at, 1], len(cells)).astype(np.int64)
        n_pairs = np.bincount(cells // width, minlength=len(values)).tolist()
        return [(*s, sha, n) for s, sha, n in zip(sums, shas, n_pairs, strict=True)], cells % width, times

    def _whole(self, text: str) -> list[int]:
        """A text with a chunk whose bytes are not kept: one chunk if its own bytes are, else none."""
        number = self.numbers[text]
        self.learn()
        return [number] if self.kept[number] else []


_CODED = "block bigint, number int, a int, b int, docs bigint, row binary, links binary"


def _coded_rows(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=[c.split()[0] for c in _CODED.split(", ")])


def _pair_rows(block: int, pairs: dict[int, int], docs: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = np.fromiter(pairs, np.int64, len(pairs))
    for low in range(0, len(keys), ROWS):
        own = keys[low : low + ROWS]
        size = len(own)
        yield _coded_rows(
            pa.repeat(pa.scalar(block, pa.int64()), size),
            pa.array(np.arange(low, low + size, dtype=np.int32)),
            pa.array((own >> 32).astype(np.int32)),
            pa.array((own & 0xFFFFFFFF).astype(np.int32)),
            pa.array(docs[low : low + size]),
            pa.nulls(size, pa.binary()),
            pa.nulls(size, pa.binary()),
        )


def coded(docs: DataFrame, vocabulary, model, text: str, kept: list[int], block_bytes: int) -> DataFrame:
    """Rows of two kinds: documents (block, row, links) and pairs of ids (block, number, a, b, docs).

    ``row`` has packed documents with their own results, ``links`` their pairs by the number in
    the block and how often each is linked.
    """
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(vocabulary.value, model.value)
        current, known, in_docs = None, None, np.zeros(0, np.int64)
        for block, part in blocks.cut(batches, at, block_bytes):
            if block != current:
                if known is not None:
                    yield from _pair_rows(current, known.pairs, in_docs)
                current, known, in_docs = block, Chunks(tokenizers), np.zeros(0, np.int64)
            for piece in blocks.pieces(part, at):
                results, numbers, times = known.texts(piece.column(at).to_pylist())
                more = np.bincount(numbers, minlength=len(known.pairs))
                more[: len(in_docs)] += in_docs
                in_docs = more
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                own = [pa.array(c, kind) for c, kind in zip(zip(*results, strict=True), kinds, strict=True)]
                columns = [*[piece.column(i) for i in kept], *own]
                rows = pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])
                links = [pa.array(numbers.astype(np.int32)), pa.array(times)]
                yield _coded_rows(
                    pa.array([block], pa.int64()),
                    *[pa.nulls(1, kind) for kind in (pa.int32(), pa.int32(), pa.int32(), pa.int64())],
                    pa.array([blocks.packed(rows)], pa.binary()),
                    pa.array([blocks.packed(pa.RecordBatch.from_arrays(links, names=["number", "n"]))], pa.binary()),
                )
        if known is not None:
            yield from _pair_rows(current, known.pairs, in_docs)

    return docs.mapInArrow(run, _CODED)


def counted(pairs: DataFrame) -> DataFrame:
    """(a, b, n, best) of ``pairs(a, b, docs)``: documents that hold the pair; whether no pair of a has more.

    An id a has at most as many partners as B's vocabulary has entries.
    """
    sums = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    return sums.withColumn("best", F.col("n") == F.max("n").over(W.partitionBy("a")))


_RESULTS = {
    "n_a": T.LongType(),
    "n_b": T.LongType(),
    "n_groups": T.LongType(),
    "n_links": T.LongType(),
    "n_best": T.LongType(),
    "count_sum": T.LongType(),
    "groups_sha256": T.StringType(),
}


def align(
    docs: DataFrame,
    vocabulary_path: str | None = None,
    model_path: str | None = None,
    text: str = "text",
    keep_text: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each text."""
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(read_vocabulary(vocabulary_path or default_vocabulary()))
    model = context.broadcast(read_model(model_path or default_model()))
    kept = [i for i, c in enumerate(docs.columns) if keep_text or c != text]
    table = stored(coded(docs, vocabulary, model, text, kept, block_bytes), "aligned")
    # Not every document has tokens, so a block may be without pairs.
    pairs = table.filter("a is not null").select("block", "number", "a", "b", "docs")
    counts = stored(counted(pairs), "pair-counts")
    scored = pairs.join(counts, ["a", "b"]).select("block", "number", "n", "best")
    names = {n: free_name(docs, n) for n in _RESULTS}
    schema = T.StructType(
        [*[docs.schema.fields[i] for i in kept], *[T.StructField(names[n], kind) for n, kind in _RESULTS.items()]]
    )

    def score(packs: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(answers.column("number").to_numpy())
        counts = answers.column("n").to_numpy()[order]
        best = answers.column("best").to_numpy().astype(np.int64)[order]
        done = []
        for row, own in zip(packs.column("row"), packs.column("links"), strict=True):
            rows, links = blocks.unpacked(row.as_py()), blocks.unpacked(own.as_py())
            columns = [c.combine_chunks() for c in rows.columns]
            *shown, n_a, n_b, n_groups, sha, sizes = columns
            number, n = links.column("number").to_numpy(), links.column("n").to_numpy()
            ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))])
            sums = []
            for weight in (np.ones_like(n), best[number] if len(n) else n, counts[number] if len(n) else n):
                total = np.concatenate([[0], np.cumsum(n * weight)])
                sums.append(pa.array(np.diff(total[ends])))
            done.append(pa.Table.from_arrays([*shown, n_a, n_b, n_groups, *sums, sha], names=schema.names))
        return pa.concat_tables(done)

    packs = table.filter("row is not null").select(F.col("block").alias("own"), "row", "links")
    return packs.groupBy("own").cogroup(scored.groupBy("block")).applyInArrow(score, schema)


def pair_counts(
    docs: DataFrame, vocabulary_path: str | None = None, model_path: str | None = None, text: str = "text"
) -> DataFrame:
    """(a, b, n, best): in how many documents each pair of ids is linked, and whether it is a's most frequent one."""
    context = docs.sparkSession.sparkContext
    vocabulary = context.broadcast(read_vocabulary(vocabulary_path or default_vocabulary()))
    model = context.broadcast(read_model(model_path or default_model()))
    pairs = coded(docs.select(text), vocabulary, model, text, [], BLOCK_BYTES).filter("a is not null")
    return counted(pairs)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and the results of its alignment."""
    return align(docs.select("doc_id", "text"), keep_text=False)
