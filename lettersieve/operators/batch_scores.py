"""Scores of a batch of queries from sorted contributions, in Arrow batches.

A task has the contributions of its documents sorted by box and uid. The words of the batch are
numbered, and for each word there are the queries that ask for it; so a document's scores are sums
over cells (field of a document, query), and no row is made for a word of a query.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Functions of this module go to Python workers as code: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Cells that are summed at once, and hits of a box that a task holds to leave out all but its best ones.
CELLS = 1 << 20
HELD = 1 << 22
# Scores are rounded to six digits later; hits this close to the last one of a task's best stay.
MARGIN = 2e-6


@dataclass(frozen=True)
class Batch:
    """Queries by word: ``queries[begins[i]:begins[i + 1]]`` ask for word i, as numbers of ``ids``."""

    ids: pa.Array
    begins: np.ndarray
    queries: np.ndarray
    needed: np.ndarray


def numbered(asked: pa.Table) -> tuple[pa.Table, Batch]:
    """(field, term, word) of the words in ``asked(query_id, field, term, needed)``, and who asks for them."""
    asked = asked.combine_chunks()
    words = asked.select(["field", "term"]).group_by(["field", "term"]).aggregate([])
    words = words.append_column("word", pa.array(np.arange(len(words), dtype=np.int32)))
    query = pc.dictionary_encode(asked.column("query_id").combine_chunks(), null_encoding="encode")
    query = query.combine_chunks() if isinstance(query, pa.ChunkedArray) else query
    rows = asked.select(["field", "term"]).append_column("at", pa.array(np.arange(len(asked))))
    found = rows.join(words, ["field", "term"], join_type="inner").sort_by([("word", "ascending"), ("at", "ascending")])
    at = found.column("at").to_numpy()
    sizes = np.bincount(found.column("word").to_numpy(), minlength=len(words))
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    numbers = query.indices.to_numpy(zero_copy_only=False).astype(np.int64)[at]
    needed = asked.column("needed").to_numpy().astype(np.int64)[at]
    return words, Batch(query.dictionary, begins, numbers, needed)


def _starts(column: pa.Array) -> np.ndarray:
    """Where runs of equal values begin; null is a value."""
    return np.concatenate([[0], pc.run_end_encode(column, run_end_type=pa.int64()).run_ends.to_numpy()[:-1]]).astype(np.int64)


def _cell_sums(cell: np.ndarray, w: np.ndarray, needed: np.ndarray, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """(cells, sums) of the cells in which as many words were found as are needed."""
    if n_cells > 4 * len(cell):
        cells, cell = np.unique(cell, return_inverse=True)
    else:
        cells = np.arange(n_cells)
    sums = np.bincount(cell, weights=w, minlength=len(cells))
    counts = np.bincount(cell, minlength=len(cells))
    least = np.ones(len(cells), dtype=np.int64)
    if len(needed) and needed.max() > 1:
        np.maximum.at(least, cell, needed)
    enough = counts >= least
    return cells[enough], sums[enough]


def _hits(
    batch: Batch, group: np.ndarray, document: np.ndarray, word: np.ndarray, w: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row of the document, score) of some documents: the best field counts."""
    n_queries = len(batch.ids)
    first = batch.begins[word]
    sizes = batch.begins[word + 1] - first
    at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    cell = np.repeat(group, sizes) * n_queries + batch.queries[at]
    cells, sums = _cell_sums(cell, np.repeat(w, sizes), batch.needed[at], (int(group[-1]) + 1) * n_queries)
    # Fields of a document follow each other, so groups give documents in order.
    of_group = np.zeros(int(group[-1]) + 1, dtype=np.int64)
    of_group[group] = document
    place = of_group[cells // n_queries] * n_queries + cells % n_queries
    order = np.argsort(place, kind="stable")
    place, sums = place[order], sums[order]
    begins = np.flatnonzero(np.diff(place, prepend=-1))
    if not len(begins):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    best, place = np.maximum.reduceat(sums, begins), place[begins]
    return place % n_queries, place // n_queries, best


def _best(query: np.ndarray, uid: pa.Array, score: np.ndarray, limit: int) -> np.ndarray:
    """Rows of the ``limit`` best hits of each query, and of those near the last one; equal scores by uid."""
    by_uid = pc.rank(uid, null_placement="at_start").to_numpy()
    order = np.lexsort((by_uid, -score, query))
    query, score = query[order], score[order]
    new_query = np.diff(query, prepend=-1) != 0
    begins = np.flatnonzero(new_query)
    sizes = np.diff(np.append(begins, len(query)))
    last = score[begins + np.minimum(limit, sizes) - 1]
    near = score >= np.repeat(last, sizes) - MARGIN
    runs = np.flatnonzero(new_query | (np.diff(score, prepend=np.nan) != 0))
    in_run = np.arange(len(query)) - np.repeat(runs, np.diff(np.append(runs, len(query))))
    return order[near & (in_run < limit)]


def scorer(batch: Batch, schema: pa.Schema, limit: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted (box, uid, field, word, w) to hits (query_id, box, uid, score), by ``limit`` fewer where a box has more in a task."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole documents: what a batch has of its last one waits for the next.
        rest = None
        for rows in batches:
            if rows.num_rows:
                rows = rows if rest is None else pa.concat_batches([rest, rows])
                cut = int(max(_starts(rows.column(name))[-1] for name in ("box", "uid")))
                if cut:
                    yield rows.slice(0, cut)
                rest = rows.slice(cut)
        if rest is not None:
            yield rest

    def joined(held: list) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        query, uid, score = zip(*held, strict=True)
        return np.concatenate(query), pa.concat_arrays(uid), np.concatenate(score)

    def best(held: list) -> list:
        query, uid, score = joined(held)
        kept = _best(query, uid, score, limit)
        return [(query[kept], uid.take(pa.array(kept)), score[kept])]

    def out(box: pa.Array, held: list) -> Iterator[pa.RecordBatch]:
        query, uid, score = joined(held)
        columns = [batch.ids.take(pa.array(query)), box.take(pa.array(np.zeros(len(query), np.int64))), uid, pa.array(score)]
        found = pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        yield from found.to_batches(max_chunksize=1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, held, n_held = None, [], 0
        for rows in documents(batches):
            word = rows.column("word").to_numpy().astype(np.int64)
            w = rows.column("w").to_numpy(zero_copy_only=False)
            new_box, new_document, new_group = (np.zeros(len(word), dtype=bool) for _ in range(3))
            new_box[_starts(rows.column("box"))] = True
            new_document[_starts(rows.column("uid"))] = True
            new_group[_starts(rows.column("field"))] = True
            new_document |= new_box
            new_group |= new_document
            firsts = np.flatnonzero(new_document)
            document, group = np.cumsum(new_document) - 1, np.cumsum(new_group) - 1
            cells = np.append(np.cumsum(batch.begins[word + 1] - batch.begins[word]), 0)
            n_docs, begin = 0, 0
            for end in [*firsts[1:].tolist(), len(word)]:
                n_docs += 1
                # Documents are taken together while they are of one box and few cells.
                following = firsts[document[begin] + n_docs + 1] if document[begin] + n_docs + 1 < len(firsts) else len(word)
                more = cells[following - 1] - cells[begin - 1]
                wide = (group[following - 1] - group[begin] + 1) * len(batch.ids)
                if end < len(word) and not new_box[end] and more <= CELLS and wide <= CELLS:
                    continue
                here = rows.column("box").slice(begin, 1)
                if held and not here.equals(box):
                    yield from out(box, best(held) if limit is not None else held)
                    held, n_held = [], 0
                box, part = here, slice(begin, end)
                query, row, score = _hits(batch, group[part] - group[begin], document[part] - document[begin], word[part], w[part])
                held.append((query, rows.column("uid").take(pa.array(firsts[document[begin] + row])), score))
                n_held += len(query)
                if n_held > HELD:
                    held = best(held) if limit is not None else held
                    n_held = len(held[0][0]) if limit is not None else n_held
                    if n_held > HELD // 2:
                        yield from out(box, held)
                        held, n_held = [], 0
                n_docs, begin = 0, end
        if held:
            yield from out(box, best(held) if limit is not None else held)

    return run
