"""An indexing run: what is new since the last run goes to the index, then progress is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lettersieve.operators import upkeep
from lettersieve.operators.postings import Index, updated
from lettersieve.sources import index_tables, shared


def index_new(documents: DataFrame, checkpoints: DataFrame, index: Index) -> tuple[Index, DataFrame]:
    """The index with the new documents added, and the checkpoints to store.

    New are the documents above the last uid of their box, found without shuffling texts.
    A document that the index has already, from before a rescan or from a run whose
    checkpoints were lost, is replaced. Checkpoints advance to what the written part holds, so they never run ahead of it, and
    a run that fails leaves both as they were.
    """
    spark = documents.sparkSession
    new = upkeep.index_backlog(documents, checkpoints, index.keys, documents.columns)
    root = shared.new_folder(spark, "index-part")
    index_tables.write_index(new, root, index.term_buckets)
    part = index_tables.read_index(spark, root)
    return updated(index, part, part.keys), upkeep.advance_checkpoints(checkpoints, part.keys)
