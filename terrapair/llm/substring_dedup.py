"""Substring dedup by relative Lempel-Ziv parsing.

A document is factored against the documents before it (by doc_id): the index of reference
blocks maps content-defined grams of GRAM words to the contexts they stand in (see
`anchors`). Every context of a gram, however many there are, is joined with the earliest
document's context, its reference block; the factor is the longest match around the gram.
A factor of at least WINDOW words is a duplicate span. Windows that no factor covers, those at
factor boundaries and those that only later blocks hold, are then ranked against the windows of all
blocks of the gram: a window that a factor covers equals the reference block's, so windows
left over can only equal one another.

A word goes if a window of WINDOW words that covers it also starts in a document with a smaller
doc_id. Words are compared by 64-bit hashes, windows by two more.

Defined cases: a null text has no words; texts below the window lose nothing; a null
doc_id counts as larger than all others and not as smaller than another null; rows with
equal doc_ids don't remove each other's words; repeats inside a text alone stay; texts are
whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from terrapair.llm import anchors

WINDOW = 50
GRAM = 10


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space).

    With `texts` also kept, those bytes, null where nothing was removed.
    """
    scheme = anchors.Scheme(words=True, lengths=(window,), gram=gram, within=False)
    out = anchors.repeated_windows(docs, scheme, id_col, text_col, texts).withColumnRenamed("n", "n_words")
    return out.drop("n_spans", "n_shared")
