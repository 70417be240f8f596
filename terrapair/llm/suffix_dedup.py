"""Suffix-array dedup: distributed prefix doubling.

A byte goes if a 400-byte string that covers it starts anywhere else. Positions are ranked by
strings of growing length, and those whose rank is unique drop out between the rounds:

* round 0 ranks the first GRAM bytes at anchors (see `anchors`): every longer string holds one, at a
  place that its content fixes, so a position whose anchor's gram is unique is unique;
* round 1 ranks the first FIRST bytes at the positions that are left;
* round 2 ranks the threshold's 400 bytes at the positions whose first part was repeated.

Each round is a Spark aggregate over (rank, position) rows, joined back to the positions.
Neighbouring positions share a row as long as they agree. A rank is a pair of 64-bit hashes,
not an ordinal: no round needs the order of the ranks, only which of them are equal, so
strings are hashed where they are and no offset is fetched by a join.

Round 1 also tells what is repeated below the threshold: n_shared counts bytes in strings of FIRST
bytes that also start in another document. They are not removed.

Defined cases: a null text is empty; texts below the threshold lose nothing and count
nowhere; repeats inside a text and rows with equal doc_ids count like any other; a null
doc_id is kept; texts are whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from terrapair.llm import anchors

THRESHOLD = 400
FIRST = 256
GRAM = 64


def suffix_dedup(docs: DataFrame, threshold: int = THRESHOLD, first: int = FIRST, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, n_shared, kept_sha256.

    With `texts` also kept, the remaining bytes, null where nothing was removed.
    """
    scheme = anchors.Scheme(words=False, lengths=(first, threshold), gram=gram, within=True)
    return anchors.repeated_windows(docs, scheme, id_col, text_col, texts).withColumnRenamed("n", "n_bytes")
