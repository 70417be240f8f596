"""Benchmark decontamination with a broadcast set of normalised test n-grams.

The benchmark's windows (13 words, or a whole shorter item) are hashed on the driver and
broadcast; training texts are scanned once, every rolling word window is looked up, hits
are verified word by word, and the hit words mark spans. One scan, no shuffle.

The set is broadcast only in blocks of about BLOCK_BYTES of benchmark text, a bound
checked before collecting; a block's arrays take some ten times that. A larger benchmark is
taken in several blocks, one pass over the texts each, with hits carried along between passes.

Defined cases: null text has no words, is never hit; a null or wordless item has no
windows; items of fewer than 13 words are one window; a null item_id counts as the empty
string; a null doc_id is kept; repeated rows give repeated results; other columns are
ignored by the report and kept by `remove`; empty tables give no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _store
from terrapair.llm import _text as T

WINDOW = 13
#: Contaminated: hit words are at least one in SHARE of the words.
SHARE = 20
BLOCK_BYTES = 8 << 20
_SECOND = T.U64(0x8CB92BA72F3D8DD7)
REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_CARRY = "hits array<int>, items array<string>"


class Grams:
    """Windows of a block of items: by length the different windows by hash, a place of each
    in the items' text, and its items. A few dozen bytes a word, whatever the items share."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int = WINDOW):
        data, off = T.buffers(texts)
        self.data = T.LOWER[data]
        words = T.Words(self.data, off, T.ALNUM)
        self.start, self.end = words.start, words.end
        self.names = sorted(set(ids))
        code = {x: i for i, x in enumerate(self.names)}
        name = np.array([code[x] for x in ids], np.int64)
        second = T.ranges(T.prefix(self.data.astype(T.U64) + T.U64(1), _SECOND), words.start, words.end, _SECOND)
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        size = np.minimum(window, words.count)
        for k in np.unique(size[size > 0]).tolist():
            at = np.flatnonzero(T.windows(words.off, k) & (size[words.doc[: max(0, len(words.start) - k + 1)]] == k))
            h, g = T.rolling(words.hash, k)[at], T.rolling(T.mix(second), k, _SECOND)[at]
            item = name[words.doc[at]]
            order = np.lexsort((item, g, h))
            h, g, item, at = h[order], g[order], item[order], at[order]
            window_ = np.ones(len(h), bool)
            window_[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            once = window_.copy()
            once[1:] |= item[1:] != item[:-1]
            first = np.flatnonzero(window_)
            items = np.flatnonzero(once)
            bits = np.zeros(1 << 20, bool)
            bits[(T.mix(h[first]) >> T.U64(44)).astype(np.int64)] = True
            self.by_length[k] = (h[first], bits, at[first], np.append(np.searchsorted(items, first), len(items)), item[items])

    def _spelled(self, p: int, k: int) -> list[bytes]:
        return [self.data[a:b].tobytes() for a, b in zip(self.start[p : p + k].tolist(), self.end[p : p + k].tolist())]

    def hits(self, data: np.ndarray, words: T.Words) -> tuple[np.ndarray, list[set[str]]]:
        """(mask of hit words, item ids of each text) of a lower-cased slice."""
        change = np.zeros(len(words.start) + 1, np.int64)
        found: list[set[int]] = [set() for _ in range(len(words.off) - 1)]
        for k, (keys, bits, place, cut, item) in self.by_length.items():
            h = T.rolling(words.hash, k)
            at = np.flatnonzero(bits[(T.mix(h) >> T.U64(44)).astype(np.int64)])
            row = np.searchsorted(keys, h[at])
            hit = (keys[np.minimum(row, len(keys) - 1)] == h[at]) & (words.doc[at] == words.doc[at + k - 1])
            spelled: dict[int, list[bytes]] = {}
            for p, j in zip(at[hit].tolist(), row[hit].tolist()):
                mine = [data[a:b].tobytes() for a, b in zip(words.start[p : p + k].tolist(), words.end[p : p + k].tolist())]
                while j < len(keys) and keys[j] == h[p]:
                    if j not in spelled:
                        spelled[j] = self._spelled(int(place[j]), k)
                    if spelled[j] == mine:
                        change[p] += 1
                        change[p + k] -= 1
                        found[words.doc[p]].update(item[cut[j] : cut[j + 1]].tolist())
                        break
                    j += 1
        return np.cumsum(change[:-1]) > 0, [{self.names[x] for x in one} for one in found]


def _runs(mask: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Per text: flat [first, last + 1, ...] of its maximal runs of hit words, from its first word."""
    out = []
    for a, b in zip(off[:-1], off[1:]):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask[a:b].view(np.int8), [0]]))) if mask[a:b].any() else np.zeros(0, int)
        out.append(edge.astype(np.int32))
    return out


def _scan(grams: Grams, text_at: int, finish):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in T.slices(iter([whole]), whole.schema.names[text_at]):
                data, off = T.buffers(batch.column(text_at))
                low = T.LOWER[data]
                words = T.Words(low, off, T.ALNUM)
                mask, items = grams.hits(low, words)
                yield finish(batch, data, off, words, mask, items)

    return run


def _carried(batch, words, mask, items):
    """Add what earlier blocks found."""
    hits, names = T.column(batch, "hits"), T.column(batch, "items")
    mask = mask.copy()
    for i in range(batch.num_rows):
        for a, b in np.array(hits[i].as_py() or [], dtype=int).reshape(-1, 2):
            mask[words.off[i] + a : words.off[i] + b] = True
        items[i] |= set(names[i].as_py() or [])
    return mask, items


def _counts(words, mask):
    n = np.concatenate([[0], np.cumsum(mask)])
    return n[words.off[1:]] - n[words.off[:-1]]


def _report(batch, data, off, words, mask, items):
    if "hits" in batch.schema.names:
        mask, items = _carried(batch, words, mask, items)
    n_hit = _counts(words, mask)
    digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
    return pa.record_batch(
        [T.column(batch, "doc_id"), pa.array(words.count), pa.array(n_hit), pa.array([len(x) for x in items], pa.int64()), pa.array(digests, pa.string()), pa.array((n_hit > 0) & (SHARE * n_hit >= words.count))],
        names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def _carry(batch, data, off, words, mask, items):
    if "hits" in batch.schema.names:
        mask, items = _carried(batch, words, mask, items)
    keep = [c for c in range(batch.num_columns) if batch.schema.names[c] not in ("hits", "items")]
    return pa.record_batch(
        [*(batch.column(c) for c in keep), pa.array([x.tolist() for x in _runs(mask, words.off)], pa.list_(pa.int32())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
        names=[*(batch.schema.names[c] for c in keep), "hits", "items"],
    )


def _removed(mode: str, text_at: int, out: list[str]):
    def finish(batch, data, off, words, mask, items):
        if "hits" in batch.schema.names:
            mask, items = _carried(batch, words, mask, items)
        n_hit = _counts(words, mask)
        bad = (n_hit > 0) & (SHARE * n_hit >= words.count)
        cols = [batch.column(i) for i in range(len(out))]
        if mode == "documents":
            return pa.record_batch([c.filter(pa.array(~bad)) for c in cols], names=out)
        texts = cols[text_at].to_pylist()
        for i in np.flatnonzero(n_hit):
            raw, a, keep, at = data[off[i] : off[i + 1]].tobytes(), words.off[i], [], 0
            for first, last in _runs(mask[a : words.off[i + 1]], np.array([0, words.count[i]]))[0].reshape(-1, 2):
                keep.append(raw[at : words.start[a + first] - off[i]])
                at = words.end[a + last - 1] - off[i]
            texts[i] = b"".join([*keep, raw[at:]]).decode("utf-8", "replace")
        cols[text_at] = pa.array(texts, pa.string())
        return pa.record_batch(cols, names=out)

    return finish


def _blocks(bench: DataFrame, id_col: str, text_col: str) -> Iterator[Grams]:
    items = bench.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        rows = part.toArrow()
        yield Grams(rows.column("id").to_pylist(), pa.chunked_array(rows.column("text").chunks, pa.string()).combine_chunks() if rows.num_rows else pa.array([], pa.string()))


def _passes(rows: DataFrame, text_at: int, bench: DataFrame, item_id: str, item_text: str, finish, schema: str) -> DataFrame:
    blocks = _blocks(bench, item_id, item_text)
    grams = next(blocks)
    for after in blocks:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name not in ("hits", "items"))
        rows = _store.stored(rows.mapInArrow(_scan(grams, text_at, _carry), f"{fields}, {_CARRY}"), "decontaminate")
        grams = after
    return rows.mapInArrow(_scan(grams, text_at, finish), schema)


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: its words, hit words, items found and whether it is contaminated."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _passes(rows, 1, bench, item_id, item_text, _report, REPORT)


def remove(docs: DataFrame, bench: DataFrame, what: str = "documents", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """`docs` with all its columns, without contaminated ``documents``, or with hit ``spans``
    cut from the texts (from the first byte of a run of hit words to its last)."""
    if what not in ("documents", "spans"):
        raise ValueError(f"what: {what}")
    names = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names))))
    at = names.index(text_col)
    out = _passes(inner, at, bench, item_id, item_text, _removed(what, at, inner.columns), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in inner.schema.fields))
    return out.toDF(*names)
