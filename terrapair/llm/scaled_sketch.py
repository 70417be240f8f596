"""Document fingerprints: threshold-scaled sketches.

A document's set holds the hashes of its shingles (runs of five words); its sketch keeps every hash
below a fixed share of the hash range. Membership depends on the hash alone, so sketches of unequal
documents are samples of their sets at one rate: the union of sketches is the sketch of
the union, and the share of one sketch that is in another estimates how much of the one document is in
the other, however long that one is. A set none of whose hashes is below the threshold keeps its
least one, so only texts without words have an empty sketch.

`sketch_rows`, `merged` and `containment` hold sketches as rows (id, hash): merging is a distinct and
comparing an equi-join on hashes, without any array that grows with a group.

`edit_report` compares each document with its edited text and with the next document. Texts meet their
successors in ranges of doc_id: cut points come from a quantile sketch, ids that are very frequent are
dealt on by the hash of their text, and the first row of each range is also sent to the
range before. Texts are compressed before they are shuffled, and a task streams through its ranges holding two
texts at a time.

Defined cases: a null text is empty; words are `[^\\x20\\x09-\\x0D]+` with A-Z in lower case; a text of fewer
than five words has one shingle of all of them, one without words an empty sketch; two empty sketches
are alike (1), an empty one and another are not (0). Descending order: doc_id, then the text's
xxhash64; null doc_ids come last; equal rows follow each other; a single document is its own successor. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _text as T

#: Words of a shingle, and the share of hashes that is kept.
SHINGLE = 5
SHARE = 1 / 8
#: Hashes have this many bits.
BITS = 48
#: Ranges for each shuffle partition, and at most.
RANGES = 8
MAX_RANGES = 1 << 15
NO_ID = -(1 << 63)

_DEALT = "bin int, extra int, k long, h long, named int, doc_id long, z binary"
_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, jaccard_edited double, jaccard_next double, n_hashes int"


def sketches(data: np.ndarray, off: np.ndarray, shingle: int = SHINGLE, share: float = SHARE) -> list[np.ndarray]:
    """The sketch of each text of a slice (bytes, offsets): ascending hashes of BITS bits."""
    words = T.Words(T.LOWER[data], off, T.NON_SPACE)
    n = len(off) - 1
    full = T.windows(words.off, shingle)
    start = np.flatnonzero(full)
    h = T.mix(T.rolling(words.hash, shingle)[start]) if len(start) else np.zeros(0, T.U64)
    owner = words.doc[start]
    short = np.flatnonzero((words.count > 0) & (words.count < shingle))
    if len(short):
        whole = T.mix(T.ranges(T.prefix(words.hash), words.off[:-1][short], words.off[1:][short]) + T.U64(1))
        h, owner = np.concatenate([h, whole]), np.concatenate([owner, short])
    h >>= T.U64(64 - BITS)
    least = np.full(n, ~T.U64(0))
    np.minimum.at(least, owner, h)
    keep = (h < T.U64(int(share * (1 << BITS)))) | (h == least[owner])
    h, owner = h[keep], owner[keep]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    cut = np.searchsorted(owner, np.arange(n + 1))
    # a set with hashes below the threshold has no other
    return [h[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def printed(sketch: np.ndarray) -> str:
    """A sketch as text: base64 of its hashes, six bytes each, ascending."""
    return base64.b64encode(np.ascontiguousarray(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :]).tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(share of a's hashes that b has, share of the union's that both have)."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / len(a), both / (len(a) + len(b) - both)


def _texts(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    off = np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int64)
    return np.frombuffer(b"".join(values), np.uint8), off


def _rows(shingle: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches):
            found = sketches(*T.buffers(T.column(batch, "text")), shingle, share)
            sizes = np.array([len(x) for x in found])
            at = pa.array(np.repeat(np.arange(len(found)), sizes))
            flat = np.concatenate(found) if found else np.zeros(0, T.U64)
            yield pa.record_batch([T.column(batch, "id").take(at), pa.array(flat.astype(np.int64))], names=["id", "hash"])

    return run


def sketch_rows(docs: DataFrame, shingle: int = SHINGLE, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hash) of all documents' sketches."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_rows(shingle, share), f"id {rows.schema['id'].dataType.simpleString()}, hash long")


def merged(rows: DataFrame, groups: DataFrame, share: float = SHARE) -> DataFrame:
    """(id, hash) of the sketches of unions: `groups` has (id, group) of the sketches `rows`.

    A distinct with partial sums: a group may hold any share of all documents.
    """
    named = rows.join(groups.select("id", F.col("group").alias("_g")), "id").select(F.col("_g").alias("id"), "hash").distinct()
    least = named.groupBy(F.col("id").alias("_i")).agg(F.min("hash").alias("_m"))
    # what stood in for an empty sketch goes once the union has a hash below the threshold, or a smaller one
    bound = int(share * (1 << BITS))
    below = named.where(F.col("hash") < bound)
    above = named.where(F.col("hash") >= bound).join(least.where(F.col("_m") >= bound), (F.col("id") == F.col("_i")) & (F.col("hash") == F.col("_m"))).select("id", "hash")
    return below.union(above)


def containment(rows: DataFrame, others: DataFrame) -> DataFrame:
    """(id, other, n_both, n, n_other, containment) of sketches that share hashes: how much of `id` is in `other`.

    The join is by hash, so pairs arise only where hashes are shared; a hash that very many sketches
    of both sides hold gives as many pairs as there are.
    """
    both = rows.join(others.select(F.col("id").alias("other"), "hash"), "hash").groupBy("id", "other").agg(F.count(F.lit(1)).alias("n_both"))
    size = lambda df, key, n: df.groupBy(F.col("id").alias(key)).agg(F.count(F.lit(1)).alias(n))
    out = both.join(size(rows, "id", "n"), "id").join(size(others, "other", "n_other"), "other")
    return out.select("id", "other", "n_both", "n", "n_other", (F.col("n_both") / F.col("n")).alias("containment"))


def _binned(cuts: np.ndarray):
    """Ranges of rows: by cut points, and by hash among the ranges that one id spans."""

    def bins(k: np.ndarray, h: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(cuts, k, "left"), np.searchsorted(cuts, k, "right")
        unit = ((h.view(np.uint64) ^ T.U64(1 << 63)) >> T.U64(33)).astype(np.int64)
        return lo + (unit * (hi - lo + 1) >> 31)

    return bins


def _bounds(cuts: np.ndarray):
    """Per range of a batch: its greatest row."""
    bins = _binned(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = T.column(batch, "k").to_numpy(), T.column(batch, "h").to_numpy()
            named = T.column(batch, "named").to_numpy()
            b = bins(k, h)
            order = np.lexsort((named, h, k, b))
            last = order[np.append(b[order][1:] != b[order][:-1], True)] if len(order) else order
            yield pa.record_batch([pa.array(b[last].astype(np.int32)), *(pa.array(x[last]) for x in (k, h, named))], names=["bin", "k", "h", "named"])

    return run


def _deal(cuts: np.ndarray, first: dict[tuple[int, int, int], int]):
    """Rows with their range and compressed text; a range's first row goes to the range before too."""
    bins = _binned(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in T.slices(batches):
            k, h, named = (T.column(batch, x).to_numpy() for x in ("k", "h", "named"))
            data, off = T.buffers(T.column(batch, "text"))
            view = memoryview(np.ascontiguousarray(data))
            z = pa.array([packer.compress(view[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())], pa.binary())
            b = bins(k, h).astype(np.int32)
            more = [(i, first[x]) for i, x in enumerate(zip(k.tolist(), h.tolist(), named.tolist())) if x in first]
            at = np.array([*range(len(k)), *(i for i, _ in more)], np.int64)
            to = np.concatenate([b, np.array([x for _, x in more], np.int32)])
            extra = np.array([0] * len(k) + [1] * len(more), np.int32)
            yield pa.record_batch([pa.array(to), pa.array(extra), *(pa.array(x[at]) for x in (k, h, named)), T.column(batch, "doc_id").take(pa.array(at)), z.take(pa.array(at))], names=["bin", "extra", "k", "h", "named", "doc_id", "z"])

    return run


def _report(shingle: int, share: float):
    """Rows come sorted by (bin, extra, descending order): each is compared with the one after it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int | None, str]]:
        packer = zstandard.ZstdDecompressor()
        for batch in batches:
            z = T.column(batch, "z")
            for b, extra, d, i in zip(T.column(batch, "bin").to_pylist(), T.column(batch, "extra").to_pylist(), T.column(batch, "doc_id").to_pylist(), range(batch.num_rows)):
                yield b, extra, d, packer.decompress(z[i].as_py()).decode("utf-8")

    def flush(held: list[tuple[int | None, str, str]], last: str) -> pa.RecordBatch:
        """Documents (id, text, edited text), each followed by the next one's text, `last` by none."""
        own = [t.encode() for _, t, _ in held]
        edited = [e.encode() for _, _, e in held]
        all_ = sketches(*_texts([*own, last.encode(), *edited]), shingle, share)
        mine, after = all_[: len(held) + 1], all_[len(held) + 1 :]
        to_edited = [likeness(a, b) for a, b in zip(mine, after)]
        to_next = [likeness(a, b) for a, b in zip(mine, mine[1:])]
        return pa.record_batch(
            [
                pa.array([d for d, _, _ in held], pa.int64()),
                pa.array([len(t) for _, t, _ in held], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array([printed(x) for x in mine[:-1]]),
                pa.array([printed(x) for x in after]),
                *(pa.array([x[i] for x in side], pa.float64()) for i, side in ((0, to_edited), (0, to_next), (1, to_edited), (1, to_next))),
                pa.array([len(x) for x in mine[:-1]], pa.int32()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "jaccard_edited", "jaccard_next", "n_hashes"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str, str]] = []
        size = 0
        before: tuple[int, int | None, str] | None = None
        for b, extra, d, text in rows(batches):
            if before is not None and before[0] == b:
                t = before[2]
                half = len(t) // 2
                held.append((before[1], t, t[: len(t) - half] + text[:half]))
                size += len(t) + len(text)
                # a stretch of documents in a row ends with a range, and where it is long enough
                if extra or size > T.SLICE_BYTES:
                    yield flush(held, text)
                    held, size = [], 0
            before = None if extra else (b, d, text)

    return run


def edit_report(docs: DataFrame, shingle: int = SHINGLE, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and more.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the next
    document in descending order (after the last: the first one). near_* is the estimated share of the
    document that the other one contains, jaccard_* the estimated resemblance.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), F.xxhash64("text").alias("h"), F.col("doc_id").isNotNull().cast("int").alias("named"), "doc_id", "text")
    n = min(MAX_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = keyed.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"]
    cuts = np.array(found or [], np.int64)
    bounds = keyed.select("k", "h", "named").mapInArrow(_bounds(cuts), "bin int, k long, h long, named int")
    greatest = bounds.groupBy("bin").agg(F.max(F.struct("k", "h", "named")).alias("m")).orderBy(F.desc("bin")).collect()  # a row a range
    # in descending order a range is followed by the next one below, the last by the first
    used = [r["bin"] for r in greatest]
    first = {tuple(r["m"]): used[i - 1] for i, r in enumerate(greatest)}
    dealt = keyed.mapInArrow(_deal(cuts, first), _DEALT).repartition("bin")
    dealt = dealt.sortWithinPartitions("bin", "extra", F.desc("k"), F.desc("h"), F.desc("named"))
    return dealt.select("bin", "extra", "doc_id", "z").mapInArrow(_report(shingle, share), _REPORT)
