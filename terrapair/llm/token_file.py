"""Token-ID / binary output with Elias-Fano document boundaries.

Texts are dealt by ranges of doc_id (one shuffle of the texts), each task sorts its range,
encodes it and cuts the stream into segments. A segment is one self-contained binary image:
header, Elias-Fano coded document boundaries and ids, and the concatenated token ids at
the least width (two bytes below 65,536 ids). Segments are rows of a Parquet table in the
shared folder, written by Spark's committer, so a lost executor leaves no half file and any
Hadoop file system will do. Boundaries take about 2 + log2(mean length) bits a document
instead of 64, and `EliasFano.select` reads one of them without decoding the rest.

Words (runs without ASCII white space, which the tokenizer drops, cut where ASCII letters
and punctuation meet) are encoded by the tokenizers library once per worker and looked up
afterwards by a 64-bit hash; their ids are joined in order. That equals encoding the whole
text because neither the normaliser nor the pre-tokeniser looks across these places: apostrophes, which
contractions hold, and the signs of special tokens are not cut at. Words of ASCII alone are
lower-cased before they are looked up, as the tokenizer does with them (not those with
``<``, which may be special; and not others, whose composed forms may depend on their case).

Defined cases: a null text is empty and has just the end id; null doc_ids come first, in
the order of their texts; rows of one doc_id follow in the order of their texts (null
first); other columns are ignored; an empty table gives no segments and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _store
from terrapair.llm import _text as T
from terrapair.llm.word_cache import WordCache

END_ID = 1
SEGMENT_IDS = 1 << 20
MAGIC = b"TIDS"
SEGMENTS = "shard int, seq int, before long, n_docs long, n_ids long, image binary"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


_LETTERS = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
_SIGNS = np.array([33 <= b <= 126 and not chr(b).isalnum() and chr(b) not in "'<|>" for b in range(256)])


#: Place of the r-th set bit of a byte.
_PLACE = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for r in range(8)] for b in range(256)])


class EliasFano:
    """A sorted list of integers in its low bits and a unary coded bit map of the high ones.

    The place of every STEP-th one of the bit map is stored with it, so any value is read from
    the nearest mark on, without decoding the rest.
    """

    STEP = 256
    HEAD = "<qIBII"

    def __init__(self, base: int, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.base, self.n, self.low_bits, self.low, self.high, self.marks = base, n, low_bits, low, high, marks

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        base = int(values[0])
        v = (values - base).astype(np.uint64)
        span = int(v[-1])
        low_bits = max(0, (span // n).bit_length() - 1)
        low = v & np.uint64((1 << low_bits) - 1)
        bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(high[-1]) + 1, np.uint8)
        unary[high] = 1
        return cls(base, n, low_bits, np.packbits(bits.reshape(-1), bitorder="little"), np.packbits(unary, bitorder="little"), high[:: cls.STEP].astype(np.uint32))

    def select(self, i: np.ndarray | int) -> np.ndarray:
        """The i-th values, each from its mark on: bytes are passed over by their number of ones."""
        i = np.atleast_1d(np.asarray(i, np.int64))
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError(i)
        mark, left = self.marks[i // self.STEP].astype(np.int64), i % self.STEP
        byte = mark >> 3
        x = self.high[byte] >> (mark & 7) << (mark & 7) & 0xFF
        on = np.flatnonzero(left >= np.bitwise_count(x))
        while len(on):
            left[on] -= np.bitwise_count(x[on])
            byte[on] += 1
            x[on] = self.high[byte[on]]
            on = on[left[on] >= np.bitwise_count(x[on])]
        out = (byte * 8 + _PLACE[x, left] - i) << self.low_bits
        if self.low_bits:
            p = i * self.low_bits
            wide = np.concatenate([self.low, np.zeros(9, np.uint8)])[(p >> 3)[:, None] + np.arange(9)].astype(np.uint64)
            rest = (p & 7).astype(np.uint64)
            low = wide[:, 0] >> rest
            for k in range(1, 9):
                low |= wide[:, k] << (np.uint64(8 * k) - rest) if k < 8 else np.where(rest > 0, wide[:, 8] << np.minimum(np.uint64(64) - rest, np.uint64(63)), np.uint64(0))
            out |= (low & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)
        return out + self.base

    def tobytes(self) -> bytes:
        head = struct.pack(self.HEAD, self.base, self.n, self.low_bits, len(self.low), len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.marks.astype("<u4").tobytes()

    @classmethod
    def read(cls, raw: bytes, at: int) -> tuple[EliasFano, int]:
        base, n, low_bits, a, b = struct.unpack_from(cls.HEAD, raw, at)
        at += struct.calcsize(cls.HEAD)
        marks = -(-n // cls.STEP)
        return cls(base, n, low_bits, np.frombuffer(raw, np.uint8, a, at), np.frombuffer(raw, np.uint8, b, at + a), np.frombuffer(raw, "<u4", marks, at + a + b)), at + a + b + 4 * marks


def image(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment's binary image. Null doc_ids stand first."""
    nulls = sum(x is None for x in doc_ids)
    bounds = EliasFano.of(np.concatenate([[0], np.cumsum(sizes)])).tobytes()
    names = EliasFano.of(np.array(doc_ids[nulls:], np.int64)).tobytes()
    width = ids.dtype.itemsize
    return MAGIC + struct.pack("<BIIQ", width, len(doc_ids), nulls, len(ids)) + bounds + names + ids.astype(f"<u{width}", copy=False).tobytes()


def read_image(raw: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """(doc_ids, boundaries, ids) of a segment."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token segment")
    width, n, nulls, n_ids = struct.unpack_from("<BIIQ", raw, 4)
    bounds, at = EliasFano.read(raw, 4 + struct.calcsize("<BIIQ"))
    names, at = EliasFano.read(raw, at)
    ids = np.frombuffer(raw, f"<u{width}", n_ids, at)
    if bounds.n != n + 1 or names.n != n - nulls:
        raise ValueError("damaged token segment")
    return [None] * nulls + names.select(np.arange(names.n)).tolist(), bounds, ids


class Encoder:
    """Token ids of slices of texts, word by word through the cache."""

    def __init__(self, tokenizer_file: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.end = end_id
        wide = max(self.tokenizer.get_vocab_size(), end_id + 1) > 1 << 16
        self.cache = WordCache(np.uint32 if wide else np.uint16)
        self._check()

    def _check(self) -> None:
        """Refuse tokenizers that the cuts, or the lower-casing, would give other ids than whole texts get."""
        probe = ["the an it's 12 (or, so)! a.b c", "The THE iT'S NASA-x McDonald UPPER", "É é Straße ΣΑΣ İ x\u0301 日本語 K\u0301", "a<b> <|x|> don'T,'re A_B|c"]
        raw = [x.encode() for x in probe]
        got, counts = self.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        want = [[*x.ids, self.end] for x in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        if counts.tolist() != list(map(len, want)) or got.tolist() != [y for x in want for y in x]:
            raise ValueError("this tokenizer doesn't drop white space, keeps words together or tells letters by their case")

    def _words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word. Lower-case ASCII letters are one pre-token that the normaliser and the
        byte mapping leave alone, so the library's model takes them directly."""
        tokenize = self.tokenizer.model.tokenize
        out = [[t.id for t in tokenize(w.decode())] if w.isalpha() else None for w in words]
        rest = [i for i, x in enumerate(out) if x is None]
        coded = self.tokenizer.encode_batch_fast([words[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False)
        for i, x in zip(rest, coded):
            out[i] = x.ids
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids with end ids, ids of each text)."""
        words = T.Words(data, off, T.NON_SPACE, False, (_LETTERS, _SIGNS))
        if len(words.start):
            as_is = np.concatenate([[0], np.cumsum((data >= 0x80) | (data == ord("<")))])
            plain = np.repeat(as_is[words.end] == as_is[words.start], words.end - words.start)
            at = np.flatnonzero(T.NON_SPACE[data])[plain]
            low = data.copy()
            low[at] = T.LOWER[low[at]]
            words.hash_of(low)
            rows = self.cache.rows(words, low.tobytes(), self._words)
            sizes, first = self.cache.size[rows], self.cache.first[rows]
        else:
            sizes = first = np.zeros(0, np.int64)
        per = np.concatenate([[0], np.cumsum(sizes)])
        counts = per[words.off[1:]] - per[words.off[:-1]] + 1
        out = np.empty(int(counts.sum()), self.cache.dtype)
        # an output index is its word's start, shifted by one for each text before
        shift = per[:-1] + words.doc
        steps = np.arange(per[-1])
        out[np.repeat(shift - per[:-1], sizes) + steps] = self.cache.flat[np.repeat(first - per[:-1], sizes) + steps]
        out[np.cumsum(counts) - 1] = self.end
        return out, counts


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """One per worker process, kept over its tasks."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def _write(tokenizer_file: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_file, end_id)
        shard, seq, before = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, before, held
            n = sum(map(len, ids))
            raw = image(names, np.concatenate(sizes), np.concatenate(ids))
            out = pa.record_batch(
                [pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([before]), pa.array([len(names)]), pa.array([n]), pa.array([raw], pa.binary())],
                names=["shard", "seq", "before", "n_docs", "n_ids", "image"],
            )
            seq, before, held = seq + 1, before + n, 0
            names.clear(), sizes.clear(), ids.clear()
            return out

        for batch in T.slices(batches, size=1 << 20):
            got, counts = enc.encode(*T.buffers(T.column(batch, "text")))
            names += T.column(batch, "doc_id").to_pylist()
            sizes.append(counts)
            ids.append(got)
            held += len(got)
            if held >= segment_ids:
                yield flush()
        if names:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", segment_ids: int = SEGMENT_IDS) -> None:
    """Write the token file of `docs` in ascending doc_id order to the folder `path`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_write(tokenizer_file, end_id, segment_ids), SEGMENTS).write.option("compression", "zstd").parquet(path)


def _read(base: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, before = T.column(batch, "shard")[i].as_py(), T.column(batch, "before")[i].as_py()
                names, bounds, ids = read_image(T.column(batch, "image")[i].as_py())
                at = bounds.select(np.arange(bounds.n))
                wide = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.record_batch(
                    [pa.array(names, pa.int64()), pa.array(at[:-1] + base[shard] + before), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(docs_spark, path: str) -> DataFrame:
    """Per document of the token file at `path`: doc_id, start, n_tokens, ids_crc32.

    Only one number a shard (a task of the writer) comes to the driver.
    """
    table = docs_spark.read.schema(SEGMENTS).parquet(path)
    totals = table.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").toArrow()
    ends = np.cumsum(totals.column("n").to_numpy()) if totals.num_rows else np.zeros(0, np.int64)
    base = dict(zip(totals.column("shard").to_pylist(), [0, *ends[:-1].tolist()]))
    return table.select("shard", "before", "image").mapInArrow(_read(base), ROWS)


def token_file(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Write the token file (by default below the shared folder) and read it back."""
    path = path or _store.new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_file, end_id, id_col, text_col)
    return read_tokens(docs.sparkSession, path)
