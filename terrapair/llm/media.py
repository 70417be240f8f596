"""Media columns: AVI motion-JPEG.

A payload becomes an AVI file of intra-only baseline JPEG frames and is read back by
parsing the RIFF index and decoding every frame. JPEG's pixels are not lossless, its
quantised coefficients are, so a payload byte is stored as one coefficient: amplitude
category 8 has exactly 256 values whose 8 amplitude bits are the byte. The Huffman tables
of a frame have that one symbol, each of a block's 64 coefficients (the first one too,
since every block is a restart interval) is a 0 bit and 8 amplitude bits, a block is
72 bytes, and whole batches of blocks are packed and unpacked at once.

Frames are decoded to pixels too (dequantised, inverse cosine transform, clipped to 0 to 255).
Shots are found by the difference of consecutive frames' pixel histograms against a threshold
that adapts to the differences before, which gives timed clips: `clips` has a row for each,
and the feature string their times. Two scans, no shuffle. The reader takes frames with
this format's Huffman tables and refuses others.

Defined cases: a null or empty text is 64 zero bytes in one frame; equal texts give
equal files; a null doc_id is kept; repeated rows give repeated results; other columns are
ignored; an empty table gives no rows. A file over 4 GB would need a second RIFF; texts
are far below (Spark's own limit of a value is 2 GB).
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _text as T

BLOCK = 64
CODED = 72  # bytes of a coded block: 64 x (1 + 8) bits
FRAME_BLOCKS = 64
FRAME_MS = 40
#: Adaptive shot detection: frames looked back on, deviations above their mean, and least difference.
LOOK_BACK, DEVIATIONS, LEAST = 8, 3.0, 0.25

MEDIA = "doc_id long, n_bytes long, media binary"
FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
CLIPS = "doc_id long, clip int, start_ms long, end_ms long, n_frames int"


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


_ONE_CODE = bytes([1] + [0] * 15) + b"\x08"  # one code, of one bit, for category 8
_TABLES = _segment(0xC4, b"\x00" + _ONE_CODE) + _segment(0xC4, b"\x10" + _ONE_CODE)
_START = b"\xff\xd8" + _segment(0xDB, b"\x00" + b"\x01" * 64)
_SCAN = _segment(0xDD, struct.pack(">H", 1)) + _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
_END = b"\xff\xd9"


def _jpeg(coded: bytes, blocks: int) -> bytes:
    size = _segment(0xC0, struct.pack(">BHHB", 8, 8 * blocks, 8, 1) + bytes([1, 0x11, 0]))
    return _START + size + _TABLES + _SCAN + coded + _END


def pack_blocks(payload: np.ndarray) -> np.ndarray:
    """Payload bytes [n * 64] to coded blocks [n, 72], before byte stuffing."""
    out = np.empty((len(payload) // BLOCK, CODED), np.uint8)
    for a in range(0, len(out), 4096):  # bits take eight times the bytes
        bits = np.unpackbits(payload[a * BLOCK : (a + 4096) * BLOCK]).reshape(-1, BLOCK, 8)
        units = np.zeros((len(bits), BLOCK, 9), np.uint8)
        units[:, :, 1:] = bits
        out[a : a + 4096] = np.packbits(units.reshape(len(bits), -1), axis=1)
    return out


def unpack_blocks(coded: np.ndarray) -> np.ndarray:
    """Coded blocks [n, 72] to payload bytes."""
    out = np.empty((len(coded), BLOCK), np.uint8)
    for a in range(0, len(coded), 4096):
        units = np.unpackbits(coded[a : a + 4096], axis=1).reshape(-1, BLOCK, 9)
        if units[:, :, 0].any():
            raise ValueError("a code that the frame's Huffman table doesn't have")
        out[a : a + 4096] = np.packbits(units[:, :, 1:].reshape(-1, BLOCK * 8), axis=1)
    return out.reshape(-1)


_RST = np.stack([np.full(8, 0xFF, np.uint8), np.arange(0xD0, 0xD8, dtype=np.uint8)], axis=1)


def _entropy(blocks: np.ndarray) -> bytes:
    """Coded blocks of a frame with byte stuffing and restart markers between them."""
    if not (blocks == 0xFF).any():
        out = np.empty((len(blocks), CODED + 2), np.uint8)
        out[:, :CODED] = blocks
        out[:, CODED:] = _RST[np.arange(len(blocks)) % 8]
        return out.tobytes()[:-2]
    parts = []
    for i, b in enumerate(blocks):
        parts += [b.tobytes().replace(b"\xff", b"\xff\x00"), _RST[i % 8].tobytes()]
    return b"".join(parts[:-1])


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\x00" * (len(body) & 1)


def encode_avi(blocks: np.ndarray) -> bytes:
    """An AVI file whose frames hold the coded blocks in order."""
    frames = [_jpeg(_entropy(part := blocks[a : a + FRAME_BLOCKS]), len(part)) for a in range(0, len(blocks), FRAME_BLOCKS)]
    tall, n = 8 * min(len(blocks), FRAME_BLOCKS), len(frames)
    largest = max(map(len, frames))
    avih = struct.pack("<14I", FRAME_MS * 1000, 0, 0, 0x10, n, 0, 1, largest, 8, tall, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4h", 0, 0, 0, 0, FRAME_MS, 1000, 0, n, largest, 0xFFFFFFFF, 0, 0, 0, 8, tall)
    strf = struct.pack("<IiiHH4sIiiII", 40, 8, tall, 1, 24, b"MJPG", largest, 0, 0, 0, 0)
    header = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        movi.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + header + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def _frames(avi: bytes) -> Iterator[bytes]:
    """The frames that the file's index lists."""
    if avi[:4] != b"RIFF" or avi[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, end, movi, index = 12, 8 + struct.unpack_from("<I", avi, 4)[0], None, None
    while at + 8 <= end:
        name, size = struct.unpack_from("<4sI", avi, at)
        if name == b"LIST" and avi[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"idx1":
            index = (at + 8, size)
        at += 8 + size + (size & 1)
    if movi is None or index is None:
        raise ValueError("no frames or no index")
    for k in range(index[1] // 16):
        _, _, offset, size = struct.unpack_from("<4sIII", avi, index[0] + 16 * k)
        a = movi + offset
        if struct.unpack_from("<I", avi, a + 4)[0] != size:
            raise ValueError("index and chunk differ")
        yield avi[a + 8 : a + 8 + size]


def _coded_blocks(jpeg: bytes) -> np.ndarray:
    """A frame's coded blocks [n, 72]: segments parsed, restart markers and stuffing gone."""
    if jpeg[:2] != b"\xff\xd8" or jpeg[-2:] != _END:
        raise ValueError("not a JPEG frame")
    at, n, codes = 2, 0, 0
    while True:
        marker, size = jpeg[at + 1], int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body = jpeg[at + 4 : at + 2 + size]
        if marker == 0xC0:
            n = int.from_bytes(body[1:3], "big") // 8
        elif marker == 0xC4:
            codes += body[1:] == _ONE_CODE
        at += 2 + size
        if marker == 0xDA:
            break
    if codes != 2:
        raise ValueError("other Huffman tables than this format's")
    raw = jpeg[at:-2]
    if len(raw) == n * (CODED + 2) - 2:
        rows = np.frombuffer(raw + _RST[(n - 1) % 8].tobytes(), np.uint8).reshape(n, CODED + 2)
        if (rows[:, CODED:] == _RST[np.arange(n) % 8]).all() and not (rows[:, :CODED] == 0xFF).any():
            return rows[:, :CODED]
    parts, begin, i = [], 0, 0
    while i < len(raw):
        if raw[i] == 0xFF and raw[i + 1] != 0:
            parts.append(raw[begin:i])
            begin = i = i + 2
        else:
            i += 1 + (raw[i] == 0xFF)
    parts.append(raw[begin:])
    return np.stack([np.frombuffer(p.replace(b"\xff\x00", b"\xff"), np.uint8) for p in parts])


def _zigzag() -> np.ndarray:
    """Row-major place of each coefficient in the order in which a block is coded."""
    cells = [(i, j) for i in range(8) for j in range(8)]
    cells.sort(key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * i + j for i, j in cells])


_ZIGZAG = _zigzag()
#: The cosine transform in whole numbers of 2**-11, so that sums are exact in any order.
_SCALE = 2048
_COSINE = np.array([[round(_SCALE / 2 * math.cos((2 * x + 1) * k * math.pi / 16) * (math.sqrt(0.5) if k == 0 else 1.0)) for x in range(8)] for k in range(8)], float)


def pixels(payload: np.ndarray) -> np.ndarray:
    """Pixels of the blocks whose coded amplitudes are the payload: [n * 64], 8 x 8 each."""
    v = payload.reshape(-1, BLOCK).astype(np.float64)
    v -= 255.0 * (v < 128)  # category 8: -255 to -128 and 128 to 255
    block = np.empty_like(v)
    block[:, _ZIGZAG] = v
    rows = (block.reshape(-1, 8) @ _COSINE).reshape(-1, 8, 8)  # along each row of coefficients
    both = np.ascontiguousarray(rows.transpose(0, 2, 1)).reshape(-1, 8) @ _COSINE
    out = np.floor(both / (_SCALE * _SCALE) + 0.5).reshape(-1, 8, 8).transpose(0, 2, 1) + 128
    return np.clip(out, 0, 255).astype(np.uint8).reshape(-1)


def shots(units: np.ndarray, sizes: np.ndarray) -> list[int]:
    """First frames of the shots of one file, from the histograms of its frames' pixels."""
    n = len(sizes)
    if n == 1:
        return [0]
    owner = np.repeat(np.arange(n), sizes)
    share = np.bincount(owner * 256 + units, minlength=n * 256).reshape(n, 256) / sizes[:, None]
    diff = np.abs(np.diff(share, axis=0)).sum(1) / 2
    cuts = [0]
    for t, d in enumerate(diff):
        before = diff[max(0, t - LOOK_BACK) : t]
        least = max(LEAST, before.mean() + DEVIATIONS * before.std()) if len(before) else LEAST
        if d > least:
            cuts.append(t + 1)
    return cuts


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches, size=1 << 20):
        data, off = T.buffers(T.column(batch, "text"))
        sizes = np.diff(off)
        padded = np.maximum(-(-sizes // BLOCK), 1) * BLOCK
        at = np.concatenate([[0], np.cumsum(padded)])
        payload = np.zeros(at[-1], np.uint8)
        payload[np.arange(len(data)) + np.repeat(at[:-1] - off[:-1], sizes)] = data
        blocks = pack_blocks(payload)
        files = [encode_avi(blocks[a // BLOCK : b // BLOCK]) for a, b in zip(at[:-1], at[1:])]
        yield pa.record_batch([T.column(batch, "doc_id"), pa.array(sizes), pa.array(files, pa.binary())], names=["doc_id", "n_bytes", "media"])


def _decoded(files: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(payload, pixels, pixels of each frame) of each file."""
    frames = [[_coded_blocks(f) for f in _frames(x)] for x in files]
    every = [b for one in frames for b in one]
    payload = unpack_blocks(np.concatenate(every)) if every else np.zeros(0, np.uint8)
    seen = pixels(payload)
    at = 0
    for one in frames:
        sizes = np.array([len(b) * BLOCK for b in one])
        part = slice(at, at + int(sizes.sum()))
        yield payload[part], seen[part], sizes
        at = part.stop


def _times(seen: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """First frame and frame after the last of each shot."""
    cuts = [*shots(seen, sizes), len(sizes)]
    return list(zip(cuts, cuts[1:]))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches, "media", 1 << 20):
        files = T.column(batch, "media").to_pylist()
        rows = []
        for raw, (payload, seen, sizes) in zip(files, _decoded(files)):
            data = payload.tobytes()
            luma = int(seen.sum(dtype=np.int64)) // len(seen)
            clips = ",".join(f"{FRAME_MS * a}-{FRAME_MS * b}" for a, b in _times(seen, sizes))
            rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-BLOCK:]), len(raw), hashlib.sha256(raw).hexdigest(), f"frames={len(sizes)};luma={luma};clips_ms={clips}"))
        c = list(zip(*rows))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.record_batch(
            [T.column(batch, "doc_id"), T.column(batch, "n_bytes"), *(pa.array(x, k) for x, k in zip(c, kinds))],
            names=[x.split()[0] for x in FEATURES.split(", ")],
        )


def _clips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.slices(batches, "media", 1 << 20):
        files, rows = T.column(batch, "media").to_pylist(), []
        for doc, (_, seen, sizes) in zip(T.column(batch, "doc_id").to_pylist(), _decoded(files)):
            rows += [(doc, k, FRAME_MS * a, FRAME_MS * b, b - a) for k, (a, b) in enumerate(_times(seen, sizes))]
        c = list(zip(*rows))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.record_batch([pa.array(x, k) for x, k in zip(c, kinds)], names=[x.split()[0] for x in CLIPS.split(", ")])


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and the text's bytes as an AVI file in the column media."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_encode, MEDIA)


def media_features(media: DataFrame) -> DataFrame:
    """What reading a media column back gives: the payload's digests and features."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, FEATURES)


def clips(media: DataFrame) -> DataFrame:
    """A row for each shot of each file, with its times."""
    return media.select("doc_id", "media").mapInArrow(_clips, CLIPS)
