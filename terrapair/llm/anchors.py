"""Finding repeated windows of symbols through content-defined positions.

A window's *anchor* is the position, among its grams of K symbols, whose gram hash is smallest
(the leftmost of equals). Equal windows have equal anchors at equal offsets, so windows can be
told apart among the occurrences of their anchor's gram alone, and about 2 / (W - K + 2) of
the positions are anchors.

Plan, on classes of documents with equal texts:

1. scan: anchors' gram hashes of every text. Those in one class only are unique and dropped
   (unless a text repeats them itself, where that counts);
2. texts of the classes that share a gram (thinned by a Bloom filter before they are
   shuffled) are kept once a class, with their shared grams;
3. each shared anchor's *context* is the string of all windows it owns. Contexts are grouped by
   (gram, context): equal contexts are equal in all their windows, one of them goes on. Those of
   grams with a single context are done;
4. for each growing length, windows are ranked by (gram, string) in two steps: blocks of BLOCK
   neighbouring windows by what they have in common (unique blocks drop out) and by their
   union (equal blocks are decided), then single windows of the blocks that are left. Windows
   whose rank is unique drop out of the next length;
5. repeated windows come back as spans and are merged per text.

Ranks are grouped by Spark aggregates with partial sums, and joined back to the windows
by equi-joins that Spark can split; no rows of a gram, a context or a window are gathered anywhere,
however many documents share it. A group is told by two 64-bit hashes, a text by 128 bits.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _store, bloom
from terrapair.llm import _text as T

#: Neighbouring windows that are ranked together first.
BLOCK = 8
SEEN = 500_000
#: Grams whose least are found at once: their places take the low 24 bits of a hash, in every text.
PIECE = 1 << 24
NO_ID = (1 << 63) - 1

_CONTEXTS = "key long, whole long, c1 long, c2 long, who long, bases binary, n int, anchor int, size int, times int, body binary"
_NODES = "k long, w long, pid long, who long, b int"
_SPANS = "c1 long, c2 long, kind int, s int, e int"
_SECOND = T.U64(0x8CB92BA72F3D8DD7)


@dataclass(frozen=True)
class Scheme:
    """Symbols are bytes or words; windows of growing `lengths`, the last one being the threshold.

    Anchors are grams of `gram` symbols in windows of the first length.
    """

    words: bool
    lengths: tuple[int, ...]
    gram: int
    #: Do repeats inside one text count?
    within: bool


@dataclass
class Symbols:
    values: np.ndarray
    off: np.ndarray
    words: T.Words | None


def symbols(data: np.ndarray, off: np.ndarray, scheme: Scheme) -> Symbols:
    if not scheme.words:
        return Symbols(data.astype(T.U64) + T.U64(1), off, None)
    words = T.Words(data, off, T.NON_SPACE)
    return Symbols(words.hash, words.off, words)


def _leftmost(h: np.ndarray, w: int) -> np.ndarray:
    """For each w neighbours, the place of the least by its top 40 bits, the leftmost of equals."""
    low = T.U64(PIECE - 1)
    packed = (h & ~low) | np.arange(len(h), dtype=T.U64)
    # sliding minimum: a window's is the least of a block's suffix and the next block's prefix
    blocks = -(-len(packed) // w)
    padded = np.full(blocks * w, ~T.U64(0))
    padded[: len(packed)] = packed
    grid = padded.reshape(blocks, w)
    head = np.minimum.accumulate(grid, axis=1).reshape(-1)
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    n = len(packed) - w + 1
    least = np.minimum(tail[:n], head[w - 1 : w - 1 + n])
    return (least & low).astype(np.int64)


def runs(sym: Symbols, scheme: Scheme) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position, its gram hash, first and last window start) of every anchor."""
    w = scheme.lengths[0] - scheme.gram + 1
    inside = T.windows(sym.off, scheme.lengths[0])
    none = np.zeros(0, np.int64)
    if not inside.any():
        return none, none.astype(T.U64), none, none
    h = T.mix(T.rolling(sym.values, scheme.gram))
    # pieces share w - 1 grams, so that every window of a long text is in one of them
    step = PIECE - w + 1
    at = np.concatenate([a + _leftmost(h[a : a + PIECE], w) for a in range(0, len(h) - w + 1, step)])
    starts = np.flatnonzero(inside)
    at = at[starts]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    pos = at[first]
    return pos, h[pos], starts[first], starts[last]


def text_class(raw: memoryview) -> tuple[int, int]:
    return struct.unpack("<qq", hashlib.blake2b(raw, digest_size=16).digest())


def joined_words(data: np.ndarray, words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of each text's words joined by one space."""
    keep = T.NON_SPACE[data]
    more = np.zeros(len(words.start), bool)
    more[:-1] = words.doc[:-1] == words.doc[1:]
    gaps = words.end[more]
    out = data.copy()
    out[gaps] = 0x20
    keep[gaps] = True
    size = np.add.reduceat(np.append(words.end - words.start + more, 0), np.minimum(words.off[:-1], len(words.start))) if len(words.off) > 1 else np.zeros(0, int)
    size = np.where(words.count > 0, size, 0)
    return out[keep], np.concatenate([[0], np.cumsum(size)])


def _lists(rows: list[np.ndarray]) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, T.U64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.view(np.int64)))


def _scan(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        none = np.zeros(0, T.U64)
        for batch in T.slices(batches, size=1 << 20):
            data, off = T.buffers(T.column(batch, "text"))
            sym = symbols(data, off, scheme)
            _, key, first, _ = runs(sym, scheme)
            cut = np.searchsorted(first, sym.off)
            view = memoryview(np.ascontiguousarray(data))
            kept, kept_off = (data, off) if sym.words is None else joined_words(data, sym.words)
            kept = memoryview(np.ascontiguousarray(kept))
            cid, sha, keys, own = [], [], [], []
            for i in range(batch.num_rows):
                x = text_class(view[off[i] : off[i + 1]])
                mine, many = none, none
                if x not in seen and cut[i + 1] > cut[i]:
                    mine, times = np.unique(key[cut[i] : cut[i + 1]], return_counts=True)
                    many = mine[times > 1] if scheme.within else none
                seen.add(x)
                cid.append(x), keys.append(mine), own.append(many)
                sha.append(hashlib.sha256(kept[kept_off[i] : kept_off[i + 1]]).hexdigest())
            if len(seen) > SEEN:
                seen.clear()
            c = np.array(cid, np.int64).reshape(-1, 2)
            yield pa.record_batch([T.column(batch, "doc_id"), pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(np.diff(sym.off)), pa.array(sha), _lists(keys), _lists(own)], names=["doc_id", "c1", "c2", "n", "sha", "keys", "own"])

    return run


def _texts(bits: np.ndarray | None):
    """Texts whose class may be in the filter (None: all), once a class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in T.slices(batches):
            data, off = T.buffers(T.column(batch, "text"))
            view = memoryview(np.ascontiguousarray(data))
            c = np.array([text_class(view[a:b]) for a, b in zip(off[:-1], off[1:])], np.int64).reshape(-1, 2)
            may = np.ones(len(c), bool) if bits is None else bloom.test(bits, c[:, 0])
            keep = []
            for i in np.flatnonzero(may).tolist():
                x = (int(c[i, 0]), int(c[i, 1]))
                if x not in seen:
                    seen.add(x)
                    keep.append(i)
            if len(seen) > SEEN:
                seen.clear()
            if keep:
                yield pa.record_batch([pa.array(c[keep, 0]), pa.array(c[keep, 1]), T.column(batch, "text").take(pa.array(keep))], names=["c1", "c2", "text"])

    return run


def _binary(data: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _spread(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of the places start .. start + size of each row."""
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner]


def _contexts(scheme: Scheme):
    first_len, last_len = scheme.lengths[0], scheme.lengths[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, size=1 << 20):
            data, off = T.buffers(T.column(batch, "text"))
            sym = symbols(data, off, scheme)
            pos, key, first, last = runs(sym, scheme)
            doc = np.searchsorted(sym.off, first, "right") - 1
            shared = T.column(batch, "shared")
            soff, sflat = _list(shared)
            sflat = sflat.to_numpy().view(T.U64)
            cut = np.searchsorted(first, sym.off)
            mine = np.zeros(len(pos), bool)
            for i in range(batch.num_rows):
                mine[cut[i] : cut[i + 1]] = np.isin(key[cut[i] : cut[i + 1]], sflat[soff[i] : soff[i + 1]])
            pick = np.flatnonzero(mine)
            if not len(pick):
                continue
            pos, key, first, last, doc = (x[pick] for x in (pos, key, first, last, doc))
            # the windows of all lengths that start at the anchor's
            end = np.minimum(last + last_len, sym.off[doc + 1])
            anchor, n, size, base = pos - first, last - first + 1, end - first, first - sym.off[doc]
            shape = (size << 40 | n << 20 | anchor).astype(T.U64)
            whole = T.mix(T.ranges(T.prefix(sym.values, _SECOND), first, end, _SECOND) + T.mix(shape))
            # equal contexts in one text: one stands for them, with the places of all
            _, one, inverse, times = np.unique(T.mix(whole ^ T.mix(key)) + T.mix(doc.astype(T.U64)), return_index=True, return_inverse=True, return_counts=True)
            places = base[np.argsort(inverse.reshape(-1), kind="stable")].astype(np.int32)
            owner, at = _spread(first[one], size[one])
            body = sym.values[at] if scheme.words else data[at]
            unit = 8 if scheme.words else 1
            c1, c2, who = (T.column(batch, x).to_numpy()[doc[one]] for x in ("c1", "c2", "who"))
            yield pa.record_batch(
                [
                    pa.array(key[one].view(np.int64)),
                    pa.array(whole[one].view(np.int64)),
                    *(pa.array(x) for x in (c1, c2, who)),
                    _binary(places.view(np.uint8), np.concatenate([[0], np.cumsum(times) * 4])),
                    *(pa.array(x[one].astype(np.int32)) for x in (n, anchor, size)),
                    pa.array(times.astype(np.int32)),
                    _binary(body.view(np.uint8), np.concatenate([[0], np.cumsum(size[one]) * unit])),
                ],
                names=["key", "whole", "c1", "c2", "who", "bases", "n", "anchor", "size", "times", "body"],
            )

    return run


def _values(column: pa.Array, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of a column of bodies."""
    data, off = T.buffers(column)
    if scheme.words:
        return np.ascontiguousarray(data).view(T.U64), off // 8
    return data.astype(T.U64) + T.U64(1), off


def _list(col: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, values) of a list column, of its own rows only."""
    off = np.asarray(col.offsets).astype(np.int64)
    return off - off[0], col.values[off[0] : off[-1]]


def _fields(values: pa.Array, *names: str) -> list[np.ndarray]:
    return [pa.compute.struct_field(values, x).to_numpy(zero_copy_only=False) for x in names]


def _ints(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [T.column(batch, x).to_numpy().astype(np.int64) for x in names]


def _open(batch: pa.RecordBatch, owner: np.ndarray, l: np.ndarray) -> np.ndarray:
    """Mask of the windows (context, distance to the anchor) that are still to be decided.

    `ranges` are those that were repeated at the length before (null: all of them), `lo` to
    `hi` those that a factor covers.
    """
    out = np.ones(len(l), bool)
    if "ranges" in batch.schema.names:
        col = T.column(batch, "ranges")
        given = col.is_valid().to_numpy(zero_copy_only=False)
        off, values = _list(col)
        a, b = (x.astype(np.int64) for x in _fields(values, "la", "lb"))
        row, at = _spread(a, b - a + 1)
        of = np.searchsorted(off, row, "right") - 1
        wide = 1 << 20
        out = ~given[owner] | np.isin(owner * wide + l, of * wide + at)
    if "lo" in batch.schema.names:
        lo, hi = _ints(batch, "lo", "hi")
        out &= (l < lo[owner]) | (l > hi[owner])
    return out


def _nodes(scheme: Scheme, h: int, block: int, within: int = 0):
    """(k, w) of each block of neighbouring windows of h symbols: hashes of what they share and of their union.

    A block that is open only in part has a w of its own. With `within`, only blocks are
    taken that lie in the listed ones of that size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "body", 1 << 20):
            values, off = _values(T.column(batch, "body"), scheme)
            key, pid, n, anchor, size = _ints(batch, "key", "pid", "n", "anchor", "size")
            owner, at = _spread(np.zeros(len(n), np.int64), np.maximum(np.minimum(n, size - h + 1), 0))
            l = anchor[owner] - at
            b = l // block
            todo = _open(batch, owner, l)
            if within:
                col = T.column(batch, "blocks")
                boff, flat = _list(col)
                flat = flat.to_numpy().astype(np.int64)
                of = np.searchsorted(boff, np.arange(len(flat)), "right") - 1
                wide = 1 << 20
                todo &= np.isin(owner * wide + l // within, of * wide + flat)
            owner, b = owner[todo], b[todo]
            if not len(owner):
                continue
            new = np.ones(len(b), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (b[1:] != b[:-1])
            one = np.flatnonzero(new)
            full = np.diff(np.append(one, len(b))) == block
            owner, b = owner[one], b[one]
            middle, near, far = off[owner] + anchor[owner], b * block, b * block + block - 1
            salt = T.mix(key[owner].view(T.U64) + T.mix((b * 4096 + h).astype(T.U64)))
            k = T.mix(T.ranges(T.prefix(values), middle - near, middle - far + h) + salt)
            w = T.mix(pid[owner].view(T.U64) + salt)
            f = np.flatnonzero(full)
            m = middle[f]
            w[f] = T.mix(T.ranges(T.prefix(values, _SECOND), m - far[f], m - near[f] + h, _SECOND) ^ key[owner[f]].view(T.U64))
            yield pa.record_batch(
                [pa.array(k.view(np.int64)), pa.array(w.view(np.int64)), T.column(batch, "pid").take(pa.array(owner)), T.column(batch, "who").take(pa.array(owner)), pa.array(b.astype(np.int32))], names=["k", "w", "pid", "who", "b"]
            )

    return run


def ranked(open_: DataFrame, scheme: Scheme, h: int) -> DataFrame:
    """(pid, la, lb, more) of the windows of h symbols that are repeated, by distance to the anchor.

    Repeated: with `within`, that start anywhere else, and more tells if in another text; without,
    those that also start in a text of a smaller `who`.
    """
    stats = (F.count(F.lit(1)).alias("c"), F.min("who").alias("first"), F.max("who").alias("last"))
    hit = F.lit(True) if scheme.within else F.col("who") > F.col("first")
    more = F.col("first") < F.col("last")
    blocks = _store.stored(open_.mapInArrow(_nodes(scheme, h, BLOCK), _NODES), "blocks")
    common = blocks.groupBy("k").agg(*stats, F.min("w").alias("w0"), F.max("w").alias("w1")).where("c > 1")
    found = _store.stored(blocks.join(common, "k").select("pid", "who", "b", "first", "last", (F.col("w0") == F.col("w1")).alias("equal")), "common")
    decided = found.where(F.col("equal") & hit).select("pid", (F.col("b") * BLOCK).alias("la"), (F.col("b") * BLOCK + BLOCK - 1).alias("lb"), more.alias("more"))
    _store.drop_stored(blocks)
    mixed = found.where("not equal").groupBy("pid").agg(F.collect_list("b").alias("blocks"))
    single = _store.stored(open_.join(mixed, "pid").mapInArrow(_nodes(scheme, h, 1, BLOCK), _NODES), "windows")
    same = single.groupBy("k", "w").agg(*stats).where("c > 1")
    ones = single.join(same, ["k", "w"]).where(hit).select("pid", F.col("b").alias("la"), F.col("b").alias("lb"), more.alias("more"))
    out = decided.union(ones).groupBy("pid").agg(F.collect_list(F.struct("la", "lb", "more")).alias("ranges"))
    out = _store.stored(out, "ranges")
    _store.drop_stored(single)
    _store.drop_stored(found)
    return out


def _spans(scheme: Scheme, h: int, kind: int, only_more: bool):
    """Spans of repeated windows of h symbols in their texts; null ranges: all windows of a context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "bases", 1 << 18):
            n, anchor, size, c1, c2 = _ints(batch, "n", "anchor", "size", "c1", "c2")
            m = np.minimum(n, size - h + 1)
            col = T.column(batch, "ranges")
            off, values = _list(col)
            given = col.is_valid().to_numpy(zero_copy_only=False)
            la, lb, more = _fields(values, "la", "lb", "more")
            of = np.searchsorted(off, np.arange(len(la)), "right") - 1
            good = more.astype(bool) if only_more else np.ones(len(la), bool)
            all_ = np.flatnonzero(~given & (m > 0))
            # runs of windows, relative to the context
            row = np.concatenate([of[good], all_])
            s = np.concatenate([anchor[of[good]] - lb[good], np.zeros(len(all_), np.int64)])
            e = np.concatenate([anchor[of[good]] - la[good] + h, m[all_] - 1 + h])
            # at each place of the context
            data, boff = T.buffers(T.column(batch, "bases"))
            places, upto = np.ascontiguousarray(data).view(np.int32).astype(np.int64), boff // 4
            many = np.diff(upto)[row]
            j, at = _spread(upto[row], many)
            row, s, e = row[j], places[at] + s[j], places[at] + e[j]
            # runs of one context and place may touch, as may those of neighbouring places
            order = np.lexsort((s, row))
            row, s, e = row[order], s[order], e[order]
            far = np.maximum.accumulate(row * (1 << 40) + e) - row * (1 << 40) if len(row) else e
            new = np.ones(len(s), bool)
            new[1:] = (row[1:] != row[:-1]) | (s[1:] > far[:-1])
            f = np.flatnonzero(new)
            e = np.maximum.reduceat(e, f) if len(f) else e
            yield pa.record_batch([pa.array(c1[row[f]]), pa.array(c2[row[f]]), pa.array(np.full(len(f), kind, np.int32)), pa.array(s[f].astype(np.int32)), pa.array(e.astype(np.int32))], names=["c1", "c2", "kind", "s", "e"])

    return run


def _covered(scheme: Scheme):
    """lo and hi: windows that the longest match around the anchor with the reference block covers."""
    h = scheme.lengths[-1]

    def reach(mine: np.ndarray, other: np.ndarray, me: np.ndarray, it: np.ndarray, step: int, room: np.ndarray) -> np.ndarray:
        far = np.zeros(len(me), np.int64)
        alive = np.arange(len(me))
        d = 0
        while len(alive := alive[room[alive] > d]):
            shift = d if step > 0 else -d - 1
            alive = alive[mine[me[alive] + shift] == other[it[alive] + shift]]
            d += 1
            far[alive] = d
        return far

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "body", 1 << 20):
            mine, off = _values(T.column(batch, "body"), scheme)
            other, off2 = _values(T.column(batch, "block"), scheme)
            anchor, there, pid, block = _ints(batch, "anchor", "block_anchor", "pid", "block_pid")
            me, it = off[:-1] + anchor, off2[:-1] + there
            left = reach(mine, other, me, it, -1, np.minimum(anchor, there))
            right = reach(mine, other, me, it, 1, np.minimum(off[1:] - me, off2[1:] - it))
            # a factor of at least h symbols covers windows; the block itself has none
            some = (left + right >= h) & (pid != block)
            lo, hi = np.where(some, h - right, 1), np.where(some, left, 0)
            keep = [c for c in batch.schema.names if not c.startswith("block")]
            yield pa.record_batch([*(T.column(batch, c) for c in keep), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], names=[*keep, "lo", "hi"])

    return run


def factored(open_: DataFrame, scheme: Scheme) -> DataFrame:
    """Contexts with the windows (lo to hi) that a factor covers.

    Every context is factored against the reference block of its gram, the earliest text's context.
    """
    lead = open_.where("who = earliest").groupBy("key").agg(F.min("pid").alias("pid"))
    block = open_.join(lead.select("pid"), "pid", "left_semi").select("key", F.col("pid").alias("block_pid"), F.col("anchor").alias("block_anchor"), F.col("body").alias("block"))
    both = open_.join(block, "key")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_.schema.fields)
    names = [*open_.columns, "block_pid", "block_anchor", "block"]
    return both.select(*names).mapInArrow(_covered(scheme), f"{schema}, lo int, hi int")


def _merged(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans; touching ones are one."""
    order = np.argsort(s)
    s, e = s[order], np.maximum.accumulate(e[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    return s[new], e[np.append(np.flatnonzero(new)[1:], len(new)) - 1] if len(s) else e


def _apply(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches):
            data, off = T.buffers(T.column(batch, "text"))
            words = T.Words(data, off, T.NON_SPACE, hashes=False) if scheme.words else None
            raw = data.tobytes()
            spans = T.column(batch, "spans")
            soff, values = _list(spans)
            kind, start, end = (x.astype(np.int64) for x in _fields(values, "kind", "s", "e"))
            rows = []
            for i in range(batch.num_rows):
                mine = slice(soff[i], soff[i + 1])
                k, s, e = kind[mine], start[mine], end[mine]
                half = np.subtract(*_merged(s[k == 0], e[k == 0])[::-1]).sum()
                s, e = _merged(s[k == 1], e[k == 1])
                keep, at = [], 0
                if words is None:
                    text = raw[off[i] : off[i + 1]]
                    for a, b in zip(s.tolist(), e.tolist()):
                        keep.append(text[at:a])
                        at = b
                    kept = b"".join([*keep, text[at:]])
                else:
                    a0, b0 = int(words.off[i]), int(words.off[i + 1])
                    gone = np.zeros(b0 - a0 + 1, np.int64)
                    np.add.at(gone, s, 1), np.add.at(gone, e, -1)
                    stay = a0 + np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    kept = b" ".join(raw[a:b] for a, b in zip(words.start[stay].tolist(), words.end[stay].tolist()))
                rows.append((int((e - s).sum()), len(s), int(half), hashlib.sha256(kept).hexdigest(), kept))
            col = list(zip(*rows))
            yield pa.record_batch(
                [T.column(batch, "c1"), T.column(batch, "c2"), *(pa.array(col[i], pa.int64()) for i in range(3)), pa.array(col[3]), pa.array(col[4], pa.binary())],
                names=["c1", "c2", "n_removed", "n_spans", "n_shared", "kept_sha256", "kept"],
            )

    return run


def repeated_windows(docs: DataFrame, scheme: Scheme, id_col: str, text_col: str, texts: bool = False) -> DataFrame:
    """Per document: doc_id, n, n_removed, n_spans, n_shared, kept_sha256 (and kept, the remaining bytes).

    A class of equal texts is decided once. Where repeats inside a text count, the
    windows of a text that has a copy are all repeats; else those of all copies but the
    ones of the smallest doc_id. n_shared counts symbols in windows of the first of several lengths
    that also start in another document.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wide = _store.stored(source.mapInArrow(_scan(scheme), "doc_id long, c1 long, c2 long, n long, sha string, keys array<long>, own array<long>"), "anchors")
    narrow = _store.stored(wide.select("doc_id", "c1", "c2", "n", "sha"), "documents")
    classes = narrow.groupBy("c1", "c2").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("eid"), F.count(F.lit(1)).alias("copies"))
    classes = _store.stored(classes, "classes")

    # half a class will do to list grams: one too many is found to be unique later
    keys = wide.where("size(keys) > 0").select("c1", F.explode("keys").alias("key"))
    many = keys.groupBy("key").agg(F.min("c1").alias("lo"), F.max("c1").alias("hi")).where("lo < hi").select("key")
    shared = keys.join(many, "key").select("c1", "key")
    if scheme.within:
        shared = shared.union(wide.where("size(own) > 0").select("c1", F.explode("own").alias("key")))
    shared = shared.groupBy("c1").agg(F.collect_list("key").alias("shared"))
    shared = _store.stored(shared.join(classes.select("c1", "c2", "eid"), "c1"), "shared")
    _store.drop_stored(wide)
    del wide, keys, many
    _store.release(spark)

    bits = bloom.build(shared, "c1")
    found = source.select("text").mapInArrow(_texts(bits), "c1 long, c2 long, text string")
    found = found.join(shared, ["c1", "c2"]).dropDuplicates(["c1", "c2"])
    who = F.col("c1") if scheme.within else F.col("eid")
    held = _store.stored(found.select("c1", "c2", who.alias("who"), "text", "shared"), "shared-texts", "zstd")
    contexts = held.mapInArrow(_contexts(scheme), _CONTEXTS).withColumn("pid", F.monotonically_increasing_id())
    contexts = _store.stored(contexts, "contexts")
    _store.drop_stored(shared)
    del found, shared

    # equal contexts of a gram
    equal = contexts.groupBy("key", "whole").agg(F.sum("times").alias("c"), F.min("who").alias("first"), F.max("who").alias("last"), F.min("pid").alias("lead"))
    per = _store.stored(contexts.groupBy("key").agg((F.min("whole") < F.max("whole")).alias("several"), F.min("who").alias("earliest")), "grams")
    equal = equal.join(per, "key").where("c > 1 or several")
    hit = (F.col("c") > 1) if scheme.within else (F.col("who") > F.col("first"))
    goes_on = F.col("several") & (((F.col("c") == 1) | (F.col("pid") == F.col("lead"))) if scheme.within else (F.col("who") == F.col("first")))
    root = contexts.join(equal, ["key", "whole"]).select(
        "pid", "key", "c1", "c2", "who", "bases", "n", "anchor", "size", "earliest", hit.alias("hit"), (F.col("first") < F.col("last")).alias("more"), goes_on.alias("goes_on"), F.when(goes_on, F.col("body")).alias("body")
    ).where("hit or goes_on")
    root = _store.stored(root, "groups")
    _store.drop_stored(contexts)
    _store.drop_stored(per)
    del contexts, equal, per
    _store.release(spark)

    ranges = "array<struct<la:int,lb:int,more:boolean>>"
    places = ["c1", "c2", "bases", "n", "anchor", "size", "ranges"]
    every = root.where("hit").withColumn("ranges", F.lit(None).cast(ranges))
    open_ = root.where("goes_on").select("pid", "key", "who", "n", "anchor", "size", "earliest", "hit", "body")
    spans: list[DataFrame] = []
    parts: list[DataFrame] = []
    if not scheme.within:
        open_ = _store.stored(factored(open_, scheme), "factored")
        parts.append(open_)
        cover = open_.where("lo <= hi and who > earliest").select("pid", F.array(F.struct(F.col("lo").alias("la"), F.col("hi").alias("lb"), F.lit(True).alias("more"))).alias("ranges"))
        spans.append(root.drop("ranges").join(cover, "pid").select(*places).mapInArrow(_spans(scheme, scheme.lengths[-1], 1, False), _SPANS))
    now = open_.drop("earliest")
    for h in scheme.lengths:
        found = ranked(now, scheme, h)
        _store.release(spark)
        parts.append(found)
        back = root.join(found, "pid").select(*places)
        if h == scheme.lengths[-1]:
            spans += [x.mapInArrow(_spans(scheme, h, 1, False), _SPANS) for x in (every.select(*places), back)]
        else:
            if h == scheme.lengths[0]:
                spans += [x.mapInArrow(_spans(scheme, h, 0, True), _SPANS) for x in (every.where("more").select(*places), back)]
            # contexts with an equal one stay whole, so that they still answer for their windows
            now = open_.drop("earliest").join(found, "pid", "left").where("hit or ranges is not null").withColumn("ranges", F.when(~F.col("hit"), F.col("ranges")))
    union = spans[0]
    for x in spans[1:]:
        union = union.union(x)
    union = union.groupBy("c1", "c2").agg(F.collect_list(F.struct("kind", "s", "e")).alias("spans"))
    cut = held.select("c1", "c2", "text").join(union, ["c1", "c2"]).mapInArrow(_apply(scheme), "c1 long, c2 long, n_removed long, n_spans long, n_shared long, kept_sha256 string, kept binary")
    if not texts:
        cut = cut.drop("kept")
    cut = _store.stored(cut, "cut")
    for x in (held, root, *parts):
        _store.drop_stored(x)
    del union, spans, held, root, open_, now, every, parts
    _store.release(spark)

    # a table of its own, so that Spark can split the join where a class has very many copies
    changed = _store.stored(classes.join(cut, ["c1", "c2"], "left").where("copies > 1 or n_removed is not null"), "changed")
    _store.drop_stored(classes)
    _store.drop_stored(cut)
    out = narrow.join(changed, ["c1", "c2"], "left")
    copy = F.coalesce(F.col("copies"), F.lit(1)) > 1
    if not scheme.within:
        copy &= F.coalesce("doc_id", F.lit(NO_ID)) > F.col("eid")
    whole = copy & (F.col("n") >= scheme.lengths[-1])
    shared_whole = copy & (F.col("n") >= scheme.lengths[0])
    empty = hashlib.sha256(b"").hexdigest()
    columns = [
        F.col("doc_id"),
        F.col("n"),
        F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(shared_whole, F.col("n")).otherwise(F.coalesce("n_shared", F.lit(0))).alias("n_shared"),
        F.when(whole, empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    ]
    if texts:  # null: nothing was removed
        columns.append(F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))
    return out.select(*columns)
