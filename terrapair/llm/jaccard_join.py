"""N-gram Jaccard self-join with a token-group matrix, and its connected components.

All sets are handled as classes of documents with equal shingle sets. The plan:

1. One scan hashes every text's distinct shingles. Of each set only the shingles whose hash
   is in the lowest part SAMPLE * (1 - threshold) leave the scan. A set can only be linked
   if one of its first ``n - ceil(threshold * n) + 1`` shingles in any fixed order is shared.
   In the order "lowest hashes first, rare before frequent" that can be told from the
   sample alone: where too many sampled shingles occur in no other set, the set is done.
2. The shingles of the remaining sets are read in full (texts are thinned by a Bloom filter
   before anything is shuffled) and ordered by rarity; the same test, now sharp, leaves sets
   with their rarest shared shingles, the *prefix*.
3. Leaders: in each of ROUNDS orders a set is compared with the first set (its leader)
   among all that share a prefix shingle, which links most near copies with one comparison
   each. The components of those links are known from here on.
4. Token-group matrix: the sets of one leader are similar and form a group, cut into blocks
   of at most BLOCK sets with the union of their shingles. A set is queried against the blocks of
   groups that share one of its prefix shingles, unless these are all in its own component;
   a block is opened only if the overlap with its union can reach the threshold, and
   then counted member by member through its inverted lists. Links to other components come out.

Prefix shingles of one component only need no query, so many copies never become pairs. No
step gathers the sets of one shingle, group or component in one place: blocks have a bounded number
of members, and the queries of a block are dealt out in chunks of about QUERIES.

Shingles are compared by 64-bit hashes.

Defined cases: null, empty or wordless text has no shingles and links with nothing
(component_id is its own id); a null doc_id takes part, is never a component's smallest id,
and gets the component's smallest non-null id (null if there is none); rows with one
doc_id are separate documents, linked by their texts; very long texts are whole; other
columns are ignored (`keep_one` keeps them); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _store, bloom, hot
from terrapair.llm import _text as T
from terrapair.llm.components import components

SHINGLE, THRESHOLD = 5, 80
SAMPLE = 4 / 3
ROUNDS = 2
BLOCK = 512
#: Shingles of a block's sets, about: long texts have blocks of fewer sets.
BLOCK_SHINGLES = 4_000_000
QUERIES = 4096
#: Classes that a task remembers so as to send their shingles once.
SEEN = 500_000

_SIGNATURES = "doc_id long, cid long, n int, c int, cand array<long>"
_SETS = "cid long, n int, tokens array<long>"


def prefix_length(n, threshold: int):
    """n - ceil(threshold * n / 100) + 1 in integers, for ints and arrays."""
    return n - (threshold * n + 99) // 100 + 1


def _prefix_length(n: str, threshold: int) -> Column:
    return F.expr(f"{n} - ({threshold} * {n} + 99) div 100 + 1")


def shingle_sets(batch_data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = T.Words(T.LOWER[batch_data], off, T.NON_SPACE)
    h = T.mix(T.rolling(words.hash, k))
    sums = T.prefix(words.hash)
    for a, b in zip(words.off[:-1].tolist(), words.off[1:].tolist()):
        if b - a >= k:
            yield np.unique(h[a : b - k + 1])
        elif b > a:  # the whole sequence; its length keeps it apart from shingles
            yield T.mix(T.ranges(sums, np.array([a]), np.array([b])) + T.U64(k - (b - a)))
        else:
            yield np.zeros(0, T.U64)


def class_id(s: np.ndarray) -> int:
    """A 64-bit hash of a set."""
    x = T.mix(s ^ T.U64(0xA5A5A5A5A5A5A5A5))
    both = np.add.reduce(x, keepdims=True) + np.bitwise_xor.reduce(x, keepdims=True) * T.U64(3) + T.U64(len(s))
    return int(T.mix(both).view(np.int64)[0])


def _lists(rows: list[np.ndarray], kind=np.int64) -> pa.Array:
    off = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, T.U64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat.view(kind)))


def _signatures(k: int, threshold: int):
    limit = T.U64(min(2**64 - 1, int(SAMPLE * (1 - threshold / 100) * 2**64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        none = np.zeros(0, T.U64)
        for batch in T.slices(batches):
            cid, n, c, cand = [], [], [], []
            for s in shingle_sets(*T.buffers(T.column(batch, "text")), k):
                x = class_id(s)
                count = max(int(np.searchsorted(s, limit)), min(len(s), prefix_length(len(s), threshold))) if len(s) else 0
                cand.append(none if x in seen else s[:count])
                seen.add(x)
                cid.append(x), n.append(len(s)), c.append(count)
            if len(seen) > SEEN:
                seen.clear()
            yield pa.record_batch([T.column(batch, "doc_id"), pa.array(cid, pa.int64()), pa.array(n, pa.int32()), pa.array(c, pa.int32()), _lists(cand)], names=["doc_id", "cid", "n", "c", "cand"])

    return run


def _full_sets(k: int, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in T.slices(batches):
            cids, sets = [], []
            for s in shingle_sets(*T.buffers(T.column(batch, "text")), k):
                x = class_id(s) if len(s) else None
                if x is not None and x not in seen:
                    cids.append(x), sets.append(s)
                    seen.add(x)
            if len(seen) > SEEN:
                seen.clear()
            if cids:
                may = np.flatnonzero(bloom.test(bits, np.array(cids, np.int64)))
                sets = [sets[i] for i in may]
                yield pa.record_batch([pa.array([cids[i] for i in may], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), _lists(sets)], names=["cid", "n", "tokens"])

    return run


def _shared(rows: DataFrame, df: bool) -> DataFrame:
    """Of (token, cid) the rows whose token is in several classes; with `df` their number.

    Tokens are dealt out once, and the aggregate and the join read the same exchange; rows of hot
    tokens stay where they are.
    """

    def many(x: DataFrame) -> DataFrame:
        if df:
            return x.groupBy("token").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1")
        return x.groupBy("token").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo < hi").select("token")

    def dealt(x: DataFrame) -> DataFrame:
        y = x.repartition("token")
        return y.join(many(y).hint("shuffle_hash"), "token")

    return hot.joined(rows, "token", "cid", many, dealt)


def _prefixes(threshold: int):
    """From each class's shared shingles with their frequencies: sorted shingles and the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid, n = T.column(batch, "cid").to_numpy(), T.column(batch, "n").to_numpy()
            tokens, dfs = T.column(batch, "tokens"), T.column(batch, "dfs")
            off = np.asarray(tokens.offsets)
            flat = np.asarray(tokens.values).view(T.U64)
            df = np.asarray(dfs.values)[np.asarray(dfs.offsets)[0] : np.asarray(dfs.offsets)[-1]]
            flat, off = flat[off[0] : off[-1]], off - off[0]
            keep, sets, heads = [], [], []
            for i, (a, b) in enumerate(zip(off[:-1], off[1:])):
                left = prefix_length(int(n[i]), threshold) - (int(n[i]) - int(b - a))
                if left > 0:
                    order = np.lexsort((flat[a:b], df[a:b]))
                    keep.append(i), sets.append(np.sort(flat[a:b])), heads.append(flat[a:b][order[:left]])
            if keep:
                yield pa.record_batch([pa.array(cid[keep]), pa.array(n[keep]), _lists(sets), _lists(heads)], names=["cid", "n", "tokens", "head"])

    return run


def _links(threshold: int):
    """Pairs of sets to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("tokens", "other"):
                lists = T.column(batch, name)
                sides.append((np.asarray(lists.values).view(T.U64), np.asarray(lists.offsets)))
            (x, xo), (y, yo) = sides
            n, m = T.column(batch, "n").to_numpy().astype(np.int64), T.column(batch, "m").to_numpy().astype(np.int64)
            both = np.fromiter((len(np.intersect1d(x[xo[i] : xo[i + 1]], y[yo[i] : yo[i + 1]], assume_unique=True)) for i in range(batch.num_rows)), np.int64, batch.num_rows)
            linked = pa.array(100 * both >= threshold * (n + m - both))
            yield pa.record_batch([T.column(batch, "cid").filter(linked), T.column(batch, "leader").filter(linked)], names=["a", "b"])

    return run


class Block:
    """A row of the token-group matrix: a block's members and the union of their shingles."""

    def __init__(self, members: list[tuple[int, int, int, np.ndarray]]):
        self.cids = np.array([m[0] for m in members], np.int64)
        self.comps = np.array([m[1] for m in members], np.int64)
        self.n = np.array([m[2] for m in members], np.int64)
        flat = np.concatenate([m[3] for m in members])
        order = np.argsort(flat, kind="stable")
        self.owner = np.repeat(np.arange(len(members)), [len(m[3]) for m in members])[order]
        self.union, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))

    def links(self, comp: int, n: int, tokens: np.ndarray, threshold: int) -> np.ndarray:
        """Members of other components that the query is linked with, one a component, if the
        overlap bound lets the block be opened."""
        at = np.searchsorted(self.union, tokens)
        at = at[self.union[np.minimum(at, len(self.union) - 1)] == tokens]
        if 100 * len(at) < threshold * n:  # a link shares at least threshold * n shingles
            return self.cids[:0]
        sizes = self.first[at + 1] - self.first[at]
        picks = np.repeat(self.first[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        both = np.bincount(self.owner[picks], minlength=len(self.n))
        good = np.flatnonzero((100 * both >= threshold * (n + self.n - both)) & (self.comps != comp))
        return self.cids[good[np.unique(self.comps[good], return_index=True)[1]]]


def _open_blocks(threshold: int):
    """Rows sorted by block and chunk, the members (kind 0) before the queries (kind 1): links found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, block = None, [], None
        for batch in batches:
            key = list(zip(*(T.column(batch, x).to_pylist() for x in ("group", "part", "chunk"))))
            kind, cid, comp, n = (T.column(batch, x).to_pylist() for x in ("kind", "cid", "comp", "n"))
            lists = T.column(batch, "tokens")
            off, flat = np.asarray(lists.offsets), np.asarray(lists.values).view(T.U64)
            found = []
            for i in range(batch.num_rows):
                if key[i] != now:
                    now, members, block = key[i], [], None
                tokens = flat[off[i] : off[i + 1]]
                if kind[i] == 0:
                    members.append((cid[i], comp[i], n[i], tokens.copy()))
                elif members:
                    block = block or Block(members)
                    found += [(cid[i], x) for x in block.links(comp[i], n[i], tokens, threshold).tolist()]
            if found:
                a, b = zip(*found)
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _leaders(heads: DataFrame, round_: int) -> DataFrame:
    """(cid, leader): the first set, in this round's order, of all that share a prefix shingle."""
    # the order is a bijection of the class hash, so that the first set is found with min()
    rank = F.col("cid") if round_ == 0 else F.struct(F.xxhash64("cid", F.lit(round_)).alias("r"), "cid")
    at = hot.joined(heads.select("token", "cid"), "token", "cid", lambda x: x.groupBy("token").agg(F.min(rank).alias("first")))
    mine = at.groupBy("cid").agg(F.min("first").alias("first"))
    return mine.select("cid", (F.col("first") if round_ == 0 else F.col("first.cid")).alias("leader"))


def _leader_links(sets: DataFrame, leaders: DataFrame, threshold: int) -> DataFrame:
    """Links of sets with their leaders."""
    other = sets.select(F.col("cid").alias("leader"), F.col("n").alias("m"), F.col("tokens").alias("other"))
    rows = leaders.where("leader <> cid").join(sets.select("cid", "n", "tokens"), "cid").join(other, "leader")
    fits = F.lit(100) * F.least("n", "m") >= F.lit(threshold) * F.greatest("n", "m")
    return rows.where(fits).select("cid", "leader", "n", "m", "tokens", "other").mapInArrow(_links(threshold), "a long, b long")


def _group_links(sets: DataFrame, heads: DataFrame, leaders: DataFrame, known: DataFrame, threshold: int) -> DataFrame:
    """Links between sets of different components, through the token-group matrix."""
    label = sets.select("cid", "n").join(leaders, "cid").join(known, F.col("cid") == F.col("node"), "left")
    label = label.select("cid", "n", F.col("leader").alias("group"), F.coalesce("label", "cid").alias("comp"))
    size = label.groupBy("group").agg(F.expr(f"cast(ceil(greatest(count(1) / {BLOCK}, sum(n) / {BLOCK_SHINGLES})) as int)").alias("parts"))
    label = label.join(size, "group").select("cid", "n", "comp", "group", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("cid"), "parts")).otherwise(0).cast("int").alias("part"))
    label = _store.stored(label, "groups")
    bounds = [F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("lo"), F.max("comp").alias("hi")]
    open_ = ~((F.col("lo") == F.col("hi")) & (F.col("lo") == F.col("comp")))
    fits = (F.lit(100) * F.col("most") >= F.lit(threshold) * F.col("n")) & (F.lit(threshold) * F.col("least") <= F.lit(100) * F.col("n"))

    rows = heads.select("token", "cid").join(label, "cid")
    mixed = lambda x: x.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    rows = _store.stored(hot.joined(rows, "token", "cid", mixed), "mixed")
    matrix = rows.groupBy("token", "group").agg(*bounds)
    query = rows.select("token", "cid", "n", "comp", F.col("group").alias("own"), F.col("part").alias("own_part"))
    asked = query.join(matrix, "token").where((F.col("own") >= F.col("group")) & fits & open_)
    asked = asked.select("cid", "n", "comp", "own", "own_part", "group").distinct()
    blocks = label.groupBy("group", "part").agg(*bounds)
    later = (F.col("own") > F.col("group")) | (F.col("own_part") >= F.col("part"))
    asked = asked.join(blocks, "group").where(later & fits & open_).select("cid", "comp", "group", "part")
    asked = _store.stored(asked, "asked")
    chunks = asked.groupBy("group", "part").agg(F.expr(f"cast(ceil(count(1) / {QUERIES}) as int)").alias("chunks"))
    asked = asked.join(chunks, ["group", "part"]).select("cid", "comp", "group", "part", F.pmod(F.xxhash64("cid"), "chunks").cast("int").alias("chunk"), F.lit(1).alias("kind"))
    members = label.select("cid", "comp", "group", "part").join(chunks, ["group", "part"])
    members = members.select("cid", "comp", "group", "part", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("kind"))
    both = members.union(asked).join(sets.select("cid", "n", "tokens"), "cid")
    key = ("group", "part", "chunk")
    both = both.select(*key, "kind", "cid", "comp", "n", "tokens").repartition(*key).sortWithinPartitions(*key, "kind")
    links = _store.stored(both.mapInArrow(_open_blocks(threshold), "a long, b long"), "links")
    for done in (label, rows, asked):
        _store.drop_stored(done)
    return links


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest doc_id that links reach.

    Two documents link when 100 * intersection >= threshold * union of their sets of
    `shingle` lower-cased words.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    wide = _store.stored(texts.mapInArrow(_signatures(shingle, threshold), _SIGNATURES), "signatures")
    narrow = _store.stored(wide.select("doc_id", "cid", "n"), "documents")

    sampled = wide.where("size(cand) > 0").select("cid", F.explode("cand").alias("token"))
    hits = _shared(sampled, False).select("token", "cid").distinct().groupBy("cid").agg(F.count(F.lit(1)).alias("hits"))
    info = wide.where("n > 0").groupBy("cid").agg(F.first("n").alias("n"), F.first("c").alias("c"))
    alive = info.join(hits, "cid").where(F.col("hits") > F.col("c") - _prefix_length("n", threshold)).select("cid")
    alive = _store.stored(alive, "alive")
    _store.drop_stored(wide)
    del wide, sampled, hits, info
    _store.release(spark)

    bits = bloom.build(alive, "cid")
    full = texts.select("text").mapInArrow(_full_sets(shingle, bits), _SETS)
    full = _store.stored(full.join(alive, "cid", "left_semi").dropDuplicates(["cid"]), "sets")
    _store.release(spark)
    shared = _shared(full.select("cid", "n", F.explode("tokens").alias("token")), True)
    heads = shared.groupBy("cid").agg(F.first("n").alias("n"), F.collect_list("token").alias("tokens"), F.collect_list("df").alias("dfs"))
    sets = _store.stored(heads.mapInArrow(_prefixes(threshold), f"{_SETS}, head array<long>"), "prefixes")
    _store.drop_stored(full)
    del full, shared, heads
    _store.release(spark)

    heads = _store.stored(sets.select("cid", F.explode("head").alias("token")), "heads")
    leaders = _store.stored(_leaders(heads, 0), "leaders")
    links = _store.stored(_leader_links(sets, leaders, threshold), "links")
    for k in range(1, ROUNDS):
        _store.release(spark)
        links = links.union(_store.stored(_leader_links(sets, _leaders(heads, k), threshold), "links"))
    _store.release(spark)
    groups = _store.stored(components(links), "labels")
    more = _group_links(sets, heads, leaders, groups, threshold)
    for done in (alive, sets, heads, leaders):
        _store.drop_stored(done)
    del sets, heads, leaders
    _store.release(spark)
    label = groups
    if not more.isEmpty():
        label = components(links.union(more))
    label = _store.stored(label, "labels")

    classes = narrow.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("least"))
    classes = classes.join(label.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "least", F.coalesce("label", "cid").alias("root"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component"))
    classes = classes.join(smallest, "root").select("cid", "component")
    out = narrow.join(classes, "cid", "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with all columns and of each component only its smallest doc_id.

    Rows that share a doc_id are one document here and stay or go together; rows without
    an id stay.
    """
    found = jaccard_components(docs, shingle, threshold, id_col, text_col)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
