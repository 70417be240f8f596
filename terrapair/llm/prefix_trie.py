"""Conversation prefix trie by prefix-doubling naming.

Turns get dense names; blocks of 1, 2, 4, ... turns get the dense name of the pair of their
halves' names, one join round a length; the prefix of d turns is the chain of the blocks that d's
binary digits stand for, largest first, and is named in as many rounds from the largest blocks
down: a prefix whose lowest digit is 2**j is the named prefix without it, followed by a named
block of 2**j turns. Equal prefixes have equal names, so nodes are groups of names. A conversation of L
turns has fewer than 2 L blocks and L + 1 prefixes in about 2 log2(L) rounds.

Everything is keyed by (conversation, block), so a very long conversation is as many rows as any
others. Sums over subtrees need no walk: a node's subtree is counted through its
members, each node by the one member that it is named after (its owner), as sums over the rest of
a conversation followed by one partial aggregate.

Dense names: distinct pairs are dealt to BUCKETS by their hash, numbered in each in their order,
behind the sizes of the buckets before. No name depends on the order of tasks.

Defined cases: rows with a null conv_id belong to no conversation and are left out; a null role or
text is empty; a null turn comes first, equal turns are ordered by the digest of role and text; equal rows are
turns of their own; conv_id % 20 has the sign of conv_id; an empty table gives no rows (no conversation,
no root); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapair.llm import _store
from terrapair.llm import _text as T

WORDS = r"[^\x20\x09-\x0D]+"
#: Buckets that names are dealt to.
BUCKETS = 128
#: Turns of a conversation that are summed in one group.
STRETCH = 1024
#: Ids of one text of joined ids at most.
IDS = 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def _salt() -> Column:
    """Deals out rows that are equal in everything else."""
    return F.rand(7)


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, idx, role_text, n_words): turns by their place, role and text as a digest.

    Places come from one range exchange of narrow rows and the place of a conversation's first row, so
    that a conversation may be spread over any number of tasks.
    """
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), who.alias("role"), said.alias("text"))
    order = ["conv", F.asc_nulls_first("turn"), "hash", "salt"]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    narrow = rows.select("conv", "turn", digest.alias("hash"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("n_words"), _salt().alias("salt"))
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()  # task and place in it
    placed = placed.select("conv", F.unhex("hash").alias("role_text"), "n_words", F.shiftright(at, 33).cast("int").alias("task"), at.bitwiseAND((1 << 33) - 1).alias("at"))
    placed = _store.stored(placed, "turns")
    sizes = dict(placed.groupBy("task").agg(F.max("at") + 1).collect())  # a number a task
    before, total = [], 0
    for i in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(i, 0)
    if not before:
        before = [0]
    spread = placed.sparkSession.createDataFrame(list(enumerate(before)), "task int, before long")
    placed = placed.join(F.broadcast(spread), "task").select("conv", (F.col("at") + F.col("before")).alias("at"), "role_text", "n_words")
    first = placed.groupBy("conv").agg(F.min("at").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("at") - F.col("first")).alias("idx"), "role_text", "n_words")


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """((conv, pos, role_text, n_words), (conv, length)) of the conversations after heads were replaced.

    Conversation c starts with the first h turns of conversation c - c % every, h = crc32(c) % heads, and goes
    on with its own turns after its first h.
    """
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv") - F.col("conv") % every
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    of = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    plan = convs.select("conv", "n", base.alias("base"), h.alias("h")).join(of, "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    plan = _store.stored(plan.select("conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    own = turns.join(plan, "conv").where("idx >= h").select("conv", (F.col("idx") - F.col("h") + F.col("taken")).alias("pos"), "role_text", "n_words")
    lent = plan.where("taken > 0").select("conv", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("pos"))
    heads_ = turns.where(F.col("idx") < heads).select(F.col("conv").alias("base"), F.col("idx").alias("pos"), "role_text", "n_words")
    lent = lent.join(heads_, ["base", "pos"]).select("conv", "pos", "role_text", "n_words")
    return own.union(lent), plan.select("conv", "length")


def dense_names(pairs: DataFrame, keys: list[str], start: int) -> tuple[DataFrame, int, DataFrame]:
    """((*keys, name), first unused name, the table behind them): distinct keys numbered from `start`."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    distinct = _store.stored(pairs.select(*keys).distinct().withColumn("bucket", bucket), "names")
    sizes = dict(distinct.groupBy("bucket").count().collect())  # BUCKETS numbers
    before, total = [], start
    for i in range(BUCKETS):
        before.append(total)
        total += sizes.get(i, 0)
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*keys)) - 1
    named = distinct.select(*keys, (F.get(F.array(*(F.lit(x).cast("long") for x in before)), F.col("bucket")) + place).alias("name"))
    return named, total, distinct


def _named(rows: DataFrame, keys: list[str], start: int, *columns: str) -> tuple[DataFrame, int]:
    """`rows` with the dense name of their keys, stored."""
    names, end, behind = dense_names(rows, keys, start)
    out = _store.stored(rows.join(names, keys).select(*columns, "name"), "named")
    _store.drop_stored(behind)
    return out, end


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, node): names of all prefixes, 0 for the empty one."""
    longest = convs.agg(F.max("length")).first()[0] or 0
    blocks, end = _named(turns, ["role_text"], 0, "conv", F.col("pos").alias("b"))
    levels = [blocks]
    while 2 << (len(levels) - 1) <= longest:
        even = levels[-1].where("b % 2 = 0").select("conv", F.expr("b div 2").alias("b"), F.col("name").alias("l"))
        odd = levels[-1].where("b % 2 = 1").select("conv", F.expr("b div 2").alias("b"), F.col("name").alias("r"))
        blocks, _ = _named(even.join(odd, ["conv", "b"]), ["l", "r"], 0, "conv", "b")
        levels.append(blocks)
    done = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("name"))
    end, parts = 1, []
    for j in reversed(range(len(levels))):
        size = 1 << j
        block = levels[j].where("b % 2 = 0").select("conv", (F.col("b") * size).alias("depth"), F.col("name").alias("r"))
        longer = done.withColumnRenamed("name", "l").join(block, ["conv", "depth"]).withColumn("depth", F.col("depth") + size)
        more, end = _named(longer, ["l", "r"], end, "conv", "depth")
        parts.append(more)
        done = done.union(more)
    for x in levels:
        _store.drop_stored(x)
    out = _store.stored(done.withColumnRenamed("name", "node"), "prefixes")
    for x in parts:
        _store.drop_stored(x)
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts of ids, in order, joined by commas: rows come sorted by (node, part)."""
    node, sha = None, hashlib.sha256()
    for batch in batches:
        out: list[tuple[int, str]] = []
        for x, ids in zip(T.column(batch, "node").to_pylist(), T.column(batch, "ids").to_pylist()):
            if x == node:
                sha.update(b",")
            else:
                if node is not None:
                    out.append((node, sha.hexdigest()))
                node, sha = x, hashlib.sha256()
            sha.update(ids.encode())
        if out:
            yield pa.record_batch([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out])], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.record_batch([pa.array([node], pa.int64()), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv).

    Ids are joined within parts of IDS consecutive ids, which bounds a group; a node's
    digest then runs over its parts as a stream.
    """
    part = F.shiftright("conv", IDS.bit_length() - 1)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    parts = ends.groupBy("node", part.alias("part")).agg(ids.alias("ids"))
    dealt = parts.repartition("node").sortWithinPartitions("node", "part")
    return dealt.mapInArrow(_digests, "node long, ends_sha256 string")


def _rest(rows: DataFrame, value: Column) -> DataFrame:
    """Adds `rest`: the sum of `value` over a conversation's rows from this depth on.

    Rows are summed in stretches of a conversation, then the stretches' totals.
    """
    rows = rows.withColumns({"_v": value, "_s": F.expr(f"depth div {STRETCH}")})
    inside = Window.partitionBy("conv", "_s").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("conv").orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv", "_s").agg(F.sum("_v").alias("_t")).select("conv", "_s", F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_after"))
    return rows.withColumn("_in", F.sum("_v").over(inside)).join(totals.where("_after <> 0"), ["conv", "_s"], "left").withColumn("rest", F.col("_in") + F.coalesce("_after", F.lit(0))).drop("_v", "_s", "_in", "_after")


def prefix_trie(conversations: DataFrame, every: int = 20, heads: int = 4, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    With heads=1 conversations stay as they are.
    """
    turns = _store.stored(numbered_turns(conversations, conv, turn, role, text), "numbered")
    made, convs = rebuilt(turns, every, heads)
    made = _store.stored(made, "rebuilt")
    _store.drop_stored(turns)
    at = prefixes(made, convs)
    above = at.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    words = made.select("conv", (F.col("pos") + 1).alias("depth"), "n_words")
    rows = at.join(above, ["conv", "depth"], "left").join(words, ["conv", "depth"], "left").join(convs, "conv")
    rows = _store.stored(rows.select("conv", "depth", "node", "parent", F.coalesce("n_words", F.lit(0)).alias("n_words"), (F.col("depth") == F.col("length")).alias("ends")), "rows")
    _store.drop_stored(made)
    _store.drop_stored(at)

    nodes = rows.groupBy("node").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"), F.min("parent").alias("parent"))
    nodes = _store.stored(nodes, "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = _store.stored(nodes.join(children, "node", "left").fillna(0, ["n_children"]), "trie")

    # a node counts through its owner only: everyone else's words are saved, and a leaf is its owner's end
    owner = nodes.select("node", "conv", "n_children")
    told = rows.join(owner, ["node", "conv"], "left")
    told = _rest(told, F.when(F.col("n_children").isNull(), F.col("n_words")).otherwise(F.lit(0)))
    leaf = rows.where("ends").join(owner.where("n_children = 0"), ["node", "conv"], "left_semi").select("conv", F.lit(1).alias("leaf"))
    told = told.join(leaf, "conv", "left")
    sums = told.groupBy("node").agg(F.sum("rest").alias("saved_tokens"), F.count("leaf").alias("n_leaves"))
    ends = end_digests(rows.where("ends").select("node", "conv"))
    up = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(sums, "node").join(ends, "node", "left").join(up, "parent", "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256")
    )


#: Prefixes as lists, subtrees as pairs of nodes; crc32 by its bits.
TRIE_SQL = r"""
with t as materialized (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as i, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
c as materialized (select c, c - c % 20 as base, n, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::bigint)), lambda a, x:
    list_reduce(list_prepend(xor(a, x), range(8)), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::bigint) % 4 as h from (select c, count(*) as n from t group by 1)),
s as materialized (
  select c.c, i - h + least(h, coalesce(b.n, 0)) as p, role, text from c join t on t.c = c.c and i >= h left join (select c as base, n from c) b using (base)
  union all select c.c, i as p, role, text from c join t on t.c = c.base and i < h),
line as materialized (select c.c, coalesce(l, []) as l from c left join (select c, list({'r': role, 't': text} order by p) as l from s group by 1) x on x.c = c.c),
pre as materialized (select c, d, len(l) = d as ends, md5(l[1:d]::varchar || d) as k, coalesce(len(regexp_extract_all(l[d].t, '[^\x20\x09-\x0D]+')), 0) as w from (select c, l, unnest(range(len(l) + 1)) as d from line)),
node as materialized (select k, min(c) as c, any_value(d) as d, count(*) as n, any_value(w) as w, string_agg(c::varchar, ',' order by c) filter (where ends) as ends from pre group by 1),
up as materialized (select node.k, pre.k as above from node join pre on pre.c = node.c and pre.d = node.d - 1),
kids as (select above as k, count(*) as n from up group by 1),
below as materialized (select pre.k, x.w * (x.n - 1) as saved, x.k not in (select k from kids) as leaf from node x join pre on pre.c = x.c and pre.d <= x.d),
sums as (select k, sum(saved) as saved, count(*) filter (where leaf) as leaves from below group by 1)
select node.c as conv_id, node.d as depth, p.c as parent_conv_id, node.n as n_convs, coalesce(kids.n, 0)::bigint as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(coalesce(node.ends, '')) as ends_sha256
from node join sums using (k) left join kids using (k) left join up using (k) left join node p on p.k = up.above
"""
