"""The prefix trie of rebuilt conversations, by composable fingerprints.

Conversation c is rebuilt from the first h turns of its base (conversation
c - c % 5) and its own turns after its first h, where h = crc32(decimal c) % 9.
Each distinct sequence of first turns is a node, from the empty one (the root).

**Fingerprints.** A turn is an invertible map x -> m x + a modulo 2**64, with m
(odd) and a two hashes of its role and text; a sequence is the product of its
turns' maps. Products form a group, so with P(j) the product of the first j turns
of a stored conversation, the rebuilt one's first d turns have the product
P_base(h) * inverse(P_own(h)) * P_own(j): heads and suffixes are combined as pairs
of numbers, and no rebuilt text is ever made. A node's parent is its product times
the inverse of its last turn.

**Equality.** Nodes are grouped by (depth, product), and every row refers to a
stored turn. Turns with equal hashes have their stored roles and texts compared,
and all rows of a node must agree on their last turn and their parent; by
induction over the depth the sequences are then equal. If a comparison fails, all
starts again with other hashes.

**Sums over subtrees.** A node belongs to its smallest member. The nodes of one
conversation form a chain down to its end, so what lies below a node is the rest
of its own chain and the whole chains of its other members. One sum per chain and
one aggregation over the rows of members give ``n_leaves`` and ``saved_tokens``,
at any depth.

**Skew.** Turns are sorted by ranges of (conversation, turn), so a conversation
with most of all rows is spread over many tasks; products of ranges are composed
from one row per range. Chains are summed in blocks of ``CHAIN`` depths. All
group sizes are aggregated before they are shuffled. The ids that end at a node
are packed in blocks of ``ID_BLOCK`` ids; a node with more than one block is
hashed as a sorted stream, with one block in memory.

Rows with a NULL conv_id belong to no conversation and take no part. Turns are
ordered by turn (NULL first), equal turn numbers by a hash of role and text;
repeated rows are repeated turns. NULL roles and texts are empty ones. An empty
table has no node. Columns other than conv_id, turn, role and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationday.llm.common import on_workers, saved, table

BASE = 5  # conversations that share a base
HEADS = 9  # h is less than this
CHAIN = 4096
ID_BLOCK = 1 << 14

ONE, ZERO = np.uint64(1), np.uint64(0)


# --- the monoid ----------------------------------------------------------------


def inverse(m: np.ndarray) -> np.ndarray:
    """1 / m modulo 2**64 for odd m: each step doubles the right bits."""
    x = m.copy()  # right to 3 bits
    for _ in range(5):
        x = x * (np.uint64(2) - m * x)
    return x


def times(m1, a1, m2, a2):
    """The product of first (m1, a1), then (m2, a2)."""
    return m1 * m2, a1 * m2 + a2


def without_last(m, a, m2, a2):
    """What times (m2, a2) gives (m, a)."""
    i = inverse(m2)
    return m * i, (a - a2) * i


def suffix(m1, a1, m, a):
    """What (m1, a1) has to be multiplied with to give (m, a)."""
    q = m * inverse(m1)
    return q, a - a1 * q


def prefix_products(m: np.ndarray, a: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Products of every group's first maps, for rows in order of groups."""
    if not len(m):
        return m, a
    up = np.multiply.accumulate(m)
    down = inverse(up)
    total = np.cumsum(a * down, dtype=np.uint64) * up  # the products over all rows
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.append(first, len(m)))
    m0 = np.repeat(np.where(first > 0, up[first - 1], ONE), size)
    a0 = np.repeat(np.where(first > 0, total[first - 1], ZERO), size)
    return suffix(m0, a0, up, total)


def _unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _with(batch: pa.RecordBatch, names: list[str], **cols: np.ndarray) -> pa.RecordBatch:
    """The named columns, from ``cols`` (as longs) or from the batch."""
    out = [pa.array(cols[c].view(np.int64)) if c in cols else batch.column(batch.schema.get_field_index(c)) for c in names]
    return pa.RecordBatch.from_arrays(out, names=names)


# --- stored turns --------------------------------------------------------------


def stored_turns(rows: DataFrame, seed: int) -> DataFrame:
    """(conv_id, turn, f, g, bytes): each turn's two hashes and its text's size."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    f, g = (F.xxhash64(F.lit(seed + k), F.octet_length(role), role, text) for k in (0, 7919))
    return rows.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", f.bitwiseOR(F.lit(1)).alias("f"), g.alias("g"), F.octet_length(text).cast("long").alias("bytes"))


def hashes_agree(rows: DataFrame, seed: int) -> bool:
    """Whether all stored turns with equal hashes have equal roles and texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.filter("conv_id IS NOT NULL").select(role.alias("role"), text.alias("text"))
    f, g = (F.xxhash64(F.lit(seed + k), F.octet_length("role"), F.col("role"), F.col("text")) for k in (0, 7919))
    own = F.struct("role", "text")
    turns = turns.select(f.bitwiseOR(F.lit(1)).alias("f"), g.alias("g"), own.alias("own"))
    return turns.groupBy("f", "g").agg(F.min("own").alias("x"), F.max("own").alias("y")).filter("x != y").isEmpty()


def ranged_products(turns: DataFrame) -> DataFrame:
    """(part, conv_id, at, f, g, bytes, m, a): turns in order, ``at`` and the
    products within a conversation's rows of one range of the sort."""
    names = ["part", "conv_id", "at", "f", "g", "bytes", "m", "a"]
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("g"), F.asc("f")]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "f", "g", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, count, m0, a0 = None, 0, ONE, ZERO  # the conversation that the batch before ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            m, a = prefix_products(_unsigned(batch, "f"), _unsigned(batch, "g"), conv)
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            at = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv)))) + 1
            if last is not None and conv[0] == last:
                on = conv == last
                m[on], a[on] = times(m0, a0, m[on], a[on])
                at[on] += count
            last, count, m0, a0 = conv[-1], at[-1], m[-1], a[-1]
            yield _with(batch, names, part=np.full(len(conv), part, np.int64), at=at, m=m, a=a)

    return ordered.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def whole_products(ranged: DataFrame) -> DataFrame:
    """(conv_id, pos, f, g, bytes, m, a): the place of each turn in its
    conversation and the product of all turns up to it."""
    parts = ranged.groupBy("conv_id", "part").agg(F.max(F.struct("at", "m", "a")).alias("end"))
    split = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("part", "end"))).alias("ends")).filter("n > 1")
    before = "conv_id bigint, part bigint, skip bigint, m0 bigint, a0 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a list has a row per range of the sort at most
        for batch in batches:
            out = []
            for conv, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                skip, m, a = 0, np.array([1], np.uint64), np.array([0], np.uint64)
                for x in ends:
                    out.append((conv, x["part"], skip, int(m.view(np.int64)[0]), int(a.view(np.int64)[0])))
                    m2, a2 = (np.array([x["end"][c]], np.int64).view(np.uint64) for c in ("m", "a"))
                    m, a = times(m, a, m2, a2)
                    skip += x["end"]["at"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["conv_id", "part", "skip", "m0", "a0"])

    offsets = saved(split.select("conv_id", "ends").mapInArrow(run, before), "trie-offsets")
    joined = ranged.join(offsets, ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("skip", F.lit(0))).alias("pos"), "f", "g", "bytes", "m", "a", F.coalesce("m0", F.lit(1)).alias("m0"), F.coalesce("a0", F.lit(0)).alias("a0"))
    names = ["conv_id", "pos", "f", "g", "bytes", "m", "a"]

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, a = times(*(_unsigned(batch, c) for c in ("m0", "a0", "m", "a")))
            yield _with(batch, names, m=m, a=a)

    return joined.mapInArrow(compose, ", ".join(f"{c} bigint" for c in names))


# --- rebuilt conversations -----------------------------------------------------


def head_turns(conv_id: Column) -> Column:
    """h of a conversation."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEADS))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, last, m, a, pm, pa, f, g, bytes): a row for each depth of
    each rebuilt conversation, the empty start included: the products of the turns
    up to there and before the last one, and what is stored of the last one."""
    near = turns.filter(F.col("pos") < HEADS)
    heads = near.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "f", "g", "bytes", "m", "a"))).alias("head"))
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = saved(heads.join(sizes, "conv_id"), "trie-heads")
    h = head_turns(F.col("conv_id"))
    base = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    own = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE).join(base, "base", "left")
    of = F.slice(F.coalesce("base_head", F.array().cast("array<struct<pos:bigint,f:bigint,g:bigint,bytes:bigint,m:bigint,a:bigint>>")), 1, F.col("h").cast("int"))
    own = own.withColumn("taken", of).withColumn("hb", F.size("taken").cast("long")).withColumn("cut", F.least("h", "n"))
    at = lambda c, k, field, none: F.coalesce(F.try_element_at(F.col(c), F.nullif(F.col(k).cast("int"), F.lit(0)))[field], F.lit(none))
    own = own.withColumn("size", F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    own = saved(own.select("conv_id", "h", "hb", "size", "taken", at("taken", "hb", "m", 1).alias("bm"), at("taken", "hb", "a", 0).alias("ba"), at("head", "cut", "m", 1).alias("om"), at("head", "cut", "a", 0).alias("oa")), "trie-convs")
    root = own.select("conv_id", F.lit(0).cast("long").alias("depth"), "size", *(F.lit(x).cast("long").alias(c) for c, x in (("f", 1), ("g", 0), ("bytes", 0), ("m", 1), ("a", 0), ("bm", 1), ("ba", 0), ("om", 1), ("oa", 0))))
    t = F.col("t")
    head = own.select("conv_id", "size", F.explode("taken").alias("t")).select("conv_id", t["pos"].alias("depth"), "size", *(t[c].alias(c) for c in ("f", "g", "bytes", "m", "a")), *(F.lit(x).cast("long").alias(c) for c, x in (("bm", 1), ("ba", 0), ("om", 1), ("oa", 0))))
    rest = turns.filter(F.col("pos") > h).join(own.select("conv_id", "h", "hb", "size", "bm", "ba", "om", "oa"), "conv_id")
    rest = rest.select("conv_id", (F.col("hb") + F.col("pos") - F.col("h")).alias("depth"), "size", "f", "g", "bytes", "m", "a", "bm", "ba", "om", "oa")
    names = ["conv_id", "depth", "last", "m", "a", "pm", "pa", "f", "g", "bytes"]

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, g, m, a, bm, ba, om, oa = (_unsigned(batch, c) for c in ("f", "g", "m", "a", "bm", "ba", "om", "oa"))
            m, a = times(bm, ba, *suffix(om, oa, m, a))
            pm, pa_ = without_last(m, a, f, g)
            last = (_unsigned(batch, "depth") == _unsigned(batch, "size")).astype(np.int64)
            yield _with(batch, names, last=last, m=m, a=a, pm=pm, pa=pa_)

    return root.unionByName(head).unionByName(rest).mapInArrow(compose, ", ".join(f"{c} bigint" for c in names))


KEY = ["depth", "m", "a"]


def nodes_of(rows: DataFrame) -> DataFrame:
    """(depth, m, a, conv_id, n_convs, pm, pa, bytes, equal): the nodes; ``equal``
    says that all members agree on the last turn and on the parent."""
    own = F.struct("f", "g", "pm", "pa")
    out = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min(own).alias("x"), F.max(own).alias("y"), F.min("bytes").alias("bytes"))
    return out.select(*KEY, "conv_id", "n_convs", F.col("x.pm").alias("pm"), F.col("x.pa").alias("pa"), "bytes", (F.col("x") == F.col("y")).alias("equal"))


def above_in_chain(nodes: DataFrame) -> DataFrame:
    """nodes with ``above``: the weights of the nodes of the same conversation
    with a smaller depth, summed block by block."""
    nodes = nodes.withColumn("block", F.floor(F.col("depth") / CHAIN))
    in_block = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    blocks = nodes.groupBy("conv_id", "block").agg(F.sum("weight").alias("w"))
    whole = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.withColumn("earlier", F.sum("w").over(whole)).filter("earlier > 0").select("conv_id", "block", "earlier")
    out = nodes.withColumn("own", F.coalesce(F.sum("weight").over(in_block), F.lit(0))).join(later, ["conv_id", "block"], "left")
    return out.withColumn("above", F.col("own") + F.coalesce("earlier", F.lit(0))).drop("block", "own", "earlier")


def ends_of(rows: DataFrame) -> DataFrame:
    """(depth, m, a, ends_sha256) for nodes where conversations end."""
    block = F.shiftright("conv_id", ID_BLOCK.bit_length() - 1)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = rows.filter("last = 1").groupBy(*KEY, block.alias("block")).agg(ids.alias("ids"))
    pieces = saved(pieces, "trie-ends")
    many = pieces.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*KEY)
    many = saved(many, "trie-hot-ends")
    single = pieces.join(many, KEY, "left_anti").select(*KEY, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    streamed = pieces.join(many, KEY, "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "block").select(*KEY, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for *own, ids_ in zip(*(c.to_pylist() for c in batch.columns)):
                if own != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids_.encode())
            if out:
                yield _digests(out)
        if key is not None:
            yield _digests([(*key, state.hexdigest())])

    return single.unionByName(streamed.mapInArrow(run, "depth bigint, m bigint, a bigint, ends_sha256 string"))


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=[*KEY, "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie's nodes: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256)."""
    on_workers(conversations.sparkSession)
    seed = 1
    while True:
        if hashes_agree(conversations, seed):
            turns = saved(whole_products(saved(ranged_products(stored_turns(conversations, seed)), "trie-ranges")), "trie-turns")
            rows = saved(rebuilt(turns), "trie-rows")
            nodes = saved(nodes_of(rows), "trie-groups")
            if nodes.filter("NOT equal").isEmpty():
                break
        seed += 1
    kids = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pm").alias("m"), F.col("pa").alias("a")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.drop("equal").join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    # a node above the root's depth has no text: the root weighs nothing
    nodes = saved(nodes.withColumn("weight", F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(F.lit(0))), "trie-nodes")
    chains = nodes.groupBy("conv_id").agg(F.sum("weight").alias("chain"), F.sum((F.col("n_children") == 0).cast("long")).alias("ends"))
    below = rows.select("conv_id", *KEY).join(chains, "conv_id").groupBy(*KEY).agg(F.sum("chain").alias("chains"), F.sum("ends").alias("n_leaves"))
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("m").alias("pm"), F.col("a").alias("pa"), F.col("conv_id").alias("parent_conv_id"))
    out = above_in_chain(nodes).join(below, KEY).join(ends_of(rows), KEY, "left").join(up, ["depth", "pm", "pa"], "left")
    none = hashlib.sha256(b"").hexdigest()
    # all chains of the members but what lies above the node in its own one
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("chains") - F.col("above")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
