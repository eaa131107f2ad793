"""Prefix trie of conversations as minimal-perfect-hash node tables.

The trie has one node for each distinct sequence of first turns.  It is never built in one
place:

1. ``in_order`` numbers the turns of every conversation; ``prefixes`` gives each turn the
   digest of the prefix it ends: the exclusive or, over the turns up to it, of a 128-bit
   hash of (place, role, text).  Both run over range partitions, which may cut a
   conversation, and are joined where they do.
2. Turns are dealt to shards by conversation and stretch of ``stretch`` turns.  A shard
   lists its distinct prefix digests, gives them slots by a minimal perfect hash (``Slots``,
   the digest is kept at its slot and compared), scatters members into flat arrays and notes
   each node's slot of its parent (``shard_nodes``).
3. A node that several shards know is added up over them.  That all of a node's turns have
   the same parent and the same content (SHA-256) is checked, so a digest that stood for two
   prefixes would be found; the digests are then made anew from another seed.
4. Every node's own share of the subtree sums goes to one shard, that of its smallest member,
   whose path holds all its ancestors.  There the shares are scattered into flat arrays and
   accumulated through the parent slots, deepest first (``shard_sums``); sums of the same
   node over all shards are added up.  Of a conversation of several stretches, the shares of
   later ones enter at the last turn of each earlier one.

Nothing is bounded by the size of the most common prefix: a shard has about ``shard_turns``
turns, whichever conversations they are from, and a node is one row of each shard.  The ids
that end at a node are hashed in order, as one stream of texts of ``chunk`` ids; SHA-256
itself is sequential, so one node's texts pass through one task, never held at once.

Defined cases: turns are ordered by turn (NULL first), ties by role, then by text.  NULL
role and text count as empty.  Rows without conv_id belong to no conversation and are left
out.  Repeated rows are turns like others.  A rebuilt conversation without turns is a member
of the root only.  Long texts are hashed whole.  An empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import written

ORDER_CHARS = 32    # of a text that place it in a range partition


@dataclass(frozen=True)
class Shards:
    shard_turns: int = 200_000  # turns in a shard, about
    stretch: int = 4096         # turns of one conversation in a shard
    chunk: int = 4096           # ids in one text of an id list
    seed: int = 0


# -- minimal perfect hash


def _mixed(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a ^ (b * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


class Slots:
    """Minimal perfect hash of distinct digests (two longs each): slots 0 to n - 1.

    Level by level, the digests still without a slot are hashed to about twice as many bits;
    those alone at a bit take it, the others go to the next level.  A slot is the number of
    taken bits before its own.  The digest kept at a slot tells members from strangers."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.a, self.b = np.zeros(len(a), dtype=np.uint64), np.zeros(len(b), dtype=np.uint64)
        left, taken = np.arange(len(a)), 0
        while left.size:
            x, y = a[left], b[left]
            at = (_mixed(x, y, len(self.levels)) % np.uint64(2 * left.size + 1)).astype(np.int64)
            alone = np.bincount(at, minlength=2 * left.size + 1) == 1
            rank = np.cumsum(alone) - 1 + taken
            placed = alone[at]
            slot = rank[at[placed]]
            self.a[slot], self.b[slot] = x[placed], y[placed]
            self.levels.append((np.where(alone, rank, -1), 2 * left.size + 1))
            taken += int(placed.sum())
            left = left[~placed]

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the digests; -1 for those that are not members."""
        out = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for level, (ranks, size) in enumerate(self.levels):
            slot = ranks[(_mixed(a[left], b[left], level) % np.uint64(size)).astype(np.int64)]
            hit = slot >= 0
            out[left[hit]] = slot[hit]
            left = left[~hit]
        known = out >= 0
        known[known] = (self.a[out[known]] == a[known]) & (self.b[out[known]] == b[known])
        return np.where(known, out, -1)


# -- values that run along each conversation

ADD = (np.add, np.subtract, F.sum, lambda a, b: a + b)
XOR = (np.bitwise_xor, np.bitwise_xor, F.bit_xor, lambda a, b: a.bitwiseXOR(b))


def _running(df: DataFrame, steps: list[str], how: tuple, range_by: list[Column], sort_by: list, name: str) -> DataFrame:
    """``df`` with the columns ``steps`` run along each conv_id in order (columns with
    ``__`` serve the order only and are left out).

    Range partitions are sorted and run through batch by batch.  Where a partition cuts a
    conversation, the totals of the partitions before join in (a row for each partition at
    most), so one conversation may be as large as it likes."""
    gather, undo, total, join = how
    ordered = df.repartitionByRange(*range_by).sortWithinPartitions(*sort_by).select(
        *[c for c in df.columns if not c.startswith("__")])
    names = ordered.columns

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, so_far = TaskContext.get().partitionId(), None, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(names.index("conv_id")).to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            sizes = np.diff(np.append(starts, len(conv)))
            columns = dict(zip(names, batch.columns))
            for step in steps:
                values = columns[step].to_numpy()
                run = gather.accumulate(values)
                run = undo(run, np.repeat(undo(run[starts], values[starts]), sizes))
                if conv[0] == before:
                    run[:sizes[0]] = gather(run[:sizes[0]], so_far[step])
                columns[step], so_far[step] = pa.array(run), run[-1]
            before = conv[-1]
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(np.full(len(conv), part, dtype=np.int64))], names=[*names, "part"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    table = written(ordered.mapInArrow(along, f"{fields}, part long"), name)
    # the last value of a conversation in a partition; only where the next one goes on does it matter
    edges = table.groupBy("part").agg(F.min("conv_id").alias("__lo"), F.max("conv_id").alias("__hi"))
    cut = edges.select(F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias("__cut"), "part")
    cut = cut.groupBy("__cut").agg(F.count("*").alias("parts")).where("parts > 1").select("__cut")
    if cut.isEmpty():
        return table.drop("part")
    last = table.join(cut, F.col("conv_id") == F.col("__cut"), "left_semi").groupBy("conv_id", "part").agg(
        *[F.max_by(s, F.struct(*_order(table, steps))).alias(s) for s in steps])
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(
        F.col("conv_id").alias("__conv"), F.col("part").alias("__part"),
        *[total(s).over(earlier).alias(f"__{s}") for s in steps])
    joined = table.join(carry, (F.col("conv_id") == F.col("__conv")) & (F.col("part") == F.col("__part")), "left")
    return joined.select(*[
        (F.when(F.col(f"__{c}").isNull(), F.col(c)).otherwise(join(F.col(c), F.col(f"__{c}"))).alias(c)
         if c in steps else F.col(c)) for c in names])


def _order(table: DataFrame, steps: list[str]) -> list[Column]:
    """What tells the last turn of a partition: the depth, or the running number itself."""
    return [F.col("depth")] if "depth" in table.columns else [F.col(s) for s in steps]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, content, bytes, place): the turns numbered from 1 in order; ``content`` is
    the SHA-256 of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("__turn"), role.alias("__role"),
        text.alias("__text"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("content"),
        F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("place"))
    order = ["conv_id", "__turn", "__role"]
    return _running(
        rows, ["place"], ADD, [*order, F.substring("__text", 1, ORDER_CHARS)], [*order, "__text"], "turns")


def rebuilt(numbered: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, content, bytes, total): every conversation with the turns it takes
    over.  ``conversations`` has conv_id, base, shared (how many turns of base come first)
    and skipped (how many of its own first turns do not count)."""
    own = numbered.join(conversations.select(
        F.col("conv_id").alias("__conv"), "shared", "skipped", "total"), F.col("conv_id") == F.col("__conv"))
    own = own.where(F.col("place") > F.col("skipped")).select(
        "conv_id", (F.col("place") - F.col("skipped") + F.col("shared")).alias("depth"), "content", "bytes", "total")
    heirs = conversations.where("shared > 0").select(
        F.col("conv_id").alias("__heir"), F.col("base").alias("__base"), "shared", "total")
    most = F.lit(BORROWED - 1)
    taken = numbered.where(F.col("place") <= most).join(
        heirs, (F.col("conv_id") == F.col("__base")) & (F.col("place") <= F.col("shared")))
    return own.unionByName(taken.select(
        F.col("__heir").alias("conv_id"), F.col("place").alias("depth"), "content", "bytes", "total"))


BORROWED = 9    # a conversation takes over fewer turns than this
FAMILY = 5      # conversations whose ids differ in the remainder by this only


def families(numbered: DataFrame) -> DataFrame:
    """(conv_id, base, shared, skipped, total): conversation c takes over the first h turns
    of c - c % 5 in place of its own first h, h = crc32(decimal c) % 9."""
    sizes = numbered.groupBy("conv_id").agg(F.max("place").alias("n"))
    skipped = F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED
    mine = sizes.select("conv_id", "n", skipped.alias("skipped"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    theirs = sizes.select(F.col("conv_id").alias("__base"), F.col("n").alias("__n"))
    joined = mine.join(theirs, F.col("base") == F.col("__base"), "left")
    shared = F.least("skipped", F.coalesce("__n", F.lit(0)))
    return joined.select(
        "conv_id", "base", shared.alias("shared"), "skipped",
        (shared + F.greatest(F.col("n") - F.col("skipped"), F.lit(0))).alias("total"))


def prefixes(turns_of: DataFrame, shards: Shards) -> DataFrame:
    """The turns with the digest (a, b) of the prefix that each ends, that of the prefix
    before (pa, pb), and their shard."""
    hashed = turns_of.withColumns({
        k: F.xxhash64(F.lit(2 * shards.seed + n), "depth", "content") for n, k in enumerate(("a", "b"))})
    hashed = hashed.withColumns({"pa": F.col("a"), "pb": F.col("b")})
    run = _running(hashed, ["a", "b"], XOR, [F.col("conv_id"), F.col("depth")], ["conv_id", "depth"], "prefixes")
    return run.withColumns({"pa": F.col("a").bitwiseXOR(F.col("pa")), "pb": F.col("b").bitwiseXOR(F.col("pb"))})


def _shard(count: int, shards: Shards, conv: str = "conv_id") -> Column:
    stretch = F.expr(f"(depth - 1) div {shards.stretch}")
    return F.pmod(F.xxhash64(conv, stretch), F.lit(count))


# -- one shard


def _unsigned(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy().view(np.uint64) for c in names]


def shard_nodes(table: pa.Table) -> pa.Table:
    """The distinct prefixes of a shard's turns, each with its members and smallest member."""
    a, b = _unsigned(table, "a", "b")
    conv = table.column("conv_id").to_numpy()
    digests = np.unique(np.stack((a, b), axis=1), axis=0)
    slots = Slots(digests[:, 0], digests[:, 1])
    at = slots.find(a, b)
    if (at < 0).any():
        raise RuntimeError("a prefix has no slot")
    n = len(digests)
    members, least, row = np.zeros(n, dtype=np.int64), np.full(n, np.iinfo(np.int64).max), np.zeros(n, dtype=np.int64)
    np.add.at(members, at, 1)
    np.minimum.at(least, at, conv)
    row[at] = np.arange(len(at))
    # every turn at a slot must be the same turn after the same prefix
    number = table.column("content").combine_chunks().dictionary_encode().indices.to_numpy()
    pa_, pb_ = _unsigned(table, "pa", "pb")
    depth = table.column("depth").to_numpy()
    same = np.ones(n, dtype=bool)
    for x in (number, pa_, pb_, depth):
        np.logical_and.at(same, at, x == x[row[at]])
    out = table.select(["shard", "depth", "a", "b", "pa", "pb", "content", "bytes"]).take(pa.array(row))
    return out.append_column("members", pa.array(members)).append_column("least", pa.array(least)).append_column(
        "same", pa.array(same))


def shard_sums(nodes: pa.Table, shares: pa.Table, stretch: int) -> pa.Table:
    """Every node of a shard with the shares of its subtree: scattered by slot, accumulated
    through the parent slots, deepest first, within a stretch of turns.  The root has no
    slot; what reaches it is its row (depth 0)."""
    a, b, pa_, pb_ = _unsigned(nodes, "a", "b", "pa", "pb")
    n = len(a)
    slots = Slots(a, b)
    order = slots.find(a, b)
    depth, parent = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    depth[order] = nodes.column("depth").to_numpy()
    parent[order] = slots.find(pa_, pb_)
    parent[(depth - 1) % stretch == 0] = -1     # what goes further up is among the shares
    parent[depth == 1] = n                      # the root
    sums = np.zeros((2, n + 1), dtype=np.int64)
    at = slots.find(*_unsigned(shares, "a", "b"))
    if (at < 0).any():
        raise RuntimeError("a share has no node in its shard")
    for k, c in enumerate(("leaves", "saved")):
        np.add.at(sums[k], at, shares.column(c).to_numpy())
    by_depth = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in reversed(np.split(by_depth, cuts)):
        level = level[parent[level] >= 0]
        for total in sums:
            np.add.at(total, parent[level], total[level])
    zero = np.zeros(1, dtype=np.uint64)
    return pa.table({
        "depth": np.append(depth, 0), "a": np.append(slots.a, zero).view(np.int64),
        "b": np.append(slots.b, zero).view(np.int64), "leaves": sums[0], "saved": sums[1]})


# -- ids that end at a node


def _texts_of_ids(size: int):
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            conv = batch.column(3).to_numpy()
            if not len(conv):
                continue
            starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            begin = np.concatenate([np.arange(lo, hi, size) for lo, hi in zip(starts, np.append(starts[1:], len(conv)))])
            end = np.append(begin[1:], len(conv))
            ids = conv.astype(str).tolist()
            yield pa.RecordBatch.from_arrays([
                *(pa.array(key[begin, k]) for k in range(3)), pa.array(conv[begin]),
                pa.array([",".join(ids[lo:hi]) for lo, hi in zip(begin.tolist(), end.tolist())])],
                names=["depth", "a", "b", "first", "ids"])

    return texts


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, stream, done = None, None, []
    for batch in batches:
        for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key == now:
                stream.update(b",")
            else:
                if now:
                    done.append((*now, stream.hexdigest()))
                now, stream = key, hashlib.sha256()
            stream.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["depth", "a", "b", "ends"])
            done = []
    if now:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c]) for c in (*now, stream.hexdigest())], names=["depth", "a", "b", "ends"])


def id_hashes(ends: DataFrame, shards: Shards) -> DataFrame:
    """(depth, a, b, ends): SHA-256 of the conv_ids of each node, ascending, comma-joined.
    ``ends`` has a row (depth, a, b, conv_id) for each id."""
    key = ["depth", "a", "b"]
    texts = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(
        *key, "conv_id").mapInArrow(_texts_of_ids(shards.chunk), "depth long, a long, b long, first long, ids string")
    return texts.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(
        _hashes, "depth long, a long, b long, ends string")


# -- the trie


KEY = ["depth", "a", "b"]


def _on(tag: str) -> list[Column]:
    return [F.col(k).alias(f"__{tag}_{k}") for k in KEY]


def _same(tag: str) -> Column:
    return (F.col("depth") == F.col(f"__{tag}_depth")) & (F.col("a") == F.col(f"__{tag}_a")) & (
        F.col("b") == F.col(f"__{tag}_b"))


def trie(turns_of: DataFrame, conversations: DataFrame, shards: Shards = Shards()) -> DataFrame:
    """The nodes of the trie of ``turns_of`` (conv_id, depth, content, bytes, total; depth
    from 1) and ``conversations`` (conv_id, total), also those without turns."""
    turns_of = written(turns_of, "rebuilt")
    count = max(-(-turns_of.count() // shards.shard_turns), 1)
    while True:
        paths = written(prefixes(turns_of, shards).withColumn("shard", _shard(count, shards)), "paths")
        local = written(paths.groupBy("shard").applyInArrow(
            shard_nodes, "shard long, depth long, a long, b long, pa long, pb long, content binary, bytes long, "
            "members long, least long, same boolean"), "nodes")
        one = {c: F.min(c) for c in ("pa", "pb", "content", "bytes")}
        merged = local.groupBy(*KEY).agg(
            F.sum("members").alias("n_convs"), F.min("least").alias("conv_id"), *[f.alias(c) for c, f in one.items()],
            (F.min("same") & (F.min("pa") == F.max("pa")) & (F.min("pb") == F.max("pb"))
             & (F.min("content") == F.max("content"))).alias("same"))
        root = conversations.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where(
            "n_convs > 0").selectExpr(
                "0L as depth", "0L as a", "0L as b", "n_convs", "conv_id", "cast(null as long) as pa",
                "cast(null as long) as pb", "cast(null as binary) as content", "0L as bytes", "true as same")
        nodes = written(merged.unionByName(root), "trie")
        if nodes.where("not same").isEmpty():
            break
        shards = Shards(**{**vars(shards), "seed": shards.seed + 1})

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("__c_depth"), F.col("pa").alias("__c_a"),
                                                F.col("pb").alias("__c_b")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("__p_depth"), F.col("a").alias("__p_a"),
                           F.col("b").alias("__p_b"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(children, _same("c"), "left").join(
        parents, (F.col("depth") == F.col("__p_depth")) & (F.col("pa") == F.col("__p_a"))
        & (F.col("pb") == F.col("__p_b")), "left")
    full = written(full.select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "full")

    shares = full.where("depth > 0").select(_shard(count, shards).alias("shard"), *KEY, "leaves", "saved")
    later = _later_stretches(full, paths, shards)
    if later is not None:
        shares = shares.unionByName(later)
    sums = local.groupBy("shard").cogroup(shares.groupBy("shard")).applyInArrow(
        lambda nodes, shares: shard_sums(nodes, shares, shards.stretch),
        "depth long, a long, b long, leaves long, saved long")
    sums = sums.groupBy(*_on("s")).agg(F.sum("leaves").alias("__leaves"), F.sum("saved").alias("__saved"))
    ends = paths.where("depth = total").select(*KEY, "conv_id").unionByName(
        conversations.where("total = 0").selectExpr("0L as depth", "0L as a", "0L as b", "conv_id"))
    hashes = id_hashes(ends, shards).select(*_on("e"), "ends")
    out = full.join(sums, _same("s"), "left").join(hashes, _same("e"), "left")
    at_root = F.when(F.col("depth") == 0, F.col("leaves")).otherwise(0)  # the one node without a share
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.coalesce("__leaves", F.lit(0)) + at_root).alias("n_leaves"),
        F.coalesce("__saved", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def _later_stretches(full: DataFrame, paths: DataFrame, shards: Shards) -> "DataFrame | None":
    """Shares of a conversation's later stretches, at the last turn of each earlier one;
    None if no conversation has a second stretch."""
    stretch = F.expr(f"(depth - 1) div {shards.stretch}").alias("stretch")
    cuts = paths.where(f"depth % {shards.stretch} = 0 and depth < total").select("conv_id", stretch, "shard", *KEY)
    if cuts.isEmpty():
        return None
    long_ones = cuts.select(F.col("conv_id").alias("__long")).distinct()
    sums = full.where("depth > 0").join(long_ones, F.col("conv_id") == F.col("__long"), "left_semi").groupBy(
        "conv_id", stretch).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    both = cuts.select("*", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved")).unionByName(
        sums, allowMissingColumns=True)
    after = Window.partitionBy("conv_id").orderBy(-F.col("stretch")).rangeBetween(Window.unboundedPreceding, -1)
    both = both.withColumns({c: F.sum(c).over(after) for c in ("leaves", "saved")})
    return both.where("shard is not null").select(
        "shard", *KEY, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("leaves", "saved")])


def prefix_trie(conversations: DataFrame, shards: Shards = Shards()) -> DataFrame:
    """The trie of the rebuilt conversations (see ``families``)."""
    numbered = written(turns(conversations), "numbered")
    family = written(families(numbered), "families")
    return trie(rebuilt(numbered, family), family, shards)
