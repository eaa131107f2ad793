"""Near-duplicate documents by SetSketch registers.

A document is the set of its shingles (``shingle_words`` consecutive words, A-Z
lower-cased; with fewer words, the whole sequence; without words, the empty set, which
is linked with nothing).  Documents are linked when the Jaccard similarity of their
sets is at least ``percent`` / 100; components of links are the duplicate groups.

1. Each set gets a 128-bit digest and ``bands * rows`` SetSketch registers: register i
   is ``floor(1 - log_base(x))`` of the smallest exponential variate x that hash
   function i gives any shingle, truncated to 0..Q+1.  The minimum commutes with that
   decreasing map, so sketches of parts merge by their maximum.
2. Equal sets are one class; its smallest doc_id stands for it.
3. The registers of a class are cut into bands.  Classes that agree in a band are
   sketched again with more registers, cut into longer bands; classes that agree in one
   of those are candidates.  Shared passages make many unlike texts agree in a short band
   and few in a long one, but long bands for all texts would cost too many registers.
   ``links`` turns bands into pairs without all pairs of a band.
4. For a candidate pair the numbers of registers that are larger, smaller and equal
   give the maximum-likelihood estimate of the similarity (the set sizes are known).
   Pairs estimated more than ``margin`` below the threshold are dropped; the others
   are confirmed on the full sets.
5. In loose families (near copies of one text that are not near each other) a pair
   (a, b) with the pivot R is possible only if a and b differ from R in the same way
   often enough.  With b not linked to R, and T(x) the symmetric difference of x and R,
   |T(a) & T(b)| must exceed 4/9 |a| - |a & R| + 5/9 |R| and reach 4/9 |b| - |b & R|
   + 4/9 |R| (for 80 %); so a and b must share a token among the first |T| - need + 1
   tokens of each, rarest in the group first (prefix filter).  The first bound grows with
   a's distance from R, so b looks among a's of each level of it with a prefix of its own.
   Edits that nobody else made come first, and most members have no partner left to try.

A pair at the threshold 0.8 is missed by the bands of a step with probability
(1 - 0.8^rows)^bands, 5e-6 for the production values, and less above it; the margin is
more than five standard deviations of the estimate.

Only texts of classes that share a band are read a second time: a bitmap of fixed size
filters them, an exact join follows.  Shuffled are sketches, bands, candidate texts and
pairs.  A group of copies, however large, is one class after an aggregation with
map-side partials.

Defined cases: NULL text is the empty set.  Rows that share a doc_id are one document
(linked where any of them is).  Rows without doc_id take part; their component_id is
the smallest doc_id of the component, NULL if it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import bitmap_filter, written
from leadlake.llm.links import linked_components, prefix_pairs, shared_memberships

BASE = 1.02        # spacing of the registers
Q = 2000           # registers are 0..Q+1
SEED = 11
BLOCK = 2048       # shingles hashed at once
PAIRS = 1024       # pairs compared at once
NO_ID = 1 << 62    # nodes from here on stand for rows without doc_id


@dataclass(frozen=True)
class Near:
    shingle_words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    long_bands: int = 108
    long_rows: int = 10
    margin: float = 0.15

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of ``text``."""
    # bytes.lower changes A-Z only; bytes.split cuts at the six ASCII white spaces
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    width = min(words, len(parts))
    out = np.full(len(parts) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = _mix(out + hashes[k:len(parts) - width + 1 + k])
    return np.unique(out)


class Sketcher:
    def __init__(self, registers: int, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.factor = random.integers(0, 1 << 31, registers, dtype=np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
        self.offset = random.integers(0, 1 << 32, registers, dtype=np.uint64).astype(np.uint32)[:, None]

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """uint16 registers of a non-empty set."""
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        least = None
        for k in range(0, len(low), BLOCK):
            values = (low[None, k:k + BLOCK] * self.factor + self.offset).min(axis=1)
            least = values if least is None else np.minimum(least, values)
        variate = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 32)
        return np.clip(np.floor(1 - np.log(variate) / np.log(BASE)), 0, Q + 1).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs from their registers and sizes."""
    above, below = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    equal = a.shape[1] - above - below
    u = (na / (na + nb))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)

    def exceeds(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    p, q = exceeds(u - v * grid), exceeds(v - u * grid)
    tiny = 1e-12
    score = (above * np.log(np.maximum(p, tiny)) + below * np.log(np.maximum(q, tiny))
             + equal * np.log(np.maximum(1 - p - q, tiny)))
    return np.take_along_axis(grid, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketch(docs: DataFrame, near: Near) -> DataFrame:
    """(doc_id, tkey, n, h1, h2, regs): shingle count, set digest and registers of
    every row; ``tkey`` is a hash of the text, by which it is found again."""
    words, registers = near.shingle_words, near.registers

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(registers)
        for batch in batches:
            n, digests, regs = [], [], []
            for text in batch.column(2).to_pylist():
                s = shingles(text, words)
                n.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                regs.append(sketcher.registers(s).tobytes() if len(s) else None)
            halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(len(n), 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, type=pa.int64()),
                 pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(regs, type=pa.binary())],
                names=["doc_id", "tkey", "n", "h1", "h2", "regs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(compute, "doc_id long, tkey long, n long, h1 long, h2 long, regs binary")


def _verifier(candidates: DataFrame, near: Near):
    """Confirms pairs of nodes; ``candidates`` has (node, n, regs, text)."""
    words, percent, least, registers = near.shingle_words, near.percent, near.percent / 100 - near.margin, near.registers

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, PAIRS) for whole in batches for k in range(0, whole.num_rows, PAIRS)):
            cols = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            size = batch.num_rows
            regs = [np.frombuffer(b"".join(cols[c].to_pylist()), dtype=np.uint16).reshape(size, registers)
                    for c in ("regs_a", "regs_b")]
            na, nb = (cols[c].to_numpy().astype(np.float64) for c in ("n_a", "n_b"))
            likely = (estimate(*regs, na, nb) >= least) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            kept, known = [], {}
            for k in np.flatnonzero(likely).tolist():
                sets = []
                for side in ("text_a", "text_b"):
                    text = cols[side][k].as_py()
                    if text not in known:
                        if len(known) > 64:
                            known.clear()
                        known[text] = shingles(text, words)
                    sets.append(known[text])
                common = len(np.intersect1d(*sets, assume_unique=True))
                if 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common):
                    kept.append(k)
            yield pa.RecordBatch.from_arrays(
                [cols["a"].take(pa.array(kept, type=pa.int64())), cols["b"].take(pa.array(kept, type=pa.int64()))],
                names=["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        def side(s: str) -> DataFrame:
            return candidates.select(F.col("node").alias(f"__{s}"), *[
                F.col(c).alias(f"{c}_{s}") for c in ("n", "regs", "text")])

        joined = pairs.join(side("a"), F.col("a") == F.col("__a")).drop("__a")
        joined = joined.join(side("b"), F.col("b") == F.col("__b")).drop("__b")
        return joined.mapInArrow(compute, "a long, b long").distinct()

    return verify


#: levels of a member's distance from the pivot, by the least of 4/9 |a| - |a & R| + 5/9 |R|
LEVELS = np.array([0, 4, 8, 16, 32, 64, 128, 256, 512])
MEMBERS = 256      # members whose differences are put out at once


def _narrower(candidates: DataFrame, near: Near):
    """Possible pairs within the groups of unlinked members (step 5 above)."""
    words, percent = near.shingle_words, near.percent
    fields = ("pivot long, node long, c long, token long, n long, level int, reach long, "
              "apart_reach array<long>, linked boolean")

    def member(mine: np.ndarray, centre: np.ndarray, apart: bool):
        """(tokens, level, reach, apart_reach, linked) of a member with the set ``mine``."""
        share = percent / (100 + percent)        # 4/9 for 80 %
        tokens = np.setxor1d(mine, centre, assume_unique=True)
        common = (len(mine) + len(centre) - len(tokens)) // 2
        linked = 100 * common >= percent * (len(tokens) + common)
        weight = share * len(mine) - common
        # the bounds are fractions with small denominators, hence the tolerance
        away = int(np.floor(weight + (1 - share) * len(centre) + 1e-9))
        level = max(0, int(np.searchsorted(LEVELS, away, side="right")) - 1)
        need = np.maximum(1, np.ceil(weight + share * len(centre) + LEVELS - 1e-9))
        reaches = np.maximum(0, len(tokens) - need + 1).astype(np.int64)
        if linked or not apart:
            reaches[:] = 0
        return tokens, level, len(tokens) - max(1, away + 1) + 1, reaches, bool(apart and linked)

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, MEMBERS):
                batch = whole.slice(start, MEMBERS)
                rows, found, heads = [], [], []
                for k, (pivot, apart, text_node, text_pivot) in enumerate(zip(*(
                        batch.column(x).to_pylist() for x in (0, 3, 4, 5)))):
                    if pivot not in known:
                        if len(known) > 64:
                            known.clear()
                        known[pivot] = shingles(text_pivot, words)
                    mine = shingles(text_node, words)
                    tokens, *bounds = member(mine, known[pivot], apart)
                    rows.append(np.full(len(tokens), k, dtype=np.int64))
                    found.append(tokens)
                    heads.append((len(mine), *bounds))
                # one row per member with its bounds, then its tokens
                none = len(heads)
                at = np.concatenate([np.arange(none), *rows])
                head = pa.array(np.concatenate([np.arange(none), np.full(len(at) - none, -1)]))
                head = pc.if_else(pc.less(head, 0), None, head)
                n, level, reach, apart_reach, linked = zip(*heads)
                token = pa.array(np.concatenate([np.zeros(none, dtype=np.uint64), *found]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(x).take(pa.array(at)) for x in (0, 1, 2)), token,
                     pa.array(n, type=pa.int64()).take(head), pa.array(level, type=pa.int32()).take(head),
                     pa.array(reach, type=pa.int64()).take(head),
                     pa.array([x.tolist() for x in apart_reach], type=pa.list_(pa.int64())).take(head),
                     pa.array(linked, type=pa.bool_()).take(head)],
                    names=["pivot", "node", "c", "token", "n", "level", "reach", "apart_reach", "linked"])

    def narrow(groups: DataFrame) -> DataFrame:
        text_node = candidates.select(F.col("node").alias("__n"), F.col("text").alias("tn"))
        text_pivot = candidates.select(F.col("node").alias("__p"), F.col("text").alias("tp"))
        joined = groups.where("node <> pivot").join(text_node, F.col("node") == F.col("__n")).join(
            text_pivot, F.col("pivot") == F.col("__p"))
        tokens = written(joined.select("pivot", "node", "c", "apart", "tn", "tp").mapInArrow(
            differences, fields), "differences")
        members = tokens.where("n IS NOT NULL")
        with_pivot = members.where("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        pairs = prefix_pairs(
            tokens.where("n IS NULL").select("pivot", "node", "token"), members.drop("token", "linked"),
            lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y))
        return pairs.union(with_pivot)

    return narrow


def _long_bands(candidates: DataFrame, near: Near) -> DataFrame:
    """(key, node): the long bands of the candidates' second sketch."""
    words, rows, bands = near.shingle_words, near.long_rows, near.long_bands

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(rows * bands, SEED + 1)
        for whole in batches:
            for start in range(0, whole.num_rows, MEMBERS):
                batch = whole.slice(start, MEMBERS)
                keys = []
                for text in batch.column(1).to_pylist():
                    regs = sketcher.registers(shingles(text, words)).reshape(bands, rows)
                    keys.append([xxhash.xxh3_64_intdigest(r.tobytes(), seed=k) - (1 << 63)
                                 for k, r in enumerate(regs)])
                flat = np.array(keys, dtype=np.int64).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat), batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), bands)))],
                    names=["key", "node"])

    return candidates.select("node", "text").mapInArrow(compute, "key long, node long")


def _node(doc_id: Column, tkey: Column) -> Column:
    """Rows without doc_id get a node above all doc_ids, by their text."""
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID) + F.pmod(tkey, F.lit(NO_ID)))


def labels(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row per row of ``docs``: doc_id, tkey (hash of the text), n (shingles) and
    label: the smallest node of the component, NULL for an empty set."""
    rows = written(sketch(docs, near), "sketch")
    classes = written(
        rows.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct(
            _node(F.col("doc_id"), F.col("tkey")).alias("node"), "doc_id", "tkey", "n", "regs"
        )).alias("c")).select("h1", "h2", "c.*"), "classes")

    width = near.rows * 2
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(near.bands - 1)),
        lambda i: F.xxhash64(i, F.substring("regs", i * width + 1, F.lit(width))))
    shared = written(shared_memberships(
        classes.select(F.explode(bands).alias("key"), "node")), "shared")

    nodes = shared.select(F.col("node").alias("__node")).distinct()
    wanted = written(classes.join(nodes, F.col("node") == F.col("__node"), "left_semi").select(
        "node", "n", "regs", F.col("doc_id").alias("__doc"), F.col("tkey").alias("__tkey")), "wanted")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"),
                        F.col("text").cast("string").alias("text"))
    found = found.where(bitmap_filter(wanted, "__tkey")("tkey"))
    candidates = written(
        wanted.join(found, (F.col("__tkey") == F.col("tkey")) & F.col("__doc").eqNullSafe(F.col("doc_id")))
        .select("node", "n", "regs", "text").dropDuplicates(["node", "n", "regs"]), "candidates")

    candidates = candidates.where(F.col("text").isNotNull())
    long_bands = written(_long_bands(candidates, near), "long-bands")
    shared = written(shared_memberships(long_bands), "shared")
    components = linked_components(
        shared, _verifier(candidates, near), _narrower(candidates, near)).select(
        F.col("node").alias("__node"), "component")
    label = classes.select("h1", "h2", "node").join(components, F.col("node") == F.col("__node"), "left").select(
        F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.coalesce("component", "node").alias("label"))
    out = rows.join(label, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")), "left")
    return out.select("doc_id", "tkey", "n", "label")


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    component = F.when(F.col("label").isNull(), F.col("doc_id")).when(F.col("label") < NO_ID, F.col("label"))
    return labels(docs, near).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, and all
    documents without a word.  Same columns as ``docs``; rows equal in doc_id and text
    become one."""
    stay = labels(docs, near).select(
        _node(F.col("doc_id"), F.col("tkey")).alias("__node"), F.col("tkey").alias("__tkey"), "label"
    ).where(F.col("label").isNull() | (F.col("label") == F.col("__node"))).select("__node", "__tkey").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    tkey = F.xxhash64("text")
    keyed = docs.select(_node(F.col("doc_id"), tkey).alias("__n"), tkey.alias("__t"), row)
    kept = keyed.join(stay, (F.col("__n") == F.col("__node")) & (F.col("__t") == F.col("__tkey")), "left_semi")
    # the join has brought equal rows together already
    return kept.dropDuplicates(["__n", "__t"]).select("__row.*")
