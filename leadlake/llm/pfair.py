"""Mixing sources to target weights by Pfair scheduling.

Every source's documents form blocks of ``block_docs``.  With weight w a source's block
number j (from 1) has the release time floor((j-1)/w) and the deadline ceil(j/w), in
slots of one block.  At every slot the released block with the earliest deadline is
taken (ties: the source that comes first).  On one sequence this meets every deadline,
so after t slots each source has given its w*t blocks with a deviation of less than
one, as long as it has blocks left.

Weights are made fractions a/period of one common period.  The schedule then repeats
after ``period`` slots, in which a source with numerator a has exactly a blocks; only
one period is computed, on the driver, by a heap.  Block j of a source takes the slot
of its block (j-1) mod a, moved by whole periods, so placing documents is a join with a
table of ``period`` rows, however many documents there are.  ``period`` grows with the
number of sources only (at most ``max_sources``; more is an error).

A source that has run out leaves its slots empty; the others keep their proportions.
Every document is placed exactly once, none is dropped or repeated.

Within a source documents are ordered by a seeded hash of their id.  Positions come from
row numbers within chunks of that order (about ``chunk_docs`` documents, by leading bits
of the hash) plus the chunks' running counts, so a source with a third of all rows is
not sorted in one task.

Defined cases: rows without source form a source of their own; NULL and repeated doc_ids
are placed like any other (rows equal in doc_id, and text if there is one, are
interchangeable); an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Mix:
    block_docs: int = 16
    period: int = 1024
    exponent: float = 0.5      # default weights: documents of a source to this power
    chunk_docs: int = 4096
    max_sources: int = 100_000
    seed: int = 5


def shares(weights: Mapping, period: int) -> dict:
    """Numerators (at least 1) over ``period`` that follow the weights, by largest
    remainder; ties go to the source that comes first."""
    names = sorted(weights, key=lambda s: (s is None, s))
    if len(names) > period:
        raise ValueError("the period needs a slot for every source")
    total = sum(weights.values())
    free = period - len(names)
    exact = [Fraction(weights[s]) / Fraction(total) * free for s in names]
    out = [int(x) for x in exact]
    for k in sorted(range(len(names)), key=lambda k: (out[k] - exact[k], k))[:free - sum(out)]:
        out[k] += 1
    return {s: n + 1 for s, n in zip(names, out)}


def schedule(numerators: Mapping, period: int) -> list[tuple[object, int, int, int, int]]:
    """One period: (source, block within the period, release, deadline, slot)."""
    names = list(numerators)
    by_release: list[list[tuple[int, int, int]]] = [[] for _ in range(period)]
    for rank, name in enumerate(names):
        a = numerators[name]
        for j in range(a):
            by_release[j * period // a].append((-(-(j + 1) * period // a), rank, j))
    ready: list[tuple[int, int, int]] = []
    out = []
    for slot in range(period):
        for item in by_release[slot]:
            heapq.heappush(ready, item)
        deadline, rank, j = heapq.heappop(ready)
        out.append((names[rank], j, j * period // numerators[names[rank]], deadline, slot))
    return out


def _table(rows: Sequence[tuple], types: Mapping[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(types)
    return pa.table([pa.array(map(_text, c) if t == pa.string() else c, type=t)
                     for c, t in zip(columns, types.values())], names=list(types))


def _text(source: object) -> "str | None":
    """A source as Spark's cast to string writes it."""
    return source if source is None or isinstance(source, str) else str(source).lower() if isinstance(source, bool) \
        else str(source)


def mix(docs: DataFrame, weights: Mapping | None = None, mix: Mix = Mix()) -> DataFrame:
    """``docs`` plus block (of its source, from 0), release, deadline and slot (in blocks)
    and position (order in the mix; slots of sources that ran out leave gaps).  Weights
    by source name may be given; sources without one are an error."""
    spark = docs.sparkSession
    counts = {r["source"]: r["count"] for r in docs.groupBy("source").count().limit(mix.max_sources + 1).collect()}
    if len(counts) > mix.max_sources:
        raise ValueError(f"more than {mix.max_sources} sources")
    if weights is None:
        weights = {s: n ** mix.exponent for s, n in counts.items()}
    else:
        weights = {s: weights[s] for s in counts}
    period = max(mix.period, 16 * len(counts))
    numerators = shares(weights, period) if counts else {}
    # as Arrow tables: lists of rows would start Python processes on the executors to encode them
    slots = spark.createDataFrame(_table(
        schedule(numerators, period) if counts else [],
        {"__s": pa.string(), "__j": pa.int64(), "__release": pa.int64(), "__deadline": pa.int64(), "__slot": pa.int64()}))
    bits = {s: max(0, (n // mix.chunk_docs).bit_length()) for s, n in counts.items()}
    sources = spark.createDataFrame(_table(
        [(s, numerators[s], bits[s]) for s in counts], {"__of": pa.string(), "__a": pa.int64(), "__bits": pa.int32()}))

    def with_chunk(df: DataFrame) -> DataFrame:
        # both small tables are bounded by the number of sources
        named = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "source")]
        out = df.withColumn("__hash", F.md5(F.concat_ws("|", F.lit(str(mix.seed)), *named))).join(
            F.broadcast(sources), F.col("source").cast("string").eqNullSafe(F.col("__of"))).drop("__of")
        leading = F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long")
        # never NULL: the window and the join below then share one partitioning
        out = out.withColumn("__skey", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")))
        return out.withColumn("__chunk", F.floor(leading / F.pow(F.lit(2.0), 32 - F.col("__bits"))).cast("long"))

    row = with_chunk(docs)
    ties = ["doc_id"] + (["text"] if "text" in docs.columns else [])
    inside = Window.partitionBy("__skey", "__chunk").orderBy("__hash", *ties)
    row = row.withColumn("__in_chunk", F.row_number().over(inside) - 1)

    running = Window.partitionBy("__skey").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = with_chunk(docs.select("doc_id", "source")).groupBy("__skey", "__chunk").count().select(
        F.col("__skey").alias("__cskey"), F.col("__chunk").alias("__cchunk"),
        F.coalesce(F.sum("count").over(running), F.lit(0)).alias("__before"))
    row = row.join(
        before, (F.col("__skey") == F.col("__cskey")) & (F.col("__chunk") == F.col("__cchunk")))

    rank = F.col("__before") + F.col("__in_chunk")
    row = row.withColumn("__block", F.expr(f"(__before + __in_chunk) div {mix.block_docs}"))
    row = row.withColumn("__in_block", F.pmod(rank, F.lit(mix.block_docs)))
    row = row.withColumn("__round", F.expr("__block div __a") * period)
    row = row.join(F.broadcast(slots), F.col("source").cast("string").eqNullSafe(F.col("__s"))
                   & (F.pmod("__block", "__a") == F.col("__j")))
    return row.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in PLACED],
        F.col("__block").alias("block"),
        (F.col("__round") + F.col("__release")).alias("release"),
        (F.col("__round") + F.col("__deadline")).alias("deadline"),
        (F.col("__round") + F.col("__slot")).alias("slot"),
        ((F.col("__round") + F.col("__slot")) * mix.block_docs + F.col("__in_block")).alias("position"),
    )


PLACED = ("block", "release", "deadline", "slot", "position")


def in_mixed_order(docs: DataFrame, weights: Mapping | None = None, settings: Mix = Mix()) -> DataFrame:
    """``docs`` with the same columns, sorted by their place in the mix: written as
    files, consecutive files hold consecutive stretches of the mix."""
    names = [f"__c{k}" for k in range(len(docs.columns))]
    # own names, so that columns called like those that are added stay what they are
    plain = docs.toDF(*names).withColumns({
        need: F.col(names[docs.columns.index(need)]) for need in ("doc_id", "source")})
    placed = mix(plain, weights, settings)
    ordered = placed.repartitionByRange("position").sortWithinPartitions("position")
    return ordered.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
