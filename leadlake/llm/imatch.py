r"""Document fingerprints: I-Match with several randomised lexicons.

The lexicon holds the terms (lower-cased ``\w+``, kept as 64-bit hashes, whose order is
the terms' order) whose share of documents lies in a band, i.e. whose inverse document
frequency does.  It is thinned at random, by a hash
of the term, to SUBSETS smaller lexicons of geometrically falling rates.  A document's
fingerprint holds, for every smaller lexicon, a hash of its distinct terms in it, in
sorted order, and the number of its terms in the whole lexicon.  Small lexicons keep
their hash when a long text changes a little, large ones tell short texts apart.

Likeness of two fingerprints (0 to 1): a lexicon of rate r keeps its hash exactly when
it holds none of the d terms that only one of the two texts has, which happens with
probability (1-r)^d.  The most likely d, over all lexicons together, and the two term
counts give the Jaccard similarity of the term sets, which is the likeness.

Size: a lexicon term is in at least ``min_share`` of the documents, so there are at
most (mean distinct terms of a document) / min_share of them, however large the table
is.  Only this lexicon is collected and sent to the executors.

Texts without a lexicon term are fingerprinted by all their terms (or, without a term,
by the text itself), so that equal texts, and mostly only those, agree.

Defined cases: NULL text counts as ''.  Repeated rows and equal doc_ids are ordered by
their texts.  A row without doc_id stands outside the order, is its own next
document and is not shuffled.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERM = re.compile(r"\w+")
PER_RATE = 4
RATES = tuple(2.0 ** -k for k in range(1, 13) for _ in range(PER_RATE))
SUBSETS = len(RATES)
FLUSH_TERMS = 400_000  # partial counts are passed on beyond so many terms
REMEMBERED_TERMS = 1_000_000


@dataclass(frozen=True)
class Band:
    min_share: float = 0.001  # idf at most ln(1000)
    max_share: float = 0.2    # idf at least ln(5)


def terms_of(text: str) -> set[str]:
    return set(TERM.findall(text.lower()))


def term_hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode("utf-8", "surrogatepass")) - (1 << 63)


def document_frequency(docs: DataFrame) -> DataFrame:
    """(term, df) over all documents, terms as hashes; counts are added up per task
    before the shuffle."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(map(term_hash, counts), type=pa.int64()), pa.array(list(counts.values()), type=pa.int64())],
                names=["term", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(terms_of(text))
                if len(counts) > FLUSH_TERMS:
                    yield table(counts)
                    counts = Counter()
        yield table(counts)

    texts = docs.where(F.col("text").isNotNull()).select("text")
    return texts.mapInArrow(partial, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("df"))


def lexicon(docs: DataFrame, band: Band = Band()) -> list[int]:
    """The terms of the band (as hashes), sorted."""
    n = docs.count()
    rows = document_frequency(docs).where(
        (F.col("df") >= band.min_share * n) & (F.col("df") <= band.max_share * n)
    ).select("term").collect()
    return sorted(r["term"] for r in rows)


class _Places(dict):
    """Term -> its place in the lexicon, -1 outside; remembered up to a bound."""

    def __init__(self, lexicon: list[int]):
        super().__init__()
        self.place = {h: k for k, h in enumerate(lexicon)}

    def __missing__(self, term: str) -> int:
        if len(self) >= REMEMBERED_TERMS:
            self.clear()
        place = self[term] = self.place.get(term_hash(term), -1)
        return place


class Fingerprinter:
    """Fingerprints (uint32 per subset, then the term count) under one lexicon."""

    def __init__(self, terms: list[int]):
        self.places = _Places(terms)
        self.hashes = np.array(terms, dtype=np.int64)
        drawn = b"".join([hashlib.shake_128(h.tobytes()).digest(2 * SUBSETS) for h in self.hashes])
        draws = np.frombuffer(drawn, dtype=np.uint16).reshape(len(terms), SUBSETS)
        self.member = (draws < np.array([r * 65536 for r in RATES])).T.copy()

    @staticmethod
    def _hash(data: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(data, digest_size=4).digest(), "big") or 1

    def of(self, text: str) -> np.ndarray:
        terms = terms_of(text)
        known = np.array(sorted(k for k in map(self.places.__getitem__, terms) if k >= 0), dtype=np.int64)
        out = np.zeros(SUBSETS + 1, dtype=np.uint32)
        if known.size == 0:
            whole = "\n".join(sorted(terms)) if terms else text
            out[:SUBSETS] = self._hash(whole.encode("utf-8", "surrogatepass"))
            return out
        hashes, member = self.hashes[known], self.member[:, known]
        for j in np.flatnonzero(member.any(axis=1)):
            out[j] = self._hash(hashes[member[j]].tobytes())
        out[SUBSETS] = known.size
        return out


def text_form(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness of the fingerprints in the rows of ``a`` and ``b``."""
    equal = (a[:, :SUBSETS] == b[:, :SUBSETS]).reshape(len(a), -1, PER_RATE).sum(axis=2)
    na, nb = a[:, SUBSETS].astype(np.float64), b[:, SUBSETS].astype(np.float64)
    # candidates for d: the least possible, then geometric steps to the most
    least, most = np.abs(na - nb), na + nb
    steps = np.linspace(0, 1, 96)
    d = least[:, None] + (np.expm1(np.log1p(most - least)[:, None] * steps))
    keep_log = np.log1p(-np.array(RATES[::PER_RATE]))
    score = np.zeros_like(d)
    for level, log in enumerate(keep_log):
        hit = equal[:, level][:, None]
        score += hit * (d * log) + (PER_RATE - hit) * np.log(np.maximum(-np.expm1(d * log), 1e-300))
    best = np.take_along_axis(d, score.argmax(axis=1)[:, None], axis=1)[:, 0]
    out = (most - best) / np.maximum(most + best, 1)
    same = (a == b).all(axis=1)
    return np.where(same, 1.0, np.where((na == 0) | (nb == 0), 0.0, np.clip(out, 0, 1)))


def _bounds(docs: DataFrame, buckets: int) -> list[int]:
    """Existing doc_ids that cut the order into about equal stretches, the smallest first."""
    shares = [k / buckets for k in range(1, buckets)] or [0.5]
    row = docs.agg(
        F.min("doc_id").alias("least"),
        F.percentile_approx("doc_id", shares, max(10_000, 20 * buckets)).alias("cuts"),
    ).first()
    return [] if row["least"] is None else sorted({row["least"], *row["cuts"]})


def in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, text, __bucket, __peek), in order within each partition: every bucket
    holds a stretch of the doc_id order and, marked as a peek, the document behind its
    last one.  Each text is shuffled once.  ``docs`` have a doc_id."""
    bounds = np.array(_bounds(docs, buckets), dtype=np.int64)

    @F.pandas_udf("array<int>")
    def places(ids: pd.Series) -> pd.Series:
        values = ids.astype("int64").to_numpy()
        at = np.searchsorted(bounds, values, side="right")
        first = (at > 0) & (bounds[at - 1] == values) if bounds.size else np.zeros(len(ids), bool)
        out = []
        for b, opens in zip(at, first):
            if opens:  # code 2 * bucket, plus 1 for a peek; the first follows the last
                out.append([2 * int(b), 2 * (int(b) - 1 if b > 1 else len(bounds)) + 1])
            else:
                out.append([2 * int(b)])
        return pd.Series(out)

    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("__at", F.explode(places("doc_id")))
    return placed.select(
        "doc_id", "text", F.shiftright("__at", 1).alias("__bucket"), (F.col("__at") % 2 == 1).alias("__peek")
    ).repartition("__bucket").sortWithinPartitions("__bucket", "__peek", "doc_id", "text")


def fingerprints(docs: DataFrame, terms: list[int]) -> DataFrame:
    """doc_id and fingerprint of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Fingerprinter(shared.value)
        for batch in batches:
            prints = [text_form(printer.of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, type=pa.string())], names=["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(compute, "doc_id bigint, fingerprint string")


EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def compare_edited(docs: DataFrame, terms: list[int], buckets: int | None = None) -> DataFrame:
    """Every document against its edited text (the last quarter replaced by the start
    of the next document in doc_id order) and against the next document."""
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(terms)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        printer = Fingerprinter(shared.value)
        done: list[tuple] = []

        def row(doc_id, text, own, next_text, next_print):
            cut = len(text) // 4
            edited = text[:len(text) - cut] + next_text[:cut]
            done.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                         own, printer.of(edited), next_print))

        def table() -> pa.RecordBatch:
            cols = list(zip(*done)) or [[] for _ in range(6)]
            own, edited, following = (
                np.array(c, dtype=np.uint32).reshape(len(done), SUBSETS + 1) for c in cols[3:])
            done.clear()
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], type=pa.int64()), pa.array(cols[1], type=pa.int64()),
                pa.array(cols[2], type=pa.string()),
                pa.array([text_form(x) for x in own], type=pa.string()),
                pa.array([text_form(x) for x in edited], type=pa.string()),
                pa.array(likeness(own, edited)), pa.array(likeness(own, following)),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next"])

        waiting = None  # the last own row of the current bucket, until its next one comes
        for batch in batches:
            for doc_id, text, bucket, peek in zip(*(c.to_pylist() for c in batch.columns)):
                own = printer.of(text) if not peek or waiting is not None else None
                if doc_id is None:
                    row(doc_id, text, own, text, own)
                    continue
                if waiting is not None and waiting[0] == bucket:
                    row(*waiting[1:], text, own)
                waiting = None if peek else (bucket, doc_id, text, own)
            yield table()

    ordered = in_order(docs.where(F.col("doc_id").isNotNull()), buckets)
    # their own next documents: they stay where they are read
    unnamed = docs.where(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.lit(0).alias("__bucket"), F.lit(False).alias("__peek"))
    return ordered.mapInArrow(compute, EDITED).union(unnamed.mapInArrow(compute, EDITED))
