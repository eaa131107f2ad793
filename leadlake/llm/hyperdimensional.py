"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1/-1 in ``dim`` dimensions, derived from
its code point and a seed.  A trigram's vector binds (multiplies) the vectors of its
three letters, the first permuted (rotated) twice, the second once.  A document's
vector bundles (adds) the vectors of all its trigrams; a language's prototype bundles
its training documents, each scaled to unit length so that long ones do not decide.
A document gets the language whose prototype has the highest cosine.

Letters are lower-cased; every run of other characters counts as one gap, which has a
vector of its own; a gap is put before and after the text.

Work per batch of documents is matrix products: a count matrix (document x trigram)
times the trigrams' vectors.  Groups of documents are cut by characters, and a long
document's trigrams go through in blocks, so memory is bounded by the group size and
the longest text.  Learning adds integers, so the prototypes do not depend on how rows
are dealt; partial sums (one per language and batch) are added in two grouped steps.
Only the prototypes (languages x dim numbers) reach the driver.

Defined cases: NULL text or text without a letter gets ``und`` with score 0; NULL or
empty ``lang`` is never learned from; without any training document everything is
``und``; ties of the cosine go to the alphabetically first language; repeated rows are
learned as often as they occur and get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = 1024
SEED = 20240229
UNKNOWN = "und"
GROUP_CHARS = 1 << 20       # characters handled at once (a longer document alone)
BLOCK = 1 << 13             # trigrams multiplied at once
FIXED_POINT = 1 << 20       # unit vectors are added as integers of this scale


class Encoder:
    """Document vectors.  Letters get small codes as they first appear; the code
    never influences a vector, which depends on the code point alone."""

    def __init__(self, dim: int = DIM, seed: int = SEED):
        self.dim, self.seed = dim, seed
        self.code_of = np.full(0x110000, -1, dtype=np.int32)  # -1: not seen yet
        self.vectors = np.empty((0, dim), dtype=np.float32)
        self._add(0)  # the gap

    def _add(self, point: int) -> int:
        random = np.random.Generator(np.random.PCG64([self.seed, point]))
        vector = random.integers(0, 2, self.dim).astype(np.float32) * 2 - 1
        self.vectors = np.vstack([self.vectors, vector])
        return len(self.vectors) - 1

    def letters(self, text: str) -> np.ndarray:
        """Letter codes with single gaps (0) between letter runs and around."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = self.code_of[points]
        if codes.size and codes.min() < 0:
            for p in np.unique(points[codes < 0]).tolist():
                self.code_of[p] = self._add(p) if chr(p).isalpha() else 0
            codes = self.code_of[points]
        keep = codes > 0
        keep[1:] |= codes[:-1] > 0  # of a run of non-letters, its first
        return np.concatenate(([0], codes[keep], [0])) if codes.size and codes[-1] > 0 else \
            np.concatenate(([0], codes[keep]))

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One row per text: the sum of its trigram vectors (zeros without letters)."""
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        rows, coded = [], []
        for k, text in enumerate(texts):
            codes = self.letters(text)
            if codes.any():
                rows.append(np.full(len(codes) - 2, k, dtype=np.int64))
                coded.append(codes.astype(np.int64))
        if not rows:
            return out
        n = len(self.vectors)
        trigrams = np.concatenate([(c[:-2] * n + c[1:-1]) * n + c[2:] for c in coded])
        row = np.concatenate(rows)
        if n ** 3 <= 1 << 24:  # small alphabets: number the trigrams by table, not by sorting
            present = np.zeros(n ** 3, dtype=bool)
            present[trigrams] = True
            distinct = np.flatnonzero(present)
            number = np.cumsum(present, dtype=np.int32) - 1
            place = number[trigrams].astype(np.int64)
        else:
            distinct, place = np.unique(trigrams, return_inverse=True)
        order = None
        if len(distinct) > BLOCK:
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(0, len(distinct) + BLOCK, BLOCK))
        for b, start in enumerate(range(0, len(distinct), BLOCK)):
            block = distinct[start:start + BLOCK]
            at = slice(None) if order is None else order[cuts[b]:cuts[b + 1]]
            counts = np.bincount(row[at] * len(block) + place[at] - start, minlength=len(texts) * len(block))
            a, rest = np.divmod(block, n * n)
            second, third = np.divmod(rest, n)
            bound = np.roll(self.vectors, 2, axis=1)[a]
            bound *= np.roll(self.vectors, 1, axis=1)[second]
            bound *= self.vectors[third]
            out += counts.reshape(len(texts), len(block)).astype(np.float32) @ bound
        return out


def _groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) of consecutive groups of about GROUP_CHARS characters."""
    start, size, group = 0, 0, []
    for k, text in enumerate(texts):
        if group and size + len(text or "") > GROUP_CHARS:
            yield start, group
            start, size, group = k, 0, []
        group.append(text or "")
        size += len(text or "")
    if group:
        yield start, group


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


def learn(docs: DataFrame, dim: int = DIM, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototypes (int64 sums) by language from all rows with a language."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(dim, seed), {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, group in _groups(texts):
                fixed = np.rint(_unit(encoder.bundles(group)) * FIXED_POINT).astype(np.int64)
                of = np.array(langs[start:start + len(group)], dtype=object)
                for lang in set(of):
                    sums[lang] = sums.get(lang, 0) + fixed[of == lang].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], type=pa.list_(pa.int64()))],
                names=["lang", "v"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"][:1], "v": [np.sum(pdf["v"].tolist(), axis=0)]})

    rows = docs.where(F.col("text").isNotNull() & (F.col("lang") != "")).select("lang", "text")
    parts = rows.mapInArrow(partial, "lang string, v array<bigint>")
    some = parts.withColumn("__part", F.spark_partition_id() % 32)
    summed = some.groupBy("lang", "__part").applyInPandas(added, "lang string, v array<bigint>")
    summed = summed.groupBy("lang").applyInPandas(added, "lang string, v array<bigint>")
    return {r["lang"]: np.array(r["v"]) for r in summed.collect()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], carry: list["str | Column"],
            dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``carry`` columns plus lang_pred, score (cosine with the chosen prototype, 0 if
    negative) and margin (lead over the second best cosine)."""
    langs = sorted(lang for lang, v in prototypes.items() if v.any())
    unit = _unit(np.array([prototypes[x] for x in langs], dtype=np.float64).reshape(len(langs), dim))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dim, seed)
        for batch in batches:
            names, best, lead = [], [], []
            for _, group in _groups(batch.column(batch.num_columns - 1).to_pylist()):
                vectors = encoder.bundles(group)
                known = vectors.any(axis=1)
                if not langs:
                    known[:] = False
                cosine = _unit(vectors.astype(np.float64)) @ unit.T if langs else np.zeros((len(group), 1))
                top = cosine.argmax(axis=1)
                ranked = np.sort(cosine, axis=1)
                second = ranked[:, -2] if cosine.shape[1] > 1 else np.zeros(len(group))
                names += [langs[t] if k else UNKNOWN for t, k in zip(top, known)]
                best.append(np.where(known, np.clip(ranked[:, -1], 0, 1), 0.0))
                lead.append(np.where(known, ranked[:, -1] - second, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, type=pa.string()),
                 pa.array(np.concatenate([[], *best])), pa.array(np.concatenate([[], *lead]))],
                names=[*batch.schema.names[:-1], "lang_pred", "score", "margin"])

    rows = docs.select(*carry, F.col("text").cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(score, f"{fields}, lang_pred string, score double, margin double")
