"""Quality classifier: a byte-level convolutional network in numpy.

The UTF-8 bytes of the whole text go through FILTERS learned filters of KERNEL bytes
(stride 1).  Chunks of two halves overlap by one half and cover the document; within
each chunk every filter's response is max-pooled and rectified.  The document's
features are the mean and the maximum of its chunks' pooled responses, and a logistic
output turns them into one probability.

A filter is a table over byte values for each of its places, so a convolution is a sum
of table look-ups; places are joined in pairs to halve them.  Texts are worked through
in slices of SLICE bytes, so memory does not grow with a text.

Fitting uses a bounded sample: at most ``per_class`` labelled documents of each class
(the first by a hash of their id), a parameter.  Their texts are read whole, as in
scoring, so that means and maxima over all chunks of a text are what the weights are
fitted on.  The sample has equally many of both classes; the output is then shifted to
the classes' true shares among the labels.

Defined cases: NULL and empty texts are scored as a text of zero chunks with all
features 0; documents without a label, labels without a document and NULL labels are
not learned from; a document labelled more than once counts once per class; of several
texts with one doc_id the smallest is learned from; very long texts are worked through in
slices, in fitting too; equal rows have equal scores; without
two classes the score is the share of label 1 (0.5 without any label).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KERNEL = 6          # even: places are looked up in pairs
FILTERS = 32
HALF = 128          # bytes of half a chunk
SLICE = 1 << 17
ROWS = 1024         # chunks whose responses are held at once in fitting: 32 MB


@dataclass(frozen=True)
class Fit:
    per_class: int = 1000
    epochs: int = 10
    batch: int = 64
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


class Network:
    def __init__(self, tables: np.ndarray, weights: np.ndarray, bias: float):
        self.tables, self.weights, self.bias = tables, weights, bias
        # joint table of two neighbouring places, indexed by a pair of bytes
        self.pairs = [
            np.ascontiguousarray((tables[k][:, None, :] + tables[k + 1][None, :, :]).reshape(65536, FILTERS))
            for k in range(0, KERNEL, 2)
        ]

    def _pooled(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Maximum response of each filter over each stretch of ``data`` (bytes with
        KERNEL - 1 more behind the last stretch)."""
        joint = data[:-1].astype(np.int32) * 256 + data[1:]
        n = len(data) - KERNEL + 1
        out = np.empty((len(starts), FILTERS), dtype=np.float32)
        step = SLICE // HALF
        for a in range(0, len(starts), step):
            b = min(a + step, len(starts))
            lo, hi = starts[a], starts[b] if b < len(starts) else n
            response = self.pairs[0].take(joint[lo:hi], axis=0, mode="clip")
            for k in range(1, len(self.pairs)):
                response += self.pairs[k].take(joint[lo + 2 * k:hi + 2 * k], axis=0, mode="clip")
            out[a:b] = np.maximum.reduceat(response, starts[a:b] - lo, axis=0)
        return out

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Mean and maximum over chunks of the pooled, rectified responses."""
        out = np.zeros((len(texts), 2 * FILTERS), dtype=np.float32)
        filled = [k for k, t in enumerate(texts) if t]
        if not filled:
            return out
        # one array of all texts, zero bytes behind each, cut into half chunks; the zero
        # bytes are a stretch of their own, which is dropped after pooling
        gap = bytes(KERNEL - 1)
        data = np.frombuffer(b"".join(x for k in filled for x in (texts[k], gap)) + b"\0", dtype=np.uint8)
        sizes = np.array([len(texts[k]) for k in filled])
        halves = -(-sizes // HALF)
        text_at = np.cumsum(sizes + KERNEL - 1) - (sizes + KERNEL - 1)
        half_at = np.cumsum(halves) - halves
        within = np.arange(halves.sum()) - np.repeat(half_at, halves)
        starts = np.insert(np.repeat(text_at, halves) + HALF * within, half_at + halves, text_at + sizes)
        pooled = np.delete(self._pooled(data, starts), half_at + halves + np.arange(len(filled)), axis=0)
        # a chunk is a half and the one behind it; a last half is a chunk only if alone
        last = half_at + halves - 1
        chunks = np.maximum(pooled, 0)
        chunks[:-1] = np.maximum(chunks[:-1], chunks[1:])
        chunks[last] = np.where((halves == 1)[:, None], np.maximum(pooled[last], 0), 0)
        count = np.maximum(halves - 1, 1)[:, None]
        out[filled, :FILTERS] = np.add.reduceat(chunks, half_at, axis=0) / count
        out[filled, FILTERS:] = np.maximum.reduceat(chunks, half_at, axis=0)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        z = self.features(texts).astype(np.float64) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _chunks(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of ``text`` as rows of bytes and the number of places in each."""
    halves = -(-len(text) // HALF)
    starts = HALF * np.arange(max(halves - 1, 1))
    padded = np.zeros(len(text) + 2 * HALF + KERNEL, dtype=np.uint8)
    padded[:len(text)] = np.frombuffer(text, dtype=np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(padded, 2 * HALF + KERNEL - 1)[starts]
    return rows, np.minimum(len(text) - starts, 2 * HALF)


def _strongest(tables: np.ndarray, rows: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(response, place) of every filter where it responds most, for each chunk."""
    places = np.arange(2 * HALF)
    top = np.empty((len(rows), FILTERS), dtype=np.float32)
    winner = np.empty((len(rows), FILTERS), dtype=np.int64)
    for a in range(0, len(rows), ROWS):
        part = rows[a:a + ROWS]
        response = tables[0].take(part[:, :2 * HALF], axis=0)
        for k in range(1, KERNEL):
            response += tables[k].take(part[:, k:k + 2 * HALF], axis=0)
        response[places[None, :] >= valid[a:a + ROWS, None]] = -np.inf
        winner[a:a + ROWS] = response.argmax(axis=1)
        top[a:a + ROWS] = np.take_along_axis(response, winner[a:a + ROWS, None, :], axis=1)[:, 0]
    return top, winner


def _table_gradient(rows: np.ndarray, winner: np.ndarray, grad: np.ndarray) -> np.ndarray:
    """The gradient of the tables: what each chunk's winning bytes get."""
    out = np.zeros(KERNEL * 256 * FILTERS)
    offsets = np.arange(KERNEL)[None, :, None]
    for a in range(0, len(rows), ROWS):
        places = winner[a:a + ROWS, None, :] + offsets
        found = np.take_along_axis(rows[a:a + ROWS], places.reshape(len(places), -1), axis=1).reshape(places.shape)
        cell = (offsets * 256 + found) * FILTERS + np.arange(FILTERS)
        out += np.bincount(
            cell.ravel(), np.broadcast_to(grad[a:a + ROWS, None, :], cell.shape).ravel(), len(out))
    return out.reshape(KERNEL, 256, FILTERS)


def train(texts: list[bytes], labels: np.ndarray, fit: Fit = Fit()) -> Network:
    """Adam on the logistic loss; only the places that win the pooling get gradient."""
    random = np.random.default_rng(fit.seed)
    tables = random.normal(0, 0.4, (KERNEL, 256, FILTERS)).astype(np.float32)
    weights, bias = random.normal(0, 0.1, 2 * FILTERS), np.zeros(1)
    values = [tables, weights, bias]
    moments = [(np.zeros(v.shape), np.zeros(v.shape)) for v in values]
    step = 0
    for _ in range(fit.epochs):
        for batch in np.array_split(random.permutation(len(texts)), max(1, len(texts) // fit.batch)):
            parts = [_chunks(texts[k]) for k in batch]
            rows = np.concatenate([p[0] for p in parts])
            valid = np.concatenate([p[1] for p in parts])
            count = np.array([len(p[0]) for p in parts])
            at = np.cumsum(count) - count
            top, winner = _strongest(tables, rows, valid)
            chunks = np.maximum(top, 0)
            best = np.maximum.reduceat(chunks, at, axis=0)
            features = np.concatenate([np.add.reduceat(chunks, at, axis=0) / count[:, None], best], axis=1)
            p = 1 / (1 + np.exp(-np.clip(features @ weights + bias, -40, 40)))
            error = (p - labels[batch]) / len(batch)
            back = error[:, None] * weights
            doc = np.repeat(np.arange(len(batch)), count)
            grad = back[doc, :FILTERS] / count[doc, None] + back[doc, FILTERS:] * (chunks == best[doc])
            grad = np.where(top > 0, grad, 0)
            step += 1
            gradients = (_table_gradient(rows, winner, grad), features.T @ error + fit.decay * weights,
                         np.array([error.sum()]))
            for value, g, (m, v) in zip(values, gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                value -= (fit.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(value.dtype)
    return Network(tables, weights, float(bias[0]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", fit: Fit = Fit()) -> "Network | float":
    """Network from the labelled documents, or the share of label 1 if there is only
    one class.  The sample's ids are taken from the labels alone; its texts are then
    found by a join with that bounded set."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label")).distinct()
    texts = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("__doc"), "text")
    shares = {r["__label"]: r["count"] for r in marks.groupBy("__label").count().collect()}
    total = sum(shares.values())
    if len(shares) < 2:
        return shares.get(1, 0) / total if total else 0.5
    wanted = [
        marks.where(F.col("__label") == k).orderBy(F.xxhash64(F.lit(fit.seed), "__id"), "__id").limit(fit.per_class)
        for k in (0, 1)
    ]
    sample = texts.join(F.broadcast(wanted[0].union(wanted[1])), F.col("__doc") == F.col("__id"))
    # one text an id, however often the table repeats it
    sample = sample.groupBy("__id", "__label").agg(F.min("text").alias("text"))
    rows = sorted((r["__id"], r["__label"], r["text"]) for r in sample.collect())
    kept = [r for r in rows if r[2]]
    marked = np.array([r[1] for r in kept], dtype=np.float64)
    if len(set(marked)) < 2:
        return shares[1] / total
    network = train([r[2].encode("utf-8", "replace") for r in kept], marked, fit)
    drawn = marked.mean()
    network.bias += float(np.log(shares[1] / shares[0]) - np.log(drawn / (1 - drawn)))
    return network


def score(docs: DataFrame, network: "Network | float", carry: list["str | Column"]) -> DataFrame:
    """``carry`` columns plus score (probability of label 1) and predicted."""
    rows = docs.select(*carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))
    if isinstance(network, float):
        out = rows.drop("__text").withColumn("score", F.lit(network))
        return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
    parameters = (network.tables, network.weights, network.bias)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(*parameters)
        for batch in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(batch.num_columns - 1).to_pylist()]
            scores, group, size = [], [], 0
            for t in texts:
                group.append(t)
                size += len(t)
                if size >= SLICE:
                    scores.append(net.score(group))
                    group, size = [], 0
            if group:
                scores.append(net.score(group))
            value = np.concatenate([np.zeros(0), *scores])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(compute, f"{fields}, score double, predicted int")
