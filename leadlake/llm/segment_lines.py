"""Line deduplication by a segment-partition edit join.

Lines (white space around them ignored) of at least ``min_chars`` characters are
compared; two of them are linked when their Levenshtein distance is at most ``edits``.
Linked and equal lines form classes; the first line of a class, by (doc_id, line
number), stays and every other occurrence is a duplicate.

1. Equal lines are one node (a 128-bit hash settles equality).
2. A line of length l is cut into ``edits + 1`` segments of nearly equal length.  If
   another line is within ``edits`` of it, one segment occurs in that line, unchanged
   and shifted by a few places only; the positions that have to be looked at follow
   from the length difference and the segment's number.  Index rows and probes are
   keys (length, segment number, content), so the join is on equal keys and knows
   lengths.  All keys of a batch come from prefix hashes, a few array operations per
   segment and shift.
3. Keys are counted over the whole corpus; a fixed-size bitmap of those with two lines
   filters the second pass, which keeps only memberships of such keys.  ``links`` turns
   them into pairs without all pairs of a key.
4. A pair is confirmed by bit-parallel edit distance within a band of
   ``2 * edits + 1`` diagonals, many pairs at a time.

Shuffled are hashes; line texts only of lines that share a key.  A line that occurs
millions of times is one row per task after the first aggregation.

Defined cases: NULL text has no lines; shorter lines are never duplicates; the order of
rows with equal doc_id is that of a hash of their texts; rows equal in doc_id and text
count as one document; rows without doc_id come last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm import setsketch
from leadlake.llm.common import NON_WORD_BREAK, bitmap_filter, bitmap_of, written
from leadlake.llm.links import linked_components, shared_memberships

EDGE = " \t\x0b\x0c\r"
GROUP_CHARS = 1 << 19     # characters of lines handled at once
PAIR_CELLS = 1 << 21      # pairs times line length compared at once
KEY_BITS = 1 << 26        # bitmap of shared keys: 8 MB
U64 = np.uint64


@dataclass(frozen=True)
class LineJoin:
    min_chars: int = 20
    edits: int = 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    return x ^ (x >> U64(29))


class PrefixHashes:
    """Substring hashes of long texts: polynomial modulo 2^64 over mixed characters.
    The powers are computed once and serve every text."""

    FACTOR = U64(0xD1342543DE82EF95)  # odd, so it has an inverse
    INVERSE = U64(pow(0xD1342543DE82EF95, -1, 1 << 64))

    def __init__(self):
        self.mixed = _mix(np.arange(1, 0x110001, dtype=U64))
        self.power = self.back = np.ones(1, dtype=U64)
        self.sums = np.zeros(1, dtype=U64)

    def read(self, points: np.ndarray) -> None:
        n = len(points)
        if n >= len(self.power):
            self.power = np.full(n + n // 4 + 1, self.FACTOR, dtype=U64)
            self.back = np.full(n + n // 4 + 1, self.INVERSE, dtype=U64)
            self.power[0] = self.back[0] = 1
            np.cumprod(self.power, out=self.power)
            np.cumprod(self.back, out=self.back)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(self.mixed[points] * self.power[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.back[start]


def segment(length: np.ndarray, edits: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment ``k`` of lines of ``length``; the last ones are longer."""
    count = edits + 1
    base, longer = np.divmod(length, count)
    first_longer = count - longer
    return k * base + np.maximum(0, k - first_longer), base + (k >= first_longer)


def line_keys(
    lines: list[str], nodes: np.ndarray, join: LineJoin, hashes: PrefixHashes | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, nodes): the index rows and probes of ``lines``."""
    edits = join.edits
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.array([len(x) for x in lines], dtype=np.int64)
    at = np.cumsum(size) - size
    hashes = hashes or PrefixHashes()
    hashes.read(points)
    keys, owners = [], []
    for less in range(edits + 1):
        other = size - less                      # length of the indexed line
        fits = other >= max(join.min_chars, edits + 1)
        if not fits.any():
            continue
        begin, own, length = at[fits], nodes[fits], size[fits]
        other = other[fits]
        for k in range(edits + 1):
            start, width = segment(other, edits, k)
            low = max(-k, less - (edits - k))
            high = min(k, less + (edits - k))
            for shift in range(low, high + 1):
                place = start + shift
                inside = (place >= 0) & (place + width <= length)
                content = hashes.of((begin + place)[inside], width[inside])
                tag = (other[inside] * (edits + 1) + k).astype(U64)
                keys.append(_mix(content ^ _mix(tag + U64(1))))
                owners.append(own[inside])
    if not keys:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(owners)


def _lines(text: str | None, least: int) -> Iterator[tuple[int, str]]:
    for number, line in enumerate((text or "").split("\n")):
        if len(line) >= least:
            line = line.strip(EDGE)
            if len(line) >= least:
                yield number, line


@dataclass
class _Group:
    """Some consecutive lines: row of the batch, number in the text, line, hash halves."""

    rows: list[int]
    numbers: list[int]
    lines: list[str]

    def hashes(self) -> np.ndarray:
        digests = b"".join([xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in self.lines])
        return np.frombuffer(digests, dtype=np.int64).reshape(-1, 2)


def _groups(texts: list[str | None], least: int) -> Iterator[_Group]:
    """The lines of ``texts``, GROUP_CHARS characters or a little more at a time."""
    group, size = _Group([], [], []), 0
    for row, text in enumerate(texts):
        for number, line in _lines(text, least):
            group.rows.append(row)
            group.numbers.append(number)
            group.lines.append(line)
            size += len(line)
            if size >= GROUP_CHARS:
                yield group
                group, size = _Group([], [], []), 0
    if group.rows:
        yield group


def _held(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = values % (len(bits) * 8)
    return (bits[place >> 3] >> (place & 7) & 1).astype(bool)


def line_rows(docs: DataFrame, join: LineJoin) -> DataFrame:
    """(doc_id, tkey, line, h1, h2, again) of every line that is compared; ``again`` says
    that the document has an equal line before it."""
    least = join.min_chars

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, seen = -1, set()
            for group in _groups(batch.column(2).to_pylist(), least):
                h = group.hashes()
                again = []
                for k, line in zip(group.rows, map(bytes, h)):
                    if k != row:
                        row, seen = k, set()
                    again.append(line in seen)
                    seen.add(line)
                at = pa.array(group.rows, type=pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(group.numbers, type=pa.int32()),
                     pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(again, type=pa.bool_())],
                    names=["doc_id", "tkey", "line", "h1", "h2", "again"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(compute, "doc_id long, tkey long, line int, h1 long, h2 long, again boolean")


def memberships(docs: DataFrame, join: LineJoin, shared: "np.ndarray | None" = None) -> DataFrame:
    """(key, node) of all lines; with a bitmap, only of keys it holds."""
    bits = None if shared is None else docs.sparkSession.sparkContext.broadcast(shared)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = PrefixHashes()
        for batch in batches:
            for group in _groups(batch.column(0).to_pylist(), join.min_chars):
                nodes, first = np.unique(group.hashes()[:, 0], return_index=True)
                keys, owners = line_keys([group.lines[k] for k in first.tolist()], nodes, join, hashes)
                if bits is not None:
                    held = _held(bits.value, keys)
                    keys, owners = keys[held], owners[held]
                for k in range(0, len(keys), 1 << 16):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[k:k + (1 << 16)]), pa.array(owners[k:k + (1 << 16)])], names=["key", "node"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(compute, "key long, node long")


def within(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Which pairs (a[k], b[k]) have Levenshtein distance at most ``edits``.

    Bit-parallel columns of the distance matrix, kept to the band around the diagonal
    and computed for all pairs together.  Bit 63 of a column stands for the lowest row
    of the band; the distance there is tracked, first down the band's lower edge, then,
    once that has reached the last row, along that row."""
    la, lb = (np.array([len(x) for x in s], dtype=np.int64) for s in (a, b))
    out = np.abs(la - lb) <= edits
    todo = np.flatnonzero(out)
    todo = todo[np.argsort(la[todo], kind="stable")]
    at = 0
    while at < len(todo):
        step = max(1, PAIR_CELLS // int(la[todo[min(at + 4096, len(todo)) - 1]] + 2 * edits + 2))
        part = todo[at:at + min(step, 4096)]
        at += len(part)
        out[part] = _banded([a[k] for k in part], [b[k] for k in part], edits)
    return out


def _padded(lines: list[str], before: int, width: int, fill: int) -> np.ndarray:
    out = np.full((width, len(lines)), fill, dtype=np.int64)
    for k, line in enumerate(lines):
        out[before:before + len(line), k] = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


def _banded(a: list[str], b: list[str], edits: int) -> np.ndarray:
    la, lb = (np.array([len(x) for x in s], dtype=np.int64) for s in (a, b))
    columns = int(lb.max(initial=0))
    rows = _padded(a, edits, int(max(la.max(initial=0), columns)) + 2 * edits + 1, -1)
    text = _padded(b, 0, columns, -2)
    n = len(a)
    vp = np.full(n, (0xFFFFFFFFFFFFFFFF << (63 - edits)) & 0xFFFFFFFFFFFFFFFF, dtype=U64)
    vn = np.zeros(n, dtype=U64)
    distance = np.minimum(la, edits)             # of the edge row (or the last) before any column
    one = U64(1)
    for j in range(columns):
        x = np.zeros(n, dtype=U64)
        for d in range(2 * edits + 1):           # row j - edits + d of the band
            x |= (rows[j + d] == text[j]).astype(U64) << U64(63 - 2 * edits + d)
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        edge = j < la - edits                    # the band's lower edge is above the last row
        # on the last row its bit moves down by one place per column
        bit = np.clip(62 - (j - (la - edits)), 0, 63).astype(U64)
        change = np.where(edge, 1 - (d0 >> U64(63)).astype(np.int64),
                          (hp >> bit & one).astype(np.int64) - (hn >> bit & one).astype(np.int64))
        distance += np.where(j < lb, change, 0)
        vp, vn = hn | ~((d0 >> one) | hp), (d0 >> one) & hp
    return distance <= edits


def _verifier(texts: DataFrame, join: LineJoin):
    """Confirms pairs of nodes; ``texts`` has (node, text)."""
    edits = join.edits

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array(within(batch.column(2).to_pylist(), batch.column(3).to_pylist(), edits))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        ta = texts.select(F.col("node").alias("__a"), F.col("text").alias("ta"))
        tb = texts.select(F.col("node").alias("__b"), F.col("text").alias("tb"))
        joined = pairs.join(ta, F.col("a") == F.col("__a")).join(tb, F.col("b") == F.col("__b"))
        close = F.abs(F.length("ta") - F.length("tb")) <= edits
        return joined.where(close).select("a", "b", "ta", "tb").mapInArrow(compute, "a long, b long").distinct()

    return verify


def _texts(docs: DataFrame, nodes: DataFrame, join: LineJoin) -> DataFrame:
    """(node, text) of the lines in ``nodes``."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(nodes, "node"))
    least = join.min_chars

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch.column(0).to_pylist(), least):
                found, first = np.unique(group.hashes()[:, 0], return_index=True)
                held = _held(bits.value, found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[held]), pa.array([group.lines[k] for k in first[held].tolist()], type=pa.string())],
                    names=["node", "text"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(compute, "node long, text string")
    wanted = nodes.select(F.col("node").alias("__node"))
    return found.join(wanted, F.col("node") == F.col("__node"), "left_semi").dropDuplicates()


CLASSES = 16
GRAM = 4                  # characters of the substrings that are counted by class
GRAM_CLASSES = 64
COUNTS = [f"g{k}" for k in range(CLASSES)]


def character_counts(texts: DataFrame) -> DataFrame:
    """(node, n, g0 ..., grams): length of a line, the counts of its characters by class and
    those of its substrings of ``GRAM`` characters."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.zeros((batch.num_rows, CLASSES), dtype=np.int32)
            grams = np.zeros((batch.num_rows, GRAM_CLASSES), dtype=np.int32)
            for k, text in enumerate(batch.column(1).to_pylist()):
                points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                points = points.astype(U64) + U64(1)
                counts[k] = np.bincount((_mix(points) >> U64(40)) % U64(CLASSES), minlength=CLASSES)
                joined = np.zeros(max(len(points) - GRAM + 1, 0), dtype=U64)
                for place in range(GRAM):
                    joined = joined * PrefixHashes.FACTOR + points[place:place + len(joined)]
                grams[k] = np.bincount((_mix(joined) >> U64(40)) % U64(GRAM_CLASSES), minlength=GRAM_CLASSES)
            ends = pa.array(np.arange(0, grams.size + 1, GRAM_CLASSES, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts.sum(axis=1)), *(pa.array(counts[:, k]) for k in range(CLASSES)),
                 pa.ListArray.from_arrays(ends, pa.array(grams.ravel()))], names=["node", "n", *COUNTS, "grams"])

    fields = ", ".join(f"{g} int" for g in COUNTS)
    return texts.select("node", "text").mapInArrow(compute, f"node long, n long, {fields}, grams array<int>")


def _narrower(texts: DataFrame, join: LineJoin):
    """Possible pairs within the groups of round 3.  Each edit changes one count of the
    characters by class, or two by one each: the counts of lines within the distance
    differ by at most 2 * edits together, and by at most ``edits`` in the sum over any
    set of classes.  Two such sums place the lines in cells of ``edits`` + 1; only
    neighbouring cells are joined.  An edit also changes at most ``GRAM`` substrings of that
    many characters on either side, which tells lines with the same characters apart."""
    edits = join.edits
    width = edits + 1

    def narrow(groups: DataFrame) -> DataFrame:
        counts = character_counts(texts)
        cells = [
            F.floor(sum((F.col(g) for g in COUNTS[:CLASSES // 2]), F.lit(0)) / width).cast("long"),
            F.floor(sum((F.col(g) for g in COUNTS[::2]), F.lit(0)) / width).cast("long"),
        ]
        counts = written(counts.withColumns({"x": cells[0], "y": cells[1]}).withColumnRenamed("node", "__n"), "counts")
        members = groups.join(counts, F.col("node") == F.col("__n"))
        other = members.select(
            F.col("pivot").alias("__p"), F.col("node").alias("b"), F.col("c").alias("__cb"), F.col("n").alias("__n_b"),
            F.col("x").alias("__x"), F.col("y").alias("__y"), F.col("grams").alias("__grams"),
            *[F.col(g).alias(f"__{g}") for g in COUNTS])
        around = F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
                           for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
        one = members.where("apart").withColumn("__cell", F.explode(around))
        apart = sum((F.abs(F.col(g) - F.col(f"__{g}")) for g in COUNTS), F.lit(0))
        other_grams = F.aggregate(
            F.zip_with("grams", "__grams", lambda x, y: F.abs(x - y)), F.lit(0), lambda total, x: total + x)
        return one.join(
            other,
            (F.col("pivot") == F.col("__p")) & (F.col("__cell.x") == F.col("__x")) & (F.col("__cell.y") == F.col("__y"))
            & (F.col("c") != F.col("__cb")) & (F.abs(F.col("n") - F.col("__n_b")) <= edits) & (apart <= 2 * edits)
            & (other_grams <= 2 * GRAM * edits),
        ).select(F.col("node").alias("a"), "b")

    return narrow


def line_components(docs: DataFrame, join: LineJoin = LineJoin()) -> DataFrame:
    """(node, component) of all lines with another line within the distance."""
    doubled = memberships(docs, join).groupBy("key").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    bits = bitmap_of(doubled, "key", KEY_BITS)
    members = written(memberships(docs, join, bits), "line-members")
    shared = written(shared_memberships(members), "line-keys")
    texts = written(_texts(docs, shared.select("node").distinct(), join), "line-texts")
    return linked_components(shared, _verifier(texts, join), _narrower(texts, join))


def _classed_lines(docs: DataFrame, join: LineJoin) -> DataFrame:
    """The rows of ``line_rows`` with their class (k1, k2)."""
    lines = written(line_rows(docs, join), "lines")
    components = line_components(docs, join).select(F.col("node").alias("__node"), "component")
    return lines.join(components, F.col("h1") == F.col("__node"), "left").select(
        "doc_id", "tkey", "line", "h1", "h2", "again",
        F.coalesce("component", "h1").alias("k1"),
        F.when(F.col("component").isNull(), F.col("h2")).otherwise(F.lit(0)).alias("k2"))


def _later_lines(classed: DataFrame) -> DataFrame:
    """(doc_id, tkey, line, near, own, k1, k2, fid, ftkey), a row per duplicate line:
    whether it differs from the line that stays, whether it repeats a line of its own
    document (an equal one, or the one that stays), its class, and the document that keeps
    the class."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey", "line", "h1", "h2")
    # a table, as the join can split a very common class only if this is no aggregate of its own shuffle
    first = written(classed.groupBy("k1", "k2").agg(
        F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "first"), "line-classes")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey"))
    later = classed.join(first, (F.col("k1") == F.col("__k1")) & (F.col("k2") == F.col("__k2"))).where(
        ~(same & (F.col("line") == F.col("first.line"))))
    near = (F.col("h1") != F.col("first.h1")) | (F.col("h2") != F.col("first.h2"))
    return later.groupBy("doc_id", "tkey", "line").agg(
        F.max(near.cast("int")).alias("near"), F.max(F.col("again") | same).alias("own"),
        F.min("k1").alias("k1"), F.min("k2").alias("k2"),
        F.min("first.doc_id").alias("fid"), F.min("first.tkey").alias("ftkey"))


def _dropped(later: DataFrame) -> DataFrame:
    return later.groupBy("doc_id", "tkey").agg(
        F.array_sort(F.collect_list("line")).alias("dropped"), F.sum("near").alias("n_near"))


def duplicate_lines(docs: DataFrame, join: LineJoin = LineJoin()) -> DataFrame:
    """(doc_id, tkey, dropped, n_near): for every document with a duplicate line, the
    numbers of these lines (from 0, ascending) and how many of them differ from the
    line that stays.  ``tkey`` is a hash of the text."""
    return _dropped(_later_lines(_classed_lines(docs, join)))


def _with_dropped(docs: DataFrame, found: DataFrame) -> DataFrame:
    other = found.select(F.col("doc_id").alias("__fid"), F.col("tkey").alias("__ftkey"), "dropped", "n_near")
    return docs.join(
        other, F.col("__id").eqNullSafe(F.col("__fid")) & (F.col("__tkey") == F.col("__ftkey")), "left"
    ).drop("__fid", "__ftkey")


def deduplicate(docs: DataFrame, join: LineJoin = LineJoin()) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, n_near and ``dropped``, the
    numbers of its duplicate lines."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__tkey"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"))
    out = _with_dropped(rows, duplicate_lines(docs, join))
    none = F.array().cast("array<int>")
    return out.select(
        F.col("__id").alias("doc_id"), "n_lines",
        F.size(F.coalesce("dropped", none)).cast("long").alias("n_dropped"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("dropped", none).alias("dropped"))


def _same(left: tuple[str, str], right: tuple[str, str]) -> Column:
    """Both name the same document, by (doc_id, tkey)."""
    return F.col(left[0]).eqNullSafe(F.col(right[0])) & (F.col(left[1]) == F.col(right[1]))


def _mostly_later(docs: DataFrame, later: DataFrame, whole_copy: float) -> DataFrame:
    """(xid, xtkey, least, line, chars, k1, k2, fid, ftkey): the lines kept by other
    documents of those documents in which they have more than ``least`` characters,
    ``whole_copy`` of the text without its own repeats."""
    listed = later.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct(
        "line", "own", "k1", "k2", "fid", "ftkey")).alias("later")).select(
        F.col("doc_id").alias("xid"), F.col("tkey").alias("xtkey"), "later")
    lengths = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"),
        F.length("text").alias("size"), F.transform(F.split("text", "\n", -1), F.length).alias("lengths"))
    rows = listed.join(lengths, _same(("xid", "xtkey"), ("doc_id", "tkey"))).dropDuplicates(["xid", "xtkey"])

    def chars(own: bool) -> Column:
        lines = F.filter("later", lambda x: x["own"] == F.lit(own))
        return F.aggregate(lines, F.lit(0), lambda a, x: a + F.get(F.col("lengths"), x["line"]))

    rows = rows.withColumn("least", whole_copy * (F.col("size") - chars(True))).where(chars(False) > F.col("least"))
    return rows.select("xid", "xtkey", "least", "lengths", F.explode("later").alias("x")).where("not x.own").select(
        "xid", "xtkey", "least", F.get("lengths", F.col("x.line")).alias("chars"), "x.*").drop("own")


def _held_by_one(mostly: DataFrame, classed: DataFrame) -> DataFrame:
    """(xid, xtkey) of documents with more than ``least`` characters in lines that one
    other document holds, of those that keep a line of theirs."""
    holders = mostly.select(
        F.col("xid").alias("__x"), F.col("xtkey").alias("__t"), F.col("fid").alias("eid"),
        F.col("ftkey").alias("etkey")).distinct()
    asked = mostly.join(holders, _same(("xid", "xtkey"), ("__x", "__t")))
    lines = classed.select("doc_id", "tkey", F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    held = asked.join(lines, _same(("eid", "etkey"), ("doc_id", "tkey"))
                      & (F.col("k1") == F.col("__k1")) & (F.col("k2") == F.col("__k2")), "left_semi")
    return held.groupBy("xid", "xtkey", "eid", "etkey").agg(
        F.sum("chars").alias("held"), F.max("least").alias("least")
    ).where("held > least").select("xid", "xtkey").distinct()


def _nearly_equal(docs: DataFrame, some: DataFrame, near: setsketch.Near) -> DataFrame:
    """(xid, xtkey) of the documents ``some`` (xid, xtkey) that are near duplicates of
    another document.  Such a document has ``percent`` or more of its shingles in common
    with one of ``some``, so only documents with as many in a bitmap of theirs are compared."""
    words = near.shingle_words

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = setsketch.shingles(text, words).view(np.int64)
                for k in range(0, len(found), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(found[k:k + (1 << 16)])], names=["shingle"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tkey"),
                       F.col("text").cast("string").alias("text"))
    # a table: with both functions in one task, two Python processes a core would stay for all later stages
    theirs = written(rows.where(bitmap_filter(some, "xtkey")("tkey")).select("text"), "unheld-texts")
    theirs = theirs.mapInArrow(shingled, "shingle long")
    bits = docs.sparkSession.sparkContext.broadcast(bitmap_of(theirs, "shingle", KEY_BITS))

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in batch.column(1).to_pylist():
                found = setsketch.shingles(text, words).view(np.int64)
                kept.append(len(found) > 0 and 100 * int(_held(bits.value, found).sum()) >= near.percent * len(found))
            yield batch.filter(pa.array(kept, type=pa.bool_()))

    compared = written(rows.select("doc_id", "text").mapInArrow(partners, "doc_id long, text string"), "partners")
    labelled = written(setsketch.labels(compared, near).where("label is not null").select(
        "doc_id", "tkey", "label").distinct(), "partner-labels")
    groups = labelled.groupBy("label").count().where("count > 1").select(F.col("label").alias("__label"))
    found = labelled.join(groups, F.col("label") == F.col("__label"), "left_semi")
    return some.join(found, _same(("xid", "xtkey"), ("doc_id", "tkey")), "left_semi")


def without_duplicates(docs: DataFrame, join: LineJoin = LineJoin(), whole_copy: float = 0.5) -> DataFrame:
    """``docs`` without their duplicate lines (``n_chars``, where there is one, follows
    the text).  Lines equal to one before them in their document, or in a class that their
    document keeps, always go.  A document with
    more than ``whole_copy`` of its other characters in lines that other documents keep
    is left to document deduplication, which needs the text to recognise it, if it is a
    confirmed copy: one of those documents holds more than ``whole_copy`` of it, or it is
    a near duplicate of any other (five words, 0.8).  Else its lines go as well, and a
    document with nothing left goes with them."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__tkey"), row)
    classed = written(_classed_lines(docs, join), "classed")
    later = written(_later_lines(classed), "later")
    mostly = written(_mostly_later(docs, later, whole_copy), "mostly-later")
    whole = written(_held_by_one(mostly, classed), "whole")
    held = whole.select(F.col("xid").alias("__x"), F.col("xtkey").alias("__t"))
    rest = written(mostly.select("xid", "xtkey").distinct().join(
        held, _same(("xid", "xtkey"), ("__x", "__t")), "left_anti"), "unheld")
    if not rest.isEmpty():
        whole = whole.union(written(_nearly_equal(docs, rest, setsketch.Near()), "whole"))
    others = later.where("not own").join(whole, _same(("doc_id", "tkey"), ("xid", "xtkey")), "left_anti")
    out = _with_dropped(keyed, _dropped(later.where("own").union(others)))
    text = F.col("__row")["text"]
    out = out.withColumn("__lines", F.when(F.col("dropped").isNotNull(), F.split(text, "\n", -1)))
    staying = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "dropped"),
        lambda k: F.get(F.col("__lines"), k))
    cut = F.col("dropped").isNotNull()
    out = out.withColumn("__text", F.when(cut, F.array_join(staying, "\n")).otherwise(text))
    out = out.where(~cut | F.col("__text").rlike(NON_WORD_BREAK))
    new = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return out.select(*[new.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])
