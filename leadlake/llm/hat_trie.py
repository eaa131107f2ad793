"""Phrase collocations counted in HAT-tries.

1. Phrases are counted by length, one word first.  Every task counts in a trie over word
   ids of its own: one root for each language, below it hash containers.  A container that
   grows beyond ``burst`` phrases bursts: the next words that hold many of them get
   containers of their own, the others go on sharing one (``Trie``).  A container's hash
   table is two arrays, in which a block's phrases are looked up all at once.
2. A trie beyond ``held`` phrases spills whole subtrees, largest first, as runs sorted
   word by word: rows (lang, phrase, n).  A vocabulary beyond ``vocabulary`` words spills
   everything and starts anew.
3. The runs are dealt out by prefix (language and first two words, the path to a
   container at full depth) and merged per prefix partition.  Every task has added up its
   own copies before, so a common phrase is a few rows of each task.
4. A phrase is never more frequent than its parts.  So only phrases whose two longest parts
   are frequent are counted at all, which a bitmap tells (16 bits for each frequent part,
   at most ``most_bits``; where it is full it lets more phrases through, which costs time
   and changes nothing), and all parts of a frequent phrase are in the table of frequent ones.
5. Cuts, scores and the phrases inside longer ones are joins and aggregates of that table,
   in exact decimals; the best phrases of a language are found in parts first, so no task
   gets all phrases of a language.

All counts cover all texts.  A trie holds at most ``held`` phrases and one block of words;
the merge sorts on disk where it must; no other state grows.

Defined cases: NULL and empty texts hold no words.  A NULL language counts as ``und`` and is
added up with texts whose language is that.  Repeated rows count each time.  Ties in
score are settled by a, then by phrase (bytes).  Very long texts are counted in blocks that
overlap, whole.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import bitmap_of, written

BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK, SPACE = 10, 32    # what stands for them, and for space and tab, while words are found
UNKNOWN_LANG = "und"
SLICE_BYTES = 1 << 20
WORD_BITS = 21      # a phrase of up to three words is one long
PARTS = 64          # of a language, to find its best phrases


@dataclass(frozen=True)
class Phrases:
    longest: int = 3            # words, at most 3
    least: int = 10             # occurrences of a candidate
    cover_percent: int = 50     # of a phrase's occurrences inside one longer: it goes
    top: int = 2000             # phrases kept of a language
    scale: int = 1_000_000      # of the score
    held: int = 1_000_000       # phrases in a task's trie
    burst: int = 1 << 15        # phrases in a container before it bursts
    vocabulary: int = 800_000   # words with an id in a task
    block: int = 1 << 18        # words counted at a time
    most_bits: int = 1 << 28    # of the bitmap of frequent parts (32 MB)


class _Ids(dict):
    """Word -> id; words not seen before get the next one, and their checksum is noted."""

    def __init__(self):
        super().__init__({b"": 0})
        self.sums = [0]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.sums.append(zlib.crc32(word))
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        """The ids of distinct words."""
        new = list(filterfalse(self.__contains__, words))
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.sums.extend(map(zlib.crc32, new))
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


LEAST_BITS = 8      # of a hash table's size
SPREAD = np.uint64(0x9E3779B97F4A7C15)
MIX = 1540483477    # below 2**31, so that a checksum times it plus another fits a long


class _Table:
    """Hash table of phrases (packed word ids, never 0) and their counts, in two arrays: open
    addressing, at most half full.  Phrases are looked for all at once."""

    __slots__ = ("keys", "counts", "bits", "size")

    def __init__(self, room: int = 0):
        self._clear(max((2 * room).bit_length(), LEAST_BITS))

    def _clear(self, bits: int) -> None:
        self.bits, self.size = bits, 0
        self.keys, self.counts = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)

    def __len__(self) -> int:
        return self.size

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Count distinct ``keys``; the number of new ones."""
        if 2 * (self.size + len(keys)) > len(self.keys):
            held = self.items()
            self._clear((2 * (self.size + len(keys))).bit_length())
            self._put(*held)
        return self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> int:
        before, last = self.size, len(self.keys) - 1
        slot = (keys.view(np.uint64) * SPREAD >> np.uint64(64 - self.bits)).view(np.int64)
        while len(keys):
            held = self.keys[slot]
            found = held == keys
            free = np.flatnonzero(held == 0)
            if free.size:       # of several that want a place the last gets it
                at, wanted = slot[free], keys[free]
                self.keys[at] = wanted
                found[free] = got = self.keys[at] == wanted
                self.size += int(np.count_nonzero(got))
            self.counts[slot[found]] += counts[found]
            left = ~found
            keys, counts, slot = keys[left], counts[left], (slot[left] + 1) & last
        return self.size - before

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.keys)
        return self.keys[at], self.counts[at]


class _Node:
    """A container of phrases (a hash table) and, for next words that burst out of it, nodes of
    their own.  ``shift`` tells where the next word's id stands."""

    __slots__ = ("shift", "bag", "own", "looked")

    def __init__(self, shift: int):
        self.shift, self.bag, self.own, self.looked = shift, _Table(), {}, 0

    def add(self, keys: np.ndarray, counts: np.ndarray, burst: int) -> int:
        """Count ``keys`` (sorted, distinct); the number of phrases that are new."""
        new = 0
        if self.own:
            word = keys >> self.shift
            heads = np.fromiter(self.own, dtype=np.int64, count=len(self.own))
            heads.sort()
            lo, hi = np.searchsorted(word, heads), np.searchsorted(word, heads, "right")
            rest = np.ones(len(keys), dtype=bool)
            for head, a, b in zip(heads.tolist(), lo.tolist(), hi.tolist()):
                if a < b:
                    new += self.own[head].add(keys[a:b], counts[a:b], burst)
                    rest[a:b] = False
            keys, counts = keys[rest], counts[rest]
        new += self.bag.add(keys, counts)
        if self.shift and len(self.bag) > max(burst, 2 * self.looked):
            self._burst(burst)
            self.looked = len(self.bag)     # what stays shared is looked through again at twice the size
        return new

    def _burst(self, burst: int) -> None:
        """Next words with a sixteenth of the limit or more get nodes of their own."""
        keys, counts = self.bag.items()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        heads, first, n = np.unique(keys >> self.shift, return_index=True, return_counts=True)
        heavy = np.flatnonzero(n >= max(burst >> 4, 2))
        if not heavy.size:
            return
        rest = np.ones(len(keys), dtype=bool)
        for head, a, size in zip(heads[heavy].tolist(), first[heavy].tolist(), n[heavy].tolist()):
            part = slice(a, a + size)
            node = self.own[head] = _Node(self.shift - WORD_BITS)
            node.bag.add(keys[part], counts[part])
            rest[part] = False
        self.bag = _Table(int(rest.sum()))
        self.bag.add(keys[rest], counts[rest])

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self.bag.items()
        for node in self.own.values():
            yield from node.parts()

    def size(self) -> int:
        return len(self.bag) + sum(node.size() for node in self.own.values())

    def subtrees(self) -> list[tuple[int, "int | None"]]:
        """(size, next word) of the nodes below; the shared container has no word."""
        return [(node.size(), head) for head, node in self.own.items()] + [(len(self.bag), None)]

    def take(self, head: "int | None") -> tuple[np.ndarray, np.ndarray]:
        """(phrases, counts) of a node below, which goes."""
        if head is None:
            bag, self.bag, self.looked = self.bag, _Table(), 0
            return bag.items()
        keys, counts = zip(*self.own.pop(head).parts())
        return np.concatenate(keys), np.concatenate(counts)


class Trie:
    """The tries of all languages of one task, for phrases of ``size`` words, within the
    limits of ``rules``."""

    def __init__(self, rules: Phrases, size: int, frequent: "np.ndarray | None" = None):
        self.rules, self.phrase, self.frequent = rules, size, frequent
        self.words, self.sums = _Ids(), np.zeros(1, dtype=np.int64)
        self.roots: dict[str, _Node] = {}
        self.size = 0

    def add(self, lang: str, tokens: np.ndarray) -> None:
        """Count the phrases of ``tokens`` (ids from 1 on; 0 ends a piece) whose parts are all
        frequent."""
        keys = np.zeros(max(len(tokens) - self.phrase + 1, 0), dtype=np.int64)
        whole = np.ones(len(keys), dtype=bool)
        for k in range(self.phrase):
            next_ = tokens[k:k + len(keys)]
            whole &= next_ > 0
            keys |= next_ << ((2 - k) * WORD_BITS)
        if self.phrase > 1:
            held = self._frequent(tokens)
            whole &= held[:len(keys)] & held[1:len(keys) + 1]
        found, n = np.unique(keys[whole], return_counts=True)
        self.size += self.roots.setdefault(lang, _Node(2 * WORD_BITS)).add(found, n, self.rules.burst)

    def _frequent(self, tokens: np.ndarray) -> np.ndarray:
        """Whether the part one word shorter that begins at each token may be frequent."""
        if len(self.sums) < len(self.words):
            self.sums = np.append(self.sums, np.array(self.words.sums[len(self.sums):], dtype=np.int64))
        part = sums = self.sums[tokens]
        for k in range(1, self.phrase - 1):
            part = part[:-1] * MIX + sums[k:]
        place = part % (len(self.frequent) * 8)
        return (self.frequent[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)

    def spill(self, down_to: int = 0) -> Iterator[pa.RecordBatch]:
        """Runs of the largest subtrees, until ``down_to`` phrases are left."""
        below = [(n, lang, head) for lang, root in self.roots.items() for n, head in root.subtrees()]
        words = pa.array(list(self.words), type=pa.binary())
        place = np.empty(len(words), dtype=np.int64)    # of each word in their order
        place[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
        for n, lang, head in sorted(below, key=lambda x: -x[0]):
            if self.size <= down_to or not n:
                break
            keys, counts = self.roots[lang].take(head)
            self.size -= len(keys)
            yield from self._run(lang, keys, counts, words, place)
        if not down_to:
            self.words, self.sums = _Ids(), np.zeros(1, dtype=np.int64)
            self.roots.clear()

    def _run(
        self, lang: str, keys: np.ndarray, n: np.ndarray, words: pa.Array, place: np.ndarray
    ) -> Iterator[pa.RecordBatch]:
        ids = [(keys >> (k * WORD_BITS)) & ((1 << WORD_BITS) - 1) for k in (2, 1, 0)][:self.phrase]
        sorting = place[ids[0]]
        for x in ids[1:]:
            sorting = sorting << WORD_BITS | place[x]
        order = np.argsort(sorting)
        phrase = pc.binary_join_element_wise(*(words.take(pa.array(x[order])) for x in ids), b" ").cast(pa.string())
        count = pa.array(n[order])
        for at in range(0, len(keys), 50_000):
            part = phrase.slice(at, 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(part)), part, count.slice(at, 50_000)], names=["lang", "phrase", "n"])


# by byte, as UTF-8 keeps these apart: A-Z to a-z, tab to SPACE, what ends a piece to BREAK
PLAIN = np.array([BREAK if k in BREAKS else SPACE if k == 9 else k + 32 if 65 <= k <= 90 else k for k in range(256)],
                 dtype=np.uint8)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, number of each one's piece, number of its text) of ``texts``."""
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    plain = PLAIN[np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]]] if data else np.empty(0, dtype=np.uint8)
    ends = (ends - ends[0]).astype(np.int64)
    inside = (plain != SPACE) & (plain != BREAK)
    edge = np.zeros(len(plain) + 1, dtype=bool)
    edge[ends] = True
    begin = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    offsets = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(plain[inside]))])
    breaks = np.flatnonzero((plain == BREAK) | edge[:-1])
    return words, np.searchsorted(breaks, begin, "right"), np.searchsorted(ends, begin, "right") - 1


def _slices(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(first row, rows) of stretches of about ``size`` bytes; a longer text is one alone."""
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = max(int(np.searchsorted(ends, int(ends[at]) + size, "right")) - 1, at + 1)
        yield at, to - at
        at = to


def runs(
    docs: DataFrame, size: int, rules: Phrases = Phrases(), lang: "str | Column" = "lang",
    frequent: "np.ndarray | None" = None,
) -> DataFrame:
    """(lang, phrase, n): the sorted runs of all tasks for phrases of ``size`` words; a phrase
    may come up in several.  ``frequent`` is a bitmap of the parts of size - 1 words."""
    lang = F.col(lang) if isinstance(lang, str) else lang
    rows = docs.select(
        F.coalesce(lang.cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.col("text").cast("string").alias("text")).where("text is not null")
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(rules, size, shared.value)
        waiting: dict[str, list[np.ndarray]] = {}
        held = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for name, tokens in waiting.items():
                trie.add(name, np.concatenate(tokens))
                if trie.size > rules.held:
                    yield from trie.spill(rules.held // 2)
            waiting.clear()

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for at, rows_ in _slices(texts, SLICE_BYTES):
                names = batch.column(0).slice(at, rows_).dictionary_encode()
                words, piece, text = _words(texts.slice(at, rows_))
                lang = names.indices.to_numpy()[text]
                for k in range(0, len(words), rules.block):  # with the words that its last phrases reach
                    part = slice(k, k + rules.block + size - 1)
                    coded = words[part].dictionary_encode()
                    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
                    if len(trie.words) + len(distinct) > rules.vocabulary:
                        yield from counted()
                        yield from trie.spill()
                    ids = trie.words.of(distinct)[coded.indices.to_numpy()]
                    for n, name in enumerate(names.dictionary.to_pylist()):
                        of = np.flatnonzero(lang[part] == n)
                        if of.size:
                            ends = np.flatnonzero(np.diff(piece[part][of])) + 1
                            waiting.setdefault(name, []).append(np.append(np.insert(ids[of], ends, 0), 0))
                    held += len(ids)
                    if held >= rules.block:
                        yield from counted()
                        held = 0
        yield from counted()
        yield from trie.spill()

    return rows.mapInArrow(count, "lang string, phrase string, n long")


def counts(
    docs: DataFrame, size: int, rules: Phrases = Phrases(), lang: "str | Column" = "lang",
    frequent: "np.ndarray | None" = None,
) -> DataFrame:
    """(lang, phrase, n): the runs merged per prefix partition."""
    prefix = F.xxhash64("lang", F.substring_index("phrase", " ", 2))
    dealt = runs(docs, size, rules, lang, frequent).withColumn("prefix", prefix).repartition("prefix")
    return dealt.groupBy("prefix", "lang", "phrase").agg(F.sum("n").alias("n")).drop("prefix")


def _bitmap(parts: DataFrame, size: int, rules: Phrases) -> np.ndarray:
    """Bitmap of the phrases of ``size`` words in ``parts``."""
    sums = [F.crc32(F.split("phrase", " ")[k].cast("binary")) for k in range(size)]
    key = sums[0]
    for other in sums[1:]:
        key = key * MIX + other
    bits = 1 << 16
    wanted = min(16 * parts.count(), rules.most_bits)
    while bits < wanted:
        bits *= 2
    return bitmap_of(parts.select(key.alias("key")), "key", bits)


def frequent_phrases(docs: DataFrame, rules: Phrases = Phrases(), lang: "str | Column" = "lang") -> DataFrame:
    """(lang, phrase, words, n): all single words, and the phrases with at least ``least``
    occurrences."""
    tables, frequent = [], None
    for size in range(1, rules.longest + 1):
        counted = counts(docs, size, rules, lang, frequent)
        if size > 1:
            counted = counted.where(F.col("n") >= rules.least)
        tables.append(written(counted, f"phrases{size}"))
        if size < rules.longest:
            frequent = _bitmap(tables[-1].where(F.col("n") >= rules.least), size, rules)
    out = tables[0].withColumn("words", F.lit(1))
    for size, table in enumerate(tables[1:], 2):
        out = out.unionByName(table.withColumn("words", F.lit(size)))
    return out


def collocations(docs: DataFrame, rules: Phrases = Phrases(), lang: "str | Column" = "lang") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counted = frequent_phrases(docs, rules, lang)
    totals = counted.where("words = 1").groupBy(F.col("lang").alias("__lang")).agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= rules.least).withColumnRenamed("n", "a")
    candidates = frequent.where("words > 1")

    def part(tag: str) -> DataFrame:
        return frequent.select(F.col("lang").alias(f"__{tag}_lang"), F.col("phrase").alias(f"__{tag}"), F.col("a").alias(tag))

    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    cuts = cuts.join(part("l"), (F.col("lang") == F.col("__l_lang")) & (F.col("first") == F.col("__l"))).join(
        part("r"), (F.col("lang") == F.col("__r_lang")) & (F.col("rest") == F.col("__r")))
    exact = [F.col(c).cast("decimal(19,0)") for c in "alr"]
    cuts = cuts.withColumns({"above": F.lit(rules.scale).cast("decimal(19,0)") * exact[0] * exact[0],
                             "below": exact[1] * exact[2]})
    scored = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut"))

    held = candidates.where("words > 2").select(
        "lang", "a", F.explode(F.flatten(F.expr(
            "transform(sequence(2, words - 1), size -> transform(sequence(1, words - size + 1), "
            "at -> array_join(slice(split(phrase, ' '), at, size), ' ')))"))).alias("__inside"))
    held = held.groupBy(F.col("lang").alias("__in_lang"), "__inside").agg(F.max("a").alias("longer"))
    left = scored.join(held, (F.col("lang") == F.col("__in_lang")) & (F.col("phrase") == F.col("__inside")), "left")
    left = left.where(F.col("longer").isNull() | (100 * F.col("longer") < rules.cover_percent * F.col("a")))

    best = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    in_part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    top = left.withColumn("rank", F.row_number().over(in_part)).where(F.col("rank") <= rules.top)
    top = top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    top = top.where(F.col("rank") <= rules.top).join(totals, F.col("lang") == F.col("__lang"))
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
