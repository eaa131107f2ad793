"""SentencePiece encoding and decoding (BPE models) by suffix-array matching.

Encoding a batch:

1. White space is escaped, and the text is cut where a piece can never reach across
   (before an escaped space that follows another character).  The distinct stretches of
   the batch are concatenated, with a sentinel behind each.
2. The suffixes of that text are sorted by as many characters as the longest piece has.
   All pieces are looked up in this suffix array at once by binary search; the range of
   a piece lists every place where it occurs.
3. The occurrences are the edges of a graph over text positions.  They are sorted by
   end position and relaxed, position by position for all stretches together: an edge is
   taken if its piece may follow the piece that ends where it starts.  Two pieces may
   stand next to each other if merging their joint text gives back just these two; the
   merge procedure's result is the only path whose neighbours all may, so the path
   equals the library's encoding, not merely some segmentation.
4. Characters outside the vocabulary become the byte pieces of their UTF-8 form.

Whether two pieces may be neighbours is found by undoing their merges, latest first,
and asking at each step whether the parts at the boundary would have merged earlier
(vectorised; pieces whose merges are not in order of rank are simulated).

The model's tables are made once on the driver and broadcast; they do not grow with the
data.  Memory is bounded by a group's characters, by the number of remembered stretches
and by the longest text.  Nothing is shuffled.

Defined cases: NULL and empty texts have no tokens and decode to ''.  Texts that hold
the escape character itself decode to a space in its place (as in the library), so
their round trip is false.  Long texts are encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ESCAPE = "▁"
GROUP_CHARS = 1 << 16     # characters in one suffix array
REMEMBERED = 200_000      # stretches kept with their tokens before starting anew
TEXT_STRETCHES = 1 << 18  # stretches of whole texts handed on at once
CACHE_BITS = 21           # neighbour decisions kept
PACK = 5                  # characters in one sort key of 12 bits each


class Model:
    """Tables of a BPE model: pieces, ranks, splits and mergeable pairs."""

    def __init__(self, path: str = MODEL):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.unknown, self.start = size, size + 1   # tokens of this module only
        self.byte_ids = np.zeros(256, dtype=np.int32)
        self.piece_bytes: list[bytes] = []
        normal: list[tuple[int, str, float]] = []
        for k in range(size):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                self.byte_ids[int(piece[1:-1], 16)] = k
                self.piece_bytes.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k):
                self.piece_bytes.append(b"")
            else:
                normal.append((k, piece, sp.get_score(k)))
                self.piece_bytes.append(piece.replace(ESCAPE, " ").encode())
        order = {s: r for r, s in enumerate(sorted({s for _, _, s in normal}, reverse=True), 1)}
        self.rank_of = {p: order[s] for _, p, s in normal}
        self.id_of = {p: k for k, p, _ in normal}
        if any(ESCAPE in p.lstrip(ESCAPE) for p in self.id_of):
            raise ValueError("the model has pieces that reach across white space")

        # how each piece is made: its last merge; pieces that merging never makes are unusable
        self.left = np.full(size + 2, -1, dtype=np.int32)
        self.right = np.full(size + 2, -1, dtype=np.int32)
        self.rank = np.zeros(size + 2, dtype=np.int32)
        odd, usable = [], []
        self.text_of = {k: p for k, p, _ in normal}
        for k, piece, _ in normal:
            parts, last = self.merged(piece)
            if len(parts) > 1:
                continue
            usable.append((k, piece))
            if last:
                self.rank[k] = self.rank_of[piece]
                self.left[k], self.right[k] = self.id_of[last[0]], self.id_of[last[1]]
        for k, piece in usable:
            if len(piece) > 1 and max(self.rank[self.left[k]], self.rank[self.right[k]]) >= self.rank[k]:
                odd.append(k)
        self.odd = np.zeros(size + 2, dtype=bool)
        self.odd[odd] = True
        for k, piece in sorted(usable, key=lambda x: len(x[1])):  # made of odd pieces: odd too
            if len(piece) > 1:
                self.odd[k] |= self.odd[self.left[k]] | self.odd[self.right[k]]

        pairs = []
        for piece, k in self.id_of.items():
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    pairs.append((a * (size + 2) + b, self.rank_of[piece]))
        pairs.sort()
        self.pair_code = np.array([p for p, _ in pairs], dtype=np.int64)
        self.pair_rank = np.array([r for _, r in pairs], dtype=np.int32)

        # characters get codes of 12 bits from 1 on; all others share the last code
        letters = sorted({c for _, p in usable for c in p})
        if len(letters) + 2 > 1 << 12:
            raise ValueError("the model's alphabet does not fit 12 bits")
        self.points = np.array([ord(c) for c in letters], dtype=np.int64)
        self.other = len(letters) + 1
        code = {c: k for k, c in enumerate(letters, 1)}
        self.longest = max(len(p) for _, p in usable)
        self.ids = np.array([k for k, _ in usable], dtype=np.int32)
        self.sizes = np.array([len(p) for _, p in usable], dtype=np.int32)
        spelled = np.zeros((len(usable), -(-self.longest // PACK) * PACK), dtype=np.int64)
        for row, (_, p) in enumerate(usable):
            spelled[row, :len(p)] = [code[c] for c in p]
        self.spelled = spelled
        self.size_of = np.ones(size + 2, dtype=np.int32)
        self.size_of[self.ids] = self.sizes

    @classmethod
    def from_tables(cls, tables: dict) -> "Model":
        """A model from another one's ``vars``: executors need no model file."""
        model = cls.__new__(cls)
        model.__dict__.update(tables)
        return model

    def merged(self, text: str) -> tuple[list[str], "tuple[str, str] | None"]:
        """The pieces that merging ``text`` leaves, and the last merge."""
        parts, last = list(text), None
        while True:
            best, where = None, -1
            for k in range(len(parts) - 1):
                rank = self.rank_of.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank < best):
                    best, where = rank, k
            if best is None:
                return parts, last
            last = (parts[where], parts[where + 1])
            parts[where:where + 2] = [parts[where] + parts[where + 1]]


def _packed(codes: np.ndarray, first: int) -> np.ndarray:
    """Sort key of PACK characters, ``first`` places behind each position; ``codes`` has
    enough zeros at its end."""
    n = len(codes)
    key = np.zeros(n, dtype=np.int64)
    for k in range(first, first + PACK):
        key <<= 12
        key[:n - k] |= codes[k:]
    return key


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``keys`` and the dense rank of each (from 1)."""
    order = np.argsort(keys)
    ordered = keys[order]
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return order, ranks


def _bound(keys: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of each ``wanted`` in its own range of ``keys``: the first place not
    below it (``after``: above it)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        at = keys[np.minimum(middle, len(keys) - 1)]
        right = open_ & ((at <= wanted) if after else (at < wanted))
        low = np.where(right, middle + 1, low)
        high = np.where(open_ & ~right, middle, high)


class _Numbers(dict):
    """Numbers strings as they first come; new ones are also put into ``fresh``."""

    def __init__(self, fresh: list[str]):
        super().__init__()
        self.fresh = fresh

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class Encoder:
    def __init__(self, model: Model):
        self.m = model
        self.code_of = np.full(0x110000, model.other, dtype=np.int16)
        self.code_of[model.points] = np.arange(1, len(model.points) + 1)
        self.cache_code = np.full(1 << CACHE_BITS, -1, dtype=np.int64)
        self.cache_ok = np.zeros(1 << CACHE_BITS, dtype=bool)
        self.simulated: dict[tuple[int, int], bool] = {}
        # pieces by sort keys: exact parts, and lowest and highest key of the rest
        blocks = model.spelled.reshape(len(model.ids), -1, PACK)
        weights = 1 << (12 * np.arange(PACK - 1, -1, -1, dtype=np.int64))
        self.low_keys = (blocks * weights).sum(axis=2)
        place = np.arange(model.spelled.shape[1]).reshape(-1, PACK)
        filled = np.where(place[None] < model.sizes[:, None, None], blocks, (1 << 12) - 1)
        self.high_keys = (filled * weights).sum(axis=2)
        self.split = re.compile(f"{ESCAPE}+[^{ESCAPE}]*")
        self.fresh: list[str] = []              # stretches without tokens so far
        self._forget()

    # -- which pieces may be neighbours

    def _decide(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        m = self.m
        ok = np.ones(len(a), dtype=bool)
        odd = m.odd[a] | m.odd[b]
        for k in np.flatnonzero(odd).tolist():
            ok[k] = self._simulate(int(a[k]), int(b[k]))
        at = np.flatnonzero(~odd)
        x, y = a[at].astype(np.int64), b[at].astype(np.int64)
        limit = np.full(len(at), np.iinfo(np.int32).max, dtype=np.int64)
        right_undone = np.zeros(len(at), dtype=bool)
        width = m.start + 1
        while len(at):
            code = x * width + y
            place = np.minimum(np.searchsorted(m.pair_code, code), len(m.pair_code) - 1)
            rank = np.where(m.pair_code[place] == code, m.pair_rank[place], np.iinfo(np.int32).max)
            # of equal ranks the left merge comes first
            crossed = np.where(right_undone, rank <= limit, rank < limit)
            ok[at[crossed]] = False
            go_x, go_y = m.left[x] >= 0, m.left[y] >= 0
            keep = ~crossed & (go_x | go_y)
            at, x, y, go_x, go_y = at[keep], x[keep], y[keep], go_x[keep], go_y[keep]
            undo_x = go_x & (~go_y | (m.rank[x] > m.rank[y]))
            limit = np.where(undo_x, m.rank[x], m.rank[y]).astype(np.int64)
            right_undone = ~undo_x
            x, y = np.where(undo_x, m.right[x], x), np.where(undo_x, y, m.left[y])
        return ok

    def _simulate(self, a: int, b: int) -> bool:
        known = self.simulated.get((a, b))
        if known is None:
            texts = [self.m.text_of.get(k) for k in (a, b)]
            known = None in texts or self.m.merged("".join(texts))[0] == texts
            if len(self.simulated) > 1 << 20:
                self.simulated.clear()
            self.simulated[a, b] = known
        return known

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a.astype(np.int64) * (self.m.start + 1) + b
        slot = (code * 0x9E3779B97F4A7C1 >> 20) & ((1 << CACHE_BITS) - 1)
        ok = self.cache_ok[slot]
        new = np.flatnonzero(self.cache_code[slot] != code)
        if new.size:
            _, first = np.unique(code[new], return_index=True)
            fresh = new[first]
            decided = self._decide(a[fresh], b[fresh])
            self.cache_code[slot[fresh]], self.cache_ok[slot[fresh]] = code[fresh], decided
            place = np.searchsorted(code[fresh], code[new])
            ok[new] = decided[place]
        return ok

    # -- one suffix array

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, piece row) of every occurrence of every piece."""
        m = self.m
        keys = [_packed(codes, k) for k in range(0, m.spelled.shape[1], PACK)]
        array, ranks = _ranked(keys[0])
        reach = PACK
        while reach < m.longest:  # ranks of twice as many characters from two ranks
            further = np.zeros_like(ranks)
            further[:-reach] = ranks[reach:]
            array, ranks = _ranked(ranks * (len(codes) + 1) + further)
            reach *= 2
        array = array[np.searchsorted(keys[0][array], 1 << (12 * (PACK - 1))):]  # without sentinels
        low = np.zeros(len(m.ids), dtype=np.int64)
        high = np.full(len(m.ids), len(array), dtype=np.int64)
        rows = np.arange(len(m.ids))
        for level, key in enumerate(keys):
            ordered = key[array]
            l, h = low[rows], high[rows]
            low[rows] = _bound(ordered, l, h, self.low_keys[rows, level], False)
            high[rows] = _bound(ordered, l, h, self.high_keys[rows, level], True)
            rows = rows[(m.sizes[rows] > PACK * (level + 1)) & (low[rows] < high[rows])]
            if not rows.size:
                break
        # a longer piece whose search ended early has an empty range there
        count = np.maximum(high - low, 0)
        piece = np.repeat(np.arange(len(m.ids)), count)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
        return array[low[piece] + within], piece

    def _encode_group(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all stretches, number of tokens of each)."""
        m = self.m
        points = np.frombuffer("\0".join([*stretches, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.array([len(x) for x in stretches], dtype=np.int64)
        begin = np.cumsum(size + 1) - (size + 1)
        codes = self.code_of[points].astype(np.int64)  # sort keys need the width
        codes[begin + size] = 0
        codes = np.concatenate((codes, np.zeros(m.longest + PACK, dtype=np.int64)))
        at, piece = self._edges(codes)
        # characters outside the vocabulary are edges too
        strange = np.flatnonzero(codes == m.other)
        at = np.concatenate((at, strange))
        token = np.concatenate((m.ids[piece], np.full(len(strange), m.unknown, dtype=np.int32)))
        length = m.size_of[token]
        of = np.repeat(np.arange(len(stretches)), size + 1)[at]
        end = at + length
        offset = end - begin[of]
        # by end offset, then by stretch, longest first: most often the longest is right
        place = offset * len(stretches) + of
        order = np.argsort(place * 32 + (31 - np.minimum(length, 31)))
        at, token, end, offset, place = at[order], token[order], end[order], offset[order], place[order]
        opens = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        rank = np.arange(len(place)) - np.repeat(opens, np.diff(np.append(opens, len(place))))
        last = np.full(len(codes), -1, dtype=np.int64)
        steps = np.zeros(len(codes), dtype=np.int32)
        last[begin] = m.start
        cuts = np.searchsorted(offset, np.arange(1, int(size.max(initial=0)) + 2))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            tries = rank[lo:hi]
            left = np.arange(lo, hi)
            turn = 0
            while left.size:
                now = left[tries[left - lo] == turn]
                good = now[self.may_follow(last[at[now]], token[now].astype(np.int64))]
                last[end[good]] = token[good]
                steps[end[good]] = steps[at[good]] + 1
                turn += 1
                left = left[(tries[left - lo] >= turn) & (last[end[left]] < 0)]
        return self._walk(last, steps, begin, size, points)

    def _walk(self, last, steps, begin, size, points) -> tuple[np.ndarray, np.ndarray]:
        """Read the paths back from the ends of the stretches."""
        m = self.m
        n = steps[begin + size].astype(np.int64)
        first = np.cumsum(n) - n
        out = np.empty(int(n.sum()), dtype=np.int32)
        place = np.empty(len(out), dtype=np.int64)
        at, of = (begin + size).copy(), np.arange(len(begin))
        while of.size:
            here = at[of]
            token = last[here]
            slot = first[of] + steps[here] - 1
            out[slot] = token
            at[of] -= m.size_of[token]
            place[slot] = at[of]
            of = of[at[of] > begin[of]]
        strange = out == m.unknown
        if strange.any():  # replace by the bytes of the character
            spelled = [chr(p).encode("utf-8", "surrogatepass") for p in points[place[strange]].tolist()]
            width = np.ones(len(out), dtype=np.int64)
            width[strange] = [len(b) for b in spelled]
            n = np.add.reduceat(width, first) if len(first) else n
            wide = np.repeat(out, width)
            wide[np.repeat(strange, width)] = self.m.byte_ids[np.frombuffer(b"".join(spelled), dtype=np.uint8)]
            out = wide
        return out, n

    # -- texts

    def _forget(self) -> None:
        self.known = _Numbers(self.fresh)
        self.flat, self.counts = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)

    def encode(self, texts: list["str | None"]) -> Iterator[list[np.ndarray]]:
        """Tokens of ``texts``, in lists of consecutive ones.  Stretches are remembered
        from one call to the next."""
        waiting: list[np.ndarray] = []

        def finish() -> list[np.ndarray]:
            tokens, counts = [self.flat], [self.counts]
            group, size = [], 0
            for s in self.fresh:
                group.append(s)
                size += len(s) + 1
                if size >= GROUP_CHARS:
                    self._add(group, tokens, counts)
                    group, size = [], 0
            if group:
                self._add(group, tokens, counts)
            self.fresh.clear()
            flat, n = self.flat, self.counts = np.concatenate(tokens), np.concatenate(counts)
            first = np.cumsum(n) - n
            out = []
            for stretches in waiting:
                width = n[stretches]
                inner = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
                out.append(flat[np.repeat(first[stretches], width) + inner])
            waiting.clear()
            return out

        size = 0
        for text in texts:
            stretches = self.split.findall(ESCAPE + text.replace(" ", ESCAPE)) if text else []
            waiting.append(np.fromiter(
                map(self.known.__getitem__, stretches), dtype=np.int64, count=len(stretches)))
            size += len(stretches)
            if size > TEXT_STRETCHES:
                yield finish()
                size = 0
                if len(self.known) > REMEMBERED:
                    self._forget()
        yield finish()

    def _add(self, group: list[str], tokens: list, counts: list) -> None:
        flat, n = self._encode_group(group)
        tokens.append(flat)
        counts.append(n)


def decode_tokens(tokens: np.ndarray, pieces: list[bytes]) -> str:
    """Text of ``tokens``: their bytes, without the space put before every text."""
    return b"".join([pieces[k] for k in tokens.tolist()]).decode("utf-8", "replace")[1:]


def encode(docs: DataFrame, carry: list["str | Column"], path: str = MODEL) -> DataFrame:
    """``carry`` columns plus n_tokens, ids (array of int) and round_trip (decoding the
    ids gives the text back)."""
    tables = docs.sparkSession.sparkContext.broadcast(vars(Model(path)))
    rows = docs.select(*carry, F.col("text").cast("string").alias("__text"))
    names = [f.name for f in rows.schema.fields[:-1]]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Model.from_tables(tables.value))
        pieces = encoder.m.piece_bytes
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            at = 0
            for part in encoder.encode(texts):
                if not part:
                    continue
                here = slice(at, at + len(part))
                at += len(part)
                size = np.array([len(t) for t in part], dtype=np.int64)
                offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                same = [decode_tokens(t, pieces) == (x or "") for t, x in zip(part, texts[here])]
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(part)))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(here.start, len(part)) for c in batch.columns[:-1]),
                     pa.array(size), ids, pa.array(same)],
                    names=[*names, "n_tokens", "ids", "round_trip"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(compute, f"{fields}, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, carry: list["str | Column"], path: str = MODEL) -> DataFrame:
    """``carry`` columns plus text, from the column ``ids`` (NULL: '')."""
    pieces = encoded.sparkSession.sparkContext.broadcast(Model(path).piece_bytes)
    rows = encoded.select(*carry, F.col("ids").cast("array<int>").alias("__ids"))
    names = [f.name for f in rows.schema.fields[:-1]]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_tokens(np.array(t or [], dtype=np.int32), pieces.value)
                     for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, type=pa.string())], names=[*names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(compute, f"{fields}, text string")
