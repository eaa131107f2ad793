"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in one pass: at-signs, plus
signs, digits, URL schemes and identifier cues.  Each anchor has a local parser that
expands to the left and right from it, validates what it read and gives a span (code
points, end exclusive).  Per kind, spans are leftmost and do not overlap: a parser
never reads before the end of its kind's last match.

Kinds email, ip, card and phone accept exactly the contract's expressions; account,
iban, ssn and userinfo (name and password in a URL) need a cue or a scheme next to
them and are added to those.

Defined cases: NULL and empty texts have no spans; long texts are read whole, in time
linear in their length; every row is judged by itself, so repeated rows, NULLs in
other columns and an empty table need no rule.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "account", "iban", "ssn", "userinfo")
BASE_KINDS = 4
EMAIL, IP, CARD, PHONE, ACCOUNT, IBAN, SSN, USERINFO = range(len(KINDS))

DIGITS = frozenset("0123456789")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTERS = UPPER | frozenset("abcdefghijklmnopqrstuvwxyz")
LABEL = LETTERS | DIGITS | {"-"}
LOCAL = LABEL | frozenset("._%+")
PHONE_INNER = DIGITS | frozenset(" ().-")
CUES = {
    ACCOUNT: ("account", "acct", "konto", "cuenta", "compte"),
    IBAN: ("iban",),
    SSN: ("ssn", "social security"),
}
CUE_GAP = frozenset(" :#.=\t")
NUMBER_WORDS = ("number", "no", "nr", "num")


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        v = int(d) * (1 + place % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _run(text: str, at: int, chars: frozenset) -> int:
    """End of the run of ``chars`` that starts at ``at``."""
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def _email(text: str, at: int, done: int):
    start = at
    while start > done and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while text[end:end + 1] == ".":
        more = _run(text, end + 1, LABEL)
        if more == end + 1:
            break
        end, labels = more, labels + 1
    return (start, end) if labels > 1 else None


def _ip_chain(text: str, at: int) -> tuple[int, list[tuple[int, int]]]:
    """End of the chain of dotted numbers at ``at`` and its valid groups of four."""
    runs = [(at, _run(text, at, DIGITS))]
    while text[runs[-1][1]:runs[-1][1] + 1] == ".":
        start = runs[-1][1] + 1
        end = _run(text, start, DIGITS)
        if end == start:
            break
        runs.append((start, end))
    spans = []
    for k in range(0, len(runs) - 3, 4):
        four = runs[k:k + 4]
        # a part of many digits is at most 255 only behind zeros
        if all(len(part := text[s:e].lstrip("0")) < 4 and int(part or 0) <= 255 for s, e in four):
            spans.append((four[0][0], four[3][1]))
    return runs[-1][1], spans


def _digit_chain(text: str, at: int) -> int:
    """End of the digits from ``at``, each at most one space or hyphen after the last."""
    end = _run(text, at, DIGITS)
    while text[end:end + 1] in (" ", "-") and text[end + 1:end + 2] in DIGITS:
        end = _run(text, end + 1, DIGITS)
    return end


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _phone(text: str, at: int):
    """(end, digits) of the number behind the plus sign at ``at``."""
    if text[at + 1:at + 2] not in DIGITS:
        return None
    end = _run(text, at + 2, PHONE_INNER)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3:
        return None
    return end, len(_only_digits(text[at:end]))


def _after_cue(text: str, at: int) -> int:
    """Where the identifier behind a cue starts: gaps and one word for "number" go."""
    at = _run(text, at, CUE_GAP)
    for word in NUMBER_WORDS:
        end = at + len(word)
        if text[at:end].lower() == word and text[end:end + 1] not in LETTERS:
            return _run(text, end, CUE_GAP)
    return at


def _account(text: str, at: int):
    start = _after_cue(text, at)
    if text[start:start + 1] not in DIGITS:
        return None
    end = _digit_chain(text, start)
    if not 6 <= len(_only_digits(text[start:end])) <= 17 or text[end:end + 1] in LETTERS:
        return None
    return start, end


def _iban(text: str, at: int):
    start = at = _after_cue(text, at)
    symbols: list[str] = []
    end = start
    while at < len(text) and len(symbols) < 34:
        if text[at] in UPPER or text[at] in DIGITS:
            symbols.append(text[at])
            end = at + 1
        elif text[at] != " " or at != end or not symbols:
            break
        at += 1
    code = "".join(symbols)
    # the text may go on in capitals: take the longest valid prefix
    while len(code) >= 15:
        if code[0] in UPPER and code[1] in UPPER and code[2] in DIGITS and code[3] in DIGITS:
            if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
                return start, end
        code = code[:-1]
        end -= 1
        while text[end - 1] == " ":
            end -= 1
    return None


def _ssn(text: str, at: int):
    start = _after_cue(text, at)
    part = text[start:start + 11]
    if len(part) != 11 or part[3] != "-" or part[6] != "-" or text[start + 11:start + 12] in DIGITS:
        return None
    area, group, serial = part[:3], part[4:6], part[7:]
    if any(c not in DIGITS for c in area + group + serial):
        return None
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    return start, start + 11


def _userinfo(text: str, at: int):
    """name[:password] between a scheme and an at-sign with a host behind it."""
    end = at
    while end < len(text) and (text[end] in LOCAL or text[end] in ":!$&'()*,;=~"):
        end += 1
    if end == at or text[end:end + 1] != "@" or text[end + 1:end + 2] not in LABEL:
        return None
    return at, end


_CUE_PARSERS = {ACCOUNT: _account, IBAN: _iban, SSN: _ssn, USERINFO: _userinfo}


def automaton() -> ahocorasick.Automaton:
    """Anchors: pattern -> (kind, length); digits anchor ip and card."""
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", (EMAIL, 1))
    anchors.add_word("+", (PHONE, 1))
    for d in DIGITS:
        anchors.add_word(d, (IP, 1))
    anchors.add_word("://", (USERINFO, 3))
    for kind, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.upper(), cue.title()}:
                anchors.add_word(form, (kind, len(form)))
    anchors.make_automaton()
    return anchors


def find(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span, in that order."""
    spans: list[tuple[int, int, int]] = []
    done = [0] * len(KINDS)
    for last, (kind, length) in anchors.iter(text):
        if kind == IP:  # a digit: both kinds that are made of digits
            if last >= done[IP]:
                done[IP], found = _ip_chain(text, last)
                spans.extend((s, IP, e) for s, e in found)
            if last >= done[CARD]:
                end = done[CARD] = _digit_chain(text, last)
                digits = _only_digits(text[last:end]) if end - last >= 12 else ""
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    spans.append((last, CARD, end))
        elif kind == EMAIL:
            if last >= done[EMAIL] and (found := _email(text, last, done[EMAIL])):
                done[EMAIL] = found[1]
                spans.append((found[0], EMAIL, found[1]))
        elif kind == PHONE:
            if last >= done[PHONE] and (found := _phone(text, last)):
                done[PHONE], digits = found
                if 9 <= digits <= 15:
                    spans.append((last, PHONE, done[PHONE]))
        else:
            if kind != USERINFO and text[last - length:last - length + 1] in LETTERS and last >= length:
                continue  # the cue is the end of another word
            if last + 1 >= done[kind] and (found := _CUE_PARSERS[kind](text, last + 1)):
                done[kind] = found[1]
                spans.append((found[0], kind, found[1]))
    spans.sort()
    return spans


_SPANS = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = automaton()
    for batch in batches:
        texts = batch.column(1).to_pylist()
        spans = [find(t, anchors) if t else [] for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, type=_SPANS)], names=["doc_id", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans``: array of (s, k, e) in order, k an index into KINDS."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan_batches, "doc_id long, spans array<struct<s:int,k:int,e:int>>")


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``'s spans, and the counts of the added kinds."""
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["k"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["k"] < BASE_KINDS)
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS, len(KINDS))],
        F.size("spans").cast("long").alias("n_spans"),
    )
