"""Secret scans: known forms, and sliding-window Shannon entropy.

Native: DataFrame functions only.

Known forms (``assign``, ``access``, ``hex``) are the regular expressions of the
contract, leftmost and non-overlapping per kind, failing matches dropped.  Spark
has no function that returns match positions; ``split`` on the same expression
gives the text between the matches, and running lengths give every position.

Entropy (kind ``entropy``): candidate strings are maximal runs of the characters
of base64, ``_`` and ``-`` with at least ``window`` of them, a letter and a digit.
The character class of a candidate (hexadecimal, or base64) sets its alphabet and
its threshold.  A window of ``window`` characters slides over the candidate; the
counts of its characters are updated for the one that enters and the one that
leaves, and so is the sum of c*log2(c), from which the entropy
``log2(window) - sum / window`` follows.  The span runs from the first to the last
character of the windows at or above the threshold.  Allow-listed candidates give
nothing: UUIDs and candidates with a placeholder word.

Defined cases: NULL and empty texts have no spans; long texts are scanned whole;
every row is judged by itself, so repeated rows, NULLs in other columns and an
empty table need no rule.  Nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

_VALUE = r"([A-Za-z0-9+/_.=-]+)"
_ASSIGN_HEAD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN = _ASSIGN_HEAD + _VALUE
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
# equal to HEX and a length test: a match is a maximal run (lets the scan skip short runs)
HEX_LONG = "[0-9a-f]{24,}"


@dataclass(frozen=True)
class EntropyRules:
    window: int = 20
    hex_bits: float = 3.0
    base64_bits: float = 3.7
    allow: str = r"(?i)example|placeholder|changeme|dummy|redacted|lorem"
    uuid: str = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


HEX_ALPHABET = "0123456789abcdefABCDEF"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="


SPAN = "array<struct<s:int,e:int,t:string>>"
_BLOCK = 512


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(pieces: Column, at: Column) -> Column:
    """(at, out): spans of ``pieces`` (gap before, text) from offset ``at`` on."""
    return F.aggregate(
        pieces,
        F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["g"] + F.length(x["t"])).alias("at"),
            F.array_append(a["out"], F.struct(
                (a["at"] + x["g"]).alias("s"),
                (a["at"] + x["g"] + F.length(x["t"])).alias("e"),
                x["t"].alias("t"),
            )).alias("out"),
        ),
    )


def match_spans(text: Column, pattern: str) -> Column:
    """Array of (s, e, t): code point span and text of every match of ``pattern``,
    leftmost and non-overlapping; NULL when there is none.  Offsets run over blocks
    of matches, so texts with very many matches stay linear."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def placed(pieces: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(pieces, b * _BLOCK + 1, F.lit(_BLOCK)),
        )
        return F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
            lambda a, block: _let(_running(block, a["at"]), lambda r: F.struct(
                r["at"].alias("at"), F.array_append(a["out"], r["out"]).alias("out"))),
            lambda a: F.flatten(a["out"]),
        )

    pieces = _let(between, lambda gaps: F.zip_with(
        F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0))), found,
        lambda gap, t: F.struct(F.length(gap).alias("g"), t.alias("t")),
    ))
    return F.when(text.rlike(pattern), _let(pieces, placed))


def _spans(kind: str, matches: Column) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        F.coalesce(matches, F.array().cast(SPAN)),
        lambda m: F.struct(m["s"].alias("s"), F.lit(rank).alias("k"), m["e"].alias("e")),
    )


def _term(c: Column) -> Column:
    """c * log2(c) of a count, 0 for 0."""
    return F.when(c > 1, c * F.log2(F.greatest(c, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))


def hot_windows(candidate: Column, alphabet: str, window: int, bits: float) -> Column:
    """(first, last): starts of the first and last window of ``candidate`` whose
    entropy reaches ``bits``; first is -1 when none does."""
    codes = F.transform(
        F.filter(F.split(candidate, ""), lambda ch: ch != ""),
        lambda ch: F.instr(F.lit(alphabet), ch) - 1,
    )
    state = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0.0).alias("s"), F.lit(0).alias("i"),
        F.lit(-1).alias("first"), F.lit(-1).alias("last"),
    )

    def step(a: Column, code: Column, all_codes: Column) -> Column:
        i = a["i"]
        gone = F.when(i >= window, F.get(all_codes, i - window)).otherwise(F.lit(-1))
        # one character enters, one leaves: two counts and two terms change
        c_in = F.get(a["n"], code)
        added = _term(c_in + 1) - _term(c_in)
        c_out = F.get(a["n"], gone) + F.when(code == gone, F.lit(1)).otherwise(F.lit(0))
        taken = F.when(gone < 0, F.lit(0.0)).otherwise(_term(c_out) - _term(c_out - 1))
        total = a["s"] + added - taken
        counts = F.transform(
            a["n"],
            lambda c, k: c + F.when(k == code, F.lit(1)).otherwise(F.lit(0))
            - F.when(k == gone, F.lit(1)).otherwise(F.lit(0)),
        )
        hot = (i >= window - 1) & (F.log2(F.lit(float(window))) - total / window >= bits - 1e-9)
        start = i - (window - 1)
        return F.struct(
            counts.alias("n"), total.alias("s"), (i + 1).alias("i"),
            F.when((a["first"] < 0) & hot, start).otherwise(a["first"]).alias("first"),
            F.when(hot, start).otherwise(a["last"]).alias("last"),
        )

    return _let(codes, lambda known: F.aggregate(
        known, state, lambda a, c: step(a, c, known),
        lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")),
    ))


def entropy_spans(text: Column, rules: EntropyRules = EntropyRules()) -> Column:
    """Array of (s, e, t) of the high-entropy stretches of ``text``."""
    runs = match_spans(text, r"[A-Za-z0-9+/_=-]{%d,}+" % rules.window)
    candidates = F.filter(
        F.coalesce(runs, F.array().cast(SPAN)),
        lambda m: m["t"].rlike("[0-9]") & m["t"].rlike("[A-Za-z]")
        & ~m["t"].rlike(rules.allow) & ~m["t"].rlike(rules.uuid),
    )
    measured = F.transform(candidates, lambda m: F.struct(
        m.alias("m"),
        F.when(m["t"].rlike("^[0-9a-fA-F]+$"), hot_windows(m["t"], HEX_ALPHABET, rules.window, rules.hex_bits))
        .otherwise(hot_windows(m["t"], BASE64_ALPHABET, rules.window, rules.base64_bits)).alias("hot"),
    ))
    return F.transform(
        F.filter(measured, lambda x: x["hot"]["first"] >= 0),
        lambda x: F.struct(
            (x["m"]["s"] + x["hot"]["first"]).alias("s"),
            (x["m"]["s"] + x["hot"]["last"] + rules.window).alias("e"),
            x["m"]["t"].alias("t"),
        ),
    )


def _listed(spans: Column) -> Column:
    """kind:start:end, by start and then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(docs: DataFrame, rules: EntropyRules = EntropyRules()) -> DataFrame:
    """One row per document: doc_id and the spans of each kind (arrays of start,
    end and matched text, code points, end exclusive)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        "doc_id",
        F.when(text.rlike(ASSIGN), F.filter(
            match_spans(text, ASSIGN),
            lambda m: F.length(F.regexp_extract(m["t"], ASSIGN, 1)) >= 6)).alias("assign"),
        F.filter(match_spans(text, ACCESS), lambda m: m["e"] - m["s"] >= 20).alias("access"),
        match_spans(text, HEX_LONG).alias("hex"),
        entropy_spans(text, rules).alias("entropy"),
    )
    none = F.array().cast(SPAN)
    return base.select("doc_id", *[F.coalesce(k, none).alias(k) for k in KINDS])


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan``'s spans."""
    sets = found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.concat(*[_spans(k, F.col(k)) for k in KINDS[:3]]).alias("__base"),
        _spans("entropy", F.col("entropy")).alias("__more"),
    )
    return sets.select(
        "doc_id", *[f"n_{k}" for k in KINDS],
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
        _listed(F.concat("__base", "__more")).alias("spans"),
    )
