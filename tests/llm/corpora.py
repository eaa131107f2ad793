"""Small corpora for the tests of the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# extra columns that clash with output and working names
CLASHING = {"score": "'x'", "kept": "1", "n_words": "'w'", "label": "2.5", "node": "cast(null as int)",
            "component_id": "'c'", "position": "'p'", "ids": "'i'", "held_out": "3", "tkey": "'t'", "__row": "1"}
SYLLABLES = "an ber chi do el fu gra hi jo ka lum mi no pri qua ro sta tu vo wex yl zan".split()


def word(k):
    """The k-th word: its number written in syllables."""
    out = ""
    while True:
        k, digit = divmod(k, len(SYLLABLES))
        out += SYLLABLES[digit]
        if not k:
            return out


def words(rnd, n, vocabulary=2000):
    return [word(rnd.randrange(vocabulary)) for _ in range(n)]


def text(rnd, n, per_line=20, vocabulary=2000):
    w = words(rnd, n, vocabulary)
    return "\n".join(" ".join(w[k:k + per_line]) for k in range(0, n, per_line))


def edited(rnd, original, n):
    w = original.split(" ")
    for _ in range(n):
        w[rnd.randrange(len(w))] = "".join(rnd.choice("abcdefghij") for _ in range(6))
    return " ".join(w)


def frame(spark, rows, clash=True):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], *(list(r[2:]) + ["en", "s0"][len(r) - 2:])[:2], len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.selectExpr("*", *[f"{v} as {c}" for c, v in CLASHING.items()]) if clash else df


def odd_rows(rnd):
    """NULLs in any column, empty and blank texts, repeated rows, a doc_id used twice, a
    long text, unusual characters."""
    same = text(rnd, 80)
    return [
        (1, None, "en", "s0"), (2, "", "en", "s0"), (3, " \t\n ", "en", "s0"),
        (4, same, "en", "s0"), (4, same, "en", "s0"), (5, same, None, None), (6, text(rnd, 70), None, "s1"),
        (6, text(rnd, 75), "de", "s1"), (None, text(rnd, 60), "en", "s1"), (None, None, None, None),
        (7, "é😀 ﬁ ①\x00 ñandú x" * 3, "es", "s1"), (8, text(rnd, 30000, vocabulary=5000), "en", "s0"),
        (9, "word", "en", "s0"), (10, "x" * 70000, "en", "s0"),
    ]
