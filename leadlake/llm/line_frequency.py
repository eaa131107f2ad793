"""Quality rules: word statistics of a document and cross-document line frequency.

Native: DataFrame functions only.

Line frequency
--------------
Lines are normalised (lower case, white space runs to one space, trimmed) and
hashed.  For every host and line hash the distinct documents holding the line are
counted; *distinct* means different texts, so that exact copies (which a later
deduplication settles) do not make the lines of a good document look like
boilerplate.  A line is above the limit on a host when more than
``max(min_docs, max_share * distinct documents of the host)`` documents hold it; with
``root_limit``, more than ``max(min_docs, square root of the distinct documents)``, so that
a hot host's boilerplate is found as well (the pipeline's rule; op5's SQL has the share).
Such a line is removed from every document but the one with the host's smallest
doc_id among its holders.  A document that loses more than ``max_removed`` of the
characters of its lines is depleted and rejected.

Size and skew
-------------
* A host has at most (lines of its documents) / (max_share * its documents) lines
  above the limit, i.e. mean lines per document / max_share, whatever its size; with
  ``root_limit``, mean lines per document * square root of its documents.
* Counting is a two-step aggregation (distinct first) with map-side partials, so
  neither a host with a third of all rows nor one line in every document meets in
  one task.  Only hashes and lengths are shuffled, never text.
* The join with the lines above the limit is an inner equi-join, which AQE may
  broadcast or split.

Defined cases: NULL text counts as ''; NULL host is a host of its own; NULL doc_id
is never the smallest unless all are NULL (then every holder keeps the line);
repeated rows get the same verdict; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import NON_WORD_BREAK, WORD_BREAK, words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 3


@dataclass(frozen=True)
class LineRules:
    min_words: int = 50            # base rule: fewer words fail
    max_repeat_percent: int = 50   # base rule: more words in repeated windows fail
    min_docs: int = 20             # a line in at most so many documents of a host is fine
    max_share: float = 0.05        # ... or in at most this share of them
    max_removed: float = 0.7       # share of line characters a document may lose
    root_limit: bool = False       # the square root of a host's documents instead of the share


def _windows(word_array: Column) -> Column:
    """64-bit hash of every window of three consecutive words, in text order."""
    return F.transform(
        F.slice(word_array, 1, F.greatest(F.size(word_array) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(word_array, i + 1), F.get(word_array, i + 2)),
    )


def _repeated_starts(placed: Column) -> Column:
    """Sorted starts of the windows found at least twice; ``placed`` is the array
    of (hash, start) in hash order, so equal windows are neighbours."""
    def same(k: Column, h: Column) -> Column:
        return F.coalesce(F.get(placed, k)["h"] == h, F.lit(False))

    repeated = F.filter(placed, lambda x, k: same(k - 1, x["h"]) | same(k + 1, x["h"]))
    return F.sort_array(F.transform(repeated, lambda x: x["i"]))


def word_statistics(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``carry`` columns plus n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words of ``text`` (see the contract of the query), within the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select(
        *carry,
        words(F.col("text")).alias("__words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(NON_WORD_BREAK)).alias("__lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    out = out.select(
        *carry,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("__words")).alias("__windows"),
    )
    # most texts repeat no window; only the others pay for the ordering
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__placed", F.when(repeats, placed)).drop("__windows")
    out = out.withColumn("__starts", _repeated_starts(F.col("__placed"))).drop("__placed")
    # the union of windows of three: each start adds the words up to the next start
    starts = F.col("__starts")
    covered = F.aggregate(
        F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x,
    )
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__starts")


def _normalised(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(line), WORD_BREAK, " "))


def line_hashes(text: Column) -> Column:
    """Array of (h, n): hash and length of every normalised line with a word."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(NON_WORD_BREAK))
    return F.transform(
        F.transform(lines, _normalised),
        lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n")),
    )


def lines_above_limit(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """(__host, __h, __first): the lines above the limit of each host and the
    smallest doc_id among their holders."""
    held = docs.select(
        F.col("doc_id").alias("__id"),
        F.col("source").alias("__host"),
        F.xxhash64("text").alias("__content"),
        F.explode(F.array_distinct(F.transform(line_hashes(F.col("text")), lambda x: x["h"]))).alias("__h"),
    )
    counted = held.groupBy("__host", "__h").agg(
        F.count_distinct("__content").alias("__n"), F.min("__id").alias("__first")
    ).where(F.col("__n") > rules.min_docs)
    hosts = docs.groupBy(F.col("source").alias("__host")).agg(
        F.count_distinct(F.xxhash64("text")).alias("__docs")
    ).where(F.col("__docs") > rules.min_docs)
    hosts = hosts.withColumnRenamed("__host", "__of")
    limit = F.sqrt("__docs") if rules.root_limit else rules.max_share * F.col("__docs")
    return counted.join(hosts, F.col("__host").eqNullSafe(F.col("__of"))).where(
        F.col("__n") > limit
    ).select("__host", "__h", "__first")


KEY = ("__id", "__host", "__content")


def _keyed(docs: DataFrame, columns: Sequence["str | Column"]) -> DataFrame:
    """Rows under their key: rows with equal keys have equal texts."""
    return docs.select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__host"),
        F.xxhash64("text").alias("__content"), *columns,
    )


def removed_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Key columns and ``__removed``: the hashes of the lines to remove from the
    documents with that key (only documents that lose a line have a row)."""
    held = _keyed(docs, [F.explode(F.array_distinct(
        F.transform(line_hashes(F.col("text")), lambda x: x["h"]))).alias("__h")])
    limit = lines_above_limit(docs, rules).select(
        F.col("__host").alias("__lhost"), F.col("__h").alias("__lh"), "__first")
    hit = held.join(
        limit, (F.col("__h") == F.col("__lh")) & F.col("__host").eqNullSafe(F.col("__lhost"))
    ).where(~F.col("__id").eqNullSafe(F.col("__first")))
    # a set per document: at most its distinct lines
    return hit.groupBy(*KEY).agg(F.collect_set("__h").alias("__removed"))


def _with_removed(keyed: DataFrame, removed: DataFrame) -> DataFrame:
    other = removed.select(*[F.col(k).alias(f"{k}_r") for k in KEY], "__removed")
    on = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in KEY]
    return keyed.join(other, on, "left").drop(*[f"{k}_r" for k in KEY])


def _verdict(out: DataFrame, rules: LineRules) -> DataFrame:
    """Adds base_failed, line_chars, removed_chars and kept."""
    def chars(lines: Column) -> Column:
        return F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + x["n"])

    gone = F.filter("__line_hashes", lambda x: F.array_contains("__removed", x["h"]))
    out = out.withColumns({
        "line_chars": chars(F.col("__line_hashes")),
        "removed_chars": F.when(F.col("__removed").isNull(), F.lit(0).cast("long")).otherwise(chars(gone)),
        "base_failed": (F.col("n_words") < rules.min_words)
        | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
    })
    # one comparison that needs both sides of the join: a filter on ``kept`` stays above
    # it, where the statistics are columns and are not computed again
    may_lose = F.when(F.col("base_failed"), F.lit(-1.0)).otherwise(rules.max_removed * F.col("line_chars"))
    return out.withColumn("kept", F.col("removed_chars") <= may_lose)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_quality(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: doc_id, the word statistics, line_chars,
    removed_chars, base_failed and kept.  No text is shuffled."""
    keyed = _keyed(docs, ["text"]).withColumn("__line_hashes", line_hashes(F.col("text")))
    stats = word_statistics(keyed, [*KEY, "__line_hashes"])
    out = _verdict(_with_removed(stats, removed_lines(docs, rules)), rules)
    return out.select(F.col("__id").alias("doc_id"), *MEASURES, "line_chars", "removed_chars",
                      "base_failed", "kept")


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents, without the lines above the limit (``n_chars``, where
    there is one, follows the text).  Same columns as ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    keyed = _keyed(docs, [row, "text"]).withColumn("__line_hashes", line_hashes(F.col("text")))
    stats = word_statistics(keyed, [*KEY, "__row", "__line_hashes"])
    kept = _verdict(_with_removed(stats, removed_lines(docs, rules)), rules).where("kept")
    text = F.col("__row")["text"]
    lines = F.filter(
        F.split(text, "\n", -1),
        lambda x: ~(x.rlike(NON_WORD_BREAK) & F.array_contains("__removed", F.xxhash64(_normalised(x)))),
    )
    cleaned = F.when(F.col("__removed").isNull(), text).otherwise(F.array_join(lines, "\n"))
    kept = kept.withColumn("__text", cleaned)
    new = {"text": F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return kept.select(*[new.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])
