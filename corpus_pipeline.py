"""Corpus pipeline: quality rules, line deduplication, near-duplicate removal, mixing
to target weights, tokenisation.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as
Parquet and read again as the next stage's documents.  All but the last return the
columns of their input.  The cases that need a rule (NULLs, empty and repeated rows,
empty tables, extra columns) are defined in the operators' modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import line_frequency, pfair, piece_arrays, segment_lines, setsketch
from leadlake.llm.common import batch_rows, read_table, written


RULES = line_frequency.LineRules(root_limit=True)
TEXT_ROWS = 1_000   # whole texts handed to Python at once; each is read in full
WEIGHTS = None      # of the mix, by source; None: the square root of its documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above a host's limit leave the texts of the others."""
    return line_frequency.clean_documents(docs, RULES)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every line but the first of its class leaves its document; confirmed copies of
    another document are left to the next stage."""
    with batch_rows(spark, TEXT_ROWS):
        return segment_lines.without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more) the
    document with the smallest doc_id stays."""
    with batch_rows(spark, TEXT_ROWS):
        return setsketch.without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: consecutive files are consecutive stretches."""
    return pfair.in_mixed_order(docs, WEIGHTS)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and round_trip of every document, and its block, slot
    and position in the mix: files read again have no order, so it is in the rows."""
    keyed = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("tkey"))
    # encoded once: the mix reads its input several times
    with batch_rows(spark, TEXT_ROWS):
        coded = written(piece_arrays.encode(keyed, ["doc_id", "source", "tkey"]), "tokens")
    placed = pfair.mix(coded.withColumnRenamed("tkey", "text"), WEIGHTS)  # the text settles ties only
    return placed.select("doc_id", "source", "n_tokens", "ids", "round_trip", "block", "slot", "position")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokenise", tokenise),
]

# Near-duplicate groups, edit distances and tokens are beyond SQL; tests/llm holds the
# pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
