"""The operators bound to the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm import (
    anchor_pii,
    byte_cnn,
    entropy_scan,
    hat_trie,
    hyperdimensional,
    imatch,
    line_frequency,
    pfair,
    piece_arrays,
    prefix_trie,
    segment_lines,
    setsketch,
    warc,
)
from leadlake.llm.common import held_out, read_table


def op1_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    prototypes = hyperdimensional.learn(docs.where(~F.col("held_out")))
    return hyperdimensional.predict(docs, prototypes, ["doc_id", "held_out"])


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return imatch.compare_edited(docs, imatch.lexicon(docs))


def op3_anchor_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_pii.digest(anchor_pii.scan(read_table(spark, sf_dir, "documents")))


def op4_pfair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mix(docs)


def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.line_quality(read_table(spark, sf_dir, "documents"))


def op6_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_scan.digest(entropy_scan.scan(read_table(spark, sf_dir, "documents")))


def op7_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return setsketch.near_duplicates(docs, setsketch.Near(shingle_words=2))


def op8_segment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_lines.deduplicate(read_table(spark, sf_dir, "documents"))


def op9_piece_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_arrays.encode(read_table(spark, sf_dir, "documents"), ["doc_id"])


def op10_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    labels = read_table(spark, sf_dir, "labels")
    network = byte_cnn.learn(docs.where(~F.col("held_out")), labels.where(~held_out(F.col("doc_id"))))
    return byte_cnn.score(docs, network, ["doc_id", "held_out"])


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read_table(spark, sf_dir, "pages"))


def op12_hat_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hat_trie.collocations(read_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_hyperdimensional,
    op2_imatch,
    op3_anchor_pii,
    op4_pfair,
    op5_line_frequency,
    op6_entropy_secrets,
    op7_setsketch,
    op8_segment_lines,
    op9_piece_arrays,
    op10_byte_cnn,
    op11_warc,
    op12_hat_trie,
    op13_prefix_trie,
)}
