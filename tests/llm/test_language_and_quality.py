"""op1 (language ID) and op10 (quality classifier)."""

import random
import zlib

import numpy as np
import pytest
from corpora import frame, odd_rows, text
from pyspark.sql import functions as F

from leadlake.llm import byte_cnn, hyperdimensional
from leadlake.llm.common import held_out

ALPHABETS = {"aa": "abcdefghij", "bb": "hijklmnopq", "cc": "nopqrstuvwxyzé"}


def _language(rnd, lang, n):
    return " ".join("".join(rnd.choice(ALPHABETS[lang]) for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_held_out_is_the_crc_rule(spark):
    got = {r.i: r.h for r in spark.range(50).select(F.col("id").alias("i"), held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}
    assert spark.range(1).select(held_out(F.lit(None).cast("long")).alias("h")).collect()[0].h is False


def test_trigram_bundles_equal_their_definition():
    e = hyperdimensional.Encoder(dim=64)
    texts = ["Ab c", "", "12 !?", "zz--zz é", "a" * 50]
    got = e.bundles(texts)

    def vector(ch):
        return e.vectors[e.code_of[ord(ch)]] if ch != "_" else e.vectors[0]

    for t, g in zip(texts, got):
        runs = "".join(c if c.isalpha() else " " for c in t.lower()).split()
        coded = "_" + "_".join(runs) + "_" if runs else ""
        want = np.zeros(64)
        for k in range(len(coded) - 2):
            a, b, c = (vector(x) for x in coded[k:k + 3])
            want += np.roll(a, 2) * np.roll(b, 1) * c
        assert np.array_equal(g, want), t


def test_blocks_of_trigrams_do_not_change_a_bundle(monkeypatch):
    rnd = random.Random(1)
    texts = ["".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(400)) for _ in range(3)] + ["abc def"]
    whole = hyperdimensional.Encoder(dim=32).bundles(texts)
    monkeypatch.setattr(hyperdimensional, "BLOCK", 37)
    assert np.array_equal(whole, hyperdimensional.Encoder(dim=32).bundles(texts))


def test_languages_are_told_apart_and_odd_rows_have_results(spark):
    rnd = random.Random(2)
    rows = [(100 + k, _language(rnd, lang, 30), lang, "s") for k, lang in enumerate(list(ALPHABETS) * 30)]
    docs = frame(spark, rows + odd_rows(rnd)).withColumn("held_out", held_out(F.col("doc_id")))
    prototypes = hyperdimensional.learn(docs.where(~F.col("held_out")))
    assert {"aa", "bb", "cc"} <= set(prototypes)
    got = hyperdimensional.predict(docs, prototypes, ["doc_id", "held_out", "lang"]).collect()
    assert len(got) == len(rows) + len(odd_rows(rnd))
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == r.lang for r in got if r.doc_id and r.doc_id >= 100)
    unknown = [r for r in got if r.doc_id in (1, 2, 3)]
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}
    twice = [(r.lang_pred, r.score) for r in got if r.doc_id == 4]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_prototypes_do_not_depend_on_the_partitioning(spark):
    rnd = random.Random(3)
    docs = frame(spark, [(k, _language(rnd, "aa", 20), "aa") for k in range(40)])
    one, many = (hyperdimensional.learn(docs.repartition(n)) for n in (1, 7))
    assert np.array_equal(one["aa"], many["aa"])


def test_nothing_to_learn_gives_und(spark):
    docs = frame(spark, [(1, "abc", None), (2, "abc", "")])
    assert hyperdimensional.learn(docs) == {} == hyperdimensional.learn(docs.limit(0))
    got = hyperdimensional.predict(docs, {}, ["doc_id"]).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2


# ---- classifier --------------------------------------------------------------------
def _brute_features(net, t):
    padded = np.frombuffer(t + bytes(byte_cnn.KERNEL - 1), dtype=np.uint8)
    response = np.array([sum(net.tables[k][padded[i + k]] for k in range(byte_cnn.KERNEL)) for i in range(len(t))])
    halves = [response[i:i + byte_cnn.HALF].max(axis=0) for i in range(0, len(t), byte_cnn.HALF)]
    chunks = [np.maximum(0, np.maximum(a, b)) for a, b in zip(halves, halves[1:])] or [np.maximum(0, halves[0])]
    return np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])


def test_features_equal_a_plain_convolution(monkeypatch):
    rng = np.random.default_rng(1)
    net = byte_cnn.Network(rng.normal(size=(byte_cnn.KERNEL, 256, byte_cnn.FILTERS)).astype(np.float32),
                           rng.normal(size=2 * byte_cnn.FILTERS), 0.1)
    texts = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (1, 5, 127, 128, 129, 256, 257, 1000)]
    want = np.array([_brute_features(net, t) for t in texts])
    for size in (1 << 17, 256):                       # also in slices smaller than a text
        monkeypatch.setattr(byte_cnn, "SLICE", size)
        got = net.features([b"", *texts[:3], b"", *texts[3:]])
        assert np.abs(np.delete(got, [0, 4], axis=0) - want).max() < 1e-4
        assert not got[[0, 4]].any()


def _quality_rows(rnd, n):
    out, labels = [], []
    for k in range(n):
        good = k % 3 != 0
        t = text(rnd, rnd.randint(30, 120))
        out.append((1000 + k, t if good else t.upper().replace(" ", "!! "), "en", "s"))
        labels.append((1000 + k, int(good)))
    return out, labels


def test_held_out_quality_and_odd_rows(spark):
    rnd = random.Random(4)
    rows, labels = _quality_rows(rnd, 240)
    docs = frame(spark, rows + odd_rows(rnd)).withColumn("held_out", held_out(F.col("doc_id")))
    marks = spark.createDataFrame(labels + [(None, 1), (1000, 1), (5, None), (999999, 0)], "doc_id long, quality int")
    fit = byte_cnn.Fit(per_class=80, epochs=25)
    net = byte_cnn.learn(docs.where(~F.col("held_out")), marks.where(~held_out(F.col("doc_id"))), fit=fit)
    got = byte_cnn.score(docs, net, ["doc_id", "held_out"]).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(labels)
    checked = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert len(checked) > 50 and np.mean(checked) > 0.95
    again = byte_cnn.learn(docs.where(~F.col("held_out")), marks.where(~held_out(F.col("doc_id"))), fit=fit)
    assert np.array_equal(again.tables, net.tables)      # the sample and the fit are deterministic


def test_training_reads_whole_texts_in_slices(monkeypatch):
    """What marks a class stands once, far behind the start of a long text."""
    rnd = random.Random(5)
    texts = [text(rnd, 1500).encode() for _ in range(60)]
    marks = np.array([k % 2 for k in range(60)], dtype=np.float64)
    texts = [t[:-300] + b" ZZZZZZZZZZ " + t[-288:] if m else t for t, m in zip(texts, marks)]
    fit = byte_cnn.Fit(epochs=30, batch=8)
    whole = byte_cnn.train(texts, marks, fit)
    assert min(len(t) for t in texts) > 40 * byte_cnn.HALF
    assert np.mean((whole.score(texts) >= 0.5) == marks) > 0.95
    short = byte_cnn.Fit(epochs=2, batch=8)
    one = byte_cnn.train(texts[:16], marks[:16], short)
    monkeypatch.setattr(byte_cnn, "ROWS", 7)
    many = byte_cnn.train(texts[:16], marks[:16], short)
    assert np.allclose(one.tables, many.tables, atol=1e-5) and np.allclose(one.weights, many.weights, atol=1e-5)


def test_a_repeated_id_brings_one_text_to_the_sample(spark, monkeypatch):
    rows = [(k, f"text {k}") for k in range(10)] + [(3, f"text 3 {k}") for k in range(500)]
    marks = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, quality int")
    seen = []
    train = byte_cnn.train
    monkeypatch.setattr(byte_cnn, "train", lambda texts, *rest: (seen.extend(texts), train(texts, *rest))[1])
    byte_cnn.learn(frame(spark, rows), marks, fit=byte_cnn.Fit(epochs=1))
    assert sorted(seen) == [f"text {k}".encode() for k in range(10)]


def test_without_two_classes_the_score_is_the_share(spark):
    docs = frame(spark, [(1, "a"), (2, None)])
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert byte_cnn.learn(docs, ones) == 1.0
    assert byte_cnn.learn(docs, ones.limit(0)) == 0.5
    got = byte_cnn.score(docs, 0.5, ["doc_id"]).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1)] * 2
    assert byte_cnn.score(docs.limit(0), 0.5, ["doc_id"]).count() == 0


@pytest.mark.parametrize("module", [hyperdimensional, byte_cnn])
def test_docstrings_define_the_cases(module):
    assert "Defined cases" in module.__doc__
