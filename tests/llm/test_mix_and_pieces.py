"""op4 (Pfair mixing) and op9 (SentencePiece by suffix arrays)."""

import os
import random
from collections import Counter

import pytest
import sentencepiece
from corpora import frame, odd_rows, text

from leadlake.llm import pfair, piece_arrays
from leadlake.llm.common import batch_rows, written


def test_schedule_meets_every_window_and_deviates_by_less_than_a_block():
    rnd = random.Random(20)
    for n in (1, 2, 7, 40):
        weights = {f"s{k}": rnd.random() ** 3 + 0.001 for k in range(n)}
        period = 1024
        numerators = pfair.shares(weights, period)
        assert sum(numerators.values()) == period and min(numerators.values()) >= 1
        slots = pfair.schedule(numerators, period)
        assert [s[4] for s in slots] == list(range(period))
        assert all(release <= slot < deadline for _, _, release, deadline, slot in slots)
        given = Counter()
        for name, block, _, _, slot in slots:
            assert block == given[name]
            given[name] += 1
            assert all(abs(given[s] - numerators[s] * (slot + 1) / period) < 1 for s in numerators)


def test_shares_follow_the_weights():
    got = pfair.shares({"a": 0.5, "b": 0.3, "c": 0.2, None: 1e-9}, 1000)
    assert got[None] == 1 and all(abs(got[s] - w * 1000) <= 2 for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.2)))
    with pytest.raises(ValueError):
        pfair.shares({k: 1 for k in range(5)}, 4)


SMALL = pfair.Mix(block_docs=2, period=64, chunk_docs=8)


def _sources(rnd):
    return [(k, f"text {k}", "en", "big" if k % 3 else f"s{k % 4}") for k in range(150)] + [(500, "x", "en", None)]


def test_mix_starts_no_python_on_executors(spark):
    """Its two small tables come as Arrow: lists of rows were encoded by Python processes, which
    then kept their memory.  Sources of other types are placed by their text."""
    rows = _sources(random.Random(21))
    plan = pfair.mix(written(frame(spark, rows), "docs"), mix=SMALL)._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan
    numbers = frame(spark, rows).selectExpr("doc_id", "text", "doc_id % 3 as source")
    flags = frame(spark, rows).selectExpr("doc_id", "text", "doc_id % 3 = 0 as source")
    assert pfair.mix(numbers, mix=SMALL).count() == pfair.mix(flags, mix=SMALL).count() == len(rows)


def test_mix_places_every_document_once_in_its_window(spark):
    rnd = random.Random(21)
    rows = _sources(rnd) + odd_rows(rnd)
    got = pfair.mix(frame(spark, rows), mix=SMALL).collect()
    assert len(got) == len(rows) and len({r.position for r in got}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in got)
    for source in {r.source for r in got}:
        mine = sorted((r.block, r.slot, r.position) for r in got if r.source == source)
        assert [b for b, *_ in mine] == [k // SMALL.block_docs for k in range(len(mine))]   # full blocks, in order
        assert [p for *_, p in mine] == sorted(p for *_, p in mine)
    again = pfair.mix(frame(spark, rows).repartition(5), mix=SMALL).collect()
    assert {(r.doc_id, r.source, r.position) for r in got if r.doc_id and r.doc_id > 10} == \
        {(r.doc_id, r.source, r.position) for r in again if r.doc_id and r.doc_id > 10}


def test_given_weights_rule_the_prefixes(spark):
    rows = [(k, "t", "en", "ab"[k % 2]) for k in range(400)]
    got = sorted(pfair.mix(frame(spark, rows), {"a": 0.75, "b": 0.25}, SMALL).collect(), key=lambda r: r.position)
    for n in (16, 40, 120, 200):
        share = sum(r.source == "a" for r in got[:n]) / n
        assert abs(share - 0.75) <= 2 * SMALL.block_docs / n
    with pytest.raises(KeyError):
        pfair.mix(frame(spark, rows), {"a": 1.0}, SMALL)


def test_mixed_order_keeps_rows_and_columns(spark, tmp_path):
    rnd = random.Random(22)
    docs = frame(spark, _sources(rnd) + odd_rows(rnd))
    out = pfair.in_mixed_order(docs, settings=SMALL)
    assert out.columns == docs.columns
    assert Counter(map(str, out.collect())) == Counter(map(str, docs.collect()))
    order = [(r.doc_id, r.source) for r in out.collect()]              # partitions in order
    placed = sorted(pfair.mix(docs.select("doc_id", "source", "text"), mix=SMALL).collect(), key=lambda r: r.position)
    assert [x[1] for x in order] == [r.source for r in placed]
    assert pfair.in_mixed_order(docs.limit(0)).count() == 0
    assert pfair.mix(docs.limit(0)).count() == 0


# ---- pieces ------------------------------------------------------------------------
pytestmark = pytest.mark.skipif(not os.path.exists(piece_arrays.MODEL), reason="tokenizer files not present")


@pytest.fixture(scope="module")
def model():
    return piece_arrays.Model()


def test_encoding_equals_the_library(model):
    rnd = random.Random(23)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_arrays.MODEL)
    pieces = [p.replace(piece_arrays.ESCAPE, " ") for p in model.id_of]
    texts = [None, "", " ", "a", "  a   b", "\n\n\t", "日本語 ñ 😀 ①②", "▁x ▁", "    " * 9, "-" * 70,
             "=" * 33 + " " + "*" * 17, "a" * 500, "<s>a</s> <0x0A>", "x" * 20000]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(1500)]
    texts += ["".join(rnd.choice("abcdeth in ér\n 1①  -=") for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    got = [x for part in piece_arrays.Encoder(model).encode(texts) for x in part]
    assert len(got) == len(texts)
    for t, ids in zip(texts, got):
        assert ids.tolist() == library.encode(t or ""), t
        assert piece_arrays.decode_tokens(ids, model.piece_bytes) == library.decode(library.encode(t or ""))


def test_small_groups_and_forgetting_change_nothing(model, monkeypatch):
    rnd = random.Random(24)
    texts = [text(rnd, 60) for _ in range(30)]
    whole = [x.tolist() for part in piece_arrays.Encoder(model).encode(texts) for x in part]
    monkeypatch.setattr(piece_arrays, "GROUP_CHARS", 40)
    monkeypatch.setattr(piece_arrays, "REMEMBERED", 5)
    monkeypatch.setattr(piece_arrays, "CACHE_BITS", 4)
    assert [x.tolist() for part in piece_arrays.Encoder(model).encode(texts) for x in part] == whole


def test_round_trip_of_odd_rows(spark):
    rnd = random.Random(25)
    rows = odd_rows(rnd) + [(50, "under ▁ score")]
    docs = frame(spark, rows)
    coded = piece_arrays.encode(docs, ["doc_id", "text"])
    got = coded.collect()
    assert len(got) == len(rows) and all(r.n_tokens == len(r.ids) for r in got)
    assert all(r.round_trip == (r.doc_id != 50) for r in got)
    assert [(r.n_tokens, r.ids) for r in got if r.doc_id in (1, 2)] == [(0, [])] * 2
    back = piece_arrays.decode(coded.withColumnRenamed("text", "was"), ["doc_id", "was"]).collect()
    assert all(r.text == (r.was or "") for r in back if r.doc_id != 50)
    assert piece_arrays.encode(docs.limit(0), ["doc_id"]).count() == 0


def test_tokens_do_not_depend_on_batches(spark):
    texts = ["one two  three", "", None, "two three " * 50, "é ü 漢字 " * 9, "one two  three"] * 20
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    whole = {r.doc_id: r.ids for r in piece_arrays.encode(docs, ["doc_id"]).collect()}
    with batch_rows(spark, 7):
        assert spark.conf.get(setting) == "7"
        small = {r.doc_id: r.ids for r in piece_arrays.encode(docs, ["doc_id"]).collect()}
    assert small == whole and spark.conf.get(setting) == before


def test_encoder_remembers_between_calls(monkeypatch):
    monkeypatch.setattr(piece_arrays, "REMEMBERED", 3)
    monkeypatch.setattr(piece_arrays, "TEXT_STRETCHES", 2)
    encoder, once = (piece_arrays.Encoder(piece_arrays.Model()) for _ in range(2))
    texts = ["a b c d e", "c d", "e f g a", "a b c d e", "", None, "z"]
    every = [t.tolist() for part in once.encode(texts) for t in part]
    apart = [t.tolist() for text in texts for part in encoder.encode([text]) for t in part]
    assert apart == every
