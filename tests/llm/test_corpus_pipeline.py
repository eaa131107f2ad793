"""The pipeline against a brute-force version, and the registered queries."""

import random
import re
from collections import Counter

import brute
import pytest
import sentencepiece
from corpora import CLASHING, SCHEMA, edited, frame, odd_rows, text

import __spark_entry__ as entry
import corpus_pipeline
from leadlake.llm import line_frequency, piece_arrays, segment_lines
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


def _corpus(rnd):
    shared = text(rnd, 15, per_line=99)
    rows = []
    for k in range(45):
        t = text(rnd, rnd.randint(60, 150))
        if k % 4 == 0:
            t = f"{shared}\n{t}"
        if k % 9 == 0:
            t = t + "\n" + t.split("\n")[0] + "x"
        rows.append((100 + k, t, "en", f"s{k % 3}"))
    for k in range(12):
        rows.append((200 + k, rows[k][1] if k % 2 else edited(rnd, rows[k][1], 2), "en", "s0"))
    return rows + [(300, text(rnd, 10), "en", "s1"), (301, "word " * 300, "en", "s1")]


def _stages(rows):
    """doc_id -> text after each of the first three stages."""
    cleaned = [(r, t) for r, (_, _, kept, t) in zip(
        rows, brute.line_rules([(r[0], r[1], r[3]) for r in rows], line_frequency.LineRules())) if kept]
    first = {r[0]: t for r, t in cleaned}
    join = segment_lines.LineJoin()
    found = brute.duplicate_lines(list(first.items()), join.min_chars, join.edits)
    second = {}
    for i, t in first.items():
        dropped = set(found.get((i, t), ([], 0))[0])
        lines = t.split("\n")
        lost = sum(len(lines[n]) for n in dropped)
        second[i] = t if lost > 0.5 * len(t) else "\n".join(x for n, x in enumerate(lines) if n not in dropped)
    third = {i: second[i] for i, _, c in brute.near(list(second.items()), 5) if i == c}
    return first, second, third


def test_pipeline_equals_the_brute_force_version(spark, tmp_path):
    rnd = random.Random(30)
    rows = _corpus(rnd)
    frame(spark, rows, clash=False).write.parquet(str(tmp_path / "documents.parquet"))
    first, second, third = _stages(rows)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), want in zip(corpus_pipeline.STAGES, (first, second, third, third)):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert Counter((r.doc_id, r.text, r.n_chars) for r in docs.collect()) == Counter(
            (i, t, len(t)) for i, t in want.items()), name
    assert len(first) < len(rows) and second != first and len(third) < len(second)
    library = sentencepiece.SentencePieceProcessor(model_file=piece_arrays.MODEL)
    source = {r[0]: r[3] for r in rows}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.source, tuple(r.ids), r.round_trip) for r in got) == Counter(
        (i, source[i], tuple(library.encode(t)), True) for i, t in third.items())


def test_boilerplate_of_a_large_host_goes(spark, tmp_path):
    """30 of 700 texts hold the line: less than 5 %, more than the square root."""
    rnd = random.Random(34)
    line = "a line that many texts of this host have"
    rows = [(k, (f"{line}\n" if k < 30 else "") + text(rnd, 60), "en", "hot") for k in range(700)]
    got = {r.doc_id: r.text for r in corpus_pipeline.quality_rules(spark, frame(spark, rows), str(tmp_path)).collect()}
    assert got == {i: t if i == 0 else t.removeprefix(f"{line}\n") for i, t, *_ in rows}


def test_prefixes_of_the_result_follow_the_weights(spark, tmp_path, monkeypatch):
    rnd = random.Random(33)
    rows = [(k, text(rnd, 12), "en", "ab"[k % 2]) for k in range(240)] + [(7, text(rnd, 12), "en", "b")]
    docs = frame(spark, rows)
    for weights in ({"a": 0.75, "b": 0.25}, {"a": 0.2, "b": 0.8}):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        got = sorted(corpus_pipeline.tokenise(spark, docs, str(tmp_path)).collect(), key=lambda r: r.position)
        assert len(got) == len(rows) and len({r.position for r in got}) == len(rows)
        for n in (48, 80, 128):
            share = sum(r.source == "a" for r in got[:n]) / n
            assert abs(share - weights["a"]) <= 2 * 16 / n
    again = corpus_pipeline.tokenise(spark, docs.repartition(5), str(tmp_path)).collect()
    assert {(r.position, tuple(r.ids)) for r in again} == {(r.position, tuple(r.ids)) for r in got}


def test_every_stage_takes_odd_rows_and_empty_tables(spark, tmp_path):
    odd = frame(spark, odd_rows(random.Random(31)))
    empty = spark.createDataFrame([], SCHEMA).selectExpr("*", *[f"{v} as {c}" for c, v in CLASHING.items()])
    for name, stage in corpus_pipeline.STAGES:
        for kind, docs in (("odd", odd), ("empty", empty)):
            out = stage(spark, docs, str(tmp_path))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{name}-{kind}"))
        assert out.count() == 0


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_|pipeline", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", ["op4_pfair", "op5_line_frequency", "op6_entropy_secrets", "op7_setsketch"])
def test_query_matches_its_sql(spark, name):
    ok, message = compare(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name])
    assert ok, message
