"""op5 (quality rules), op7 (near duplicates) and op8 (line deduplication)."""

import os
import random
from collections import Counter

import brute
import numpy as np
import pytest
from corpora import edited, frame, odd_rows, text

from leadlake.llm import line_frequency, links, segment_lines, setsketch
from leadlake.session import scratch_dir


# ---- quality rules -----------------------------------------------------------------
RULES = line_frequency.LineRules(min_words=8, min_docs=3, max_share=0.2, max_removed=0.6)


def _hosted(rnd):
    rows = odd_rows(rnd)
    for k in range(40):
        host = "h0" if k % 3 else "h1"
        lines = [text(rnd, rnd.randint(15, 40), per_line=99) for _ in range(3)]
        if k % 2:
            lines.insert(rnd.randrange(3), "  Common LINE of  the host\tthat everyone has ")
        if k % 5 == 0:
            lines = ["common line of the host that everyone has"] + [lines[0][:20]]
        if k % 7 == 0:
            lines += [lines[0]] * 3
        rows.append((20 + k, "\n".join(lines), "en", host))
    return rows


def test_quality_rules_equal_plain_counting(spark):
    rnd = random.Random(11)
    rows = _hosted(rnd)
    docs = frame(spark, rows)
    want = brute.line_rules([(r[0], r[1], r[3]) for r in rows], RULES)
    got = line_frequency.line_quality(docs, RULES).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed, r.kept) for r in got) == Counter(
        (r[0], *stats, failed, kept) for r, (stats, failed, kept, _) in zip(rows, want))
    assert any(not k and not f for _, f, k, _ in want)             # some are depleted only
    cleaned = line_frequency.clean_documents(docs, RULES)
    assert cleaned.columns == docs.columns
    assert Counter((r.doc_id, r.text, r.n_chars) for r in cleaned.collect()) == Counter(
        (r[0], t, len(t)) for r, (_, _, kept, t) in zip(rows, want) if kept)
    assert any(t != r[1] for r, (_, _, kept, t) in zip(rows, want) if kept)


def test_quality_rules_on_nothing_and_native(spark):
    docs = frame(spark, [(1, "a b")])
    assert line_frequency.line_quality(docs.limit(0)).count() == 0
    assert line_frequency.clean_documents(docs.limit(0)).count() == 0
    for df in (line_frequency.line_quality(docs), line_frequency.clean_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


# ---- near duplicates ---------------------------------------------------------------
def _families(rnd):
    """Exact copies, near copies at all distances, and a chain."""
    rows, i = [], 0
    for _ in range(6):
        base = text(rnd, 120)
        for k in range(14):
            rows.append((i, base if k % 5 == 1 else edited(rnd, base, k)))
            i += 1
    link = text(rnd, 100)
    for _ in range(8):
        rows.append((i, link))
        link = edited(rnd, link, 4)
        i += 1
    return rows + [(i + k, text(rnd, rnd.randint(1, 60))) for k in range(20)]


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates_equal_all_pairs(spark, n):
    rnd = random.Random(12)
    rows = _families(rnd)
    rnd.shuffle(rows)
    got = setsketch.near_duplicates(frame(spark, rows), setsketch.Near(shingle_words=n)).collect()
    want = brute.near(rows, n)
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter(
        (i, size, c, i == c) for i, size, c in want)
    assert len({c for *_, c in want}) < len(rows) - 20


def test_near_duplicates_on_odd_rows(spark):
    rnd = random.Random(13)
    rows = odd_rows(rnd)
    rows += [(20, rows[8][1]), (21, "A b  C"), (22, "a B c"), (23, "a\x0bb c\n"), (24, "É b c"), (25, "é b c")]
    docs = frame(spark, rows)
    got = setsketch.near_duplicates(docs, setsketch.Near(shingle_words=2)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) for i in (1, 2, 3)] == [
        (0, 1, True), (0, 2, True), (0, 3, True)]
    assert by_id[5].component_id == 4 and not by_id[5].kept
    assert [by_id[i].component_id for i in (21, 22, 23, 24, 25)] == [21, 21, 21, 24, 25]
    unnamed = [r for r in got if r.doc_id is None]
    assert sorted((r.component_id is None, r.kept) for r in unnamed) == [(False, False), (True, True)]
    assert next(r for r in unnamed if r.component_id).component_id == 20
    kept = setsketch.without_near_duplicates(docs, setsketch.Near(shingle_words=2))
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, 6: 2, 7: 1, 8: 1, 9: 1, 10: 1, None: 1, 20: 1, 21: 1, 24: 1, 25: 1})
    assert setsketch.near_duplicates(docs.limit(0)).count() == 0


def test_registers_merge_and_estimate_the_similarity():
    rng = np.random.default_rng(3)
    sketcher = setsketch.Sketcher(1024)
    pool = rng.integers(0, 1 << 63, 6000, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    a, b = pool[:3000], pool[600:4000]
    ra, rb = sketcher.registers(a), sketcher.registers(b)
    assert np.array_equal(np.maximum(ra, rb), sketcher.registers(np.union1d(a, b)))
    got = setsketch.estimate(ra[None], rb[None], np.array([3000.0]), np.array([3400.0]))[0]
    assert abs(got - 2400 / 4000) < 0.05


def test_components_equal_union_find(spark):
    rnd = random.Random(14)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)]
    groups = brute.Groups()
    for a, b in edges:
        groups.link(a, b)
    got = {r.node: r.component for r in links.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.find(x) for e in edges for x in e if e[0] != e[1] or x in got}
    assert links.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _plans_of_written_tables(monkeypatch, module):
    """(name, final plan) of every table that ``module`` writes."""
    plans, write = [], module.written

    def record(df, name):
        df.collect()
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(module, "written", record)
    return plans


@pytest.fixture
def eager_skew_join(spark):
    """AQE splits a partition that is larger than the others, however small it is."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split(spark, eager_skew_join, monkeypatch, tmp_path):
    """A key with most memberships, a centre with most edges, a line class with most lines."""
    def table(df, name):
        df.repartition(8).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    members = table(spark.range(60_000).selectExpr(
        "if(id % 4 > 0, 7, 100 + id div 8) as key", "xxhash64(id) as node"), "members")
    shared = links.shared_memberships(members)
    assert len(shared.collect()) > 45_000
    assert "skew=true" in shared._jdf.queryExecution().executedPlan().toString()

    plans = _plans_of_written_tables(monkeypatch, links)
    edges = table(spark.range(60_000).selectExpr(
        "if(id % 4 > 0, 0, id div 8 * 8) as a", "id as b").where("a <> b"), "edges")
    assert links.connected_components(edges).select("component").distinct().count() == 7_500
    assert any(name == "large" and "skew=true" in plan for name, plan in plans)

    del plans[:]
    classes = table(spark.range(60_000).selectExpr("id as node", "id div 2 * 2 as component"), "classes")
    rows = table(spark.range(60_000).selectExpr("if(id % 4 > 0, 7, 100 + id div 8) as key", "id as node", "id as rep"), "rows")
    assert links._open_groups(rows, classes).where("pivot is null").isEmpty()
    assert any(name == "open" and "skew=true" in plan for name, plan in plans)

    lines = table(spark.range(60_000).selectExpr(
        "id as doc_id", "xxhash64(id) as tkey", "0 as line", "if(id % 4 > 0, 7, 100 + id div 8) as h1", "0L as h2",
        "false as again", "if(id % 4 > 0, 7, 100 + id div 8) as k1", "0L as k2"), "lines")
    later = segment_lines._later_lines(lines)
    assert len(later.collect()) > 45_000
    assert "skew=true" in later._jdf.queryExecution().executedPlan().toString()


# ---- lines -------------------------------------------------------------------------
JOIN = segment_lines.LineJoin(min_chars=12, edits=2)


def _mutated(rnd, line, n):
    line = list(line)
    for _ in range(n):
        k = rnd.randrange(len(line) + 1)
        kind = rnd.randrange(3)
        if kind == 0:
            line.insert(k, rnd.choice("abé😀"))
        elif kind == 1 and line:
            line.pop(min(k, len(line) - 1))
        elif line:
            line[min(k, len(line) - 1)] = rnd.choice("abé😀")
    return "".join(line)


def _line_rows(rnd):
    bases = [text(rnd, rnd.randint(4, 12), per_line=99) for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [_mutated(rnd, rnd.choice(bases), rnd.choice((0, 0, 1, 1, 2, 3, 5))) for _ in range(3)]
        lines += [text(rnd, 6, per_line=99), "short"]
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    return rows


def test_line_classes_equal_all_pairs(spark):
    rnd = random.Random(15)
    rows = _line_rows(rnd) + [(900, ""), (901, "short\nshort"), (902, "  padded line of text \t\nx"), (903, "padded line of text")]
    got = segment_lines.deduplicate(frame(spark, rows), JOIN).collect()
    want = brute.duplicate_lines(rows, JOIN.min_chars, JOIN.edits)
    assert {r.doc_id: (r.dropped, r.n_near) for r in got if r.n_dropped} == {i: v for (i, _), v in want.items()}
    assert sum(n for _, n in want.values()) > 50
    assert {r.doc_id: r.n_lines for r in got} == {i: len(t.split("\n")) for i, t in rows}


def test_lines_of_odd_rows(spark):
    rnd = random.Random(16)
    rows = odd_rows(rnd)
    docs = frame(spark, rows)
    got = segment_lines.deduplicate(docs, JOIN).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].n_lines == 0 and by_id[2].n_lines == 1
    assert by_id[4].n_dropped == 0 and by_id[5].n_dropped == by_id[5].n_lines   # 4 comes first, twice the same
    out = segment_lines.without_duplicates(docs, JOIN)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r[0], r[1]) for r in rows)   # 5 is a whole copy
    assert segment_lines.deduplicate(docs.limit(0), JOIN).count() == 0


def test_duplicate_lines_leave_texts_that_are_no_whole_copies(spark):
    first, second = "a line that is long enough", "another line that is long"
    rows = [(1, f"{first}\nb"), (2, f"{first}.\n{second}\nmore than half of this text is its own, as it goes on"),
            (3, f"{second}\n{first}")]
    out = {r.doc_id: (r.text, r.n_chars) for r in segment_lines.without_duplicates(frame(spark, rows), JOIN).collect()}
    rest = f"{second}\nmore than half of this text is its own, as it goes on"
    assert out == {1: (rows[0][1], len(rows[0][1])), 2: (rest, len(rest)), 3: (rows[2][1], len(rows[2][1]))}


def test_only_confirmed_copies_keep_their_duplicate_lines(spark):
    rnd = random.Random(32)
    lines = [text(rnd, 14, per_line=99) for _ in range(16)]
    two = lines[8:10]
    scattered = lines[:8]                       # each kept by another document
    rows = [(k, f"{line}\n{text(rnd, 40)}") for k, line in enumerate(scattered)]
    rewrapped = " ".join(lines[12:16]).split(" ")
    rows += [(20, "\n".join(two * 3)),          # repeats only itself
             (21, "\n".join(two * 3)),          # and a copy of that
             (30, "\n".join(scattered[:4])),    # nothing left
             (31, "\n".join([*scattered[4:], "its own end"])),
             *((40 + k, f"{line}\n{text(rnd, 40)}") for k, line in enumerate(lines[12:16])),
             (50, "\n".join(lines[12:16])),     # a near duplicate of 51, which shares no line
             (51, "\n".join(" ".join(rewrapped[k:k + 9]) for k in range(0, len(rewrapped), 9)))]
    docs = frame(spark, rows)
    out = segment_lines.without_duplicates(docs, JOIN)
    assert out.columns == docs.columns
    want = {**dict(rows), 20: "\n".join(two), 21: "\n".join(two), 31: "its own end"}
    del want[30]
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {i: (t, len(t)) for i, t in want.items()}


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance_and_segments(edits):
    rnd = random.Random(17)
    pairs = []
    for _ in range(800):
        a = "".join(rnd.choice("abcé😀") for _ in range(rnd.randint(0, 40)))
        pairs.append((a, _mutated(rnd, a, rnd.randint(0, 5))))
    got = segment_lines.within([a for a, _ in pairs], [b for _, b in pairs], edits)
    assert got.tolist() == [brute.distance(a, b) <= edits for a, b in pairs]
    join = segment_lines.LineJoin(min_chars=5, edits=edits)
    for (a, b), near in zip(pairs, got):
        if near and a != b and min(len(a), len(b)) >= 5:
            keys, owner = segment_lines.line_keys([a, b], np.array([1, 2]), join)
            assert set(keys[owner == 1]) & set(keys[owner == 2]), (a, b)


def test_last_round_pairs_include_every_link(spark):
    """Counts of characters never rule out a pair within the distance."""
    rnd = random.Random(18)
    base = text(rnd, 10, per_line=99)
    lines = [base] + [_mutated(rnd, base, rnd.randint(1, 4)) for _ in range(60)]
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, text string")
    groups = texts.selectExpr("0L as pivot", "node", "node as c", "node <> 0 as apart")
    got = {tuple(sorted((r.a, r.b))) for r in segment_lines._narrower(texts, JOIN)(groups).collect()}
    want = {(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))
            if lines[i] != lines[j] and brute.distance(lines[i], lines[j]) <= JOIN.edits}
    assert want <= got and len(got) < len(lines) * len(lines) / 2


def test_difference_prefixes_include_every_link(spark):
    """In a loose family around a pivot, no linked pair is ruled out."""
    rnd = random.Random(19)
    base = text(rnd, 100)
    texts = [base] + [edited(rnd, base, rnd.randint(1, 16)) for _ in range(40)]
    texts += [edited(rnd, rnd.choice(texts[1:]), rnd.randint(1, 3)) for _ in range(20)]
    near = setsketch.Near(shingle_words=2)
    candidates = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    groups = candidates.selectExpr("0L as pivot", "node", "node as c", "node <> 0 as apart")
    got = {tuple(sorted((r.a, r.b))) for r in setsketch._narrower(candidates, near)(groups).collect()}
    sets = [brute.shingle_set(t, 2) for t in texts]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)

    with_pivot = {j for j in range(1, len(texts)) if linked(0, j)}
    assert {(0, j) for j in with_pivot} <= got
    want = {(i, j) for i in range(1, len(texts)) for j in range(i + 1, len(texts))
            if linked(i, j) and not (i in with_pivot and j in with_pivot)}
    assert want and want <= got


def _generated(plan):
    """Rows that the Generate operators of an executed plan made."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _generated(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _generated(plan.plan())
    below = sum(_generated(plan.children().apply(k)) for k in range(plan.children().size()))
    return below + (plan.metrics().apply("numOutputRows").value() if name == "GenerateExec" else 0)


def test_prefix_rows_are_of_levels_that_can_match(spark):
    """A token is a row for each level that has members and that its place reaches, not for all."""
    nodes, levels = range(40), 9
    members = spark.createDataFrame(
        [(0, k, k, 100, k % 2 * 3, 2, [3, 3, 2, 2, 1, 1, 0, 0, 0]) for k in nodes],
        "pivot long, node long, c long, n long, level int, reach long, apart_reach array<long>")
    tokens = spark.createDataFrame(
        [(0, k, t) for k in nodes for t in (k // 2, 100 + k // 4, 200 + k // 8, 300)], "pivot long, node long, token long")
    pairs = links.prefix_pairs(tokens, members, lambda x, y: x <= y)
    got = {(r.a, r.b) for r in pairs.collect()}
    # a's tokens at places up to apart_reach[level of b] meet b's at places up to reach
    assert got == {(a, b) for a in nodes for b in nodes if a != b and a // 4 == b // 4}
    made = _generated(pairs._jdf.queryExecution().executedPlan())
    assert 0 < made <= len(nodes) * (3 + 2) < len(nodes) * 3 * levels


def test_components_are_few_steps(spark, monkeypatch):
    """Stars take one step, and what is known of them is written, not aggregated again by each reader."""
    def scratch():
        return {x.rpartition("-")[0] for x in os.listdir(scratch_dir(spark).removeprefix("file:")) if x not in before}

    before = set(os.listdir(scratch_dir(spark).removeprefix("file:")))
    names, write = [], links.written
    monkeypatch.setattr(links, "written", lambda df, name: names.append(name) or write(df, name))
    edges = spark.createDataFrame([(k, k % 5) for k in range(5, 60)] * 2, "a long, b long")
    got = links.connected_components(edges)
    assert sorted((r.node, r.component) for r in got.collect()) == [(k, k % 5) for k in range(60)]
    assert names == ["edges", "least", "large", "children", "components"]
    assert scratch() == {"components"}
    chain = links.connected_components(spark.createDataFrame([(k, k + 1) for k in range(100, 140)], "a long, b long"))
    assert {r.component for r in chain.collect()} == {100} and len(names) > 10 and scratch() == {"components"}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_no_task_needs_two_python_processes(spark, monkeypatch):
    """A filter in Python and a map in Python in one task are two processes a core, which stay for
    the stages to come; the documents in question are a table between them."""
    rnd = random.Random(31)
    base = text(rnd, 120)
    rows = [(k, edited(rnd, base, 1) if k < 4 else text(rnd, 60), "en", "s") for k in range(12)]
    docs = frame(spark, rows)
    plans = []
    real = segment_lines.bitmap_of

    def told(df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, *args)

    monkeypatch.setattr(segment_lines, "bitmap_of", told)
    some = docs.where("doc_id in (1, 7)").selectExpr("doc_id as xid", "xxhash64(text) as xtkey")
    got = segment_lines._nearly_equal(docs, some, setsketch.Near())
    assert len(plans) == 1 and "MapInArrow" in plans[0] and "EvalPython" not in plans[0]
    assert {r.xid for r in got.collect()} <= {1}
