"""op2 (I-Match)."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from corpora import edited, frame, odd_rows, text

from leadlake.llm import imatch


def _want(rows):
    """(doc_id, length, sha of the edited text) by plain sorting."""
    ordered = sorted([(i, t or "") for i, t, *_ in rows if i is not None])
    out = []
    for k, (i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        cut = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - cut] + nxt[:cut]).encode()).hexdigest()))
    for i, t, *_ in rows:
        if i is None:                       # its own next document
            t = t or ""
            cut = len(t) // 4
            out.append((None, len(t), hashlib.sha256((t[:len(t) - cut] + t[:cut]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edited_texts_and_fingerprints(spark):
    rnd = random.Random(5)
    rows = odd_rows(rnd) + [(50 + 3 * k, text(rnd, rnd.randint(5, 300)), "en", "s") for k in range(60)]
    rows.append((500, rows[-1][1], "en", "s"))                     # an exact copy
    docs = frame(spark, rows).repartition(5)
    terms = imatch.lexicon(docs, imatch.Band(min_share=0.01, max_share=0.5))
    for buckets in (1, 7):
        got = imatch.compare_edited(docs, terms, buckets).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == _want(rows)
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    by_text = {}
    prints = {r.doc_id: r.fingerprint for r in imatch.fingerprints(docs, terms).collect()}
    for i, t, *_ in rows:
        if i not in (4, 6, None):
            by_text.setdefault(t or "", set()).add(prints[i])
    assert all(len(v) == 1 for v in by_text.values())              # equal texts, equal fingerprints
    long = [r for r in got if r.doc_id and 50 <= r.doc_id < 500 and r.n_chars > 300]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95


def test_rows_without_id_are_not_gathered(spark):
    rows = [(None if k % 3 else k, f"text {k % 2}", "en", "s") for k in range(120)]
    docs = frame(spark, rows).repartition(6)
    got = imatch.compare_edited(docs, [], 4)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got.collect()), key=repr) == _want(rows)
    held = got.where("doc_id is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == 6 and sum(r["count"] for r in held) == 80


def test_document_frequency_and_band_equal_counting(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(k, text(rnd, 40, vocabulary=120)) for k in range(50)] + [(99, None)]
    monkeypatch.setattr(imatch, "FLUSH_TERMS", 50)
    df = Counter(imatch.term_hash(t) for _, x in rows if x for t in imatch.terms_of(x))
    got = {r.term: r.df for r in imatch.document_frequency(frame(spark, rows)).collect()}
    assert got == df
    band = imatch.Band(min_share=0.1, max_share=0.4)
    want = sorted(t for t, n in df.items() if 0.1 * 51 <= n <= 0.4 * 51)
    assert imatch.lexicon(frame(spark, rows), band) == want


def test_likeness_estimates_the_jaccard_similarity():
    rnd = random.Random(7)
    vocabulary = [f"t{k}" for k in range(5000)]
    printer = imatch.Fingerprinter(sorted(map(imatch.term_hash, vocabulary)))
    errors = []
    for _ in range(60):
        base = rnd.sample(vocabulary, rnd.randint(40, 900))
        cut = rnd.randint(0, len(base))
        other = base[:cut] + rnd.sample(vocabulary, len(base) - cut)
        a, b = set(base), set(other)
        pair = [printer.of(" ".join(x))[None] for x in (base, other)]
        errors.append(imatch.likeness(*pair)[0] - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.08 and np.std(errors) < 0.15
    one = printer.of("t1 t2 t3")[None]
    assert imatch.likeness(one, one)[0] == 1.0


def test_texts_without_lexicon_terms_differ_unless_equal():
    printer = imatch.Fingerprinter([imatch.term_hash("known")])
    a, b, c, d = (printer.of(x) for x in ("some words", "words some", "other", ""))
    assert np.array_equal(a, b) and not np.array_equal(a, c) and not np.array_equal(a, d)
    assert imatch.likeness(a[None], c[None])[0] == 0.0


def test_empty_table_and_single_document(spark):
    none = frame(spark, [(1, "a")]).limit(0)
    assert imatch.lexicon(none) == [] and imatch.compare_edited(none, []).count() == 0
    t = edited(random.Random(1), text(random.Random(2), 50), 3)
    got = imatch.compare_edited(frame(spark, [(1, t)]), []).collect()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in got] == [
        (1, hashlib.sha256((t[:len(t) - len(t) // 4] + t[:len(t) // 4]).encode()).hexdigest(), 1.0)]
