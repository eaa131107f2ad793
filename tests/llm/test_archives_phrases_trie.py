"""WARC archives, collocations and the prefix trie against plain versions and DuckDB."""

import hashlib
import json
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpora import frame, odd_rows, text
from leadlake.llm import hat_trie, prefix_trie, warc
from leadlake.llm.queries import QUERIES
from leadlake.llm.sql import ORACLE
from leadlake.session import scratch_dir
from oracle_compare import compare, duck

SMALL = "/root/testdata/sf0.001"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op11_warc", "op12_hat_trie", "op13_prefix_trie"])
def test_queries_equal_sql(spark, name):
    same, why = compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE[name])
    assert same, why


# -- WARC


def plain_archive(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for page, _, html in rows:
        p = (html or "").encode()
        first = max((x for x in groups[p] if x is not None), default=None)
        copy = len(p) >= 1000 and page != first
        out.append((page, len(p), hashlib.sha1(p).hexdigest(), "revisit" if copy else "response", first if copy else None))
    return sorted(out, key=repr)


PAGES = [
    (1, None, None), (2, "u", ""), (3, "u\r\nX: y", "x" * 999), (4, "é", "x" * 999), (5, "a", "x" * 1000),
    (6, "a", "x" * 1000), (6, "b", "x" * 1000), (None, "q", "x" * 1000), (None, None, "é" * 5000),
    (None, None, "é" * 5000), (-3, "u", "\r\n\r\n" * 400), (7, "u", "\r\n\r\n" * 400), (8, "w", "z" * 3_000_000),
    (9, "w", "z" * 3_000_000), (10, "w", "HTTP/1.1 200\r\n\r\n"), (11, "w", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"),
]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 as payload", "'x' as record_type", "2 as refers_to", "3 as date")


def test_pages_are_archived_and_read_back(spark):
    assert tuples(warc.archived(pages(spark, PAGES))) == plain_archive(PAGES)
    empty = warc.archived(pages(spark, PAGES).limit(0))
    assert empty.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert empty.collect() == []


def test_payloads_and_headers_round_trip(spark):
    path = f"{scratch_dir(spark)}/warc-round-trip"
    rows = warc.page_records(pages(spark, PAGES))
    warc.write_warc(rows, path, "overwrite")
    back = warc.read_warc(spark, path).select(rows.columns)
    kept = [r for r in tuples(rows) if r[2] not in ("é", "u\r\nX: y")]
    got = [r for r in tuples(back.withColumn("payload", F.when(F.col("record_type") == "response", F.col("payload"))))
           if r[2] not in ("%C3%A9", "u%0D%0AX:%20y")]
    assert got == kept
    warc.write_warc(rows.limit(2), path, "overwrite")
    assert warc.read_warc(spark, path).count() == 2
    warc.write_warc(rows.limit(3), path)
    assert warc.read_warc(spark, path).count() == 5


def test_predicates_and_schema_reach_the_reader(spark):
    path = f"{scratch_dir(spark)}/warc-pushed"
    warc.write_warc(warc.page_records(pages(spark, PAGES)), path, "overwrite")
    read = warc.read_warc(spark, path, warc.HEAD_SCHEMA)
    pushed = read.where("record_type = 'revisit' and target_uri in ('u', 'w') and record_id like 'urn:page:%'")
    assert "Filter (" not in pushed._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.record_id for r in pushed.collect()) == ["urn:page:-3", "urn:page:8"]
    kept = read.where("payload_length > 9000 and record_type = 'response'")  # no header column: Spark's own filter
    assert "Filter (" in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.payload_length for r in kept.collect()) == [10000, 10000, 3000000]
    with pytest.raises(Exception, match="has no colour"):
        warc.read_warc(spark, path, "colour string").collect()


class Counted:
    """A file that counts the bytes read of it."""

    def __init__(self, data):
        self.file, self.bytes = pa.BufferReader(data), 0

    def read_at(self, size, at):
        got = self.file.read_at(size, at)
        self.bytes += len(got)
        return got


@pytest.mark.parametrize("compressed", [True, False])
def test_unwanted_payloads_are_not_read(compressed):
    rnd = random.Random(4)
    noise = bytes(rnd.randrange(256) for _ in range(400_000))
    made = [warc.record({"record_type": t, "record_id": f"urn:page:{k}", "payload": noise})
            for k, t in enumerate(["response", "revisit", "resource", "response"])]
    data = b"".join(map(warc.member, made) if compressed else made)
    file = Counted(data)
    only = [lambda r: r["record_type"] == "revisit"]
    assert [r["record_id"] for r in warc.records(file, 0, len(data), only, True)] == ["urn:page:1"]
    assert file.bytes < 60_000
    whole = list(warc.records(Counted(data), 0, len(data), [], True))
    assert [r["payload"] for r in whole] == [noise, b"", noise, noise]
    second = len(warc.member(made[0])) if compressed else len(made[0])
    assert len(list(warc.records(Counted(data), second, len(data), [], False))) == 3
    with pytest.raises(EOFError):
        list(warc.records(Counted(data[:-5000]), 0, len(data), [], True))


def test_archives_of_others(spark, tmp_path):
    """No manifest, no skip lengths, no HTTP head, a digest in hex, folded headers."""
    import gzip
    one = (b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Record-ID: <urn:x>\r\nWARC-Target-URI: http://a/\r\n b\r\n"
           b"WARC-Payload-Digest: sha1:" + b"ab" * 20 + b"\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(one))
    (tmp_path / "b.warc").write_bytes(one * 3)
    (tmp_path / "c.txt").write_bytes(b"not an archive")
    rows = warc.read_warc(spark, str(tmp_path)).collect()
    assert len(rows) == 5
    assert {(r.record_type, r.record_id, r.target_uri, r.payload_digest, r.payload_length, bytes(r.payload)) for r in rows} == {
        ("resource", "urn:x", "http://a/ b", "ab" * 20, 5, b"hello")}


def test_only_committed_files_are_read_and_split_where_records_begin(spark):
    path = f"{scratch_dir(spark)}/warc-committed"
    warc.register(spark)
    rows = warc.page_records(pages(spark, [(k, "u", f"{k}" * 3000) for k in range(60)])).coalesce(2)
    rows.write.format("warc").option("splitBytes", 500).option("fileBytes", 3000).mode("append").save(path)
    folder = Path(path)
    manifest = json.loads(next(folder.glob("_manifest-*.json")).read_text())
    assert len(manifest) > 2 and sum(len(f["splits"]) for f in manifest) > 10
    (folder / "lost.warc.gz").write_bytes(warc.member(warc.record({"record_type": "response"})))
    reader = warc.WarcReader({"path": path, "partitions": "4"}, spark.read.format("warc").load(path).schema)
    pieces = [p for part in reader.partitions() for p in part.value]
    assert len(pieces) == sum(len(f["splits"]) for f in manifest)
    assert sorted(r.record_id for r in warc.read_warc(spark, path).collect()) == sorted(f"urn:page:{k}" for k in range(60))


def test_a_common_payload_is_split(spark):
    rows = spark.range(0, 4000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 4 > 0, F.lit("x" * 1500)).otherwise(
            F.concat(F.col("id").cast("string"), F.lit("y" * 1200))).alias("html"))
    old = {k: spark.conf.get(k, None) for k in HOT}
    try:
        for k, v in HOT.items():
            spark.conf.set(k, v)
        joined = warc.page_records(rows)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


HOT = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}


# -- collocations


def plain_collocations(rows, least=10, cover=50, top=2000):
    counts, out = {}, []
    for lang, t in rows:
        c = counts.setdefault("und" if lang is None else lang, Counter())
        t = (t or "").translate({k: k + 32 for k in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            c.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for lang, c in counts.items():
        n = sum(a for p, a in c.items() if len(p) == 1)
        chosen = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = {}
        for p, a in chosen.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer.get(q, 0), a)
        kept = []
        for p, a in chosen.items():
            if p not in longer or 100 * longer[p] < cover * a:
                score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out, key=repr)


def phrase_rows():
    rnd = random.Random(7)
    rows = [(k, text(rnd, 200, vocabulary=12), rnd.choice(["en", "de", None])) for k in range(30)]
    rows += [(40 + k, "New York city, New\tYork.City NEW YORK city\x0bnew york", "en") for k in range(9)]
    rows += [(60, " ".join(["ha"] * 5000), "en"), (61, "É É é é " * 12, "und"), (62, "x y!z,x y\n" * 15, "")]
    return rows + odd_rows(rnd)


@pytest.mark.parametrize("rules", [
    hat_trie.Phrases(), hat_trie.Phrases(held=40, burst=8, vocabulary=60, block=37, most_bits=1 << 16),
    hat_trie.Phrases(top=7, least=5, cover_percent=80)])
def test_collocations_equal_a_plain_count(spark, rules):
    rows = phrase_rows()
    docs = frame(spark, rows).withColumn("phrase", F.lit(1)).withColumn("n", F.lit("n")).repartition(3)
    want = plain_collocations([(r[2], r[1]) for r in rows], rules.least, rules.cover_percent, rules.top)
    assert want and tuples(hat_trie.collocations(docs, rules)) == want
    assert hat_trie.collocations(docs.limit(0), rules).collect() == []


def test_scores_beyond_64_bits(spark):
    docs = frame(spark, [(1, "a b " * 2_000_000, "en")])
    rows = [tuple(r) for r in hat_trie.collocations(docs).collect()]
    assert rows == plain_collocations([("en", "a b " * 2_000_000)])  # 10**6 * a * a is above 2**63


def test_trie_bursts_and_spills_sorted_subtrees():
    rules = hat_trie.Phrases(burst=16, held=10**6)
    trie = hat_trie.Trie(rules, 2, np.full(1 << 13, 255, dtype=np.uint8))
    rnd = random.Random(2)
    words = [b"the" if rnd.random() < 0.4 else f"w{rnd.randrange(300)}".encode() for _ in range(6000)]
    trie.add("en", np.array([trie.words[w] for w in words]))
    root = trie.roots["en"]
    assert trie.words[b"the"] in root.own and root.own[trie.words[b"the"]].size() > 200
    want = Counter(zip(words, words[1:]))
    assert trie.size == len(want) == root.size()
    runs = [b.to_pydict() for b in trie.spill(trie.size // 2)]
    assert 0 < trie.size <= len(want) // 2
    runs += [b.to_pydict() for b in trie.spill()]
    assert all(p == sorted(p) for p in ([x.encode().split() for x in r["phrase"]] for r in runs))
    got = {tuple(p.encode().split()): n for r in runs for p, n in zip(r["phrase"], r["n"])}
    assert got == want and trie.size == 0


def test_containers_are_small_arrays():
    """A phrase takes two longs of a table that is a quarter full or more, not two Python objects
    and a dict entry; repeated and colliding phrases count once each."""
    rnd = np.random.default_rng(3)
    blocks = [np.unique(rnd.integers(1, 1 << 18, 60_000) << 42 | rnd.integers(1, 3, 60_000) << 21) for _ in range(8)]
    tracemalloc.start()
    node = hat_trie._Node(42)
    new = [node.add(b, np.ones(len(b), dtype=np.int64), 1 << 40) for b in blocks]
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    want = Counter(np.concatenate(blocks).tolist())
    assert sum(new) == node.size() == len(want) and held < 80 * len(want)
    keys, n = node.take(None)
    assert dict(zip(keys.tolist(), n.tolist())) == want and node.size() == 0


# -- prefix trie


def plain_trie(rows):
    own, full, nodes, children, below = {}, {}, {}, {}, {}
    for c, turn, role, t in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", t or ""))
    for v in own.values():
        v.sort()
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = [x[2:] for x in own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]]
    for c, v in full.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    for k in nodes:
        if k:
            children.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        inner = children.get(k, [])
        saved = (len(nodes[k]) - 1) * len(k[-1][1].encode()) if k else 0
        below[k] = (sum(below[x][0] for x in inner) if inner else 1, saved + sum(below[x][1] for x in inner))
    return sorted(((
        min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), len(children.get(k, [])), *below[k],
        hashlib.sha256(",".join(str(c) for c in sorted(m) if len(full[c]) == len(k)).encode()).hexdigest())
        for k, m in nodes.items()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").selectExpr(
        "*", "'d' as depth", "1 as place", "'c' as content", "2 as shard", "'b' as bytes", "0 as total")


def odd_conversations():
    rnd = random.Random(3)
    ids = [None, -7, -5, -1, 0, 1, 2, 3, 4, 5, 10, 11, 12, 13, 14]
    rows = [(rnd.choice(ids), rnd.choice([None, *range(6)]), rnd.choice([None, "user", "bot"]),
             rnd.choice([None, "", "a", "b", "é😀", "x" * 5000])) for _ in range(400)]
    rows += [(50, k, "user", f"t{k % 3}") for k in range(700)] + [(51, k, "user", f"t{k % 3}") for k in range(650)]
    return rows + [(52, None, "u", "x")] * 300 + [(k, 0, "user", "hi") for k in range(100, 400)]


def test_trie_equals_a_plain_one(spark):
    rows = odd_conversations()
    small = prefix_trie.Shards(shard_turns=100, stretch=16, chunk=3)
    assert tuples(prefix_trie.prefix_trie(conversations(spark, rows), small)) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert prefix_trie.prefix_trie(conversations(spark, odd_conversations()).limit(0)).collect() == []
    alone = next(c for c in range(11, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(alone, 1, "user", "x"), (None, 1, "user", "y")]
    got = tuples(prefix_trie.prefix_trie(conversations(spark, rows)))
    assert got == plain_trie(rows) and len(got) == 1


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_slots_are_minimal_and_tell_strangers(n):
    rnd = np.random.default_rng(n)
    a, b = (rnd.integers(0, 1 << 63, n, dtype=np.uint64) for _ in "ab")
    slots = prefix_trie.Slots(a, b)
    assert sorted(slots.find(a, b).tolist()) == list(range(n))
    assert (slots.find(a ^ np.uint64(1), b) == -1).all()


def test_a_digest_of_two_prefixes_is_noticed():
    rows = pa.table({
        "shard": [0, 0, 0], "depth": [1, 1, 2], "a": [5, 5, 9], "b": [6, 6, 9], "pa": [0, 0, 5], "pb": [0, 0, 6],
        "content": [b"x", b"y", b"z"], "bytes": [1, 1, 1], "conv_id": [3, 2, 2]})
    out = prefix_trie.shard_nodes(rows).to_pydict()
    assert dict(zip(out["a"], out["same"])) == {5: False, 9: True}
    assert dict(zip(out["a"], out["least"])) == {5: 2, 9: 2}
