"""Near duplicates, exact search, archive and pipeline against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.errors import PySparkException

import corpus_pipeline
from legwork.llm import jaccard, topk, warc
from legwork.llm.components import components
from legwork.llm.queries import ORACLE, QUERIES
from suite.compare import _rows, connect

SF = "/root/testdata/sf0.001"


def groups_of(links, nodes):
    parent = {k: k for k in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {k: find(k) for k in nodes}


def plain_near(rows):
    """Set size and smallest linked key of every row, by comparing all pairs that share a shingle."""
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[key] = {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    holders = defaultdict(list)
    for key, items in sets.items():
        for item in items:
            holders[item].append(key)
    links = []
    for key, items in sets.items():
        shared = Counter(other for item in items for other in holders[item] if other > key)
        links += [(key, o) for o, n in shared.items() if 100 * n >= 80 * (len(items) + len(sets[o]) - n)]
    return {k: (len(sets[k]), part) for k, part in groups_of(links, sets).items()}


def near_copies(seed, families=12):
    """Families of edited texts, passages that many share, and short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([6, 12, 40, 120, 200]))]
        if rng.random() < 0.6:
            base = base + passage[: rng.randint(20, 60)]
        for _ in range(rng.choice([1, 2, 6, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.2:
                copy = copy[: rng.randint(len(copy) * 7 // 10, len(copy))]
            rows.append(" ".join(copy) if rng.random() < 0.9 else "  ".join(copy).upper())
    rows += [None, "", " \n", "a b", "A  b", "a b c d", "a b c d e", "a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("seed, frequent, ordered", [(1, 2000, 0), (2, 10, 0), (3, 20, 50), (4, 2000, 1 << 20)])
def test_near_duplicates(spark, monkeypatch, seed, frequent, ordered):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "ORDERED", ordered)
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "2 as set_id", "3 as gid")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()}
    assert got == plain_near(rows)


def test_op5(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard_join"](spark, "/root/testdata/sf0.01").collect()}
    assert got == plain_near(rows)


def test_op5_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (1, text), (1, text), (2, text + " x"), (3, None), (4, "long " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got if r.doc_id) == [(1, 1), (1, 1), (2, 1), (3, 3), (4, 4)]
    assert sorted(r.doc_id or 0 for r in jaccard.one_of_each(docs).collect()) == [0, 1, 3, 4]
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0 and jaccard.one_of_each(docs.limit(0)).count() == 0


def test_meeting_shuffles_the_buckets_once(spark, tmp_path):
    """Groups 1 and 2 share a bucket across components, 2 and 3 lie in one, and 4 is too large for any."""
    rows = [(7, 1, 20, 0, 1, 1), (7, 2, 20, 1, 2, 2), (7, 3, 20, 0, 2, 2), (7, 4, 90, 0, 4, 4), (8, 1, 20, 1, 1, 1), (8, 2, 20, 2, 2, 2)]
    spark.createDataFrame(rows, "shingle long, gid long, n long, position int, low long, high long").write.parquet(f"{tmp_path}/buckets")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        met = jaccard.meeting(spark.read.parquet(f"{tmp_path}/buckets"))
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan
        assert sorted(map(tuple, met.collect())) == [(1, 2), (1, 3)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_one_of_each_loses_no_text(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, a), (1, b), (2, a), (3, b + " more"), (4, None), (4, ""), (5, "a"), (5, "b"), (5, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 as n", "8 as set_id")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, a), (1, b), (4, ""), (5, "a"), (5, "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)]
    links += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)]
    want = groups_of(links, {x for pair in links for x in pair})
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def same_as_sql(spark, name, sf=SF):
    con = connect(sf)
    found = QUERIES[name](spark, sf)
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert _rows(found.columns, found.collect()) == _rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["op6_exact_top_k", "op8_warc"])
def test_against_sql(spark, name):
    same_as_sql(spark, name)


@pytest.mark.parametrize("shard, queries", [(8192, 2048), (40, 3)])
def test_top_k(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", queries)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(150)]
    rows += [(i, [1.0, 0.5, -0.25, 0.0]) for i in range(150, 200)]  # ties
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [1.0, float("nan"), 0.0, 0.0]), (303, [1.0, float("inf"), 0.0, 0.0]), (304, []), (400, [0.1, 0.2])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as size", "2 as _shard")
    got = defaultdict(list)
    for r in topk.top_k(frame, frame.where("vec_id % 10 = 0"), 10).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = {k: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64) for k, v in rows if k < 300}
    for q in range(0, 200, 10):
        best = sorted(((-int(whole[q] @ v), k) for k, v in whole.items() if k != q))[:10]
        assert got[q] == [(i, k, -s) for i, (s, k) in enumerate(best, 1)]
    assert set(got) == {k for k in range(0, 200, 10)}
    assert topk.top_k(frame.limit(0), frame.limit(0), 3).count() == 0


def test_large_scores_stay_exact():
    rng = np.random.default_rng(5)
    points = rng.integers(-(2**29), 2**29, (300, 6))
    tree = topk.Tree(points, np.arange(300))
    asked = points[:5]
    for q, ids, scores in tree.search(asked.astype(float), np.arange(5), np.full(5, -np.inf), 4):
        exact = [int(sum(int(a) * int(b) for a, b in zip(points[q], p))) for p in points]
        want = sorted((-s, i) for i, s in enumerate(exact) if i != q)[:4]
        assert sorted(zip(-scores, ids)) == want


def test_archive_round_trip(spark, tmp_path):
    big, other = "é" * 600, "x" * 999
    rows = [(1, "http://a/\r\nX: y", big), (2, "http://b/", big), (3, None, big), (4, "u", other), (5, "u", other), (6, "u", None), (7, "u", ""), (8, "u", "y" * 1000), (8, "u", "y" * 1000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as payload", "3 as owner")
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4
    records = warc.read_records(spark, folder).collect()
    assert len(records) == 9
    kinds = {}
    for r in records:
        head, _, body = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        kinds.setdefault(r.page_id, fields["WARC-Type"])
        payload = dict((k, v or "") for k, _, v in rows)[r.page_id].encode()
        assert bytes(r.payload) == payload and "X" not in fields
        want = b"" if fields["WARC-Type"] == "revisit" else payload
        assert body == want + b"\r\n\r\n" and int(fields["Content-Length"]) == len(want)
    assert kinds == {1: "revisit", 2: "revisit", 3: "response", 4: "response", 5: "response", 6: "response", 7: "response", 8: "response"}
    found = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.page_records(warc.read_records(spark, folder)).collect()}
    assert found[1] == ("revisit", 3, 1200) and found[3] == ("response", None, 1200) and found[6] == ("response", None, 0)
    broken = str(tmp_path / "broken")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{broken}/headers")
    spark.read.parquet(f"{folder}/payloads").selectExpr("digest", "concat(payload, x'00') as payload").write.parquet(f"{broken}/payloads")
    with pytest.raises(PySparkException):
        warc.read_records(spark, broken).select("payload").collect()
    warc.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_records(spark, str(tmp_path / "none")).count() == 0


def test_archive_keeps_pages_without_a_key(spark, tmp_path):
    rows = [(None, "u", "z" * 2000), (None, "v", "z" * 2000), (1, "w", "y" * 2000), (None, "w", "y" * 2000)]
    folder = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    records = warc.read_records(spark, folder)
    assert sorted(bytes(r.payload)[:1] for r in records.collect()) == [b"y", b"y", b"z", b"z"]
    found = warc.page_records(records)
    assert sorted((r.page_id or 0, r.record_type, r.payload_bytes) for r in found.collect()) == [(0, "response", 2000)] * 3 + [(1, "response", 2000)]
    assert "payload" in found._jdf.queryExecution().optimizedPlan().toString()


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept, rows = [set(texts)], docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, sf)
        assert rows.columns == docs.columns and rows.dtypes == docs.dtypes
        kept.append({r.doc_id for r in rows.select("doc_id").collect()})
    assert all(later <= earlier for earlier, later in zip(kept, kept[1:])) and kept[3] == kept[4]
    good = {k for k, q in labels.items() if q == 1 and len((texts[k] or "").split()) >= 10}
    assert len(good & kept[2]) >= 0.97 * len(good)
    near = plain_near([(k, texts[k]) for k in kept[2]])
    assert kept[3] == {part for _, part in near.values()}
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in packed} == kept[4]
    assert max(r.offset + r.length for r in packed) <= 1024
