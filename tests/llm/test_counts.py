"""Line dedup, phrases and source divergence against plain counting."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from legwork.llm import byte_words, divergence, line_dedup, phrases, recurring
from legwork.llm.queries import ORACLE, QUERIES
from suite.compare import _rows, connect

SF = "/root/testdata/sf0.001"
SMALL = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "3",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "7",
}


@pytest.fixture
def small_batches(spark):
    """Many partitions and batches, so that runs and prefixes cross their edges."""
    before = {name: spark.conf.get(name, None) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("name", ["op11_divergence", "op12_phrases", "op13_line_dedup"])
def test_query_equals_sql(spark, name):
    found = QUERIES[name](spark, SF)
    cursor = connect(SF).execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert _rows(found.columns, found.collect()) == _rows(columns, cursor.fetchall())


# ---- lines ----

LINES = ["", " ", "short", "Common license line", " common LICENSE line\t", "another shared line", "ünïcode line no 1", "  x" * 4, "\r\x0bcommon license line"]


def line_documents(seed):
    rng = random.Random(seed)
    rows = [(i, "\n".join(rng.choice(LINES + [f"own line number {i}"]) for _ in range(rng.randint(1, 9)))) for i in range(60)]
    rows += [(7, "another shared line\nown line number 7"), rows[3], rows[3], (200, None), (201, ""), (202, "\n"), (203, "common license line\n")]
    return rows + [(None, "common license line\nkeyless line here"), (None, "keyless line here"), (None, None)]


def plain_lines(rows):
    strip = lambda line: lower(line.strip(line_dedup.BLANK))
    last = lambda key: (key is None, key or 0)
    holder = {}
    for key, text in rows:
        for line in (text or "").split("\n"):
            if len(strip(line)) >= 10:
                holder[strip(line)] = min(holder.get(strip(line), key), key, key=last)
    for key, text in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if len(strip(p)) < 10 or holder[strip(p)] == key]
        yield key, len(parts), len(parts) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, small_batches, seed):
    rows = line_documents(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as position", "2 as hi", "3 as _a", "4 as doc")
    found = line_dedup.kept_lines(docs.repartition(5)).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, found)) == Counter(plain_lines(rows))


def test_keep_bitmaps_rebuild_the_text(spark):
    rows = line_documents(3)
    want = {(k, t) for k, _, n, t in plain_lines(rows) if n}
    texts = defaultdict(set)
    for key, text in rows:
        texts[key].add(text or "")
    for row in line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert (row.keep is None) == (row.n_dropped == 0)
        if row.keep is not None and len(texts[row.doc_id]) == 1:
            (text,) = texts[row.doc_id]
            bits = np.unpackbits(np.frombuffer(zlib.decompress(row.keep), np.uint8), bitorder="little")
            kept = [line for line, bit in zip(text.split("\n"), bits) if bit]
            assert (row.doc_id, "\n".join(kept)) in want and len(kept) == row.n_lines - row.n_dropped


def test_lines_with_text_keys_and_no_rows(spark):
    docs = spark.createDataFrame([("b", "the very same line"), ("a", "the very same line")], "id string, body string")
    assert {r.id: r.n_dropped for r in line_dedup.keep_bitmaps(docs, "id", "body").collect()} == {"a": 0, "b": 1}
    assert line_dedup.kept_lines(docs.limit(0), "id", "body").count() == 0


def test_line_of_a_very_long_text(spark):
    text = "\n".join(f"line number {i}" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (2, text + "\nlast of all lines")], "doc_id long, text string")
    found = {r.doc_id: r for r in line_dedup.kept_lines(docs).collect()}
    assert (found[2].n_lines, found[2].n_dropped, found[2].kept) == (30_001, 30_000, "last of all lines") and found[1].kept == text


# ---- words ----


def test_words_are_told_apart_whatever_the_hash():
    texts = ["Ab ab\tAB cd", None, "", "éa éA\x00 ab" * 3]
    table, inside = byte_words.WordTable(), phrases._INSIDE
    for first, block in byte_words.blocks(texts, size=8):
        words = byte_words.words_of(block, inside)
        at = np.arange(len(words.start))
        second = byte_words.hashes(words, 1)
        plain = table.numbers(words, at, byte_words.hashes(words), second)
        again = table.numbers(words, at, np.zeros(len(at), np.uint64), second)  # every hash collides
        assert plain.tolist() == again.tolist()
        names = [table.names[i].decode() for i in plain.tolist()]
        assert names == [w for t in texts[first : first + len(block)] for w in re.findall(r"[^ \t\n]+", lower(t))]


def test_hashes_do_not_depend_on_the_block():
    one = byte_words.words_of([b"x", b"some word"], phrases._INSIDE)
    two = byte_words.words_of([b"word"], phrases._INSIDE)
    for which in (0, 1):
        assert byte_words.hashes(one, which)[2] == byte_words.hashes(two, which)[0]


def test_filter_never_denies(spark):
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    counts = spark.createDataFrame([(int(k), i % 5) for i, k in enumerate(keys.view(np.int64))], "key long, n long")
    words = recurring.recurring(recurring.often(counts, 3, 3000), bits=1 << 16)
    held = recurring.may_recur(keys, words)
    assert held[np.arange(3000) % 5 >= 3].all() and held.mean() < 0.6


def test_counts_leave_a_task_in_bounded_batches():
    keys = np.arange(300_000, dtype=np.uint64)
    found = list(recurring.counted([keys, keys[:7], keys[:0]]))
    assert max(map(len, found)) <= recurring.BATCH_ROWS
    n = {k: n for batch in found for k, n in zip(batch.column("key").to_pylist(), batch.column("n").to_pylist())}
    assert len(n) == 300_000 and [k for k in n if n[k] == 2] == list(range(7)) and sum(n.values()) == 300_007
    assert list(recurring.counted([])) == [] and not [b for b in recurring.counted([keys[:0]]) if len(b)]


# ---- phrases ----


def packed(words):
    return sum(w << (phrases.BITS * (phrases.LONGEST - 1 - i)) for i, w in enumerate(words))


def test_trie_counts_and_leaves_whole_subtrees():
    rng = random.Random(4)
    trie, want, gone = phrases.Trie(burst=4, depth=3), Counter(), Counter()
    for _ in range(4000):
        window = packed([rng.choice([1, 2, 3, 65_535]) for _ in range(rng.randint(1, 4))])
        n = rng.randint(1, 3)
        trie.add(window, n)
        want[window] += n
        if trie.size > 150:
            left = trie.leave(60)
            gone.update(dict(left))
            opened = {w >> 48 for w, _ in left}
            assert trie.size <= 60 and not opened & set(trie.root)
    assert any(type(child) is phrases.Node for child in trie.root.values())
    gone.update(dict(trie.leave(0)))
    assert gone == want and trie.size == 0 and not trie.root


def test_runs_are_sorted_by_words():
    names = [b"", b"b", b"a", "é".encode(), b"a\x01"]
    entries = [(packed(w), n) for n, w in enumerate([(1,), (1, 2), (3, 1, 2, 4), (4, 4), (2,), (2, 3)], 1)]
    run = phrases._run("en", entries, names)
    rows = [tuple(run.column(f"w{i}")[j].as_py() for i in range(1, 5)) for j in range(len(run))]
    assert rows == sorted(rows, key=lambda r: tuple((w or "").encode() for w in r))
    assert run.column("n").to_pylist() == [5, 6, 4, 1, 2, 3]


def plain_phrases(rows, least, share, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            inside = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= share * a for b in inside):
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            yield lang, rank, phrase.decode(), -a, left, right, n[lang], -score


def phrase_documents(seed):
    rng = random.Random(seed)
    vocabulary = ["of", "the", "New", "york", "new", "état", "a\x01", "a", "b\x00c", "x" * 40]
    rows = []
    for _ in range(80):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            words += ["city", "of", "New", "York"]
        rows.append((rng.choice(["en", "fr", None, ""]), "".join(w + rng.choice([" ", "\t ", ", ", "\n", " "]) for w in words)))
    return rows + [("en", None), ("en", ""), ("de", " . ,"), rows[0], rows[0]]


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"FULL": 40, "PENDING": 10}), (3, {"NAMES": 8}), (4, {"FULL": 0, "PENDING": 0, "NAMES": 12})])
def test_phrases(spark, small_batches, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(phrases, name, value)
    rows = phrase_documents(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 as n", "2 as phrase", "3 as w1", "4 as rank").repartition(3)
    found = phrases.collocations(docs, least=4, top=25)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(map(tuple, found.collect())) == Counter(plain_phrases(rows, 4, 80, 25))


def test_phrase_scores_beyond_64_bits(spark):
    rows = [("en", "a", 1, 9 * 10**14), ("en", "b", 1, 9 * 10**14 + 7), ("en", "a b", 2, 9 * 10**14 - 1)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, size int, a long")).first()
    assert got.score == 2_000_000 * (9 * 10**14 - 1) // (18 * 10**14 + 7)


def test_phrases_of_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


# ---- divergence ----


def plain_divergence(rows, least, top):
    tokens = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for lang, source, text in rows]
    for lang in {t[0] for t in tokens}:
        mine = [(s, w) for x, s, w in tokens if x == lang]
        held = Counter(t for _, w in mine for t in set(w))
        kept = sorted(t for t, n in held.items() if n >= least)
        counts = {s: Counter() for s, _ in mine}
        for s, w in mine:
            counts[s].update(t for t in w if t in set(kept))
        whole = sum(counts.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in counts.items():
            pairs = sorted((-sum(abs(p(c, t) - p(o, t)) for t in kept), x.encode()) for x, o in counts.items() if x != s)
            terms = sorted((p(whole, t) - p(c, t), t.encode()) for t in kept if c[t] and p(c, t) > p(whole, t))[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(found, 1):
                    yield lang, s, part, item.decode(), -value, rank


def divergence_documents(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdé" for b in "xyzZ"]
    rows = []
    for _ in range(90):
        words = [rng.choice(vocabulary[: rng.randint(1, 20)]) for _ in range(rng.randint(0, 25))]
        rows.append((rng.choice(["en", "en", "fr", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", None, "é"]), rng.choice([" ", "1", "\x00", "-"]).join(words)))
    return rows + [("de", "only", "one two"), ("de", "other", None), ("xx", None, ""), rows[0], rows[0]]


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"SEGMENT": 4}), (3, {"LEADING": 1, "COMBINED": 10, "BLOCK": 2}), (4, {"SEGMENT": 1, "NAMES": 3})])
def test_divergence(spark, small_batches, monkeypatch, seed, limits):
    for name, value in limits.items():
        monkeypatch.setattr(divergence, name, value)
    rows = divergence_documents(seed)
    docs = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 as term", "2 as n", "3 as total").repartition(3)
    found = divergence.divergence(docs, least=4, top=3)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert Counter(map(tuple, found.collect())) == Counter(plain_divergence(rows, 4, 3))


def test_shares_beyond_64_bits():
    counts = [0, 3 * 10**12, 10**14]
    assert divergence.shares(2 * 10**14, 77, counts) == [1 + 10**9 * (n + 5) // (2 * 10**14 + 385) for n in counts]


def test_divergence_of_no_rows(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.divergence(docs).count() == 0


def test_vocabulary_order_makes_fewer_runs(spark):
    rows = [("en", f"s{s}", f"t{t:03d}", 1 + (t * 7) % 5 + s) for t in range(200) for s in range(3)]
    counts = spark.createDataFrame(rows, "lang string, source string, term string, n long")
    docs = counts.select("lang", "source").distinct()
    groups = divergence.group_sizes(docs, counts)
    columns = divergence.columns_of_runs(counts, divergence.vocabulary(counts, groups), groups)
    runs = columns.selectExpr("sum(size(runs.ends)) as n").first().n
    assert runs == 4 * 5  # five different counts in each of three sources and in their sum


def test_hash_of_kept_text(spark):
    found = {r.doc_id: r.kept_sha256 for r in QUERIES["op13_line_dedup"](spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert found == {k: hashlib.sha256(t.encode()).hexdigest() for k, _, _, t in plain_lines(rows)}
