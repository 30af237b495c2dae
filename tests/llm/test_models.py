"""Language filters, quality classifier, secret field and URL models against brute force and held-out rows."""

import hashlib
import itertools
import math
import pickle
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from legwork.llm import language, quality, secret_scan, urls
from legwork.llm.queries import QUERIES, URL_RULES

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- language ----


def test_filters_hold_their_grams():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 62, 5000).astype(np.uint64)
    owners = rng.integers(0, 20, 5000)
    filters = language.build_filters([f"l{i}" for i in range(20)], grams, owners)
    bits = np.unpackbits(filters.masks(grams), axis=1, bitorder="little")
    assert bits[np.arange(5000), owners].all()
    others = rng.integers(0, 1 << 62, 20000).astype(np.uint64)
    false = np.unpackbits(filters.masks(others), axis=1, bitorder="little")[:, :20].mean(0)
    assert np.allclose(false, filters.false_rate, atol=0.01)


def test_trigrams_are_those_inside_words():
    text = "Eß  d'été!\n12x"
    words = ["eß", "d", "été", "x"]
    want = sorted(f" {w} "[i : i + 3] for w in words for i in range(len(w)))
    got = sorted("".join(chr(int(k) >> s & 0x1FFFFF) for s in (42, 21, 0)) for k in language.trigrams(text))
    assert got == want


def test_op1_learns_on_its_fold_only(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, LARGER).collect()}
    langs = {r.doc_id: r.lang for r in docs.collect()}
    assert rows.keys() == langs.keys()
    for key, row in rows.items():
        assert row.held_out == (zlib.crc32(str(key).encode()) % 4 == 2) and 0 <= row.score <= 1
    held = [rows[k].lang_pred == lang for k, lang in langs.items() if rows[k].held_out]
    assert sum(held) / len(held) > 0.98
    # other labels in the held-out fold change nothing
    spoiled = docs.withColumn("lang", F.when(language.held_out(), "zz").otherwise(F.col("lang")))
    filters = language.train(spoiled.where(~language.held_out()))
    again = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, filters).select("doc_id", "lang_pred", "score").collect()}
    assert again == {k: (r.lang_pred, r.score) for k, r in rows.items()}


def test_op1_odd_rows(spark):
    learn = spark.createDataFrame([(1, "der die das und nicht", "de"), (2, "the and that with", "en"), (3, "x", None), (4, None, "fr")], "doc_id long, text string, lang string")
    filters = language.train(learn)
    assert filters.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 !"), (4, "the that"), (4, "the that"), (5, "nicht " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as score", "1 as _lang")
    found = language.predict(docs, filters).collect()
    by = {r.doc_id: (r.lang_pred, round(r.score, 3)) for r in found}
    assert len(found) == 6 and by[1] == by[2] == by[3] == ("und", 0.0) and by[4] == ("en", 1.0) and by[5] == ("de", 1.0)
    kept = language.keep_clear(docs, filters)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, 5}
    nobody = language.train(learn.limit(0))
    assert {r.lang_pred for r in language.predict(docs, nobody).collect()} == {"und"}
    assert language.predict(docs.limit(0), filters).count() == 0


# ---- quality ----

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dups = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def test_measures_of_odd_texts():
    model = quality.QualityModel(np.zeros(quality.N_BUCKETS), 0.0, 0.0, 0.0)
    rng = random.Random(4)
    for _ in range(300):
        text = "".join(rng.choice(["a ", "b ", "a b c d e ", "\n", "\x0b", "\x1c", "\xa0", "é#", "x<>", "\t", "\r\n"]) for _ in range(rng.randint(0, 40)))
        assert quality.measure(model, text)[:5] == plain_measures(text), repr(text)
    assert quality.measure(model, None)[:5] == (0, 0, 0, 0, 0)


def test_op4(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = QUERIES["op4_quality_rules"](spark, LARGER).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == plain_measures(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.probability >= quality.KEEP_FROM)
    judged = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels and not r.base_failed]
    assert sum(kept for label, kept in judged if label == 1) >= 0.99 * sum(label == 1 for label, _ in judged)
    assert sum(kept for label, kept in judged if label == 0) <= 0.1 * sum(label == 0 for label, _ in judged)


def test_op4_ranks_rows_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    model = quality.train(docs, labels.where(seen))
    rest = quality.judge(docs.join(labels.where(~seen), "doc_id"), model).where("not base_failed").select("quality", "probability").collect()
    good, bad = ([r.probability for r in rest if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g, b in itertools.product(good, bad)]) > 0.97


def test_op4_probability_is_the_curve_over_the_mean_weights(spark):
    model = quality.QualityModel(np.sin(np.arange(quality.N_BUCKETS)).astype(np.float32), 0.25, 0.7, -0.1)
    texts = ["", "one two two three", "Straße #1\nStraße", "a" * 50, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in docs.select("doc_id", quality.margins_of(F.col("text"), model, spark).alias("m"), quality.measures_of(F.col("text"), model, spark).alias("p")).collect()}
    for i, text in enumerate(texts):
        vector = quality.feature_vector(text)
        margin = 0.25 + sum(float(model.weights[j]) * v for j, v in zip(vector.indices, vector.values))
        assert got[i].m == pytest.approx(margin, abs=1e-4)
        assert got[i].p.probability == pytest.approx(1 / (1 + math.exp(-(0.7 * margin - 0.1))), abs=1e-5)


def test_op4_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 300_000), (4, " ".join(map(str, range(50))))], "doc_id long, text string")
    docs = docs.selectExpr("*", "'x' as kept", "'y' as n_words", "1 as _m")
    few = spark.createDataFrame([(1, 1), (4, 1), (4, 0), (4, None), (None, 1)], "doc_id long, quality int")
    model = quality.train(docs, few)
    rows = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    assert rows[1].base_failed and rows[2].base_failed and rows[3].base_failed and rows[4].kept
    kept = quality.keep_good(docs, model).collect()
    assert [(r.doc_id, r.kept, r.n_words) for r in kept] == [(4, "x", "y")]
    assert quality.judge(docs.limit(0), quality.train(docs, few.limit(0))).count() == 0


# ---- secrets ----


def plain_spans(text):
    found = []
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    found += [("assign", *m.span()) for m in assign.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    order = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def test_base_spans_of_odd_texts():
    rng = random.Random(5)
    parts = ["token", "Secret", "PASSWD", "api_key", "apikey", ":", "=", " ", '"', "'", "abc", "abcdef12", "AKIA", "ABCDEFGH", "12345678", "\n", "ſecret", "é", "0123456789abcdef"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [(k, s, e) for s, e, k, _ in secret_scan.base_spans(text)] == plain_spans(text), text


@pytest.fixture(scope="module")
def field(spark):
    return secret_scan.train(spark.read.parquet(f"{LARGER}/documents.parquet"))


def test_op2(spark):
    rows = QUERIES["op2_secret_scan"](spark, LARGER).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        written = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        kinds = Counter(k for k, _, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert set(written) <= set(filter(None, r.spans.split(",")))
    assert sum("tagged" in r.spans for r in rows if not plain_spans(texts[r.doc_id])) <= 0.01 * len(rows)


def test_field_tags_most_pattern_values_of_unseen_rows(spark, field):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 1000").select("text").collect()]
    want = got = 0
    for text in texts:
        values = [(value, end) for _, end, kind, value in secret_scan.base_spans(text) if kind == "hex"]
        if values:
            spans = field.spans(text)
            want += len(values)
            got += sum(any(s < end and e > start for s, e in spans) for start, end in values)
    assert want > 50 and got > 0.9 * want


def test_rare_matches_of_a_large_table_all_train(spark):
    at = [7, 20_011, 40_013, 60_017, 99_991]
    secret = F.concat(F.lit("set api_key = Zx9"), F.col("id").cast("string"), F.lit("abcdef now"))
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.when(F.col("id").isin(at), secret).otherwise(F.lit("plain words only")).alias("text"))
    rows = secret_scan.training_rows(docs, "doc_id", "text", 50).collect()
    assert sum(secret_scan.BEGIN in r.tags for r in rows) == len(at) and len(rows) == len(at) + 50


def test_screened_decoding_is_viterbi_over_the_whole_text(field):
    rng = random.Random(6)
    words = ["the", "token", "=", '"', "04dbebab91ab85687d33", "AKIAABCDEFGHIJKL", "ofer.", "12", "Xk92kd83"]
    for _ in range(200):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 30)))
        tokens = secret_scan._TOKEN.findall(text)
        at = field.row_ids(tokens)
        scores = field.emissions(at, np.arange(len(at)), field.file_scores(at))
        tags = secret_scan.viterbi(scores, field.moves)
        spans, inside = [], False
        for m, tag in zip(secret_scan._TOKEN.finditer(text), tags):
            if tag == secret_scan.INSIDE and inside:
                spans[-1] = (spans[-1][0], m.end())
            elif tag:
                spans.append((m.end() - len(m.group().lstrip()), m.end()))
            inside = tag > 0
        assert spans == field.spans(text)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(7)
    for n in (1, 2, 5):
        scores, moves = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))

        def total(path):
            whole = [0, *path, 0]
            return sum(moves[a, b] for a, b in zip(whole, whole[1:])) + sum(scores[i, y] for i, y in enumerate(path))

        assert tuple(secret_scan.viterbi(scores, moves)) == max(itertools.product(range(3), repeat=n), key=total)


def test_op2_keeps_features_when_tokens_turn_over(monkeypatch):
    weights = np.random.default_rng(3).normal(size=(secret_scan.BUCKETS, 3)).astype(np.float32)
    draw = random.Random(3)
    texts = [" ".join("".join(draw.choices("abcé", k=draw.choice((3, 5, 12)))) for _ in range(40)) for _ in range(30)]
    texts += ["Known KNOWN known kNown Ω ΩΩ 12 0f0f0f0f0f x_1 漢字 ﬁn ª Ǆa ǅa", "known " + "z" * 90 + " " + "Q" * 12]
    field = secret_scan.Field(weights, np.zeros((3, 3)), {"known", "aaa"})
    whole = secret_scan.Field(weights, np.zeros((3, 3)), {"known", "aaa"})
    made, real = [], secret_scan.own_features
    monkeypatch.setattr(secret_scan, "own_features", lambda key: made.append(key) or real(key))
    monkeypatch.setattr(secret_scan, "CACHED_TOKENS", 60)
    for text in texts * 2:
        tokens = secret_scan._TOKEN.findall(text)
        at = field.row_ids(tokens)
        for token, i in zip(tokens, at):
            key = secret_scan.token_key(token, whole.vocabulary)
            assert field.by_key[key] == i, token
            assert np.array_equal(field.rows[i, 0], weights[real(key)].sum(0))
    assert len(field) <= 60 // 2 + 40 and len(made) == len(set(made))


def test_op2_odd_rows(spark, field):
    field = pickle.loads(pickle.dumps(field))
    long = "the and " * 200_000 + "token = abcdef12"
    rows = [(1, None), (2, ""), (3, 'x token = "abcdef12" y'), (3, 'x token = "abcdef12" y'), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'z' as spans", "length(text) as n_chars")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secret_scan.scan(docs, field).collect()}
    assert found == {1: [], 2: [], 3: [("assign", 2, 19)], 4: [("assign", 1_600_000, 1_600_016)]}
    clean = {r.doc_id: r for r in secret_scan.redact(docs, field).collect()}
    assert clean[1].text is None and clean[2].text == "" and clean[3].text == 'x token = "[SECRET]" y'
    assert clean[3].n_chars == len(clean[3].text) and clean[3].spans == "z" and clean[4].text.endswith("token = [SECRET]")
    empty = secret_scan.train(docs.limit(0))
    assert secret_scan.scan(docs.limit(0), empty).count() == 0 and empty.spans("token abc") == []


# ---- URLs ----


def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    tail = rest[len(host) :]
    path = re.split(r"[?#]", tail, maxsplit=1)[0] if tail.startswith("/") else ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = []
    for rule in URL_RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def test_op10(spark):
    known = {r.page_id: r.url for r in spark.read.parquet(f"{LARGER}/pages.parquet").collect()}
    rows = QUERIES["op10_url_filter"](spark, LARGER).collect()
    assert {r.page_id for r in rows} == known.keys()
    for r in rows:
        host, path = plain_host_path(known[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (URL_RULES[rule] if rule else "allow" if r.accept_probability >= 0.5 else "block")
    agree = [r.verdict == ("allow" if r.accept_probability >= 0.5 else "block") for r in rows if r.rule]
    assert sum(agree) > 0.95 * len(agree)


def test_op10_odd_rows(spark):
    odd = [None, "", "no scheme", "://", "http://", "HTTP://A.NET/x", "http://net/", "http://net", "http://xnet/a", "http://a.net?x/y", "http://a.org#/fr/", "http://B.ORG/fr/é?q#f", "x://y://example.net/en/", "http://example.net/en/" + "a" * 100_000]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(odd * 2)], "page_id long, url string").selectExpr("*", "1 as host", "2 as verdict", "3 as _difference")
    rows = urls.judge(pages, URL_RULES).collect()
    assert len(rows) == 2 * len(odd) and urls.judge(pages.limit(0), URL_RULES).count() == 0
    for r in rows:
        host, path = plain_host_path(odd[r.page_id % len(odd)])
        assert (r.host, r.path, r.rule) == (host, path, plain_rule(host, path)) and r.verdict in ("allow", "block")
    same = {}
    for r in rows:
        assert same.setdefault(r.page_id % len(odd), r.verdict) == r.verdict


def test_url_models_smooth_and_count(spark):
    rows = [(i, f"http://good{i % 7}.org/a", True) for i in range(60)] + [(100 + i, f"http://bad{i % 5}.net/b", False) for i in range(60)]
    models = urls.train(spark.createDataFrame(rows, "page_id long, url string, accepted boolean"), "page_id")
    good, bad, other = models.probability(models.differences(["http://good9.org/a", "http://bad9.net/b", ""]))
    assert good > 0.9 and bad < 0.1 and 0 < other < 1
    n_chars = sum(len(u) + 1 for k, u, ok in rows)
    counted = spark.createDataFrame(rows, "page_id long, url string, accepted boolean")
    assert urls.cell_counts(counted).where("kind = 1").agg(F.sum("n")).first()[0] == n_chars * (urls.ORDER + 1)


def plain_differences(known, urls_asked, order=5, backing=2.0):
    counts = [Counter(), Counter()]
    for url, accepted in known:
        text = "\x02" * order + url + "\x03"
        for i in range(order, len(text)):
            for k in range(order + 1):
                counts[accepted][0, text[i - k : i], k] += 1
                counts[accepted][1, text[i - k : i + 1], k] += 1
    found = []
    for url in urls_asked:
        text, total = "\x02" * order + url + "\x03", 0.0
        for i in range(order, len(text)):
            for sign, held in ((-1, counts[0]), (1, counts[1])):
                p = 1 / 256
                for k in range(order + 1):
                    p = (held[1, text[i - k : i + 1], k] + backing * p) / (held[0, text[i - k : i], k] + backing)
                total += sign * np.log(p)
        found.append(total / (len(url) + 1))
    return found


@pytest.mark.parametrize("common", [0.0, 1 / 200, 1.0])
def test_url_counts_are_exact_beyond_any_table_size(spark, monkeypatch, common):
    """More distinct strings than the 262,144 cells that once held them, and URLs whose strings are all unseen."""
    monkeypatch.setattr(urls, "COMMON", common)
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789éß漢"
    rows = [(i, "http://" + "".join(rng.choices(letters, k=30)) + (".org/" if i % 2 else ".net/"), i % 2 == 1) for i in range(4000)]
    labelled = spark.createDataFrame(rows, "page_id long, url string, accepted boolean")
    counted = urls.cell_counts(labelled)
    assert counted.where("kind = 1").count() > 1 << 18
    models = urls.UrlModels(urls.gram_counts(urls._by_text(labelled, "url", urls._label_sums()), "_url", ["rejected", "accepted"]))
    asked = [rows[0][1], rows[1][1], "http://漢漢漢漢漢漢漢漢.org/", "ZZZZZZZZ", "", "aaaaaaaaaaaaaaaa", "\x00\x02\x03"] + ["http://q.net/"] * 2
    assert models.differences(asked) == pytest.approx(plain_differences([r[1:] for r in rows], asked), abs=1e-12)
