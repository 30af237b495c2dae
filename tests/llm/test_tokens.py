"""Encoding, counting and packing against the tokenizers library and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from legwork.llm import bpe, packing, token_counts, tokens
from legwork.llm.queries import BYTE_BPE, QUERIES, WORD_BPE

SF = "/root/testdata/sf0.001"
LETTERS = "aAbB eé́ÉΣς İſK\x1c\x1f\x85\xa0  \n\t'sDLL're 19½漢字🙂🏽#$.,%"


def odd_texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40)))
        if i % 3 == 0:
            text = "".join(chr(rng.choice([32, rng.randint(32, 0x2FF), rng.randint(0x300, 0x2FFF), rng.randint(0x10000, 0x1F9FF)])) for _ in range(20))
        if i % 5 == 0:
            text += rng.choice(["<|endoftext|>", " <|startoftext|> "]) + text
        yield text
    yield from ["", " ", "\n", "a" * 3000, "ab " * 400, "".join(rng.choice("abc") for _ in range(2000)), "x  y", " <|endoftext|>"]


def test_word_encoder_is_the_librarys():
    library, own = Tokenizer.from_file(WORD_BPE), bpe.Encoder(WORD_BPE)
    for text in odd_texts(1500, 1):
        assert np.frombuffer(own.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_long_and_short_words_merge_alike():
    own, rng = bpe.Encoder(WORD_BPE), random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("abcdeth") for _ in range(rng.randint(2, 90))).encode()
        parts = [own.inner[b] for b in word[:-1]] + [own.last[word[-1]]]
        assert own.merge(word) == own._merge_long(parts)


def test_byte_encoder_is_the_librarys():
    library, own = Tokenizer.from_file(BYTE_BPE), tokens.ByteEncoder(BYTE_BPE)
    for text in odd_texts(3000, 2):
        assert np.frombuffer(own.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def texts_of(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op3(spark):
    library = Tokenizer.from_file(WORD_BPE)
    found = {r.doc_id: r for r in QUERIES["op3_bpe"](spark, SF).collect()}
    for key, text in texts_of(spark).items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[key].n_tokens == len(ids)
        assert found[key].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[key].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_op3_odd_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", None), (3, "Hé <|endoftext|> a", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = bpe.decode_documents(bpe.encode_documents(docs, WORD_BPE), WORD_BPE).collect()
    by = {r.doc_id: r for r in coded}
    assert len(coded) == 4 and by[1].ids == [] and by[1].decoded == "" and by[2].ids == []
    assert by[3].decoded == Tokenizer.from_file(WORD_BPE).decode(by[3].ids, skip_special_tokens=False)
    lists = spark.createDataFrame([(1, [320, -1, 10**8]), (2, None), (3, [None, 320])], "doc_id long, ids array<int>")
    assert {r.decoded for r in bpe.decode_documents(lists, WORD_BPE).collect()} == {"a</w>", ""}
    assert bpe.encode_documents(docs.limit(0), WORD_BPE).count() == 0


def check_packing(rows, capacity, key):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_op7(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    rows = QUERIES["op7_best_fit_packing"](spark, SF).collect()
    n_bins = check_packing(rows, 1024, "doc_id")
    total = sum(r.length for r in rows)
    assert n_bins <= -(-total // 1024) * 1.02 + 1
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    for key, text in texts_of(spark).items():
        ids = library.encode(text, add_special_tokens=False).ids + [2]
        start = 0
        for i, r in enumerate(sorted(by[key], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, start)
            assert r.length == 1024 or i == 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[start : start + r.length], "<u4").tobytes())
            start += r.length
        assert start == len(ids)


def optimum(items, capacity):
    """Fewest bins by search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            go(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1 :])
        go(i + 1, rooms + [capacity - items[i]])

    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 30])
    items = [rng.randint(1 + capacity // 10 * rng.choice([0, 1]), capacity) for _ in range(rng.randint(1, 11))]
    fixed, rest = packing.reduce_instance(Counter(items), capacity)
    used = Counter(s for p, n in fixed.items() for s in p for _ in range(n))
    assert used + Counter(rest) == Counter(items)
    assert all(sum(p) <= capacity for p in fixed)
    left = [s for s, n in rest.items() for _ in range(n)]
    assert sum(fixed.values()) + optimum(left, capacity) == optimum(items, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_plan_holds_each_item_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 100): rng.randint(1, 10**6) for _ in range(60)}
    plan = packing.plan_bins(counts, 100)
    used = Counter()
    for pattern, n in plan.items():
        assert sum(pattern) <= 100 and n > 0
        for size in pattern:
            used[size] += n
    assert used == Counter(counts)


def test_op7_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "word " * 3000, 3)] + [(k, "same text", 4) for k in range(10, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    packed = packing.pack_documents(docs, BYTE_BPE, capacity=64).collect()
    check_packing(packed, 64, "doc_id")
    assert sum(r.length for r in packed if r.doc_id == 1) == 2 and len({r.doc_id for r in packed}) == 293
    assert packing.pack_documents(docs.limit(0), BYTE_BPE).collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 65)], "k int, length long"), 64, ["k"])


def test_ranks_are_dense_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_ROWS", 100)
    rows = spark.range(3000).selectExpr("id", "if(id < 2000, 7, 8) as length")
    got = defaultdict(list)
    for r in packing.ranked(rows, "length", ["id"], 3000).collect():
        got[r.length].append(r._rank)
    assert sorted(got[7]) == [*range(2000)] and sorted(got[8]) == [*range(1000)]


def test_op9(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    lengths = [len(library.encode(t, add_special_tokens=False).ids) for t in texts_of(spark).values()]
    rows = QUERIES["op9_token_counts"](spark, SF).collect()
    assert {r.length: r.docs for r in rows} == Counter(lengths)
    for r in rows:
        limit = r.length
        assert r.tokens == limit * r.docs
        assert r.docs_at_least == sum(n >= limit for n in lengths)
        assert r.tokens_at_least == sum(n for n in lengths if n >= limit)
        assert r.docs_at_most == sum(n <= limit for n in lengths)
        assert r.truncated_total == sum(min(n, limit) for n in lengths)


def test_op9_limits_and_odd_rows(spark):
    rows = [(None,), ("",), ("a b c",), ("a b c",), ("word " * 5000,)]
    docs = spark.createDataFrame(rows, "text string").selectExpr("text", "1 as length", "2 as docs")
    sums = token_counts.suffix_sums(token_counts.length_histogram(docs, BYTE_BPE))
    lengths = sorted([0, 0, 3, 3, 5001])
    got = {r.context_limit: (r.docs_cut, r.tokens, r.tokens_lost) for r in token_counts.truncated_totals(sums, [0, 2, 3, 9000]).collect()}
    for limit, found in got.items():
        tokens_left = sum(min(n, limit) for n in lengths)
        assert found == (sum(n > limit for n in lengths), tokens_left, sum(lengths) - tokens_left)
    assert len(got) == 4
    shares = {r.share: r.length for r in token_counts.quantiles(sums, [0.4, 0.5, 0.8, 1.0]).collect()}
    assert shares == {0.4: 0, 0.5: 3, 0.8: 3, 1.0: 5001}
    empty = token_counts.suffix_sums(token_counts.length_histogram(docs.limit(0), BYTE_BPE))
    assert empty.count() == 0 and token_counts.truncated_totals(empty, [1]).count() == 0
    assert token_counts.quantiles(empty, [0.5]).count() == 0
