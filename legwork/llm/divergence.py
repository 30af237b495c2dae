"""How far the word use of each source of a language is from its other sources and from the language.

Terms are runs of ASCII letters and of characters beyond ASCII, A-Z in lower case. A language
keeps the terms that at least ``least`` of its documents hold. Each source group, and the
language itself, gives each kept term ``p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``,
with ``N`` the group's count of kept terms and ``V`` the number of kept terms.

Kept terms are sorted so that equal counts lie together: by their counts in the language's
``LEADING`` largest sources. The sorted vocabulary is cut by ranges into segments of bounded
size. In a segment each group is one column of run lengths, zeros included. Two columns meet
by intersecting their run boundaries, and each piece adds ``|p - q|`` times its length, so
work follows the number of runs. The same meeting with the language's own column gives the
runs in which a source exceeds its language; only the best of them become terms again.

All values are whole numbers and exact. Null text, language and source are empty strings.
Repeated rows count each. Any length of text is taken whole. Ties are ranked by name. A
language without kept terms has distance 0 between all its sources and no terms. An empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.byte_words import Words, WordTable, blocks, hashes, words_of
from legwork.llm.chars import mix
from legwork.llm.recurring import counted, in_batches, may_recur, often, recurring, runs_of, taken
from legwork.llm.storage import landed

LEAST, TOP = 30, 50
SCALE, PRIOR = 1_000_000_000, 5
#: Terms of a segment, sources whose counts order the vocabulary, and sources that meet at once.
#: They only set the work and its memory.
SEGMENT, LEADING, BLOCK = 1 << 13, 16, 16
#: Entries that a task combines before they leave it, and words that it numbers.
COMBINED, NAMES = 1 << 20, 400_000

_INSIDE = np.zeros(256, bool)
_INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True


def _read(batches) -> Iterator[tuple[Words, np.ndarray, list[tuple[str, str]]]]:
    """Words of blocks of whole texts, the word hashes, and each text's language and source."""
    for batch in batches:
        groups = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for first, block in blocks(t.as_py() for t in batch.column(2)):
            words = words_of(block, _INSIDE)
            yield words, hashes(words), groups[first : first + len(block)]


def _keys(words: Words, plain: np.ndarray, groups: list[tuple[str, str]]) -> np.ndarray:
    """Hash of each word with its language."""
    langs = np.array([xxhash.xxh3_64_intdigest(lang) for lang, _ in groups], np.uint64)
    return mix(plain ^ langs[words.text])


def _first_in_text(words: Words, plain: np.ndarray) -> np.ndarray:
    """Places of the words that do not occur earlier in their text."""
    order = np.lexsort((plain, words.text))
    new = np.ones(len(order), bool)
    new[1:] = (plain[order][1:] != plain[order][:-1]) | (words.text[order][1:] != words.text[order][:-1])
    return order[new]


def document_counts(docs: DataFrame) -> DataFrame:
    """``key, n``: in how many documents each hashed term occurs."""

    def count(batches):
        yield from counted(_keys(words, plain, groups)[_first_in_text(words, plain)] for words, plain, groups in _read(batches))

    return docs.mapInArrow(count, "key bigint, n bigint")


def term_counts(docs: DataFrame, often_terms) -> DataFrame:
    """``lang, source, term, n, n_docs`` of the terms that may be kept, combined within tasks."""
    names = ["lang", "source", "term", "n", "n_docs"]

    def count(batches):
        table, numbers = WordTable(), {}
        held, size = [], 0

        def flush():
            entries = taken(held)
            starts, n = runs_of(entries >> 1)
            n_docs = np.add.reduceat(entries & 1, starts) if len(starts) else n
            keys = entries[starts] >> 1
            # Each name becomes text once, and rows take theirs by number.
            langs, sources = (pa.array([group[side] for group in numbers], pa.string()) for side in (0, 1))
            terms = pa.array([name.decode("utf-8", "surrogatepass") for name in table.names], pa.string())
            of, term = pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF)
            return in_batches(pa.record_batch([langs.take(of), sources.take(of), terms.take(term), pa.array(n), pa.array(n_docs)], names))

        for words, plain, groups in _read(batches):
            at = np.flatnonzero(may_recur(_keys(words, plain, groups), often_terms.value))
            of = np.array([numbers.setdefault(group, len(numbers)) for group in groups], np.int64)
            opens = np.zeros(len(plain), np.int64)
            opens[_first_in_text(words, plain)] = 1
            # Group, word, and in the lowest bit whether it is the word's first in its text.
            held.append((of[words.text[at]] << 32 | table.numbers(words, at, plain, hashes(words, 1))) << 1 | opens[at])
            size += len(at)
            if size > COMBINED or len(table) > NAMES:
                yield from flush()
                size = 0
                table, numbers = WordTable(), {}
        if held:
            yield from flush()

    return docs.mapInArrow(count, "lang string, source string, term string, n bigint, n_docs bigint")


def kept_counts(docs: DataFrame, least: int) -> DataFrame:
    """``lang, source, term, n`` of the terms that their language keeps."""
    spark = docs.sparkSession
    held = landed(document_counts(docs))
    often_terms = spark.sparkContext.broadcast(recurring(often(held, least, held.count())))
    counts = landed(term_counts(docs, often_terms).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")))
    kept = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= least)
    return counts.join(kept.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "source", "term", "n")


def group_sizes(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, total, kinds, place`` of every group; a null source is the language itself.

    ``total`` is N and ``kinds`` is V; ``place`` numbers a language's sources by size.
    """
    groups = docs.select("lang", "source").distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    kinds = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"))
    found = groups.join(sums, ["lang", "source"], "left").join(kinds, "lang", "left").fillna(0, ["total", "kinds"])
    by_size = Window.partitionBy("lang").orderBy(F.desc("total"), "source")
    placed = landed(found.withColumn("place", F.row_number().over(by_size)))
    whole = placed.groupBy("lang").agg(F.sum("total").alias("total"), F.max("kinds").alias("kinds"))
    return placed.unionByName(whole.select("lang", F.lit(None).cast("string").alias("source"), "total", "kinds", F.lit(0).alias("place")))


def vocabulary(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, term, n, segment, position``: kept terms in an order that puts equal counts together."""
    leading = groups.where((F.col("place") > 0) & (F.col("place") <= LEADING)).select("lang", "source", "place")
    placed = counts.join(leading, ["lang", "source"], "left")
    few = F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", (-F.col("n")).alias("_n"))))
    terms = landed(placed.groupBy("lang", "term").agg(F.sort_array(few).alias("_order"), F.sum("n").alias("n")))
    n_segments = max(1, -(-terms.count() // SEGMENT))
    order = ["lang", "_order", "n", "term"]
    ranged = terms.repartitionByRange(n_segments, *order).sortWithinPartitions(*order)

    def number(batches):
        at = 0
        for batch in batches:
            positions = pa.array(np.arange(at, at + len(batch)), pa.int64())
            at += len(batch)
            yield pa.record_batch([*batch.columns[:3], batch.column(3), positions], ["lang", "term", "n", "part", "position"])

    numbered = ranged.select("lang", "term", "n", F.spark_partition_id().alias("part"))
    numbered = numbered.mapInArrow(number, "lang string, term string, n bigint, part int, position bigint")
    # However unevenly the ranges fall, no segment has more than SEGMENT terms.
    segment = F.col("part").cast("bigint") * F.lit(1 << 32) + F.floor(F.col("position") / SEGMENT)
    return landed(numbered.select("lang", "term", "n", segment.alias("segment"), (F.col("position") % SEGMENT).cast("int").alias("position")))


def shares(total: int, kinds: int, counts: list[int]) -> list[int]:
    """The p of each count."""
    return [1 + SCALE * (n + PRIOR) // (total + PRIOR * kinds) for n in counts]


def lists_of(parts: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """One list per array, without a Python object per value."""
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]), kind))


def run_lengths(low: Column, high: Column, entries: Column, total: Column, kinds: Column) -> Column:
    """A column's runs over the positions ``low`` to ``high``: where each ends, its count and its p."""

    @F.arrow_udf("struct<ends: array<int>, counts: array<bigint>, p: array<bigint>>")
    def encode(first: pa.Array, last: pa.Array, rows: pa.Array, totals: pa.Array, sizes: pa.Array) -> pa.Array:
        places, held, p = [], [], []
        for a, b, row, n, v in zip(first.to_pylist(), last.to_pylist(), rows, totals.to_pylist(), sizes.to_pylist()):
            dense = np.zeros(b - a + 1, np.int64)
            if row.is_valid and len(row.values):
                dense[row.values.field("position").to_numpy() - a] = row.values.field("n").to_numpy()
            ends = np.append(np.flatnonzero(np.diff(dense)) + 1, len(dense))
            counts = dense[ends - 1]
            places.append(ends + a)
            held.append(counts)
            p.append(np.array(shares(n, v, counts.tolist()), np.int64))
        return pa.StructArray.from_arrays([lists_of(places, pa.int32()), lists_of(held), lists_of(p)], ["ends", "counts", "p"])

    return encode(low, high, entries, total, kinds)


def columns_of_runs(counts: DataFrame, words: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, segment, source, low, runs``: a row per group and segment of its language."""
    segments = words.groupBy("lang", "segment").agg(F.min("position").alias("low"), F.max("position").alias("high"))
    places = words.select("lang", "term", "segment", "position")
    own = counts.join(places, ["lang", "term"]).select("lang", "segment", "source", "position", "n")
    whole = words.select("lang", "segment", F.lit(None).cast("string").alias("source"), "position", "n")
    entries = own.unionByName(whole).groupBy("lang", "segment", "source").agg(F.collect_list(F.struct("position", "n")).alias("entries"))
    wanted = groups.select("lang", F.col("source").alias("_source"), "total", "kinds").join(segments, "lang")
    same = (F.col("e.lang") == F.col("w.lang")) & (F.col("e.segment") == F.col("w.segment")) & F.col("e.source").eqNullSafe(F.col("w._source"))
    both = wanted.alias("w").join(entries.alias("e"), same, "left")
    runs = run_lengths(F.col("low"), F.col("high"), F.col("entries"), F.col("total"), F.col("kinds"))
    return landed(both.select("w.lang", "w.segment", F.col("w._source").alias("source"), "low", runs.alias("runs")))


def _meet(low: int, left, right) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces between the boundaries of two run columns: ends, lengths and the run of each side."""
    a, b = (side["ends"].values.to_numpy() for side in (left, right))
    ends = np.union1d(a, b)
    return ends, np.diff(ends, prepend=low), np.searchsorted(a, ends), np.searchsorted(b, ends)


def _distances(lang: str, rows: pa.Table, same: bool) -> pa.Table:
    """Sum of ``|p - q|`` over a segment, of the pairs within one block of sources or across two."""
    rows = rows.sort_by("place").combine_chunks()
    blocks, sources = rows.column("block").to_pylist(), rows.column("source").to_pylist()
    runs, low = rows.column("runs").combine_chunks(), rows.column("low").to_pylist()
    found = []
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if same or blocks[i] != blocks[j]:
                _, lengths, x, y = _meet(low[i], runs[i], runs[j])
                p, q = runs[i]["p"].values.to_numpy()[x], runs[j]["p"].values.to_numpy()[y]
                found.append((sources[i], sources[j], int((np.abs(p - q) * lengths).sum())))
    columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.string(), pa.int64()))]
    return pa.table([pa.array([lang] * len(found), pa.string()), *columns], ["lang", "source", "item", "value"])


def excesses(low: Column, left: Column, right: Column) -> Column:
    """Pieces where the left column counts and exceeds the right one: first position, one past the last, excess."""

    @F.arrow_udf("array<struct<start: int, stop: int, value: bigint>>")
    def cut(lows: pa.Array, lefts: pa.Array, rights: pa.Array) -> pa.Array:
        starts, stops, values = [], [], []
        for at, one, two in zip(lows.to_pylist(), lefts, rights):
            ends, lengths, i, j = _meet(at, one, two)
            over = one["p"].values.to_numpy()[i] - two["p"].values.to_numpy()[j]
            on = np.flatnonzero((over > 0) & (one["counts"].values.to_numpy()[i] > 0))
            starts.append((ends - lengths)[on])
            stops.append(ends[on])
            values.append(over[on])
        first, last, value = lists_of(starts, pa.int32()), lists_of(stops, pa.int32()), lists_of(values)
        pieces = pa.StructArray.from_arrays([first.values, last.values, value.values], ["start", "stop", "value"])
        return pa.ListArray.from_arrays(first.offsets, pieces)

    return cut(low, left, right)


def pair_distances(columns: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value`` of all ordered pairs of a language's sources.

    Sources lie in blocks of ``BLOCK``. A task meets the columns of two blocks in one
    segment at a time, so a column moves once per block and not once per pair.
    """
    block = F.floor((F.col("place") - 1) / BLOCK).cast("int")
    named = groups.where("source is not null").select("lang", "source", "place", block.alias("block"))
    last = named.groupBy("lang").agg(F.max("block").alias("_last"))
    own = columns.where("source is not null").join(named, ["lang", "source"]).join(last, "lang")
    met = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    met = met.withColumns({"_a": F.least("block", "_other"), "_b": F.greatest("block", "_other")})

    def meet(key, table):
        return _distances(key[0].as_py(), table, key[2] == key[3])

    sums = met.select("lang", "segment", "_a", "_b", "source", "place", "block", "low", "runs").groupBy("lang", "segment", "_a", "_b")
    sums = sums.applyInArrow(meet, "lang string, source string, item string, value bigint")
    sums = landed(sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    names = named.select("lang", "source")
    pairs = names.join(names.withColumnRenamed("source", "item"), "lang").where("source <> item")
    return pairs.join(both, ["lang", "source", "item"], "left").fillna(0, ["value"])


def top_terms(columns: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank``: terms by which each source exceeds its language most.

    Runs are ranked first, ties kept; only those that can hold one of the best are expanded.
    """
    whole = columns.where("source is null").select("lang", "segment", F.col("runs").alias("_whole"))
    own = columns.where("source is not null").join(whole, ["lang", "segment"])
    pieces = own.select("lang", "segment", "source", F.inline(excesses(F.col("low"), F.col("runs"), F.col("_whole"))))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = pieces.withColumn("_r", F.rank().over(by_value)).where(F.col("_r") <= top)
    places = best.select("lang", "segment", "source", "value", F.explode(F.sequence("start", F.col("stop") - 1)).alias("position"))
    named = places.join(words.select("lang", "segment", "position", F.col("term").alias("item")), ["lang", "segment", "position"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "source", "item", "value", "rank")


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` against each other source, part ``term`` against the language."""
    empty = lambda name: F.coalesce(F.col(name), F.lit("")).alias
    rows = docs.select(empty(lang)("lang"), empty(source)("source"), empty(text)("text"))
    counts = landed(kept_counts(rows, least))
    groups = landed(group_sizes(rows, counts))
    words = vocabulary(counts, groups)
    columns = columns_of_runs(counts, words, groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_distances(columns, groups).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    terms = top_terms(columns, words, top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
