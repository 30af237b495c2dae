"""Language by bit-sliced Bloom filters of character trigrams.

The filters of all languages share their positions: a cell holds one bit per language,
so the AND of a trigram's cells is the set of languages that contain it. A text's count
per language, less the false positives its filter's fill makes expected, decides.

A language contains a trigram whose share of all its training trigrams reaches
``MIN_RATE`` and ``MIN_SHARE`` of the share in the language where it is most common;
so a filter holds at most 1 / MIN_RATE trigrams, whatever the corpus.

Null texts and texts without a letter are ``und`` with score 0; ties go to the language
with more training documents, then to the smaller name. Without any labelled text
everything is ``und``. Columns ``lang_pred`` and ``score`` of the input are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.llm.chars import code_points, has_letter, mix, slices, word_letters
from legwork.llm.storage import free_name

#: Training documents of one language at most, chosen by a hash of their key.
TRAIN_DOCS = 4_000
MIN_RATE = 1e-5
MIN_SHARE = 0.1
HASHES = 4
CELLS_PER_GRAM = 12
#: Trigrams counted together before they leave a task.
COUNTED = 1 << 21
UNKNOWN = "und"


def trigrams(text: str) -> np.ndarray:
    """Keys of the trigrams inside words, which are lower-cased and end in a blank on both sides."""
    codes = code_points(f" {text.lower()} ")
    codes = np.where(word_letters()[codes], codes, np.uint32(32))
    blank = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    codes = codes[keep].astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(0, np.uint64)
    keys = (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]
    return keys[codes[1:-1] != 32]


@dataclass
class LanguageFilters:
    languages: list[str]
    cells: np.ndarray  # (positions, bytes): one bit per language
    false_rate: np.ndarray

    def positions(self, keys: np.ndarray) -> list[np.ndarray]:
        hashed = mix(keys)
        step = (hashed >> np.uint64(32)) | np.uint64(1)
        last = np.uint64(len(self.cells) - 1)
        return [((hashed + np.uint64(i) * step) & last).astype(np.int64) for i in range(HASHES)]

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """Bytes whose bits are the languages that contain each trigram."""
        first, *rest = self.positions(keys)
        found = self.cells[first]
        for at in rest:
            found &= self.cells[at]
        return found

    def corrected(self, text: str) -> tuple[np.ndarray, int]:
        """Trigrams of the text in each language, and in all."""
        counts, n = np.zeros(len(self.languages)), 0
        for part in slices(text):
            keys = trigrams(part)
            n += len(keys)
            bits = np.unpackbits(self.masks(keys), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)[: len(self.languages)]
        return np.clip((counts - n * self.false_rate) / (1 - self.false_rate), 0, n), n

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        counts, n = self.corrected(text)
        if not n:
            return UNKNOWN, 0.0
        best = int(counts.argmax())
        return self.languages[best], float(counts[best] / n)


def build_filters(languages: list[str], grams: np.ndarray, owners: np.ndarray) -> LanguageFilters:
    """Filters from trigram keys and the place of each one's language."""
    width = max(1, -(-len(languages) // 8))
    size = 1 << max(10, int(np.ceil(np.log2(CELLS_PER_GRAM * max(1, len(np.unique(grams)))))))
    found = LanguageFilters(languages, np.zeros((size, width), np.uint8), np.zeros(len(languages)))
    byte, bit = owners // 8, np.left_shift(np.uint8(1), (owners % 8).astype(np.uint8))
    for at in found.positions(grams):
        np.bitwise_or.at(found.cells, (at, byte), bit)
    fill = np.unpackbits(found.cells, axis=1, bitorder="little").mean(axis=0)[: len(languages)]
    found.false_rate = fill**HASHES
    return found


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, gram, n`` over the documents, summed in tasks before the shuffle."""

    def count(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            for name, parts in held.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )
            held.clear()

        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                for part in slices(content.as_py()):
                    keys = trigrams(part)
                    held.setdefault(name.as_py(), []).append(keys)
                    size += len(keys)
                if size > COUNTED:
                    yield from flush()
                    size = 0
        yield from flush()

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", max_docs: int = TRAIN_DOCS) -> LanguageFilters:
    """Filters of the languages labelled in ``docs``, from at most about ``max_docs`` documents of each.

    The driver sees one row per language and the trigrams that the filters hold.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    per = labelled.groupBy(F.col(lang).cast("string").alias("l")).agg(F.count("*").alias("n")).collect()
    ranked = sorted(per, key=lambda r: (-r.n, r.l))
    languages = [r.l for r in ranked]
    if not languages:
        return build_filters([], np.zeros(0, np.uint64), np.zeros(0, np.int64))
    spark = docs.sparkSession
    limits = spark.createDataFrame([(r.l, min(1.0, max_docs / r.n), i) for i, r in enumerate(ranked)], "l string, _part double, _owner int")
    chance = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = F.broadcast(limits)  # one row per language
    sample = labelled.join(few, F.col(lang).cast("string") == F.col("l")).where(chance < F.col("_part"))
    counts = gram_counts(sample, text, lang)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("_total"))
    rates = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("_total"))
    kept = rates.where(F.col("rate") >= MIN_RATE)
    top = kept.groupBy("gram").agg(F.max("rate").alias("_top"), F.collect_list(F.struct("lang", "rate")).alias("_all"))
    held = (
        top.select("gram", "_top", F.explode("_all").alias("r"))
        .where(F.col("r.rate") >= MIN_SHARE * F.col("_top"))
        .join(few, F.col("r.lang") == F.col("l"))
        .select("gram", "_owner")
    )
    table = held.toArrow()
    return build_filters(
        languages,
        table.column("gram").to_numpy().view(np.uint64),
        table.column("_owner").to_numpy().astype(np.int64),
    )


def language_of(text: Column, filters: LanguageFilters, spark) -> Column:
    """``lang_pred`` and ``score`` of each text."""
    shared = spark.sparkContext.broadcast(filters)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def decide(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in texts]
        names, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
        return pa.StructArray.from_arrays([names, scores], ["lang_pred", "score"])

    return decide(text)


def predict(docs: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """Documents with ``lang_pred`` and ``score``, the part of its trigrams the language contains."""
    rows = docs.drop("lang_pred", "score").withColumn("_lang", language_of(F.col(text), filters, docs.sparkSession))
    return rows.withColumns({"lang_pred": F.col("_lang.lang_pred"), "score": F.col("_lang.score")}).drop("_lang")


def held_out(key: str = "doc_id") -> Column:
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


#: A text whose language contains less than this part of its trigrams is rejected.
CLEAR = 0.5


def keep_clear(docs: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """Documents in a known language, with their own columns."""
    name = free_name(docs, "_lang")
    rows = docs.withColumn(name, language_of(F.col(text), filters, docs.sparkSession))
    return rows.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= CLEAR)).select(*docs.columns)
