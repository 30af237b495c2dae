"""Quality of documents: fixed rules and a calibrated classifier.

The classifier is a logistic regression on hashed words and character n-grams, trained on
labelled rows, with a Platt scale fitted on labelled rows it has not seen. A task scores
Arrow batches with the coefficients as an array: a text's margin is the mean weight of
its words plus that of its n-grams.

Null and empty texts have no words and fail the rules. Ties, repeated and conflicting
labels: a document whose labels disagree is not used for training. Without labels of both
kinds the classifier accepts everything. Columns of the result that clash with those of
the input replace them.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legwork.llm.chars import code_points, mix, slices
from legwork.llm.storage import free_name, landed

#: Labelled rows used at most; a quarter of them calibrates.
TRAIN_ROWS = 8_000
#: Tasks that hold them once they are selected; each returns a gradient of all buckets in every step.
TRAIN_TASKS = 8
WORD_BUCKETS = 1 << 16
CHAR_BUCKETS = 1 << 16
ORDERS = (1, 3)
SCALE = 10.0
KEEP_FROM = 0.3
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

_SYMBOLS = re.compile(r"[#*$%&|<>]+")  # fixed value
_BLANK = b" \t\n\x0b\x0c\r"


def char_buckets(codes: np.ndarray, order: int) -> np.ndarray:
    keys = np.full(max(0, len(codes) - order + 1), order, np.uint64)
    for i in range(order):
        keys = keys * np.uint64(0x100000001B3) + codes[i : len(codes) - order + 1 + i]
    return (mix(keys) & np.uint64(CHAR_BUCKETS - 1)).astype(np.int64)


def blocks(text: str, words: list[bytes]) -> list[list[np.ndarray]]:
    """Bucket indices per block of features; each block counts alike."""
    word = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (WORD_BUCKETS - 1)
    found = [[word]]
    parts = [code_points(part).astype(np.uint64) for part in slices(text)]
    for i, order in enumerate(ORDERS):
        base = WORD_BUCKETS + i * CHAR_BUCKETS
        found.append([char_buckets(codes, order) + base for codes in parts])
    return found


N_BUCKETS = WORD_BUCKETS + len(ORDERS) * CHAR_BUCKETS


def feature_vector(text: str | None) -> SparseVector:
    """Shares of a text's words and n-grams by bucket."""
    text = text or ""
    values: dict[int, float] = {}
    for block in blocks(text, text.encode("utf-8", "surrogatepass").split()):
        at, n = np.unique(np.concatenate(block), return_counts=True)
        values.update(zip(at.tolist(), (SCALE * n / max(1, n.sum())).tolist()))
    return SparseVector(N_BUCKETS, values)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more."""
    if len(words) <= WINDOW:
        return 0
    windows = list(zip(*[words[i:] for i in range(WINDOW)]))
    seen, twice = set(), set()
    if len(set(windows)) == len(windows):
        return 0
    for window in windows:
        (twice if window in seen else seen).add(window)
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if window in twice:
            covered += start + WINDOW - max(start, end)
            end = start + WINDOW
    return covered


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def margin(self, text: str, words: list[bytes]) -> float:
        total = self.intercept
        for block in blocks(text, words):
            n = sum(len(at) for at in block)
            if n:
                total += SCALE * sum(float(self.weights[at].sum()) for at in block) / n
        return total

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def platt(rows: DataFrame, margin: str, label: str) -> tuple[float, float]:
    """Slope and offset of the logistic curve of a 0/1 label over a margin.

    With one label only there is nothing to fit: slope 0 and that label's side.
    """
    seen = {r[0]: r[1] for r in rows.groupBy(F.col(label).cast("int")).agg(F.count("*")).collect() if r[0] is not None}
    if len(seen) < 2:
        return 0.0, (-5.0 if 0 in seen else 5.0)
    points = rows.select(array_to_vector(F.array(F.col(margin).cast("double"))).alias("features"), F.col(label).cast("double").alias("label"))
    fitted = LogisticRegression(regParam=1e-4, standardization=True).fit(points)
    return float(fitted.coefficients[0]), float(fitted.intercept)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = TRAIN_ROWS
) -> QualityModel:
    """The classifier from at most about ``max_rows`` labelled documents, chosen by a hash of their key."""
    agreed = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(label).alias("_low"), F.max(label).alias("_label"))
        .where(F.col("_low") == F.col("_label"))
    )
    n = agreed.count()
    chance = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("quality")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = agreed.where(chance < min(1.0, max_rows / max(1, n))).select(key, "_label")
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("_key").cast("string")), F.lit(4))
    vector = F.udf(feature_vector, VectorUDT())
    rows = landed(
        docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
        .join(F.broadcast(chosen.withColumnRenamed(key, "_key")), "_key")  # at most about max_rows rows
        .select("text", F.col("_label").cast("double").alias("label"), fold.alias("_fold"))
    )
    fit = rows.where("_fold != 0").select(vector("text").alias("features"), "label").coalesce(TRAIN_TASKS).persist()
    try:
        if fit.select("label").distinct().count() < 2:
            return QualityModel(np.zeros(N_BUCKETS), 0.0, 0.0, 5.0)
        fitted = LogisticRegression(maxIter=40, regParam=1e-4, standardization=False).fit(fit)
    finally:
        fit.unpersist()
    model = QualityModel(fitted.coefficients.toArray().astype(np.float32), float(fitted.intercept), 1.0, 0.0)
    rest = rows.where("_fold = 0").select(margins_of(F.col("text"), model, docs.sparkSession).alias("margin"), "label")
    model.slope, model.offset = platt(rest, "margin", "label")
    return model


def margins_of(text: Column, model: QualityModel, spark) -> Column:
    """The classifier's margin of each text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def margins(texts: pa.Array) -> pa.Array:
        found = [t.as_py() or "" for t in texts]
        return pa.array([shared.value.margin(t, t.encode("utf-8", "surrogatepass").split()) for t in found], pa.float64())

    return margins(text)


_FIELDS = [("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("probability", "double")]


def measure(model: QualityModel, text: str | None) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blank = sum(data.count(c) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
    symbols = sum(map(len, _SYMBOLS.findall(text)))
    probability = model.probability(model.margin(text, words))
    return len(words), len(text) - blank, symbols, duplicate_lines(text), repeated_words(words), probability


def measures_of(text: Column, model: QualityModel, spark) -> Column:
    """The measures and ``probability`` of each text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(f"struct<{', '.join(f'{name}: {kind}' for name, kind in _FIELDS)}>")
    def measured(texts: pa.Array) -> pa.Array:
        rows = [measure(shared.value, t.as_py()) for t in texts]
        kinds = {"bigint": pa.int64(), "double": pa.float64()}
        columns = [pa.array([r[i] for r in rows], kinds[kind]) for i, (_, kind) in enumerate(_FIELDS)]
        return pa.StructArray.from_arrays(columns, [name for name, _ in _FIELDS])

    return measured(text)


def fails_rules(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words)


def judge(docs: DataFrame, model: QualityModel, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """Documents with the five measures, ``probability``, ``base_failed`` and ``kept``."""
    names = [name for name, _ in _FIELDS]
    rows = docs.drop(*names, "base_failed", "kept").withColumn("_m", measures_of(F.col(text), model, docs.sparkSession))
    rows = rows.withColumns({name: F.col(f"_m.{name}") for name in names}).drop("_m")
    rows = rows.withColumn("base_failed", fails_rules(F.col("n_words"), F.col("n_repeat_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= keep_from))


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """Documents that pass the rules and the classifier, with their own columns."""
    name = free_name(docs, "_m")
    rows = docs.withColumn(name, measures_of(F.col(text), model, docs.sparkSession))
    fails = fails_rules(F.col(f"{name}.n_words"), F.col(f"{name}.n_repeat_words"))
    return rows.where(~fails & (F.col(f"{name}.probability") >= keep_from)).select(*docs.columns)
