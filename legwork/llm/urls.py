"""URLs judged by host and path rules, else by two character language models.

A rule fits its host and all subdomains where the URL's path starts with the rule's path;
the longest rule wins. The rules label their URLs, and all labelled URLs train a smoothed
variable-order Markov model of accepted and one of rejected URLs. The difference of the
log-likelihoods per character, on a logistic curve fitted on labelled URLs that the models
have not seen, decides the rest.

The counts of a model are exact and those of all its URLs: one stored row per string of
``ORDER + 1`` characters, so the table grows with the URLs. Each string's share of the score
follows level by level from its shorter ends, which are joined on the end of a string, never
on its occurrences; so a key has as many rows as there are characters. Distinct URLs are
scored by their strings: those that occur most are shared with the tasks, the others joined.
Null URLs, and those without ``://``, have an empty host and path, and no rule fits them. Equal URLs are judged alike; without labelled URLs
of both kinds every URL that no rule blocks is allowed. Columns of the result that clash
with those of the input replace them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legwork.llm.chars import code_points, mix
from legwork.llm.quality import platt
from legwork.llm.storage import free_name, landed

#: Two longs hold a string's ``ORDER + 1`` code points, 21 bits each.
ORDER = 5
POINT_BITS = 21
#: Strings with more than this share of all occurrences are shared with the tasks: fewer than its inverse.
COMMON = 1 / 20_000
#: Characters of URLs cut at once in a task; a longer URL is cut alone.
CHUNK_CHARS = 1 << 17
#: Weight of the shorter context's estimate, in counts.
BACKING = 2.0
ALPHABET = 256
LOW, HIGH = "block", "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.substring_index(F.substring_index(F.substring_index(_after_scheme(url), "/", 1), "?", 1), "#", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    slash = F.locate("/", rest)
    return F.coalesce(F.when(slash > 0, F.substring(rest, slash, F.length(rest))).otherwise(""), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls where none fits. Rules are written ``host/path``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, rules[text]).otherwise(verdict)
    return rule, verdict


def grams(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each character after the ``ORDER`` before it as two longs, and the URL of each character.

    A URL ends in a sign of its own, so its length counts as well.
    """
    texts = [code_points("\x02" * ORDER + url + "\x03") for url in urls]
    codes = np.concatenate(texts).astype(np.int64) if texts else np.zeros(0, np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts = np.cumsum(sizes) - sizes
    at = np.flatnonzero(np.arange(len(codes)) - starts[owner] >= ORDER)
    b = POINT_BITS
    high = codes[at - 5] << 2 * b | codes[at - 4] << b | codes[at - 3]
    low = codes[at - 2] << 2 * b | codes[at - 1] << b | codes[at]
    return high, low, owner[at]


def _chunks(lengths: np.ndarray) -> Iterator[slice]:
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if i > start and size + n > CHUNK_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if len(lengths) > start:
        yield slice(start, len(lengths))


def _distinct(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts rows of keys, and where each distinct one starts in it."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    return order, np.flatnonzero(new)


def gram_counts(texts: DataFrame, url: str, weights: list[str]) -> DataFrame:
    """``high, low`` and, per column of weights, its sum over the occurrences in all rows."""

    def count(batches):
        for batch in batches:
            urls = [u or "" for u in batch.column(0).to_pylist()]
            by = [batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(weights))]
            for part in _chunks(np.array([len(u) for u in urls], np.int64)):
                high, low, owner = grams(urls[part])
                order, first = _distinct(low, high)
                sums = [np.add.reduceat(w[part][owner][order], first) for w in by]
                columns = [high[order][first], low[order][first], *sums]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["high", "low", *weights])

    schema = ", ".join(f"{c} bigint" for c in ["high", "low", *weights])
    narrow = texts.select(F.col(url), *[F.col(w).cast("bigint") for w in weights])
    return narrow.mapInArrow(count, schema).groupBy("high", "low").agg(*[F.sum(w).alias(w) for w in weights])


def _ends(table: DataFrame, order: int, weights: list[str]) -> DataFrame:
    """The counts of the strings' last ``order + 1`` characters."""
    if order == ORDER:
        return table
    bits = (order + 1) * POINT_BITS
    low = F.col("low").bitwiseAND(F.lit((1 << min(bits, 63)) - 1))
    high = F.col("high").bitwiseAND(F.lit((1 << max(0, bits - 63)) - 1))
    return table.groupBy(high.alias("high"), low.alias("low")).agg(*[F.sum(w).alias(w) for w in weights])


def _context() -> Column:
    return F.col("low").bitwiseAND(F.lit(~((1 << POINT_BITS) - 1)))


def cell_counts(labelled: DataFrame) -> DataFrame:
    """``accepted, kind, order, high, low, n``: exact counts of contexts (0) and of context and character (1) per order.

    Over all rows of ``accepted, url``.
    """
    counted = gram_counts(_by_text(labelled, "url", _label_sums()), "_url", ["rejected", "accepted"])
    both = None
    for order in range(ORDER + 1):
        pairs = _ends(counted, order, ["rejected", "accepted"])
        before = pairs.groupBy("high", _context().alias("low")).agg(*[F.sum(w).alias(w) for w in ("rejected", "accepted")])
        for kind, table in enumerate((before, pairs)):
            rows = table.select(
                F.explode(F.array(*[F.struct(F.lit(w == "accepted").alias("accepted"), F.col(w).alias("n")) for w in ("rejected", "accepted")])).alias("_c"),
                F.lit(kind).alias("kind"), F.lit(order).alias("order"), "high", "low",
            ).select("_c.accepted", "kind", "order", "high", "low", "_c.n").where("n > 0")
            both = rows if both is None else both.unionByName(rows)
    return both


def _label_sums() -> list[Column]:
    return [F.count_if(~F.col("accepted")).alias("rejected"), F.count_if(F.col("accepted")).alias("accepted")]


def _by_text(rows: DataFrame, url: str, sums: list[Column]) -> DataFrame:
    """One row per distinct URL, null as the empty one."""
    return rows.groupBy(F.coalesce(F.col(url), F.lit("")).alias("_url")).agg(*sums)


def gram_differences(table: DataFrame) -> DataFrame:
    """``high, low, difference, uses``: log-likelihood of the accepted less that of the rejected of each string's last character.

    ``table`` holds ``high, low, rejected, accepted, uses`` of all strings that are counted or asked for.
    """
    shorter = None
    for order in range(ORDER + 1):
        weights = ["rejected", "accepted", "uses"]
        level = _ends(table, order, weights)
        before = Window.partitionBy("high", "_before")
        level = level.withColumn("_before", _context()).withColumns({f"_all_{m}": F.sum(m).over(before) for m in weights[:2]})
        if shorter is None:
            level = level.withColumns({f"_p_{m}": F.lit(1 / ALPHABET) for m in weights[:2]})
        else:
            bits = order * POINT_BITS
            end = level.withColumns(
                {
                    "_end_low": F.col("low").bitwiseAND(F.lit((1 << min(bits, 63)) - 1)),
                    "_end_high": F.col("high").bitwiseAND(F.lit((1 << max(0, bits - 63)) - 1)),
                }
            )
            level = end.join(shorter, ["_end_high", "_end_low"])
        p = {m: (F.col(m) + BACKING * F.col(f"_p_{m}")) / (F.col(f"_all_{m}") + BACKING) for m in weights[:2]}
        if order == ORDER:
            return level.select("high", "low", (F.log(p["accepted"]) - F.log(p["rejected"])).alias("difference"), "uses")
        shorter = level.select(F.col("high").alias("_end_high"), F.col("low").alias("_end_low"), *[p[m].alias(f"_p_{m}") for m in p])


@dataclass
class UrlModels:
    """Stored counts of both models (``high, low, rejected, accepted``), and the curve."""

    counts: DataFrame
    slope: float = 0.0
    offset: float = 0.0

    def differences(self, urls: list[str]) -> np.ndarray:
        """Log-likelihood of accepted less that of rejected, per character, of a few URLs."""
        rows = self.counts.sparkSession.createDataFrame(list(enumerate(urls)), "place long, url string")
        found = {r["place"]: r["_difference"] for r in scored(rows, self, "url").collect()}
        return np.array([found[i] for i in range(len(urls))])

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.offset, -500, 500)))


def train(labelled: DataFrame, key: str) -> UrlModels:
    """Models of the rows of ``key, url, accepted``; a fifth of them, by a hash of the key, calibrates.

    The counts stay in a stored table; the driver sees their sums.
    """
    known = labelled.where(F.col("url").isNotNull() & F.col("accepted").isNotNull())
    fold = F.pmod(F.xxhash64(F.lit("url"), F.col(key).cast("string")), F.lit(5))
    counts = landed(gram_counts(_by_text(known.where(fold != 0), "url", _label_sums()), "_url", ["rejected", "accepted"]))
    found = UrlModels(counts)
    sums = counts.agg(F.sum("rejected"), F.sum("accepted")).first()
    if not sums[0] or not sums[1]:
        return UrlModels(counts, 0.0, 5.0)
    rows = scored(known.where(fold == 0), found, "url").select("_difference", F.col("accepted").cast("int").alias("_label"))
    found.slope, found.offset = platt(landed(rows), "_difference", "_label")
    return found


def _spread(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(mix(high) * np.uint64(0x9E3779B97F4A7C15) + low.astype(np.uint64))


def _common(table: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, strings and difference of the strings that occur most, by hash; of those that share a hash, one."""
    uses = table.agg(F.sum("uses")).first()[0] or 0
    rows = table.where(F.col("uses") > COMMON * uses).toPandas()
    high, low = rows["high"].to_numpy(np.int64), rows["low"].to_numpy(np.int64)
    names, at = np.unique(_spread(high, low), return_index=True)
    return names, high[at], low[at], rows["difference"].to_numpy(float)[at]


def scored(rows: DataFrame, models: UrlModels, url: str) -> DataFrame:
    """Rows with ``_difference`` per character; each distinct URL is scored once and joined to its rows."""
    texts = landed(_by_text(rows, url, [F.lit(1).alias("uses")]))
    asked = gram_counts(texts, "_url", ["uses"]).selectExpr("high", "low", "0L as rejected", "0L as accepted", "uses")
    known = models.counts.selectExpr("high", "low", "rejected", "accepted", "0L as uses")
    both = asked.unionByName(known).groupBy("high", "low").agg(*[F.sum(w).alias(w) for w in ("rejected", "accepted", "uses")])
    table = landed(gram_differences(landed(both)).where("uses > 0"))
    shared = rows.sparkSession.sparkContext.broadcast(_common(table))

    def cut(batches):
        names, known_high, known_low, known_difference = shared.value
        for batch in batches:
            urls, keys = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            for part in _chunks(np.array([len(u) for u in urls], np.int64)):
                high, low, owner = grams(urls[part])
                at = np.minimum(np.searchsorted(names, _spread(high, low)), max(0, len(names) - 1))
                held = (known_high[at] == high) & (known_low[at] == low) if len(names) else np.zeros(len(high), bool)
                n = np.bincount(owner, minlength=len(urls[part]))
                sums = np.bincount(owner[held], known_difference[at[held]], len(n)) if held.any() else np.zeros(len(n))
                high, low, owner = high[~held], low[~held], owner[~held]
                order, first = _distinct(low, high, owner)
                times = np.diff(np.append(first, len(order)))
                high, low, owner = (x[order][first] for x in (high, low, owner))
                ids = keys[part]
                columns = [
                    pa.array(np.concatenate([ids, ids[owner]]), pa.binary()),
                    pa.array(np.concatenate([np.zeros_like(n), high]), pa.int64(), mask=np.arange(len(n) + len(high)) < len(n)),
                    pa.array(np.concatenate([np.zeros_like(n), low]), pa.int64(), mask=np.arange(len(n) + len(low)) < len(n)),
                    pa.array(np.concatenate([sums / n, times / n[owner]]), pa.float64()),
                ]
                yield pa.record_batch(columns, ["_id", "high", "low", "share"])

    # a row per URL with what the common strings give, and a row per other string of it
    name = F.unhex(F.md5("_url"))
    cuts = texts.select("_url", name.alias("_id")).mapInArrow(cut, "_id binary, high bigint, low bigint, share double")
    cuts = landed(cuts)
    others = cuts.where("high is not null").join(table.select("high", "low", "difference"), ["high", "low"])
    parts = cuts.where("high is null").select("_id", "share").unionByName(others.select("_id", (F.col("share") * F.col("difference")).alias("share")))
    found = parts.groupBy("_id").agg(F.sum("share").alias("_difference"))
    key = free_name(rows, "_url_id")
    named = rows.drop("_difference").withColumn(key, F.unhex(F.md5(F.coalesce(F.col(url), F.lit("")))))
    return named.join(found.withColumnRenamed("_id", key), key).drop(key)


def judge(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url") -> DataFrame:
    """Pages with ``host, path, rule, verdict`` and ``accept_probability``.

    The rows are joined with their URLs' scores, so pass only the columns that are needed.
    """
    rows = pages.drop("host", "path", "rule", "verdict", "accept_probability")
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_verdict": verdict})
    labelled = rows.where("_verdict is not null").select(key, F.col(url).alias("url"), (F.col("_verdict") == HIGH).alias("accepted"))
    models = train(labelled, key)
    slope, offset = models.slope, models.offset
    judged = scored(rows, models, url)
    p = 1 / (1 + F.exp(-(F.col("_difference") * slope + offset)))
    judged = judged.withColumn("accept_probability", p)
    own = F.when(F.col("accept_probability") >= 0.5, HIGH).otherwise(LOW)
    return judged.withColumn("verdict", F.coalesce("_verdict", own)).drop("_verdict", "_difference")
