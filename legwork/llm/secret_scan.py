"""Secrets in texts: fixed patterns, and spans that a linear-chain conditional random field tags.

The field tags tokens as begin, inside or outside of a secret. Its features are a token's
own shape, the words before and after it, and features of the whole text. It is trained on
windows of texts whose pattern matches label the tokens, and decoded by Viterbi.

Spans are code points, end exclusive. Pattern spans always stay; a tagged span is added
where it overlaps none of them. Null and empty texts have no spans. Without any match in
the training texts the field tags nothing. Clashing columns of the input are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Documents with a match, of all that have one, and documents without that train at most, by a hash of their key.
TRAIN_DOCS = 1_000
#: Those without a match are looked for among this many times as many documents.
SEARCHED = 30
#: Tokens on each side of a match, and windows of one document, that train.
AROUND, WINDOWS = 16, 2
STEPS = 100
BUCKETS = 1 << 15
PENALTY = 2e-4
#: Features are kept for so many kinds of tokens; of the tokens themselves, about the last half as many and those of the half before.
CACHED_TOKENS = 100_000
CACHED_CHARS = 16
#: Longer tokens are known by their shape only.
WORD_CHARS = 10
PLAIN_CHARS = 64
REPLACEMENT = "[SECRET]"

# The kinds of base spans, in the order of their listing
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{24,}")
#: Every text with a match has one of these.
MAYBE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""
KINDS = ("assign", "access", "hex", "tagged")
_KEYS = ("passw", "secret", "token", "api")

_TOKEN = re.compile(r"\s?(?:[^\W_]+|[^\w\s]|_)")
OUTSIDE, BEGIN, INSIDE = 0, 1, 2


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """``start, end, kind, start of the value`` of all pattern matches, by start, then kind."""
    found = []
    low = text.lower()
    if any([key in low for key in _KEYS]):
        found += [(*m.span(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(*m.span(), "hex", m.start()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def bucket(*parts) -> int:
    return zlib.crc32(repr(parts).encode()) % BUCKETS


def shape(core: str) -> tuple:
    """What a token looks like, without which word it is; one tuple for most words of a length."""
    n = len(core)
    size = n if n < 8 else 8 + int(2 * math.log2(n / 8))
    if core.isalpha() and (core.islower() or core.isupper() or core.istitle()):
        runs = "a" if core.islower() else "A" if core.isupper() else "Aa"
        return size, runs, len(runs) - 1, len(runs), 0, False, False
    lower = sum(map(str.islower, core))
    upper = sum(map(str.isupper, core))
    digits = sum(map(str.isdigit, core))
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in core[:200]]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    runs = "".join(key for key, _ in groupby(kinds))[:8]
    hexed = n >= 8 and digits > 0 and all(c in "0123456789abcdefABCDEF" for c in core)
    return size, runs, min(turns, 12), (lower > 0) + (upper > 0) + (digits > 0), int(10 * digits / n), hexed, core[-1].isdigit()


def token_key(token: str, vocabulary: set[str]) -> tuple:
    """All that features see of a token: its shape, a blank before it, and its word if the training met it."""
    core = token.lstrip()
    word = core.lower() if len(core) <= WORD_CHARS else ""
    return shape(core), len(core) < len(token), word if word in vocabulary else ""


def own_features(key: tuple) -> list[int]:
    (size, runs, turns, mixed, digits, hexed, _), spaced, word = key
    return [
        bucket("bias"),
        bucket("size", size),
        bucket("runs", runs),
        bucket("turns", turns, size > 8),
        bucket("mixed", mixed, size),
        bucket("digits", digits, size),
        bucket("hexed", hexed),
        bucket("spaced", spaced),
        bucket("word", word),
    ]


def word_features(place: str, key: tuple) -> list[int]:
    """Features of the token at a place beside the tagged one."""
    (size, runs, *_), _, word = key
    return [bucket(place, word), bucket(place, "shape", runs, min(size, 10))]


PLACES = {"before": 1, "before2": 2, "before3": 3, "after": -1}


def file_features(n: int, signs: int, numbers: int) -> list[int]:
    """Size of a text in tokens, and its shares of signs and of tokens that end in a digit."""
    return [bucket("file", int(math.log2(n))), bucket("signs", int(8 * signs / n)), bucket("numbers", int(8 * numbers / n))]


def is_sign(token: str) -> bool:
    return not token[-1].isalnum()


def viterbi(emissions: np.ndarray, moves: np.ndarray) -> list[int]:
    """The best tags between two outside tokens."""
    best, back = moves[OUTSIDE] + emissions[0], []
    for row in emissions[1:]:
        paths = best[:, None] + moves
        back.append(paths.argmax(0))
        best = paths.max(0) + row
    tag = int((best + moves[:, OUTSIDE]).argmax())
    tags = [tag]
    for step in reversed(back):
        tag = int(step[tag])
        tags.append(tag)
    return tags[::-1]


class Field(dict):
    """Weights by feature bucket and tag and by pair of tags; as a mapping, the row of each token."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, vocabulary: set[str]):
        super().__init__()
        self.weights, self.moves, self.vocabulary = weights, moves, vocabulary
        self.by_key: dict[tuple, int] = {}
        self.older: dict[str, int] = {}
        self.plain: dict[tuple[int, int, int], int] = {}
        self.rows = np.zeros((256, 1 + len(PLACES), 3), np.float32)
        self.leads = np.zeros((1 + len(PLACES), 256), np.float32)
        self.flags = np.zeros((256, 2), bool)
        # A token whose outside score leads by more than any two moves can return is outside on the best path
        lead = moves[:, 1:, None] + moves[None, 1:, :] - moves[:, :1, None] - moves[None, :1, :]
        self.lead = float(max(0.0, lead.max()))

    def __reduce__(self):
        return Field, (self.weights, self.moves, self.vocabulary)

    def __missing__(self, token: str) -> int:
        at = self.older.get(token)
        if at is None:
            at = self.unseen(token)
        if len(token) <= CACHED_CHARS:
            self[token] = at
        return at

    def unseen(self, token: str) -> int:
        """Words that the training did not meet differ by length and case only, so they skip the making of a key."""
        core = token.lstrip()
        if not core.isalpha() or len(core) > PLAIN_CHARS or (len(core) <= WORD_CHARS and core.lower() in self.vocabulary):
            return self.row_of(token)
        case = 1 if core.islower() else 2 if core.isupper() else 3 if core.istitle() else 0
        if not case:
            return self.row_of(token)
        kind = len(core), len(token), case
        at = self.plain.get(kind)
        if at is None:
            at = self.plain[kind] = self.row_of(token)
        return at

    def row_of(self, token: str) -> int:
        key = token_key(token, self.vocabulary)
        at = self.by_key.get(key)
        if at is None:
            at = len(self.by_key)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                self.leads = np.concatenate([self.leads, np.zeros_like(self.leads)], 1)
                self.flags = np.concatenate([self.flags, np.zeros_like(self.flags)])
            self.rows[at, 0] = self.weights[own_features(key)].sum(0)
            for i, place in enumerate(PLACES, 1):
                self.rows[at, i] = self.weights[word_features(place, key)].sum(0)
            self.leads[:, at] = self.rows[at, :, OUTSIDE] - self.rows[at, :, 1:].max(1)
            self.flags[at] = is_sign(token), token[-1].isdigit()
            self.by_key[key] = at
        return at

    def row_ids(self, tokens: list[str]) -> np.ndarray:
        if len(self.by_key) > CACHED_TOKENS:
            self.clear()
            self.older = {}
            self.plain.clear()
            self.by_key.clear()
        elif len(self) > CACHED_TOKENS // 2:
            self.older = dict(self)
            self.clear()
        return np.fromiter(map(self.__getitem__, tokens), np.int32, len(tokens))

    def file_scores(self, at: np.ndarray) -> np.ndarray:
        return self.weights[file_features(len(at), *self.flags[at].sum(0).tolist())].sum(0)

    def open_tokens(self, at: np.ndarray, file: np.ndarray) -> np.ndarray:
        """Tokens that may be tagged: the sum of the leads is at most the lead of the sum."""
        sure = self.leads[0].take(at) + (file[OUTSIDE] - file[1:].max())
        for i, step in enumerate(PLACES.values(), 1):
            beside = self.leads[i].take(at)
            if step > 0:
                sure[step:] += beside[:-step]
            else:
                sure[:step] += beside[-step:]
        return np.flatnonzero(sure <= self.lead + 1e-3)

    def emissions(self, at: np.ndarray, chosen: np.ndarray, file: np.ndarray) -> np.ndarray:
        found = self.rows[at[chosen], 0] + file
        for i, step in enumerate(PLACES.values(), 1):
            near = chosen - step
            inside = (near >= 0) & (near < len(at))
            found[inside] += self.rows[at[near[inside]], i]
        return found

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Tagged spans, from the first letter or sign of their first token."""
        tokens = _TOKEN.findall(text)
        if not tokens:
            return []
        at = self.row_ids(tokens)
        file = self.file_scores(at)
        chosen = self.open_tokens(at, file)
        if not len(chosen):
            return []
        scores = self.emissions(at, chosen, file)
        tagged: dict[int, int] = {}
        ends = np.flatnonzero(np.diff(chosen) > 1) + 1
        for run, rows in zip(np.split(chosen, ends), np.split(scores, ends)):
            tagged |= {int(i): tag for i, tag in zip(run, viterbi(rows, self.moves)) if tag != OUTSIDE}
        if not tagged:
            return []
        found: list[list[int]] = []
        for i, m in enumerate(_TOKEN.finditer(text)):
            if tagged.get(i) == INSIDE and i - 1 in tagged:
                found[-1][1] = m.end()
            elif i in tagged:
                found.append([m.end() - len(m.group().lstrip()), m.end()])
        return [(start, end) for start, end in found]


def training_windows(text: str) -> list[tuple[list[str], list[int], list[int]]]:
    """Tokens, tags and file features around the matches of a text, or from its middle if it has none."""
    matches = list(_TOKEN.finditer(text))
    if not matches:
        return []
    tokens = [m.group() for m in matches]
    values = [(value, end) for _, end, _, value in base_spans(text)]
    tags = [OUTSIDE] * len(tokens)
    centres = []
    for start, end in values:
        inner = [i for i, m in enumerate(matches) if m.end() > start and m.end() - len(m.group().lstrip()) < end]
        if inner and tags[inner[0]] == OUTSIDE:
            centres.append(inner[0])
            for i in inner:
                tags[i] = INSIDE
            tags[inner[0]] = BEGIN
    file = file_features(len(tokens), sum(map(is_sign, tokens)), sum([t[-1].isdigit() for t in tokens]))
    windows = []
    for centre in (centres or [len(tokens) // 2])[:WINDOWS]:
        span = slice(max(0, centre - AROUND), centre + AROUND)
        windows.append((tokens[span], tags[span], file))
    return windows


def fit(windows: list[tuple[list[str], list[int], list[int]]]) -> Field:
    """Weights of the greatest penalised likelihood, by full-batch Adam steps."""
    weights, moves = np.zeros((BUCKETS, 3)), np.zeros((3, 3))
    windows = [w for w in windows if w[0]]
    if not any(BEGIN in tags for _, tags, _ in windows):
        weights[bucket("bias"), OUTSIDE] = 100.0
        return Field(weights, moves, set())
    met = Counter(word for tokens, _, _ in windows for t in tokens if len(word := t.lstrip().lower()) <= WORD_CHARS)
    vocabulary = {word for word, times in met.items() if times > 1}
    # A unit is a token at a place, or the file features of a text: cells with equal units share their sums
    units: dict[tuple, int] = {(): 0}
    members: list[list[int]] = [[]]

    def unit(key: tuple, features) -> int:
        if key not in units:
            units[key] = len(members)
            members.append(features())
        return units[key]

    n, length = len(windows), max(len(w[0]) for w in windows)
    tags = np.zeros((n, length), np.int64)
    real = np.zeros((n, length), bool)
    cells = np.zeros((n, length, 2 + len(PLACES)), np.int64)
    for i, (tokens, gold, file) in enumerate(windows):
        real[i, : len(tokens)] = True
        tags[i, : len(tokens)] = gold
        cells[i, : len(tokens), 0] = unit(("file", *file), lambda: file)
        keys = [token_key(token, vocabulary) for token in tokens]
        for j, own in enumerate(keys):
            cells[i, j, 1] = unit(("own", own), lambda: own_features(own))
            for k, (place, step) in enumerate(PLACES.items(), 2):
                if 0 <= j - step < len(keys):
                    near = keys[j - step]
                    cells[i, j, k] = unit((place, near), lambda: word_features(place, near))
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    used, feature = np.unique(np.concatenate([np.array(m, np.int64) for m in members]), return_inverse=True)
    flat = cells.reshape(n * length, -1)
    ends = real.sum(1) - 1
    rows = np.arange(n)
    gold = np.zeros((n, length, 3))
    gold[rows[:, None], np.arange(length), tags] = real
    seen = np.zeros((3, 3))
    np.add.at(seen, (tags[:, :-1][real[:, 1:]], tags[:, 1:][real[:, 1:]]), 1)
    np.add.at(seen, (OUTSIDE, tags[:, 0]), 1)
    np.add.at(seen, (tags[rows, ends], OUTSIDE), 1)
    first, second = np.zeros((2, len(used) * 3 + 9))
    params = np.zeros(len(used) * 3 + 9)
    for step in range(1, STEPS + 1):
        w, moves = params[:-9].reshape(-1, 3), params[-9:].reshape(3, 3)
        sums = np.stack([np.bincount(owner, w[feature, y], len(members)) for y in range(3)], 1)
        emit = sums[flat].sum(1).reshape(n, length, 3)
        forward = np.zeros((n, length, 3))
        forward[:, 0] = moves[OUTSIDE] + emit[:, 0]
        for t in range(1, length):
            forward[:, t] = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, 1) + emit[:, t]
        backward = np.zeros((n, length, 3))
        last = moves[:, OUTSIDE]
        for t in range(length - 1, -1, -1):
            if t + 1 < length:
                backward[:, t] = np.logaddexp.reduce(moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[ends == t, t] = last
        total = np.logaddexp.reduce(forward[rows, ends] + last, 1)
        share = np.exp(forward + backward - total[:, None, None]) * real[:, :, None]
        moved = np.zeros((3, 3))
        for t in range(1, length):
            on = real[:, t]
            pairs = forward[on, t - 1, :, None] + moves + (emit[on, t] + backward[on, t])[:, None, :]
            moved += np.exp(pairs - total[on, None, None]).sum(0)
        moved[OUTSIDE] += share[:, 0].sum(0)
        moved[:, OUTSIDE] += share[rows, ends].sum(0)
        off = (gold - share).reshape(-1, 3)
        spread = [np.bincount(flat.ravel(), np.repeat(off[:, y], flat.shape[1]), len(members)) for y in range(3)]
        slope = np.stack([np.bincount(feature, g[owner], len(used)) for g in spread], 1)
        gradient = np.concatenate([slope.ravel(), (seen - moved).ravel()]) / n - PENALTY * params
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        params = params + 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights[used] = params[:-9].reshape(-1, 3)
    return Field(weights.astype(np.float32), params[-9:].reshape(3, 3), vocabulary)


def training_rows(docs: DataFrame, key: str, text: str, max_docs: int) -> DataFrame:
    """``tokens, tags, file`` of the windows of at most ``max_docs`` documents with a match and as many without.

    Those with a match are chosen among all of the table; a pattern that passes them all
    keeps the other texts out of the workers. Both choices are top-k by a hash, so no task
    holds more than ``max_docs`` of a kind.
    """

    @F.arrow_udf("array<struct<tokens: array<string>, tags: array<int>, file: array<int>>>")
    def windows(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("tokens", pa.list_(pa.string())), ("tags", pa.list_(pa.int32())), ("file", pa.list_(pa.int32()))]))
        cut = [training_windows(t.as_py()) for t in texts]
        return pa.array([[dict(zip(("tokens", "tags", "file"), w)) for w in found] for found in cut], kind)

    n = docs.count()
    spread = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("secret")), F.lit(1 << 30))
    maybe = F.col(text).rlike(MAYBE)
    filled = docs.where(F.length(text) > 0)

    def first(rows: DataFrame) -> DataFrame:
        return rows.orderBy("_spread", "_tie").limit(max_docs).select("_w")

    def cut(rows: DataFrame) -> DataFrame:
        return rows.select(spread.alias("_spread"), F.xxhash64(text).alias("_tie"), windows(F.col(text)).alias("_w"))

    matched = F.exists("_w", lambda w: F.array_contains(w["tags"], BEGIN))
    hit = first(cut(filled.where(maybe)).where(matched))
    clean = first(cut(filled.where(spread < min(1.0, SEARCHED * max_docs / max(1, n)) * (1 << 30))).where(~matched))
    return hit.union(clean).select(F.explode("_w").alias("w")).select("w.*")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", max_docs: int = TRAIN_DOCS) -> Field:
    """The field from windows of at most ``max_docs`` documents with a match and as many without.

    Windows are cut in the tasks; the driver fits on at most ``2 * max_docs * WINDOWS`` of them.
    """
    rows = training_rows(docs, key, text, max_docs).collect()
    return fit([(r.tokens, r.tags, r.file) for r in rows])


def all_spans(text: str, field: Field) -> list[tuple[int, int, str]]:
    """Pattern spans and the tagged ones beside them, by start, then kind."""
    base = [(start, end, kind) for start, end, kind, _ in base_spans(text)]
    added = [
        (start, end, "tagged")
        for start, end in field.spans(text)
        if all(end <= b_start or start >= b_end for b_start, b_end, _ in base)
    ]
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def spans(text: Column | str, field: Field, spark) -> Column:
    """All spans of each text, by start, then kind."""
    shared = spark.sparkContext.broadcast(field)

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        found = [all_spans(t.as_py() or "", shared.value) for t in texts]
        return pa.array([[{"kind": k, "start": s, "end": e} for s, e, k in row] for row in found], kind)

    return find(text)


def scan(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Documents with ``spans``, replacing a column of that name."""
    return docs.withColumn("spans", spans(F.col(text), field, docs.sparkSession))


def redact(docs: DataFrame, field: Field, text: str = "text", replacement: str = REPLACEMENT) -> DataFrame:
    """Documents whose text has each secret replaced; overlapping spans are replaced as one.

    Of an assignment the name stays and its value goes. A column ``n_chars`` is counted again.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py(), shared.value, replacement) if t.is_valid else None for t in texts], pa.string())

    found = docs.withColumn(text, clean(F.col(text)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length(text)).cast(kind))
    return found


def redacted(text: str, field: Field, replacement: str) -> str:
    values = [(value, end) for _, end, _, value in base_spans(text)]
    base = [(start, end) for start, end, _, _ in base_spans(text)]
    values += [s for s in field.spans(text) if all(s[1] <= b[0] or s[0] >= b[1] for b in base)]
    parts, at = [], 0
    for start, end in sorted(values):
        if start >= at:
            parts += [text[at:start], replacement]
        at = max(at, end)
    return "".join([*parts, text[at:]])
