"""Byte-pair encoding and decoding with a word-end vocabulary.

A word is held as contiguous arrays: the ids of its parts, whose boundaries lie
between neighbours, and the merge rank of each adjacent pair. The smallest rank is
looked up by a scan, its boundary deleted, and the two ranks beside it refreshed.
Words over ``SHORT_WORD`` parts, where scans would cost their square, merge in the
same order through a heap.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SHORT_WORD = 96
#: Words kept by a worker; beyond them it starts a new table, so memory stays bounded.
CACHED_WORDS = 500_000
CACHED_CHARS = 24

#: Below this, the last of the Latin letters, all Unicode versions agree.
FAMILIAR = "\u0250"
SIGNS = ".,;:!?#%&$*|"
NEVER = 1 << 30
#: Python splits at these four controls, which Unicode does not call white space.
_CONTROLS = re.compile("[\x1c-\x1f]")
_WHITE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(byte if byte in plain else next(moved)) for byte in range(256)]


class Encoder(dict):
    """Bytes of little-endian 32-bit ids by white-space separated piece of text."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [vocab[letter] for letter in letters]
        self.last = [vocab[letter + end] for letter in letters]
        self.width = len(vocab) + len(spec["added_tokens"])
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            self.rank[vocab[left] * self.width + vocab[right]] = rank
            self.merged.append(vocab[left + right])
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.special = {text: np.array([i], "<i4").tobytes() for text, i in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.library = Tokenizer.from_file(path)
        self.byte = {letter: byte for byte, letter in enumerate(letters)}
        self.by_word: dict[bytes, bytes] = {}
        names = {**vocab, **special}
        self.names = pa.array(sorted(names, key=names.get), pa.string())

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        parts = [self.inner[byte] for byte in word[:-1]] + [self.last[word[-1]]]
        if len(parts) > SHORT_WORD:
            return self._merge_long(parts)
        rank, width = self.rank.get, self.width
        ranks = [rank(a * width + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [self.merged[least]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] * width + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = rank(parts[i] * width + parts[i + 1], NEVER)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank, width, n = self.rank.get, self.width, len(parts)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank(a * width + b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = self.merged[r], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (r := rank(parts[left] * width + parts[right])) is not None:
                    heapq.heappush(heap, (r, left, parts[left], parts[right]))
        return [part for part in parts if part >= 0]

    def split(self, piece: str) -> list[bytes]:
        """Normalised words of a piece without white space."""
        if max(piece) < FAMILIAR:
            low = piece.lower()
            if low.isalpha():
                return [low.encode()]
            word = low.rstrip(SIGNS)
            if word.isalpha():
                return [word.encode(), low[len(word) :].encode()]
            plain = "".join([c.lower() for c in unicodedata.normalize("NFC", piece)])
            return [word.encode() for word in self.words.findall(plain)]
        # Unicode tables differ between libraries in their newest letters: split by those of the file's own
        plain = self.library.normalizer.normalize_str(piece)
        return [bytes(map(self.byte.get, word)) for word, _ in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def __missing__(self, piece: str) -> bytes:
        parts = []
        for word in self.split(piece):
            ids = self.by_word.get(word)
            if ids is None:
                ids = array("i", self.merge(word)).tobytes()
                if len(word) <= CACHED_CHARS:
                    self.by_word[word] = ids
            parts.append(ids)
        found = b"".join(parts)
        if len(piece) <= CACHED_CHARS:
            self[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        if len(self.by_word) > CACHED_WORDS:
            self.by_word.clear()
        if self.cut and "<" in text and self.cut.search(text):
            return b"".join(self.special.get(part) or self.encode(part) for part in self.cut.split(text) if part)
        pieces = filter(None, _WHITE.split(text)) if _CONTROLS.search(text) else text.split()
        return b"".join(map(self.__getitem__, pieces))


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    return Encoder(path)


def id_lists(found: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(ids) // 4 for ids in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))


def encode(text: Column | str, path: str) -> Column:
    """Ids of each text: ``array<int>``, empty for null and for texts without a word.

    ``path`` names the vocabulary file on every executor. Strings of special tokens
    in a text become these tokens, as the file's own library does by default.
    """

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        table = encoder(path)
        return id_lists([table.encode(t.as_py()) if t.is_valid else b"" for t in texts])

    return ids(text)


def decode_lists(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """Each list's tokens joined by one space; ids outside the vocabulary give nothing."""
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    flat = ids.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(names)))
    if not pc.all(pc.fill_null(known, False)).as_py() and len(flat):
        keep = pc.fill_null(known, False).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lengths)), lengths)[keep]
        lengths, flat = np.bincount(row, minlength=len(lengths)), flat.filter(pa.array(keep))
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names.take(flat)), " ")


def decode(ids: Column | str, path: str) -> Column:
    """Text of each id list: its tokens with their word ends, special ones included.

    Without a decoder in the file, tokens are joined by one space. A null list gives
    an empty text.
    """

    @F.arrow_udf("string")
    def texts(lists: pa.Array) -> pa.Array:
        names, step = encoder(path).names, 500
        parts = [decode_lists(lists[i : i + step], names) for i in range(0, len(lists), step)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return texts(ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Documents with ``ids``, replacing a column of that name."""
    return docs.withColumn("ids", encode(F.col(text), path))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """Encoded documents with ``decoded``, replacing a column of that name."""
    return encoded.withColumn("decoded", decode(F.col("ids"), path))
