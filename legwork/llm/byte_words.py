"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts are joined into blocks of about ``BLOCK`` bytes, each text followed by a line feed,
so no word or piece spans two texts. A longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

from legwork.llm.chars import mix

BLOCK = 1 << 19
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """``data`` in lower case, where words start and end in it, and each word's text number."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    n_texts: int


def blocks(texts: Iterable[str | None], size: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Encoded texts in blocks, each with the number of its first text."""
    held, length, first = [], 0, 0
    for number, text in enumerate(texts):
        if held and length + len(text or "") > size:
            yield first, held
            held, length, first = [], 0, number
        held.append((text or "").encode("utf-8", "surrogatepass"))
        length += len(held[-1])
    if held:
        yield first, held


def words_of(block: list[bytes], inside: np.ndarray) -> Words:
    """Words of a block: longest runs of bytes that ``inside`` marks (a table of 256)."""
    data = LOWER[np.frombuffer(b"\n".join([*block, b""]), np.uint8)]
    mark = np.zeros(len(data) + 1, np.int8)
    mark[1:] = inside[data]
    edge = np.diff(mark)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.cumsum([len(b) + 1 for b in block])
    return Words(data, start, end, np.searchsorted(ends, start, side="right"), len(block))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    up = np.full(n, base, np.uint64)
    down = np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_block_powers = lru_cache(maxsize=len(_BASES))(_powers)


def hashes(words: Words, which: int = 0) -> np.ndarray:
    """64-bit polynomial hashes of the words, the same in every block; ``which`` picks one of two."""
    # Only the powers that a block usually needs are kept.
    n = len(words.data)
    up, down = _block_powers(int(_BASES[which]), 2 * BLOCK) if n <= 2 * BLOCK else _powers(int(_BASES[which]), n)
    sums = np.zeros(len(words.data) + 1, np.uint64)
    np.cumsum((words.data.astype(np.uint64) + np.uint64(1)) * up[: len(words.data)], out=sums[1:])
    return mix((sums[words.end] - sums[words.start]) * down[words.start])


class WordTable:
    """Numbers from 1 for words, equal for equal bytes."""

    def __init__(self) -> None:
        self.names: list[bytes] = [b""]
        self._numbers: dict[bytes, int] = {}

    def __len__(self) -> int:
        return len(self._numbers)

    def _number(self, word: bytes) -> int:
        found = self._numbers.get(word)
        if found is None:
            found = self._numbers[word] = len(self.names)
            self.names.append(word)
        return found

    def numbers(self, words: Words, at: np.ndarray, first: np.ndarray, second: np.ndarray, most: int | None = None) -> np.ndarray | None:
        """Numbers of the words at the given places, by both hashes of the block's words.

        Words are told apart by the first hash, which the second one checks; where they
        disagree, each word's bytes are looked up. Nothing is numbered, and None returned,
        where the numbers might pass ``most``.
        """
        found, place, codes = np.unique(first[at], return_index=True, return_inverse=True)
        checked = np.array_equal(second[at], second[at][place][codes])
        lookup = at[place] if checked else at
        spans = zip(words.start[lookup].tolist(), words.end[lookup].tolist())
        data = memoryview(words.data)
        named = [bytes(data[s:e]) for s, e in spans]
        if most is not None and len(self) + len(lookup) > most and len(self._numbers.keys() | set(named)) > most:
            return None
        ids = np.fromiter(map(self._number, named), np.int64, len(lookup))
        return ids[codes] if checked else ids
