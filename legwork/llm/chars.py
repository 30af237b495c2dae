"""Texts as numpy arrays of code points, for n-gram hashing inside tasks."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Longer texts are worked on in slices cut at white space, so memory stays bounded.
SLICE = 1 << 20


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The whole text in order, cut before a space where there is one."""
    at = 0
    while len(text) - at > size:
        cut = text.rfind(" ", at + size // 2, at + size)
        cut = at + size if cut < 0 else cut
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


@cache
def word_letters() -> np.ndarray:
    """Whether each code point is a letter or a mark."""
    return np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(0x110000)), bool, 0x110000)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def mix(keys: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit keys."""
    x = keys.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
