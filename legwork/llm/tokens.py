"""Byte-level token ids of whole texts.

No token spans the boundary between a letter or sign and the space after it. Texts are
cut there, and the ids of each piece are kept, as most pieces come again.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache, cached_property

import tiktoken
from tokenizers import Tokenizer

from legwork.llm.bpe import FAMILIAR, SIGNS, byte_letters

#: Pieces kept by a worker; beyond them it starts a new table, so memory stays bounded.
CACHED_PIECES = 150_000
CACHED_CHARS = 32
#: Longer pieces go to the library whose time does not grow with their square.
LONG_PIECE = 1_000



_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value
_SPACE_BEFORE_SPACE = re.compile(r"\s ")


def pieces(text: str) -> list[str]:
    """The text cut before each space that follows no other white space.

    All pieces but the first lack their leading space.
    """
    parts = text.split(" ")
    if "" not in parts[:-1] and parts[-1] and not _SPACE_BEFORE_SPACE.search(text):
        return parts
    found, open_part = [], [parts[0]]
    for part in parts[1:]:
        if not open_part[-1] or open_part[-1][-1].isspace():
            open_part.append(part)
        else:
            found.append(" ".join(open_part))
            open_part = [part]
    return [*found, " ".join(open_part)]


class ByteEncoder(dict):
    """Bytes of little-endian 32-bit ids by piece, without the piece's leading space."""

    def __init__(self, path: str):
        super().__init__()
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        self.special = [token["content"] for token in spec["added_tokens"]]
        ranks = {bytes(map(byte.get, token)): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("pieces", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

        self.signs: dict[str, bytes] = {}

    @cached_property
    def library(self) -> Tokenizer:
        """Loaded only where a text needs it, as it takes memory."""
        return Tokenizer.from_file(self.path)

    def ids(self, piece: str) -> bytes:
        if not piece:
            return b""
        plain = piece.isascii() or max(piece) < FAMILIAR
        if not plain or len(piece) > LONG_PIECE or any([s in piece for s in self.special]):
            found = self.library.encode(piece, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(piece)
        return array("i", found).tobytes()

    def __missing__(self, piece: str) -> bytes:
        word = piece.rstrip(SIGNS)
        if len(word) < len(piece) and word.isalpha() and (word.isascii() or max(word) < FAMILIAR):
            # letters and the signs after them are never in one token
            signs = piece[len(word) :]
            if signs not in self.signs:
                if len(self.signs) > CACHED_PIECES:
                    self.signs.clear()
                self.signs[signs] = self.ids(signs)
            return self[word] + self.signs[signs]
        found = self.ids(" " + piece)
        if len(piece) <= CACHED_CHARS:
            self[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        if len(self) > CACHED_PIECES:
            self.clear()
        first, *rest = pieces(text)
        return self.ids(first) + b"".join(map(self.__getitem__, rest))


@cache
def byte_encoder(path: str) -> ByteEncoder:
    """One encoder per worker and file."""
    return ByteEncoder(path)
