"""Encode texts piece by piece, and each different piece once.

The split pattern of byte-level vocabularies lets a white-space run begin a token but never
lets white space follow another character within one.  So a text may be cut before any
space that follows a character that isn't white space: the pieces' ids in a row are
the text's ids.  Ordinary prose repeats its words, so most pieces are looked up.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa

MOST = 1 << 19  # pieces of a generation; a worker holds two

# Python's white space includes all that the split pattern knows, so these are on the safe side.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
_BOUNDARY = re.compile(r"(?<=\S)(?= )")


class Pieces(dict):
    """What a function gives for each piece; filled as pieces come up.

    Pieces that have not come up for a whole generation are forgotten.
    """

    def __init__(self, function: Callable[[str], object], before: str = "", most: int | None = None):
        super().__init__()
        self.function, self.before, self.most = function, before, most or MOST
        self.earlier: dict[str, object] = {}

    def __missing__(self, piece: str):
        made = self.earlier.get(piece)
        if made is None:
            made = self.function(self.before + piece)
        if len(piece) < 64:
            if len(self) >= self.most:
                self.earlier = dict(self)
                self.clear()
            self[piece] = made
        return made


def space_after_space(text: str) -> bool:
    """Whether a space follows white space; most kinds of it are in no text at all."""
    return any(c in text and c + " " in text for c in _SPACES)


_kept: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What `make` makes, once in a worker process: pieces looked up by one task serve the next."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def release() -> None:
    """Forget what is kept: a worker that goes on to other work needs the memory."""
    _kept.clear()
    spare()


def spare() -> None:
    """Give back the memory that Arrow holds for batches to come; those of the last stage were others."""
    pa.default_memory_pool().release_unused()


class Encoder:
    """Gives, for a text, what a function gives for its pieces, as a list."""

    def __init__(self, function: Callable[[str], object], most: int | None = None):
        self.whole = Pieces(function, most=most)
        self.spaced = Pieces(function, " ", most)

    def __call__(self, text: str) -> list:
        if space_after_space(text):
            return list(map(self.whole.__getitem__, _BOUNDARY.split(text)))
        first, *rest = text.split(" ")
        return [self.whole[first], *map(self.spaced.__getitem__, rest)]
