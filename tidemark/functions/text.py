"""Splitting text into lower-case words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of these separate words; (?U) makes the class Unicode-wide.
DELIMITER = r"(?U)\W+"
WORD_CHARACTER = r"(?U)\w"


def pieces(text: Column) -> Column:
    """Lower-cased text cut at every run of non-word characters.

    Like the split it follows, it leaves an empty piece before a leading and
    after a trailing delimiter; ``is_word`` says which of them count.
    """
    return F.split(F.lower(text), DELIMITER)


def has_leading_piece(text: Column) -> Column:
    """Whether an empty first piece is kept: not when the text is all delimiters."""
    return (text == "") | text.rlike(WORD_CHARACTER)


def is_word(piece: Column, position: Column, leading: Column) -> Column:
    """Keep every non-empty piece, and an empty one only at the very front.

    A delimiter run is matched whole, so an empty piece after the first
    position can only be the trailing one, which is dropped.
    """
    return (piece != "") | ((position == 0) & leading)
