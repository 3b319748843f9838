"""Word search in long texts."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _checked(words: Sequence[str]) -> Sequence[str]:
    if not words or not all(re.fullmatch("[a-z]+( [a-z]+)*", word) for word in words):
        raise ValueError(f"expected lower-case ASCII words: {words!r}")
    return words


def longer_than(text: Column, n: int) -> Column:
    """Whether a text has more than ``n`` characters; only short texts, of four bytes a character at most, need a count."""
    return F.when(F.octet_length(text) > 4 * n, True).otherwise(F.length(text) > n)


def any_part(words: Sequence[str]) -> str:
    """Pattern for the words anywhere, also inside longer words, in any case."""
    return "(?i)" + "|".join(_checked(words))


def whole_word(words: Sequence[str]) -> str:
    r"""Pattern for the words between word boundaries, in any case; group 1 is the word.

    Nearly all characters of a text begin none of the words, and the look at the first letter is what they cost: a
    boundary test costs several times as much.
    """
    firsts = "".join(sorted({letter for word in _checked(words) for letter in (word[0], word[0].upper())}))
    return rf"(?=[{firsts}])\b((?i:{'|'.join(words)}))\b"


def first_word(text: Column, words: Sequence[str]) -> Column:
    """The first of the words that the text has, as it is written there, found in one pass for all words; null where there is none."""
    return F.nullif(F.regexp_extract(text, whole_word(words), 1), F.lit(""))


def mentions(text: Column, words: Sequence[str], pattern: str) -> Column:
    """The rows that match ``pattern``, a pattern that needs one of the words.

    A case-blind alternation tries every word at every character of the text.
    Plain substring search over the lowered text is several times faster and
    misses nothing, so the pattern only confirms the few texts that pass it.
    """
    lowered = F.lower(text)
    return reduce(or_, (lowered.contains(word) for word in _checked(words))) & text.rlike(pattern)
