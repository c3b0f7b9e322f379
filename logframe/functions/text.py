"""Whole-word tests and counts on text, without taking the text apart.

A word is a longest run of letters and digits of the lower-cased text. Each
test first looks for the plain substring, which is cheap and rules out most
texts, and only then checks the word's ends with a regular expression.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what words are made of; everything else separates them.
WORD_CHARACTER = r"[\p{L}\p{N}]"
WORD_BREAK = r"[^\p{L}\p{N}]+"


def query_words(words: str | Iterable[str]) -> list[str]:
    """The words asked for, split like a text."""
    text = words if isinstance(words, str) else " ".join(words)
    found = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    if not found:
        raise ValueError(f"no words in {words!r}")
    return found


def _whole(pattern: str) -> str:
    """The pattern with a word's start before it and a word's end behind it."""
    return f"(?<!{WORD_CHARACTER}){pattern}(?!{WORD_CHARACTER})"


def mentions_any(text: Column, words: list[str]) -> Column:
    """One of the words occurs, if only inside a longer word."""
    return functools.reduce(operator.or_, [F.lower(text).contains(w) for w in words])


def has_any_word(text: Column, words: list[str]) -> Column:
    return mentions_any(text, words) & F.lower(text).rlike(_whole(f"(?:{'|'.join(words)})"))


def has_words_in_a_row(text: Column, words: list[str]) -> Column:
    mentioned = [F.lower(text).contains(w) for w in dict.fromkeys(words)]
    in_a_row = F.lower(text).rlike(_whole(WORD_BREAK.join(words)))
    return functools.reduce(operator.and_, [*mentioned, in_a_row])


def word_count(text: Column) -> Column:
    """How many words a text has: one less than the pieces between them."""
    return F.size(F.split(F.lower(text), WORD_CHARACTER + "+")) - 1


def occurrences(text: Column, word: str) -> Column:
    return F.regexp_count(F.lower(text), F.lit(_whole(word)))
