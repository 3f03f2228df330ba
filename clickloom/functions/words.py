"""Text clean-up and tokenising as built-in expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token filters of the keyword job (a token matching one is dropped).
STOP_PATTERNS = [
    r"^[一二三四五六七八九十].{0,2}$",
    r"^.{0,1}$",
    r"^[0-9]+$",
    r"^[a-zA-Z]+$",
    r"^[^a-zA-Z0-9一-龥]+$",
    r"^[0-9]+%$",
]
# For texts in Latin scripts: one-letter tokens and numbers only.
LATIN_STOP_PATTERNS = [r"^.{0,1}$", r"^[0-9]+$", r"^[0-9]+%$"]

# Characters the classifier removes before segmenting.
BLANKS = r"[\r\n 　\t]"
SYMBOLS = r"[\p{P}\p{S}\p{C}\p{N}\p{Z}]"
TAGS = r"<[^>]*>"


def strip_symbols(text: Column) -> Column:
    """Drop blanks, punctuation, symbols, control characters and digits."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, BLANKS, ""), SYMBOLS, ""))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, TAGS, " ")


def split_words(text: Column, separator: str = r"[^\p{L}\p{N}]+") -> Column:
    """Lower-cased words of the whole text."""
    return F.filter(F.split(F.lower(text), separator), lambda w: w != "")


def drop_patterns(words: Column, patterns) -> Column:
    if not patterns:
        return words
    return F.filter(words, lambda w: ~w.rlike("|".join(f"(?:{p})" for p in patterns)))


def join_fields(*fields: Column) -> Column:
    """Title, body, summary ... as one text; missing fields are skipped."""
    return F.concat_ws(" ", *fields)


def label_number(label: Column) -> Column:
    """``C11-Space`` -> 11.0"""
    return F.regexp_extract(label, r"^.(\d+)", 1).try_cast("double")
