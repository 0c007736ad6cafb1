"""Text cleaning and tokenizing, as column expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Tokenizer = Callable[[Column], Column]

# Newline forms, longest first, written and real.
NEWLINE_FORMS = ("\\n\\n", "\n\n", "\\n", "\n")

# Fixed value: the characters that survive cleaning (after lowercasing).
KEPT_CHARS = "0-9a-zA-Zㄱ-ㅎㅏ-ㅣ가-힣"

WORD_START = "▁"
WORD_OR_MARK = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
MARKED_WORD_OR_MARK = rf"{WORD_START}?(?:[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WORD_START}])"
BLANKS = " \t\r\n\f"


def searchable(title: Column, text: Column) -> Column:
    """Title, a space, text. A missing part counts as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")))


def drop_newlines(col: Column) -> Column:
    """Real newlines and the two-character form backslash-n become spaces.

    This must come before lowercasing and the character filter: later on, the
    written form would leave its ``n`` behind as a letter.
    """
    for form in NEWLINE_FORMS:
        col = F.replace(col, F.lit(form), F.lit(" "))
    return col


def lowered(col: Column) -> Column:
    """Text without newlines, in lower case."""
    return F.lower(F.trim(drop_newlines(col)))


def clean_words(col: Column) -> Column:
    """The words of cleaned text: newlines, lowercase, character filter, blank runs.

    One regular expression does the filter and the splitting. Picking out the
    kept runs is some eight times faster in Spark than replacing the others.
    """
    return F.regexp_extract_all(lowered(col), F.lit(f"[{KEPT_CHARS}]+"), F.lit(0))


def normalize(col: Column) -> Column:
    """Cleaned text: its words, one space apart."""
    return F.array_join(clean_words(col), " ")


def word_tokens(col: Column) -> Column:
    """Words and single marks of raw text."""
    return F.regexp_extract_all(col, F.lit(WORD_OR_MARK), F.lit(0))


def marked_tokens(col: Column) -> Column:
    """Words and single marks of raw text; a token after a blank starts with ``▁``."""
    marked = F.concat(F.lit(WORD_START), F.translate(col, BLANKS, WORD_START * len(BLANKS)))
    return F.regexp_extract_all(marked, F.lit(MARKED_WORD_OR_MARK), F.lit(0))


def term_of(token: Column) -> Column:
    """The index term that a reader token stands for."""
    return F.lower(F.replace(token, F.lit(WORD_START), F.lit("")))


def last_char(col: Column) -> Column:
    return F.right(col, F.lit(1))


def drop_last_char(col: Column) -> Column:
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - 1, F.lit(0)))


def contains_any(col: Column, parts: Sequence[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | col.contains(part)
    return found
