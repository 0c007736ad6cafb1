"""What quality rules and classifiers look at: counts over one whole text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from daedap.llm.shingles import SPACE, windows, word_hashes

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
WINDOW = 8

NAMES = (
    "n_words",
    "word_chars",  # code points in words
    "n_symbols",  # characters of SYMBOLS
    "n_dup_lines",  # lines with a word, equal to an earlier line
    "n_repeat_words",  # words in windows of eight that occur twice or more
    "n_lines",  # lines with a word
    "n_ended",  # of these, those that end in . ! or ?
    "n_distinct",  # different words
    "n_top",  # occurrences of the most frequent word
    "n_upper",  # A to Z
    "n_lower",  # a to z
    "n_shouted",  # words that end in !!
)
MEASURES = StructType([StructField(name, LongType()) for name in NAMES])


def _number(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside windows that occur at least twice, the first occurrence included."""
    found = windows(hashes, WINDOW)
    if len(found) < 2:
        return 0
    _, which, counts = np.unique(found, return_inverse=True, return_counts=True)
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(counts[which] > 1)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges) > 0).sum())


def measure(data: bytes | None) -> tuple[int, ...]:
    """The measures of a text in UTF-8; null is empty, and an empty text has none."""
    data = data or b""
    words = data.split()
    if not words:
        return (0, 0, _number(data, SYMBOLS), *[0] * (len(NAMES) - 3))
    hashes = word_hashes(words)
    counts = np.unique(hashes, return_counts=True)[1]
    seen, n_dup, n_lines, n_ended = set(), 0, 0, 0
    for line in data.split(b"\n"):
        text = line.strip()
        if text:
            n_lines += 1
            n_ended += text.endswith((b".", b"!", b"?"))
            n_dup += line in seen
        seen.add(line)
    return (
        len(words),
        len(data.translate(None, SPACE).decode("utf-8", "replace")),
        _number(data, SYMBOLS),
        n_dup,
        repeated_words(hashes),
        n_lines,
        n_ended,
        len(counts),
        int(counts.max()),
        _number(data, UPPER),
        _number(data, LOWER),
        sum(w.endswith(b"!!") for w in words),
    )


# Texts of a batch that stand in Python at a time, so that its worker stays small.
TEXTS = 256


def texts_of(texts: pa.Array) -> Iterator[bytes | None]:
    """The texts of a batch in UTF-8, in order."""
    for i in range(0, len(texts), TEXTS):
        yield from texts.slice(i, TEXTS).cast(pa.binary()).to_pylist()


@F.arrow_udf(MEASURES)
def _measured(texts: pa.Array) -> pa.Array:
    rows = [measure(data) for data in texts_of(texts)]
    columns = zip(*rows) if rows else [()] * len(NAMES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(NAMES))


def measured(text: str) -> Column:
    """The measures of a text column as one struct."""
    return _measured(F.col(text).cast("string"))


def share(part: Column, whole: Column) -> Column:
    """A quotient that is 0 where there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
