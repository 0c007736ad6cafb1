"""Token sequences a reader works on: packing, cutting, slicing, reading back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daedap.functions.text import WORD_START

BOS = "<s>"
EOS = "</s>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row.

    The optimizer may inline an expression into a lambda and so repeat it for
    every array element; a lambda variable is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pack(
    question: Column,
    document: Column,
    special_tokens: bool = True,
    separator: bool = True,
) -> Column:
    """``<s> question </s> </s> document </s>`` as one token array.

    Without the separator one ``</s>`` stands between the two. Without special
    tokens only the question is left: the document is dropped altogether.
    """
    if not special_tokens:
        return question
    between = [F.lit(EOS)] * (2 if separator else 1)
    return F.concat(
        F.array(F.lit(BOS)), question, F.array(*between), document, F.array(F.lit(EOS))
    )


def document_start(question: Column, separator: bool = True) -> Column:
    """0-based position of the document's first token in a packed sequence."""
    return F.size(question) + (3 if separator else 2)


def truncate(sequence: Column, max_len: int | None) -> Column:
    """Cut a sequence to a model's maximum length; ``None`` keeps it whole."""
    return sequence if max_len is None else F.slice(sequence, 1, max_len)


def token_slice(sequence: Column, start: Column, end: Column) -> Column:
    """Tokens ``start..end``, both included and 0-based; empty when end < start."""
    return F.slice(sequence, start + 1, F.greatest(end - start + 1, F.lit(0)))


def detokenize(tokens: Column) -> Column:
    """Text of a token slice.

    A leading ``<s>`` is dropped. Two ``</s>`` in a row mean the slice spans
    question and document; such a slice has no single text and gives ''.
    """
    body = F.when(F.get(tokens, F.lit(0)) == BOS, F.slice(tokens, 2, F.size(tokens))).otherwise(
        tokens
    )

    def plain(t: Column) -> Column:
        joined = F.replace(F.array_join(t, ""), F.lit(" "), F.lit(""))
        return F.trim(F.replace(joined, F.lit(WORD_START), F.lit(" ")))

    def text(t: Column) -> Column:
        # Tokens hold no blanks, so "</s> </s>" shows up only where two adjoin.
        spans_both = F.array_join(t, " ").contains(f"{EOS} {EOS}")
        # Few slices hold a separator at all, so only those are searched for two.
        return (
            F.when(~F.array_contains(t, EOS), plain(t))
            .when(spans_both, "")
            .otherwise(plain(F.array_remove(t, EOS)))
        )

    return F.coalesce(let(body, text), F.lit(""))
