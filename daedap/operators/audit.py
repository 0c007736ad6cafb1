"""Looking at gold answers before a filter or trim rule is adopted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daedap.functions.text import drop_last_char, last_char
from daedap.operators.select import GENITIVE, is_genitive, trim_particle

# The markers and particles looked at, in this order.
INSIDE_MARKERS = ("다.",)
MARKERS = ("며,", "데,", "뿐,", "라,", "고,")
PARTICLES = ("을", "를", "이", "가", "는", "은")


def _found(values: Sequence[str], holds) -> Column:
    """The values for which ``holds(value)`` is true in this row, as an array."""
    each = [F.when(holds(v), F.lit(v)) for v in values]
    return F.array_compact(F.array(*each)) if each else F.array().cast("array<string>")


def marker_hits(
    gold: DataFrame,
    inside: Sequence[str] = INSIDE_MARKERS,
    anywhere: Sequence[str] = MARKERS,
) -> DataFrame:
    """The gold answers with each marker they hold; one scan for all markers.

    ``inside`` markers count only before the last character.
    """
    answer = F.col("answer")
    body = drop_last_char(answer)
    found = F.concat(
        _found(inside, lambda m: body.contains(m)), _found(anywhere, lambda m: answer.contains(m))
    )
    return gold.select("*", F.explode(found).alias("marker"))


def marker_counts(
    gold: DataFrame,
    inside: Sequence[str] = INSIDE_MARKERS,
    anywhere: Sequence[str] = MARKERS,
) -> DataFrame:
    """``marker, n`` for every marker, those never found included."""
    answer = F.col("answer")
    body = drop_last_char(answer)
    counts = [F.count_if(body.contains(m)) for m in inside]
    counts += [F.count_if(answer.contains(m)) for m in anywhere]
    names = [*inside, *anywhere]
    rows = [
        F.struct(F.lit(m).alias("marker"), F.col(f"c{i}").alias("n")) for i, m in enumerate(names)
    ]
    return gold.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).select(
        F.inline(F.array(*rows))
    )


def genitive_hits(tagged: DataFrame, particle: str = GENITIVE) -> DataFrame:
    """Gold answers ending in a tagged genitive particle; needs ``morph`` and ``pos``."""
    return tagged.filter(is_genitive(F.col("answer"), F.col("morph"), F.col("pos"), particle))


def particle_hits(tagged: DataFrame, particles: Sequence[str] = PARTICLES) -> DataFrame:
    """Gold answers whose last morpheme is one of the particles, with its place in the list."""
    final = last_char(F.col("answer"))
    place = F.array_position(F.array(*[F.lit(p) for p in particles]), final)
    return tagged.filter(final.isin(list(particles)) & (final == F.col("morph"))).select(
        "*", final.alias("particle"), place.alias("particle_order")
    )


def trim_trace(tagged: DataFrame, particles: Sequence[str]) -> DataFrame:
    """What the particle rule does to each answer: last character, morpheme, result."""
    answer = F.col("answer")
    return tagged.select(
        "*",
        last_char(answer).alias("final"),
        trim_particle(answer, F.col("morph"), particles).alias("trimmed"),
    )
