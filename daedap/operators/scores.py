"""How scores are distributed over all documents, per question."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daedap.operators.index import Index
from daedap.operators.retrieve import (
    PLUS,
    UNIT,
    Ranker,
    base_units,
    match_units,
    question_weights,
    score_value,
    top_units,
)
from daedap.session import SmallSide, materialize, sized

# Bits of a digit in the exact quantile search, so the most rows to sort for a question;
# and where four digits begin that cover all 64 bits of a score.
DIGIT = 20
SHIFTS = (60, 40, 20, 0)
PROBS = (0.25, 0.5, 0.75)

# Bits of the lower part of a score, of which squares are added up apart.
HALF = 26


def _runs(
    index: Index, questions: DataFrame, ranker: Ranker, small: SmallSide
) -> DataFrame:
    """``question_id, match, n_docs, base``: the dense score column, equal scores counted.

    A score is base and match together. Documents without a match are one row.
    """
    weights = question_weights(questions, index, ranker, small)
    base = base_units(questions, weights, ranker, small)
    equal = materialize(
        match_units(index, weights, ranker, small)
        .groupBy("question_id", "match")
        .agg(F.count("*").alias("n_docs"))
    )
    matched = equal.groupBy("question_id").agg(F.sum("n_docs").alias("matched"))
    others = questions.join(small(matched), "question_id", "left").select(
        "question_id",
        F.lit(0).cast("long").alias("match"),
        (F.lit(index.n_documents) - F.coalesce("matched", F.lit(0))).alias("n_docs"),
    )
    return equal.unionByName(others.filter(F.col("n_docs") > 0)).join(small(base), "question_id")


def _whole(value: Column) -> Column:
    return value.cast("decimal(19,0)")


def _squares() -> Column:
    """The sum of squares from sums over the upper and lower parts of each number."""
    parts = ((F.col("hh"), 2 * HALF), (F.col("hl"), HALF + 1), (F.col("ll"), 0))
    return reduce(Column.__add__, [part.cast("double") * float(2**shift) for part, shift in parts])


def score_runs(index: Index, questions: DataFrame, ranker: Ranker = PLUS) -> DataFrame:
    """``question_id, score, n_docs``: every question's sorted scores, equal ones counted."""

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        return (
            _runs(index, batch, ranker, small)
            .groupBy("question_id", score_value(F.col("base") + F.col("match")).alias("score"))
            .agg(F.sum("n_docs").alias("n_docs"))
        )

    return sized(questions, run)


def _shifts(index: Index, questions: DataFrame, ranker: Ranker, small: SmallSide) -> tuple[int, ...]:
    """Where the digits begin that cover every match; one number comes to the driver."""
    if ranker.signed:
        return SHIFTS
    weights = question_weights(questions, index, ranker, small)
    most = F.col("qtf") * F.col("idf") * ranker.gain(F.col("densest"), F.lit(1.0)) * UNIT + 2
    total = weights.groupBy("question_id").agg(F.sum(most).alias("most"))
    bits = int(total.agg(F.max("most")).first()[0] or 0).bit_length()
    return tuple(range(DIGIT * max(0, -(-bits // DIGIT) - 1), -1, -DIGIT))


def _values_at(
    runs: DataFrame,
    wanted: DataFrame,
    small: SmallSide,
    shifts: tuple[int, ...] = SHIFTS,
    first: DataFrame | None = None,
) -> DataFrame:
    """The values at 0-based places ``skip`` of each question's sorted ``runs``.

    Digit by digit from the top: count the rows per digit value, find the digit
    in which the place falls, go on inside it. A group to sort never has more
    than 2^20 rows, however many documents a question matches. ``first`` are the counts
    of the first digit, ``question_id, digit, n``, where they are known.
    """
    zero = F.lit(0).cast("long")
    found = wanted.withColumn("prefix", zero)
    for above, shift in zip((None, *shifts), shifts):
        # One row per prefix, with the few places looked for in it. They go along
        # in the grouping key, so each step reads the step before only once.
        places = found.groupBy("question_id", "prefix").agg(
            F.collect_list(F.struct("place", "skip")).alias("places")
        )
        if above is None and first is not None:
            counted = first.join(small(places), "question_id")
        else:
            prefix = zero if above is None else F.shiftright("units", above)
            counted = (
                runs.withColumn("prefix", prefix)
                .join(small(places), ["question_id", "prefix"])
                .groupBy("question_id", "prefix", "places", F.shiftright("units", shift).alias("digit"))
                .agg(F.sum("n_docs").alias("n"))
            )
        up_to = F.sum("n").over(Window.partitionBy("question_id", "prefix").orderBy("digit"))
        before = F.col("after") - F.col("n")
        found = (
            counted.withColumn("after", up_to)
            .select("*", F.inline("places"))
            .filter((F.col("skip") >= before) & (F.col("skip") < F.col("after")))
            .select(
                "question_id",
                "place",
                (F.col("skip") - before).alias("skip"),
                F.col("digit").alias("prefix"),
            )
        )
    return found.select("question_id", "place", F.col("prefix").alias("units"))


def score_distribution(
    index: Index, questions: DataFrame, ranker: Ranker = PLUS, cut: float = 0.95
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per question.

    Over the scores of all documents, with or without a match. Quartiles are exact
    and interpolated; ``cut_score`` is ``cut`` times the best score. One aggregation gives
    the moments and a coarse histogram of each question, a second one looks into the few
    buckets with the wanted places; scores of more than 40 bits take a third.
    """

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        runs = _runs(index, batch, ranker, small)
        match, docs = F.col("match"), F.col("n_docs")
        # Sums of whole numbers, so that no order of the rows changes them; a square
        # is added up in parts that a decimal always holds.
        high, low = F.shiftright("match", HALF), match - F.shiftleft(F.shiftright("match", HALF), HALF)
        shifts = _shifts(index, batch, ranker, small)
        histogram = runs.groupBy(
            "question_id", "base", F.shiftright("match", shifts[0]).alias("digit")
        ).agg(
            F.sum("n_docs").alias("n"),
            F.sum(_whole(docs) * match).alias("s1"),
            F.sum(_whole(docs) * _whole(high) * high).alias("hh"),
            F.sum(_whole(docs) * _whole(high) * low).alias("hl"),
            F.sum(_whole(docs) * _whole(low) * low).alias("ll"),
            F.min("match").alias("min"),
            F.max("match").alias("max"),
        )
        moments = (
            histogram.groupBy("question_id", "base")
            .agg(
                F.sum("n").alias("count"),
                *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("s1", "hh", "hl", "ll")],
                F.min("min").alias("min"),
                F.max("max").alias("max"),
            )
            .withColumn("mean", F.col("s1").cast("double") / F.col("count"))
            .withColumn("squares", _squares())
            .withColumn(
                "std",
                F.sqrt(
                    F.greatest(
                        F.col("squares") - F.col("s1").cast("double") * F.col("mean"), F.lit(0.0)
                    )
                    / F.nullif(F.col("count") - 1, F.lit(0))
                )
                / UNIT,
            )
            .withColumn("mean", (F.col("base") + F.col("mean")) / UNIT)
        )
        places = F.array(
            *[F.floor((F.col("count") - 1) * p) for p in PROBS],
            *[F.ceil((F.col("count") - 1) * p) for p in PROBS],
        )
        wanted = moments.select("question_id", F.posexplode(places).alias("place", "skip"))
        value = [F.max(F.when(F.col("place") == i, F.col("units"))) for i in range(2 * len(PROBS))]
        column = runs.select("question_id", F.col("match").alias("units"), "n_docs")
        quartiles = (
            _values_at(column, wanted, small, shifts, histogram.select("question_id", "digit", "n"))
            .groupBy("question_id")
            .agg(*[v.alias(f"v{i}") for i, v in enumerate(value)])
        )

        def interpolated(i: int) -> Column:
            low, high = F.col(f"v{i}"), F.col(f"v{i + len(PROBS)}")
            exact = (F.col("count") - 1) * PROBS[i]
            between = F.floor((high - low) * (exact - F.floor(exact)) + 0.5)
            return F.col("base") + low + between

        best = score_value(F.col("base") + F.col("max"))
        return moments.join(small(quartiles), "question_id", "left").select(
            "question_id",
            "count",
            F.round("mean", 4).alias("mean"),
            F.round("std", 4).alias("std"),
            score_value(F.col("base") + F.col("min")).alias("min"),
            *[score_value(interpolated(i)).alias(f"q{int(p * 100)}") for i, p in enumerate(PROBS)],
            best.alias("max"),
            F.round(cut * best, 4).alias("cut_score"),
        )

    return sized(questions, run)


def best_scores(
    index: Index, questions: DataFrame, n: int = 5, ranker: Ranker = PLUS
) -> DataFrame:
    """``question_id, rank, score``: the n largest scores over all documents."""

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        top = top_units(index, batch, n, ranker, False, small)
        return top.select("question_id", "rank", score_value(F.col("units")).alias("score"))

    return sized(questions, run)
