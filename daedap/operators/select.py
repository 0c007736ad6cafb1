"""From answer candidates to one answer per question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daedap.functions.text import contains_any, drop_last_char, last_char

# The genitive particle and its tag.
GENITIVE = "의"
GENITIVE_TAG = "JKG"


def acceptable(answer: Column, inside: Sequence[str], anywhere: Sequence[str]) -> Column:
    """No ``inside`` marker before the last character, no ``anywhere`` marker at all."""
    return ~(contains_any(drop_last_char(answer), inside) | contains_any(answer, anywhere))


def length_within(answer: Column, least: int, most: int | None) -> Column:
    long_enough = F.length(answer) >= least
    return long_enough if most is None else long_enough & (F.length(answer) <= most)


def last_morph_of_text(df: DataFrame, tag: str | None = None) -> DataFrame:
    """A stand-in for a tagger: the last character is the last morpheme, tagged ``tag``."""
    return df.withColumn("morph", last_char(F.col("answer"))).withColumn(
        "pos", F.lit(tag).cast("string")
    )


def with_last_morph(
    df: DataFrame, last_morph: DataFrame, endings: Sequence[str], salts: int | None = None
) -> DataFrame:
    """Add ``morph`` and ``pos`` from a tagger's table ``last_morph(answer, morph, pos)``.

    The table has one row per answer. Only answers ending in one of ``endings``
    are looked up. A very frequent answer is spread over ``salts`` tasks, each
    with a copy of its table row, and rows without a lookup over all tasks; without
    a number, over an eighth of ``spark.sql.shuffle.partitions``, at least 8. Where the
    table is small, Spark broadcasts it instead.
    """
    if salts is None:
        salts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    spread = F.xxhash64(*df.columns)
    needed = F.coalesce(last_char(F.col("answer")).isin(list(endings)), F.lit(False))
    keyed = df.withColumn("lookup", F.when(needed, F.col("answer"))).withColumn(
        "salt", F.when(needed, F.pmod(spread, F.lit(salts))).otherwise(spread)
    )
    table = last_morph.select(
        F.col("answer").alias("lookup"),
        "morph",
        "pos",
        F.explode(F.expr(f"sequence(0L, {salts - 1}L)")).alias("salt"),
    )
    return keyed.join(table, ["lookup", "salt"], "left").drop("lookup", "salt")


def trim_particle(answer: Column, morph: Column, particles: Sequence[str]) -> Column:
    """Drop a final particle that is the last morpheme, whatever its part of speech."""
    final = last_char(answer)
    return F.when(final.isin(list(particles)) & (final == morph), drop_last_char(answer)).otherwise(
        answer
    )


def is_genitive(answer: Column, morph: Column, pos: Column, particle: str = GENITIVE) -> Column:
    tagged = (last_char(answer) == particle) & (morph == particle) & (pos == GENITIVE_TAG)
    return F.coalesce(tagged, F.lit(False))


def trim_genitive(answer: Column, morph: Column, pos: Column, particle: str = GENITIVE) -> Column:
    """Drop a final genitive particle, only where the tagger says it is one."""
    return F.when(is_genitive(answer, morph, pos, particle), drop_last_char(answer)).otherwise(
        answer
    )


def trim_genitive_if_candidate(candidates: DataFrame, particle: str = GENITIVE) -> DataFrame:
    """Drop the genitive only where what is left is a candidate of the question too.

    Every candidate marks its own text; one that could be trimmed also stands
    under its trimmed text and sees there whether that was marked. One shuffle,
    by question and text.
    """
    genitive = is_genitive(F.col("answer"), F.col("morph"), F.col("pos"), particle)

    def standing(text: Column, keep: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(keep).alias("keep"))

    own = F.col("answer")
    places = F.when(
        genitive, F.array(standing(own, False), standing(drop_last_char(own), True))
    ).otherwise(F.array(standing(own, True)))
    marked = F.max(F.col("text") == own).over(Window.partitionBy("question_id", "text"))
    return (
        candidates.select("*", F.inline(places))
        .withColumn("marked", marked)
        .filter("keep")
        .withColumn("answer", F.when(F.col("marked"), F.col("text")).otherwise(own))
        .drop("text", "keep", "marked")
    )


def among_candidates(wanted: DataFrame, candidates: DataFrame) -> DataFrame:
    """The rows of ``wanted(question_id, answer)`` that are candidates of their question."""
    pool = candidates.select("question_id", "answer")
    return wanted.join(pool, ["question_id", "answer"], "left_semi")


def first_of_question(accepted: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """The first row of each question in ``order``.

    A minimum, so every task sends at most one row per question.
    """
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    first = F.min(F.struct(*keys, *columns)).alias("first")
    return (
        accepted.groupBy("question_id")
        .agg(first)
        .select("question_id", *[F.col(f"first.{c}").alias(c) for c in columns])
    )


def with_unanswered(answers: DataFrame, questions: DataFrame) -> DataFrame:
    """Every question with its answer and stage; stage ``none`` where there is no answer."""
    return (
        questions.select("question_id")
        .join(answers, "question_id", "left")
        .select("question_id", "answer", F.coalesce("stage", F.lit("none")).alias("stage"))
    )


def answer_report(answers: DataFrame) -> DataFrame:
    """How many questions ended in each stage."""
    return answers.groupBy("stage").agg(F.count("*").alias("n_questions"))
