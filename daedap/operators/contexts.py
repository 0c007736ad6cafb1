"""Contexts to read, put together from ranked documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Contexts per question, documents in each, and what joins them.
WINDOWS = 7
WIDTH = 3
JOINER = " \n"


def blank_outside_scope(ranked: DataFrame) -> DataFrame:
    """Blank the text of documents that may not be returned; they keep their rank."""
    return ranked.withColumn("text", F.when(F.col("is_candidate"), F.col("text")).otherwise(""))


def drop_blank(ranked: DataFrame) -> DataFrame:
    """Drop blank documents and close the gaps in the ranks."""
    by_rank = Window.partitionBy("question_id").orderBy("rank")
    return ranked.filter(F.col("text") != "").withColumn("rank", F.row_number().over(by_rank))


def sliding_contexts(
    ranked: DataFrame, questions: DataFrame, windows: int = WINDOWS, width: int = WIDTH
) -> DataFrame:
    """``question_id, rank, text``: window e joins the documents of ranks e-2 to e.

    Every question gets all windows. Those past its last document shrink and are
    empty in the end. A document knows the windows it belongs to, so there is no
    range join; a window holds at most ``width`` documents.
    """
    member = F.sequence(F.col("rank"), F.least(F.col("rank") + width - 1, F.lit(windows)))
    texts = F.sort_array(F.collect_list(F.struct("rank", "text")))
    filled = (
        ranked.filter(F.col("rank") <= windows)
        .select("question_id", "rank", "text", F.explode(member).alias("window"))
        .groupBy("question_id", "window")
        .agg(F.array_join(F.transform(texts, lambda t: t["text"]), JOINER).alias("text"))
    )
    every = questions.select(
        "question_id", F.explode(F.sequence(F.lit(1), F.lit(windows))).alias("window")
    )
    return every.join(filled, ["question_id", "window"], "left").select(
        "question_id", F.col("window").alias("rank"), F.coalesce("text", F.lit("")).alias("text")
    )
