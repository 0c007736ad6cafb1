"""Writing and reading the answer map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daedap.session import materialize

ENTRY = "map<string,string>"


def last_write_wins(answers: DataFrame, order: str | Column | None = None) -> DataFrame:
    """One row per question: the last one in ``order``, without it the last of the table."""
    if order is None:
        order = F.monotonically_increasing_id()
    others = [c for c in answers.columns if c != "question_id"]
    ordered = answers.withColumn("_order", F.col(order) if isinstance(order, str) else order)
    kept = ordered.groupBy("question_id").agg(F.max_by(F.struct(*others), "_order").alias("kept"))
    return kept.select("question_id", "kept.*")


def map_entries(answers: DataFrame) -> DataFrame:
    """``question_id, entry`` with the entry as JSON text, ``"id":"answer"``.

    Unanswered questions have no entry.
    """
    pair = F.to_json(F.create_map(F.col("question_id").cast("string"), F.col("answer")))
    return answers.filter(F.col("answer").isNotNull()).select(
        "question_id", pair.substr(F.lit(2), F.length(pair) - 2).alias("entry")
    )


def write_answer_map(
    answers: DataFrame, path: str, order: str | Column | None = None
) -> None:
    """Write ``question_id, answer`` as one JSON object spread over part files.

    Every task writes its own lines; the part files joined in name order are the
    object. No task and no driver holds the whole map. Of rows that repeat an id the
    last one in ``order`` stays, without it the last one of the table.
    """
    entries = materialize(map_entries(last_write_wins(answers, order)))
    if entries.isEmpty():
        answers.sparkSession.sql("SELECT '{}' AS value").write.text(path)
        return
    first = entries.agg(F.min("question_id")).scalar()
    end = entries.agg(F.max("question_id")).scalar()
    line = F.concat(
        F.when(F.col("question_id") == first, "{").otherwise(""),
        F.col("entry"),
        F.when(F.col("question_id") == end, "}").otherwise(","),
    )
    entries.orderBy("question_id").select(line.alias("value")).write.text(path)


def write_answer_rows(answers: DataFrame, path: str) -> None:
    """Write one JSON record per answered question."""
    kept = answers.filter(F.col("answer").isNotNull())
    kept.select("question_id", "answer").write.json(path)


def read_answer_map(spark: SparkSession, path: str) -> DataFrame:
    """Read back what ``write_answer_map`` wrote, as ``question_id, answer`` strings.

    A line that is no entry raises an error.
    """
    inside = F.regexp_replace("value", r"^\{|[,}]$", "")
    entry = F.from_json(F.concat(F.lit("{"), inside, F.lit("}")), ENTRY, {"mode": "FAILFAST"})
    unreadable = F.raise_error(F.concat(F.lit("no entry: "), "value")).cast(ENTRY)
    lines = spark.read.text(path).select(F.coalesce(entry, unreadable).alias("entry"))
    return lines.select(F.explode("entry").alias("question_id", "answer"))
