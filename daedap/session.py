"""The shared folder, and keeping broadcasts within a checked size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """The sizes that decide how a job is divided; none changes its rows.

    ``batch_tokens`` and ``batch_questions`` bound what a question set broadcasts: its
    tokens, some 100 bytes each, and its ranked documents, some 40 bytes each and 30 to
    a question; so 200 MB and 60 MB, far below what Spark accepts. A larger question set
    is ranked and answered in batches that fit, one after the other; where all scores are
    wanted, it meets the postings in one shuffle join instead, frequent terms split.

    Up to ``named_tokens`` tokens of a question set, its terms are named in the posting
    scan, which then reads only the pages that can hold them.

    ``direct_pairs`` is no longer looked at: the best documents are found in chunks of
    documents, however many pairs there are.

    An index has a partition for every ``documents_per_task`` documents, at most
    ``most_partitions`` (bucketed tables may not have many more), and fewer than
    ``spark.sql.shuffle.partitions`` if these would hold under ``few_documents`` each.
    A stored corpus has at most ``most_blocks`` blocks, of ``least_block`` documents or more.
    """

    batch_tokens: int = 2_000_000
    batch_questions: int = 50_000
    named_tokens: int = 4_096
    direct_pairs: int = 20_000_000_000
    documents_per_task: int = 50_000
    few_documents: int = 250
    most_partitions: int = 50_000
    most_blocks: int = 4_096
    least_block: int = 256


LIMITS = Limits()


@dataclass(frozen=True)
class SmallSide:
    """Marks the small side of a join, and tells what is known of the question set."""

    broadcasts: bool
    tokens: int
    terms: list[str] | None  # its different tokens, where they are few

    def __call__(self, df: DataFrame) -> DataFrame:
        return F.broadcast(df) if self.broadcasts else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session, where driver and executors are one machine, may go without
    the setting; it uses a folder in its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(named or f"{warehouse}/_shared-{context.applicationId}")
    return named or context.getCheckpointDir()


# Has Spark remove what a query shuffled as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind.

    Without it these stay on the executors' disks until the driver's garbage collector
    happens to find them, so that the steps of a job add up.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there; survives lost executors.

    A Parquet table rather than a checkpoint: it is read column by column, and
    Spark knows its size.
    """
    folder = f"{shared_dir(df.sparkSession)}/step-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def partitions_for(spark: SparkSession, n_documents: int, limits: Limits = LIMITS) -> int:
    """Partitions for an index: ``spark.sql.shuffle.partitions``, by its size less or more."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = min(-(-n_documents // limits.documents_per_task), limits.most_partitions)
    return max(1, least, min(usual, -(-n_documents // limits.few_documents)))


def batches_for(rows: int, most_rows: int, questions: int, most_questions: int) -> int:
    """Batches to deal questions to by hash, so that each stays below both numbers.

    On average they are filled to four fifths, as some get more than others.
    """
    return max(1, -(-5 * rows // (4 * most_rows)), -(-5 * questions // (4 * most_questions)))


def batch_of(batches: int) -> Column:
    return F.pmod(F.xxhash64("question_id"), F.lit(batches))


def sized(
    questions: DataFrame,
    run: Callable[[DataFrame, SmallSide], DataFrame],
    limits: Limits | None = None,
    in_batches: bool = False,
) -> DataFrame:
    """Run over ``questions(question_id, tokens, ..)``, all of them in one plan.

    Their sizes are counted at once, by a job that runs while the plan is built. A
    question set that fits a broadcast is one; a larger one gets no hint, and its plan
    shuffles. Either way the corpus is scanned once for all questions. Raises ValueError
    if ids repeat: their questions would be mixed up.

    ``in_batches`` is for runs that return little for each question: a larger set is dealt
    to batches that fit, and what each returns is written while the plan is built. So no
    more is on disk at a time than one batch shuffles; the corpus is scanned once for each.
    """
    limits = limits or LIMITS
    counts = [
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.size("tokens").cast("long")), F.lit(0)).alias("tokens"),
    ]
    different = F.count_distinct(F.struct("question_id")).alias("different")
    total = questions.agg(*counts, different).first()
    if total["different"] < total["n"]:
        raise ValueError("question ids repeat; give as_questions an order")

    def fits(size: Row) -> bool:
        return size["n"] <= limits.batch_questions and size["tokens"] <= limits.batch_tokens

    if in_batches and not fits(total):
        batches = batches_for(
            total["tokens"], limits.batch_tokens, total["n"], limits.batch_questions
        )
        dealt = materialize(questions.withColumn("_batch", batch_of(batches)))
        sizes = dealt.groupBy("_batch").agg(*counts).orderBy("_batch").collect()
        found = []
        for size in sizes:  # one row per batch
            batch = dealt.filter(F.col("_batch") == size["_batch"]).drop("_batch")
            small = SmallSide(fits(size), size["tokens"], None)
            found.append(materialize(run(batch, small)))
        return union_all(found)
    terms = None
    if total["tokens"] <= limits.named_tokens:
        listed = questions.select("tokens").collect()  # at most ``named_tokens`` words
        terms = sorted({token for row in listed for token in row["tokens"] or ()})
    return run(questions, SmallSide(fits(total), total["tokens"], terms))
