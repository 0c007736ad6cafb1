"""The corpus: ``doc_pos, doc_id, title, text, is_candidate``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daedap import session
from daedap.session import partitions_for
from daedap.sources.json_map import BLOCK_BYTES, IN_BLOCK, json_entries

# Files that cannot be read raise an error instead of being left out.
STRICT = {"mode": "FAILFAST"}

LINES = "doc_pos long, doc_id string, title string, text string"
RECORDS = "map<string,struct<title:string,text:string>>"


def load_json_map(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Corpus from JSON files that are each one object of records, keyed by document.

    ``path`` is a file or a folder. Files are read in blocks, by many tasks each; those in a
    store that only Spark reads come whole, one task per file. Positions run on from file to
    file in name order. A key given twice in a file counts once, with its last record, in the
    place where it first stood. A file that is not one JSON object raises an error.
    """
    entries = json_entries(spark, path, block_bytes)
    found = _whole_files(spark, path) if entries is None else _parsed(entries)
    records = (
        found.groupBy("file", F.col("entry.key").alias("doc_id"))
        .agg(
            F.min("pos").alias("pos"),
            F.max_by("entry.value", "pos").alias("record"),
        )
        .withColumn("block", F.floor(F.col("pos") / IN_BLOCK))
    )
    # One row per block from here to the offsets, and one per file to theirs.
    earlier = (Window.unboundedPreceding, -1)
    in_order = Window.partitionBy("file").orderBy("block").rowsBetween(*earlier)
    by_name = Window.orderBy("file").rowsBetween(*earlier)
    counts = records.groupBy("file", "block").agg(F.count("*").alias("n"))
    files = counts.groupBy("file").agg(F.sum("n").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(by_name), F.lit(0)).alias("before"))
    blocks = counts.select("file", "block", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("inside"))
    offsets = blocks.join(files, "file").select(
        "file", "block", (F.col("before") + F.col("inside")).alias("before")
    )
    in_block = F.row_number().over(Window.partitionBy("file", "block").orderBy("pos")) - 1
    return (
        records.withColumn("in_block", in_block)
        .join(offsets, ["file", "block"])
        .select(
            (F.col("before") + F.col("in_block")).cast("long").alias("doc_pos"),
            "doc_id",
            F.coalesce("record.title", F.lit("")).alias("title"),
            F.coalesce("record.text", F.lit("")).alias("text"),
        )
    )


def _records(json: str | Column, file: str | Column) -> Column:
    refused = F.raise_error(F.concat(F.lit("no JSON object: "), file)).cast(RECORDS)
    return F.coalesce(F.from_json(json, RECORDS, STRICT | {"allowSingleQuotes": "false"}), refused)


def _parsed(entries: DataFrame) -> DataFrame:
    """Each entry as an object of its own."""
    whole = F.concat(F.lit("{"), "entry", F.lit("}"))
    return entries.select(
        "file", "pos", F.explode(F.map_entries(_records(whole, F.col("file")))).alias("entry")
    )


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    """The entries of files that tasks cannot read parts of."""
    file = F.input_file_name()
    return (
        spark.read.text(path, wholetext=True)
        .select(file.alias("file"), _records("value", file).alias("records"))
        .select("file", F.posexplode(F.map_entries("records")).alias("pos", "entry"))
    )


def load_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Corpus from JSON files with one record per line, the way in for large corpora.

    Records have ``doc_pos``, ``doc_id``, ``title`` and ``text``. Files are split and
    nothing is shuffled. A line that is no such record raises an error.
    """
    lines = spark.read.schema(LINES).options(**STRICT).json(path)
    return lines.select(
        F.coalesce("doc_pos", F.raise_error(F.lit("a record without doc_pos")).cast("long")).alias(
            "doc_pos"
        ),
        "doc_id",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def as_corpus(
    df: DataFrame,
    doc_pos: str | Column,
    title: str | Column,
    text: str | Column,
    doc_id: str | Column | None = None,
) -> DataFrame:
    """Corpus columns from any table that has a document position."""

    def col(c: str | Column) -> Column:
        return F.col(c) if isinstance(c, str) else c

    return df.select(
        col(doc_pos).cast("long").alias("doc_pos"),
        col(doc_id if doc_id is not None else doc_pos).cast("string").alias("doc_id"),
        F.coalesce(col(title), F.lit("")).alias("title"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )


def with_scope(corpus: DataFrame, first_n: int) -> DataFrame:
    """Mark the first ``first_n`` positions as eligible results.

    The other documents still count in the term statistics.
    """
    return corpus.withColumn("is_candidate", F.col("doc_pos") < first_n)


def block_of(documents: int, doc_pos: str = "doc_pos") -> Column:
    """The block of a position, of so many positions each."""
    return F.floor(F.col(doc_pos) / documents)


def documents_per_block(corpus: DataFrame) -> int:
    """Positions in a block of a stored corpus."""
    return corpus.schema["doc_pos"].metadata["documents_per_block"]


def store_corpus(corpus: DataFrame, folder: str) -> DataFrame:
    """Write the corpus in blocks of positions and return it as read from there.

    Fetching the texts of ranked documents then opens only the blocks that hold some, by
    dynamic partition pruning, and not the whole corpus. Positions are dealt to tasks in
    ranges, in order; a block is a small part of the corpus, whatever its size is.
    """
    limits = session.LIMITS
    size = corpus.agg(F.count("*").alias("n"), F.max("doc_pos").alias("last")).first()
    documents = max(limits.least_block, -(-((size["last"] or 0) + 1) // limits.most_blocks))
    (
        corpus.withColumn("doc_block", block_of(documents))
        .repartitionByRange(partitions_for(corpus.sparkSession, size["n"]), "doc_pos")
        .sortWithinPartitions("doc_block", "doc_pos")
        .write.mode("overwrite")
        .partitionBy("doc_block")
        .parquet(folder)
    )
    layout = corpus.sparkSession.createDataFrame([(documents,)], "documents long")
    layout.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_layout")
    return open_corpus(corpus.sparkSession, folder)


def open_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """A corpus that ``store_corpus`` wrote, in this application or an earlier one."""
    documents = spark.read.parquet(f"{folder}/_layout").first()["documents"]
    types = {f.name: f.dataType for f in spark.read.parquet(folder).schema}
    types |= {"doc_block": T.LongType()}
    note = {"doc_pos": {"documents_per_block": documents}}
    schema = T.StructType([T.StructField(c, t, True, note.get(c)) for c, t in types.items()])
    return spark.read.schema(schema).parquet(folder)
