"""Term statistics of a corpus, as ordinary tables."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daedap.functions.text import KEPT_CHARS, Tokenizer, clean_words, lowered, normalize, searchable
from daedap.session import partitions_for, shuffles_removed

# Fixed value: how far a document's length counts in all three rankings.
B = 0.75

# Rows of a page and bytes of a row group of postings.
LAYOUT = {"parquet.page.row.count.limit": "2000", "parquet.block.size": str(16 * 2**20)}

# Ranges in which terms are looked for, and terms in one of them at most.
MOST_RANGES = 32
RANGE_TERMS = 32


@dataclass(frozen=True)
class Index:
    """``docs(doc_pos, is_candidate)``, one row per document, empty ones included;
    ``postings(doc_pos, is_candidate, dl, term, tf)``, hash partitioned by ``doc_pos``;
    ``terms(term, df, densest)``; ``stats(n, total_tokens, avgdl)``, one row.

    ``densest`` is the largest frequency of the term in a document, divided by that
    document's length norm: what any document gains by the term is at most what this
    gains at a norm of 1."""

    docs: DataFrame
    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    n_documents: int
    partitions: int

    @property
    def documents_per_task(self) -> int:
        return -(-self.n_documents // self.partitions)


def corpus_tokens(corpus: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """``doc_pos, is_candidate, tokens`` of the cleaned title and text.

    Without a tokenizer the tokens are the cleaned words.
    """
    text = searchable(F.col("title"), F.col("text"))
    tokens = tokenizer(normalize(text)) if tokenizer else clean_words(text)
    return corpus.select("doc_pos", "is_candidate", tokens.alias("tokens"))


def build_index(
    corpus: DataFrame, tokenizer: Tokenizer | None = None, partitions: int | None = None
) -> Index:
    """Statistics over all documents, eligible or not.

    The raw text is shuffled once, by document. Everything per document after
    that (counting terms here, adding up scores later) needs no further shuffle. Words
    are counted in Python, the tokens of another tokenizer by Spark's grouping.
    """
    n_documents = corpus.count()
    partitions = partitions or partitions_for(corpus.sparkSession, n_documents)
    dealt = corpus.repartition(partitions, "doc_pos")
    postings = _token_postings(corpus_tokens(dealt, tokenizer)) if tokenizer else _word_postings(dealt)
    docs = corpus.select("doc_pos", "is_candidate")
    stats = _totals(postings, n_documents)
    return Index(docs, postings, _terms(postings, stats), stats, n_documents, partitions)


def _token_postings(tokens: DataFrame) -> DataFrame:
    return (
        tokens.select(
            "doc_pos",
            "is_candidate",
            F.size("tokens").alias("dl"),
            # The outer form: a plain explode would repeat the cleaning in a size
            # filter, ahead of the shuffle.
            F.explode_outer("tokens").alias("term"),
        )
        .filter(F.col("term").isNotNull())
        .groupBy("doc_pos", "is_candidate", "dl", "term")
        .agg(F.count("*").cast("int").alias("tf"))
    )


# As ``clean_words`` picks them out of lowered text.
WORD = re.compile(f"[{KEPT_CHARS}]+")

# Texts that are looked at, and postings that are sent on, at a time.
TEXTS = 256
POSTINGS = 1 << 18


def _word_postings(corpus: DataFrame) -> DataFrame:
    """The postings of the cleaned words, for a corpus dealt by ``doc_pos``.

    Rows of one position that are alike but for their text count together; they come one
    after the other.
    """
    kinds = [corpus.schema[c].dataType for c in ("doc_pos", "is_candidate")]
    kinds += [T.IntegerType(), T.StringType(), T.IntegerType()]
    names = ("doc_pos", "is_candidate", "dl", "term", "tf")
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        documents: dict[tuple, Counter] = {}
        ready: list[tuple[tuple, Counter]] = []
        last, held = None, 0

        def postings() -> pa.RecordBatch:
            sizes = pa.array([i for i, (_, words) in enumerate(ready) for _ in range(len(words))], pa.int32())
            keys = zip(*(key for key, _ in ready)) if ready else [()] * 3
            columns = [pa.array(c, k).take(sizes) for c, k in zip(keys, types)]
            terms = pa.array([w for _, words in ready for w in words], pa.string()).dictionary_encode()
            columns += [terms, pa.array([n for _, words in ready for n in words.values()], pa.int32())]
            ready.clear()
            # By term, so that sorting them for the index has only runs to merge.
            rank = np.empty(len(terms.dictionary), np.int32)
            rank[pc.array_sort_indices(terms.dictionary)] = np.arange(len(rank))
            order = pa.array(np.argsort(rank[terms.indices], kind="stable"))
            columns = [c.take(order) for c in columns]
            columns[3] = columns[3].dictionary_decode()
            return pa.RecordBatch.from_arrays(columns, names=list(names))

        for whole in batches:
            types = [whole.schema.field(0).type, whole.schema.field(1).type, pa.int32()]
            for begin in range(0, len(whole), TEXTS):
                batch = whole.slice(begin, TEXTS)
                for place, scope, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if place != last:
                        ready += documents.items()
                        held += sum(map(len, documents.values()))
                        documents, last = {}, place
                        if held >= POSTINGS:
                            yield postings()
                            held = 0
                    words = WORD.findall(text)
                    documents.setdefault((place, scope, len(words)), Counter()).update(words)
        ready += documents.items()
        if types:
            yield postings()

    text = lowered(searchable(F.col("title"), F.col("text")))
    in_order = corpus.select("doc_pos", "is_candidate", text).sortWithinPartitions("doc_pos")
    return in_order.mapInArrow(run, schema)


def length_norm(dl: Column, avgdl: Column) -> Column:
    return 1 - B + B * dl / avgdl


def _totals(postings: DataFrame, n_documents: int) -> DataFrame:
    return (
        postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("total_tokens"))
        .withColumn("n", F.lit(n_documents).cast("long"))
        .select("n", "total_tokens", F.expr("try_divide(total_tokens, n)").alias("avgdl"))
    )


def _terms(postings: DataFrame, stats: DataFrame) -> DataFrame:
    density = F.col("tf") / length_norm(F.col("dl"), stats.select("avgdl").scalar())
    return postings.groupBy("term").agg(
        F.count("*").alias("df"), F.max(density).alias("densest")
    )


def store_index(index: Index, folder: str) -> Index:
    """Write the index under ``folder`` and return it as read from there.

    Postings are bucketed by document, so a scan keeps the partitioning that
    ``build_index`` made, and sorted by term inside a bucket, in small pages: a scan for
    named terms skips the others by the statistics of row groups and pages. Totals and
    terms are counted from the written postings.
    """
    spark = index.docs.sparkSession
    with shuffles_removed(spark):
        (
            index.postings.write.mode("overwrite")
            .bucketBy(index.partitions, "doc_pos")
            .sortBy("term")
            .options(**LAYOUT)
            .option("path", f"{folder}/postings")
            .saveAsTable(_table_name())
        )
    index.docs.write.mode("overwrite").parquet(f"{folder}/docs")
    layout = [(index.n_documents, index.partitions)]
    layout = spark.createDataFrame(layout, "n_documents long, partitions int")
    layout.coalesce(1).write.mode("overwrite").parquet(f"{folder}/layout")
    postings = _bucketed(spark, folder, index.partitions)
    _totals(postings, index.n_documents).write.mode("overwrite").parquet(f"{folder}/stats")
    terms = _terms(postings, spark.read.parquet(f"{folder}/stats"))
    with shuffles_removed(spark):
        terms.write.mode("overwrite").parquet(f"{folder}/terms")
    return open_index(spark, folder)


def open_index(spark: SparkSession, folder: str) -> Index:
    """An index that ``store_index`` wrote, in this application or an earlier one."""
    layout = spark.read.parquet(f"{folder}/layout").first()
    return Index(
        docs=spark.read.parquet(f"{folder}/docs"),
        postings=_bucketed(spark, folder, layout["partitions"]),
        terms=spark.read.parquet(f"{folder}/terms"),
        stats=spark.read.parquet(f"{folder}/stats"),
        n_documents=layout["n_documents"],
        partitions=layout["partitions"],
    )


def postings_of(postings: DataFrame, terms: list[str] | None) -> DataFrame:
    """Postings less those that cannot be of one of ``terms``; all of them without any named.

    The terms are put as a few ranges that Spark hands to the Parquet reader; what stands
    in a range between two terms stays.
    """
    if terms is None or len(terms) > MOST_RANGES * RANGE_TERMS:
        return postings
    step = max(1, -(-len(terms) // MOST_RANGES))
    runs = [terms[i : i + step] for i in range(0, len(terms), step)]
    found = F.lit(False)
    for run in runs:
        here = F.col("term") == run[0] if len(run) == 1 else F.col("term").between(run[0], run[-1])
        found = found | here
    return postings.filter(found)


def _table_name() -> str:
    return f"postings_{uuid.uuid4().hex}"


def _bucketed(spark: SparkSession, folder: str, partitions: int) -> DataFrame:
    """The written postings, under a new name that tells Spark how they are bucketed."""
    name, path = _table_name(), f"{folder}/postings"
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema
    )
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY (doc_pos) INTO {partitions} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)
