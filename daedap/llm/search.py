"""Ranked lexical search, term at a time with limited accumulators.

Documents stay where they are: every task ranks the documents of its own block for all
items, and only each block's best go on. Within a block the terms of an item are worked
off rarest first. A document gets an accumulator when a term reaches it, until what the
remaining terms can add at most lies below the k-th partial score; from there on no
document without one can come among the best, and the accumulators there are, and only
they, are brought to their exact scores.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daedap.session import materialize

BEST = 20

# Documents whose accumulators a task holds at a time, some 20 bytes each.
BLOCK_DOCUMENTS = 32_768

# Different terms, and terms with repeats, of the items that go to the tasks at once: some
# 100 bytes each. Further items are searched for in further passes.
PASS_TERMS = 500_000

# Letters, digits and everything beyond ASCII are terms; A to Z become small.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"


def terms_of(data: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return (data or b"").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """Items as numbers of their different terms, with repeats counted."""

    keys: list  # item_id, None included
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]  # item, its terms' numbers
    repeats: list[np.ndarray]


def in_passes(items: DataFrame, pass_terms: int = PASS_TERMS) -> Iterator[Items]:
    """The items, as many at a time as go to the tasks at once."""
    keys, vocabulary, terms, repeats, held = [], {}, [], [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        counts = Counter(terms_of(None if row["text"] is None else row["text"].encode("utf-8", "replace")))
        numbers = [vocabulary.setdefault(term, len(vocabulary)) for term in counts]
        keys.append(row["item_id"])
        terms.append(np.array(numbers, np.int64))
        repeats.append(np.array(list(counts.values()), np.int64))
        held += len(numbers)
        if held >= pass_terms:
            yield Items(keys, vocabulary, terms, repeats)
            keys, vocabulary, terms, repeats, held = [], {}, [], [], 0
    if keys:
        yield Items(keys, vocabulary, terms, repeats)


def postings(docs: DataFrame, items: Items) -> DataFrame:
    """Per document with a term: how many it has, and how often the items' terms."""
    vocabulary = items.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in POSTINGS.split(", ")]
        known = vocabulary.__contains__
        for batch in batches:
            kept, n, numbers, tfs = [], [], [], []
            for i, data in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = terms_of(data)
                if found:
                    counts = Counter(filter(known, found))
                    kept.append(i)
                    n.append(len(found))
                    numbers.append([vocabulary[term] for term in counts])
                    tfs.append(list(counts.values()))
            arrays = [
                batch.column(0).take(pa.array(kept, pa.int64())),
                pa.array(n, pa.int64()),
                pa.array(numbers, pa.list_(pa.int32())),
                pa.array(tfs, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, POSTINGS)


@dataclass(frozen=True)
class Statistics:
    documents: int  # N
    length: int  # L
    weights: np.ndarray  # per term number


def statistics(rows: DataFrame, items: Items) -> Statistics:
    """Over all documents; what is collected is a row per different term of the items."""
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(len(items.vocabulary), np.int64)
    counted = rows.select(F.explode("terms").alias("term")).groupBy("term").count()
    for row in counted.toLocalIterator():
        df[row["term"]] = row["count"]
    return Statistics(total["n"], total["length"], term_weights(total["n"], df))


def term_weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Block:
    """The postings of some documents, by term."""

    def __init__(self, n: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray, stats: Statistics):
        self.size = len(n)
        m = 75 + (25 * n * stats.documents) // max(stats.length, 1)
        order = np.argsort(term, kind="stable")
        self.documents = at[order]
        tf = tf[order].astype(np.int64)
        self.gains = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.documents])
        sizes = np.bincount(term, minlength=len(stats.weights))
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.most = np.zeros(len(sizes), np.int64)
        filled = np.flatnonzero(sizes)
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.gains, self.starts[filled])

    def best(
        self, terms: np.ndarray, weights: np.ndarray, k: int, known: int = 0
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores that hold the k best above 0, and how many were ever scored.

        ``terms`` stand rarest first, ``weights`` include their repeats. ``known`` is a score
        that k other documents are known to reach.
        """
        sizes = self.starts[terms + 1] - self.starts[terms]
        most = weights * self.most[terms]
        remaining = np.concatenate([np.cumsum(most[::-1])[::-1], [0]])
        scores = np.zeros(self.size, np.int64)
        live, limited = np.zeros(0, np.int64), False
        for i, (term, weight) in enumerate(zip(terms.tolist(), weights.tolist())):
            if not limited and remaining[i] < self._kth(scores, k, known):
                limited, live = True, np.flatnonzero(scores)
            if not sizes[i]:
                continue
            here = slice(self.starts[term], self.starts[term + 1])
            documents, gains = self.documents[here], self.gains[here]
            if not limited:
                scores[documents] += weight * gains
            elif len(live):
                # Both are in order: the accumulators are looked up in the postings.
                place = np.minimum(np.searchsorted(documents, live), len(documents) - 1)
                held = documents[place] == live
                scores[live[held]] += weight * gains[place[held]]
        found = live = np.flatnonzero(scores)
        if len(live) > k:
            exact = scores[live]
            live = live[exact >= np.partition(exact, len(exact) - k)[len(exact) - k]]
        return live, scores[live], len(found)

    @staticmethod
    def _kth(scores: np.ndarray, k: int, known: int) -> int:
        """A score that the k-th best document has by now, at least."""
        partial = scores[scores > 0]
        if len(partial) < k:
            return known
        return max(known, int(np.partition(partial, len(partial) - k)[len(partial) - k]))


def _order(row: tuple) -> tuple:
    """Higher scores first, then smaller ids; documents without an id come last."""
    doc_id, score = row
    return -score, doc_id is None, doc_id or 0


def _by_block(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, lengths, and places, terms and frequencies of the postings of some documents."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            yield _joined(held)
            held = []
    if sum(b.num_rows for b in held):
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    keys = table.column(0).to_pylist()
    terms = table.column(2).combine_chunks()
    sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
    return (
        keys,
        table.column(1).to_numpy(),
        np.repeat(np.arange(len(keys)), sizes),
        terms.flatten().to_numpy(),
        table.column(3).combine_chunks().flatten().to_numpy(),
    )


def block_best(
    rows: DataFrame, items: Items, stats: Statistics, k: int = BEST, block: int = BLOCK_DOCUMENTS
) -> DataFrame:
    """(item, doc_id, score): of each task's documents the k best of each item, or all."""
    asked = []
    for terms, repeats in zip(items.terms, items.repeats):
        # The weight falls with the number of documents, so the heaviest term is the rarest.
        order = np.argsort(-stats.weights[terms], kind="stable")
        asked.append((terms[order], (stats.weights[terms] * repeats)[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in asked]
        for keys, n, at, term, tf in _by_block(batches, block):
            part = Block(n, at, term, tf, stats)
            for item, (terms, weights) in enumerate(asked):
                known = best[item][-1][1] if len(best[item]) == k else 0
                places, scores, _ = part.best(terms, weights, k, known)
                more = [(keys[p], s) for p, s in zip(places.tolist(), scores.tolist())]
                if more:
                    best[item] = heapq.nsmallest(k, best[item] + more, key=_order)
        rows = [(item, *row) for item, kept in enumerate(best) for row in kept]
        if rows:
            types = (pa.int32(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, FOUND)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    block: int = BLOCK_DOCUMENTS,
    pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of ``docs(doc_id, text)`` for each of
    ``items(item_id, text)``.

    Only documents with a score above 0 are returned; equal scores stand by ascending
    doc_id, documents without an id last. Null and empty texts have no terms: such a document
    counts nowhere, such an item finds nothing. Rows that repeat an id count and rank each on
    its own, of documents and of items; other columns play no part. Texts are read once per
    pass; how often they hold the items' terms is written to the shared folder meanwhile.
    """
    spark = docs.sparkSession
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = None
    for some in in_passes(items, pass_terms):
        rows = materialize(postings(docs, some))
        best = block_best(rows, some, statistics(rows, some), k, block)
        placed = best.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
        key_type = items.schema["item_id"].dataType
        names = spark.createDataFrame(
            list(enumerate(some.keys)), f"item int, item_id {key_type.simpleString()}"
        )
        each = placed.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = each if found is None else found.unionAll(materialize(each))
    if found is None:
        key_type = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {key_type}, rank int, doc_id long, score long")
    return found
