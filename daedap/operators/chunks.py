"""The best documents of each question, from postings taken in chunks of documents.

A chunk's postings meet all questions at once in memory, so that no row stands for a pair
of a question and a document: a task sends on the n best of each question, whatever the
number of documents that share a term with it. Sums are over whole numbers, in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daedap import session
from daedap.session import SmallSide, batch_of, batches_for, materialize, union_all

# Documents of a chunk, scores that share a maximum, and cells of the table of frequent terms.
CHUNK = 16_384
RUN = 128
CELLS = 1 << 23

# Stands for a null position, which comes last.
NO_POSITION = np.iinfo(np.int64).min


class Asked:
    """Question terms as arrays: ``ids``, and of each question the places of its features.

    A feature is a term with a weight. ``terms`` and ``weights`` are those of the features,
    in order of the term.
    """

    def __init__(self, questions: pa.Table) -> None:
        ids, pairs = (questions.column(i).combine_chunks() for i in (0, 1))
        self.ids = ids
        self.ends = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy().astype(np.int64))])
        terms, weights = (pairs.flatten().field(i).to_numpy() for i in (0, 1))
        order = np.lexsort((weights, terms))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(terms[order]) != 0) | (np.diff(weights[order]) != 0)
        self.features = np.empty(len(order), np.int64)
        self.features[order] = np.cumsum(first) - 1
        self.terms, self.weights = terms[order][first], weights[order][first]

    def __len__(self) -> int:
        return len(self.ids)


class Best:
    """The n best documents of every question in the chunks seen, equal scores by position."""

    def __init__(self, asked: Asked, n: int, unit: int) -> None:
        self.asked, self.n, self.unit = asked, n, unit
        nothing = np.zeros(0, np.int64)
        self.match, self.place = ([nothing] * len(asked) for _ in range(2))
        self.least = np.ones(len(asked), np.int64)

    def add(self, position: np.ndarray, term: np.ndarray, gain: np.ndarray) -> None:
        """Take in all postings of some documents, in order of the position."""
        places, document = np.unique(position, return_inverse=True)
        order = np.argsort(term, kind="stable")
        term, document, gain = term[order], document[order], gain[order]
        asked = self.asked
        begin = np.searchsorted(term, asked.terms, "left")
        sizes = np.searchsorted(term, asked.terms, "right") - begin
        ends = np.cumsum(sizes)
        begins = ends - sizes
        source = np.repeat(begin - begins, sizes) + np.arange(ends[-1] if len(ends) else 0)
        units = np.floor(np.repeat(asked.weights, sizes) * gain[source] * self.unit + 0.5).astype(np.int64)
        target = document[source]
        again = bool(((np.diff(term) == 0) & (np.diff(document) == 0)).any())
        width = -(-len(places) // RUN) * RUN
        frequent = np.argsort(-sizes, kind="stable")[: max(1, CELLS // max(width, 1))]
        frequent = frequent[8 * sizes[frequent] > len(places)]
        rows = np.full(len(sizes), -1)
        rows[frequent] = np.arange(len(frequent))
        table = np.zeros((len(frequent), width), np.int64)
        for row, f in enumerate(frequent):
            np.add.at(table[row], target[begins[f] : ends[f]], units[begins[f] : ends[f]])
        total = np.zeros(width, np.int64)
        here, begins, ends, rows = sizes > 0, begins.tolist(), ends.tolist(), rows.tolist()
        for q in range(len(asked)):
            features = asked.features[asked.ends[q] : asked.ends[q + 1]]
            features = features[here[features]].tolist()
            if not features:
                continue
            total.fill(0)
            for f in features:
                if rows[f] >= 0:
                    total += table[rows[f]]
                elif again:
                    np.add.at(total, target[begins[f] : ends[f]], units[begins[f] : ends[f]])
                else:
                    total[target[begins[f] : ends[f]]] += units[begins[f] : ends[f]]
            self._keep(q, total, places)

    def _keep(self, q: int, total: np.ndarray, places: np.ndarray) -> None:
        least, tops = int(self.least[q]), total.reshape(-1, RUN).max(1)
        if len(tops) >= self.n:
            # So many documents reach the n-th greatest maximum.
            least = max(least, int(np.partition(tops, len(tops) - self.n)[len(tops) - self.n]))
        found = np.flatnonzero(total >= least)
        if not len(found):
            return
        match = np.concatenate([self.match[q], total[found]])
        place = np.concatenate([self.place[q], places[found]])
        if len(match) > self.n:
            best = np.lexsort((place, match))[-self.n :]
            match, place = match[best], place[best]
        if len(match) == self.n:
            self.least[q] = max(least, int(match.min()))
        self.match[q], self.place[q] = match, place

    def rows(self) -> pa.Table:
        nothing = [np.zeros(0, np.int64)]
        question = np.repeat(np.arange(len(self.asked)), [len(m) for m in self.match])
        place = np.concatenate(nothing + self.place)
        return pa.table(
            {
                "question_id": self.asked.ids.take(pa.array(question)),
                "doc_pos": pa.array(place, mask=place == NO_POSITION),
                "match": pa.array(np.concatenate(nothing + self.match)),
            }
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Position, term and gain of postings in order of the position, whole documents together."""
    kept: list[list[np.ndarray]] = []
    documents, last = 0, None
    for batch in filter(len, batches):
        place = batch.column(0).fill_null(NO_POSITION).to_numpy()
        columns = [place, *(batch.column(i).to_numpy() for i in (1, 2))]
        # Where a document begins that is not the one before.
        starts = np.flatnonzero(np.diff(place, prepend=place[0])).tolist()
        if last is not None and place[0] != last:
            starts.insert(0, 0)
        at = 0
        documents = max(documents, 1)
        for start in starts:
            if documents == CHUNK:
                kept.append([c[at:start] for c in columns])
                yield [np.concatenate(c) for c in zip(*kept)]
                kept, documents, at = [], 0, start
            documents += 1
        kept.append([c[at:] for c in columns])
        last = place[-1]
    if kept:
        yield [np.concatenate(c) for c in zip(*kept)]


def best_in_chunks(
    gains: DataFrame, weights: DataFrame, n: int, unit: int, small: SmallSide
) -> DataFrame:
    """``question_id, doc_pos, match``: the best documents of each question, in parts.

    ``gains(doc_pos, term, gain)`` are postings, which an index deals by document, and
    ``weights(question_id, term, weight)`` has a row per question and term. Of each part of
    the documents at most n to a question are listed, those with a match above 0; the n best
    of all are among them. Question terms that fit a broadcast go to the documents where
    these are. Others do so in batches that fit, one after the other: neither postings nor
    question terms are copied for each other. The n best of each batch are written while the
    plan is built, but for the last batch, which is left to the plan.
    """
    if small.broadcasts:
        return _best_of_known(gains, weights, n, unit)
    limits = session.LIMITS
    size = weights.agg(F.count("*").alias("n"), F.count_distinct("question_id").alias("asked")).first()
    # A task holds the terms of a batch and the n best of each of its questions.
    most = max(1, limits.batch_tokens // n)
    batches = batches_for(size["n"], limits.batch_tokens, size["asked"], most)
    best = Window.partitionBy("question_id").orderBy(F.desc("match"), F.desc("doc_pos"))
    dealt, found = weights.withColumn("_batch", batch_of(batches)), []
    taken = sorted(row["_batch"] for row in dealt.select("_batch").distinct().collect()) or [0]
    for batch in taken:
        own = dealt.filter(F.col("_batch") == batch).drop("_batch")
        in_parts = _best_of_known(gains, own, n, unit)
        if batch != taken[-1]:
            ranked = in_parts.withColumn("rank", F.row_number().over(best))
            in_parts = materialize(ranked.filter(F.col("rank") <= n).drop("rank"))
        found.append(in_parts)
    return union_all(found)


def _best_of_known(gains: DataFrame, weights: DataFrame, n: int, unit: int) -> DataFrame:
    """The same for question terms that fit a broadcast."""
    terms = weights.select("term").distinct().withColumn("number", F.monotonically_increasing_id())
    terms = materialize(terms)
    pair = F.struct("number", "weight")
    asked = weights.join(F.broadcast(terms), "term").groupBy("question_id")
    known = Asked(materialize(asked.agg(F.collect_list(pair).alias("asked"))).toArrow())
    # A task goes through its chunks one by one and sends on its best only once, so there are
    # no more tasks than keep all cores busy.
    parts = 2 * gains.sparkSession.sparkContext.defaultParallelism
    schema = T.StructType(
        [
            T.StructField("question_id", weights.schema["question_id"].dataType),
            T.StructField("doc_pos", T.LongType()),
            T.StructField("match", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(known, n, unit)
        for chunk in _chunks(batches):
            best.add(*chunk)
        yield from best.rows().to_batches(max_chunksize=10_000)

    # The window brings whole documents together in order, bucket by bucket where the postings
    # are bucketed; without it Spark may read a bucket's file in pieces, documents cut apart.
    whole = F.max("doc_pos").over(Window.partitionBy("doc_pos")).alias("doc_pos")
    numbered = gains.join(F.broadcast(terms), "term").select(whole, "number", "gain")
    return numbered.coalesce(parts).mapInArrow(run, schema)
