"""Reading: token logits for each (question, context), and answer spans from them.

A context is one row with its whole token sequence and logits as arrays, so all
steps from the logits to the spans stay inside the row and shuffle nothing.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daedap.functions.sequences import (
    EOS,
    detokenize,
    document_start,
    let,
    pack,
    token_slice,
    truncate,
)
from daedap.functions.text import Tokenizer, marked_tokens, term_of
from daedap.operators.index import Index
from daedap.session import SmallSide

# Takes rows with ``sequence``, ``document_start`` and ``term_weights`` and adds
# ``start_logits`` and ``end_logits``, one number per token. A trained model goes
# here, through ``mapInPandas`` or a pandas UDF over ``sequence``.
Reader = Callable[[DataFrame], DataFrame]

# Changes an answer's text: a column function, or a pandas UDF.
Hook = Callable[[Column], Column]

# The lexical reader: tokens to look at on either side, and the logit of tokens
# outside the document. Logits are whole ten-thousandths, so sums are exact.
REACH = 8
OUTSIDE = -20.0
STEP = 10_000


def reading_questions(
    questions: DataFrame, index: Index, small: SmallSide, tokenizer: Tokenizer = marked_tokens
) -> DataFrame:
    """``question_id, question_tokens, term_weights``: the raw question and its idf weights.

    Weights are whole ten-thousandths, for terms that the index knows.
    """
    tokens = questions.select("question_id", tokenizer(F.col("question")).alias("question_tokens"))
    asked = tokens.select(
        "question_id", F.explode(F.array_distinct(F.transform("question_tokens", term_of))).alias("term")
    )
    n = index.stats.select("n").scalar()
    idf = F.log((n + 1) / F.col("df"))
    weights = (
        small(asked)
        .join(index.terms, "term")
        .groupBy("question_id")
        .agg(F.collect_list(F.struct("term", F.floor(idf * STEP + 0.5).alias("weight"))).alias("weights"))
    )
    return tokens.join(small(weights), "question_id", "left").select(
        "question_id",
        "question_tokens",
        F.map_from_entries(
            F.coalesce("weights", F.array().cast("array<struct<term:string,weight:bigint>>"))
        ).alias("term_weights"),
    )


def packed(
    contexts: DataFrame,
    questions: DataFrame,
    small: SmallSide,
    max_len: int | None = None,
    tokenizer: Tokenizer = marked_tokens,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``sequence``, ``document_start`` and ``term_weights`` to contexts with a ``text``.

    Contexts are spread evenly over tasks first: reading is the costly part, and
    popular documents would otherwise all be read where they are stored.
    """
    spark = contexts.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [c for c in ("question_id", "doc_pos", "rank") if c in contexts.columns]
    sequence = pack(F.col("question_tokens"), tokenizer(F.col("text")))
    return (
        contexts.repartition(parts, *keys)
        .join(small(questions), "question_id")
        .withColumn("sequence", truncate(sequence, max_len))
        .withColumn("document_start", document_start(F.col("question_tokens")))
        .drop("text", "question_tokens")
    )


def lexical_reader(rows: DataFrame) -> DataFrame:
    """Logits that favor tokens beside question terms, as a stand-in for a model.

    A document token's start logit is the weight of the terms in the tokens
    before it, its end logit that of the tokens after it, both less twice its own
    weight and less 1. All other tokens get the same low logit.
    """

    def in_document(token: Column, i: Column) -> Column:
        return (i >= F.col("document_start")) & (token != EOS)

    def weight(token: Column, i: Column) -> Column:
        known = F.try_element_at("term_weights", term_of(token))
        return F.when(in_document(token, i), F.coalesce(known, F.lit(0))).otherwise(F.lit(0))

    def logits(weights: Column, offsets: range) -> Column:
        def one(token: Column, i: Column) -> Column:
            near = sum(F.coalesce(F.get(weights, i + o), F.lit(0)) for o in offsets)
            value = near - 2 * F.get(weights, i) - STEP
            return F.when(in_document(token, i), value / STEP).otherwise(F.lit(OUTSIDE))

        return F.transform("sequence", one)

    both = let(
        F.transform("sequence", weight),
        lambda w: F.struct(
            logits(w, range(-REACH, 0)).alias("start"), logits(w, range(1, REACH + 1)).alias("end")
        ),
    )
    return rows.withColumn("logits", both).select(
        *rows.columns,
        F.col("logits.start").alias("start_logits"),
        F.col("logits.end").alias("end_logits"),
    )


# Tokens in a batch for the model, padding included, and sequences of a task that are put in
# order of length at a time.
BATCH_TOKENS = 16_384
SORTED_ROWS = 4_096


def length_batches(lengths: Sequence[int], most_tokens: int = BATCH_TOKENS) -> list[list[int]]:
    """Positions in batches of similar length, longest first.

    A batch padded to its longest sequence has at most ``most_tokens`` tokens; a longer
    sequence is a batch of its own.
    """
    batches: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        if batches and lengths[batches[-1][0]] * (len(batches[-1]) + 1) <= most_tokens:
            batches[-1].append(i)
        else:
            batches.append([i])
    return batches


def model_reader(
    load: Callable[[], Callable[[list[list[str]]], Iterator[tuple[Sequence, Sequence]]]],
    batch_tokens: int = BATCH_TOKENS,
) -> Reader:
    """A reader around a model: ``load()`` gives a function from token lists to logit pairs.

    The model is loaded once per Python worker, which keeps it from one task to the next.
    It sees sequences of similar length together, in batches of at most ``batch_tokens``
    tokens with padding.
    """
    name = uuid.uuid4().hex

    def read(rows: DataFrame) -> DataFrame:
        rows = rows.drop("term_weights")
        logits = [T.StructField(f"{e}_logits", T.ArrayType(T.DoubleType())) for e in ("start", "end")]
        schema = T.StructType([*rows.schema.fields, *logits])

        def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # Workers outlive tasks; modules that Python has loaded do as well.
            models = sys.__dict__.setdefault("_reader_models", {})
            if name not in models:
                models.clear()  # one model at a time, so that memory stays bounded
                models[name] = load()
            model = models[name]
            for whole in batches:
                for begin in range(0, len(whole), SORTED_ROWS):
                    batch = whole.iloc[begin : begin + SORTED_ROWS]
                    sequences = [list(s) for s in batch["sequence"]]
                    pairs: list = [None] * len(sequences)
                    for places in length_batches([len(s) for s in sequences], batch_tokens):
                        found = model([sequences[i] for i in places])
                        for i, pair in zip(places, found, strict=True):
                            pairs[i] = pair
                    yield batch.assign(
                        start_logits=[list(p[0]) for p in pairs], end_logits=[list(p[1]) for p in pairs]
                    )

        return rows.mapInPandas(predict, schema)

    return read


def logit_rows(read: DataFrame) -> DataFrame:
    """One row per token: ``pos, token, start_logit, end_logit``."""
    keys = [c for c in ("question_id", "doc_pos", "rank") if c in read.columns]
    zipped = F.arrays_zip("sequence", "start_logits", "end_logits")
    return read.select(*keys, F.posexplode_outer(zipped).alias("pos", "at")).select(
        *keys,
        "pos",
        F.col("at.sequence").alias("token"),
        F.col("at.start_logits").alias("start_logit"),
        F.col("at.end_logits").alias("end_logit"),
    )


def _best_first(logits: Column) -> Column:
    """``(order, pos)`` of all positions, the highest logit first, then the lower position."""
    pairs = F.transform(logits, lambda x, i: F.struct((-x).alias("order"), i.alias("pos")))
    return F.sort_array(pairs)


def top_starts(logits: Column, k: int = 10) -> Column:
    """The k best start positions, over the whole sequence."""
    return F.slice(_best_first(logits), 1, k)


def top_ends(ends: Column, start: Column, k: int = 10) -> Column:
    """The usable ones among the k best end positions for a start, with their ranks.

    ``ends`` are all positions, best first. The ranking sets the logits before
    the start to 0 instead of leaving these positions out. So each of them comes
    before every end whose logit is not above 0, takes a place, and gives only an
    empty span. An end keeps its place if the ends before it, and for such an end
    the ``start`` zeros too, leave room among the k.
    """
    after = F.slice(F.filter(ends, lambda e: e["pos"] >= start), 1, k)
    ranked = F.transform(
        after,
        lambda e, i: F.struct(
            e["pos"].alias("pos"),
            (i + 1 + F.when(e["order"] >= 0, start).otherwise(F.lit(0))).alias("rank"),
        ),
    )
    return F.filter(ranked, lambda e: e["rank"] <= k)


def spans(
    read: DataFrame,
    end_weight: float = 1.0,
    k: int = 10,
    end_source: str = "start",
    postprocess: Hook | None = None,
    min_len: int = 2,
) -> DataFrame:
    """One row per answer candidate: ``start, end_excl, start_rank, end_rank, score, answer``.

    The score adds the *start* logit at the end position, times ``end_weight``;
    ``end_source="end"`` takes the end logit there, as is usual. Answers shorter
    than ``min_len`` are dropped after ``postprocess``.
    """

    def span(start: Column, rank: Column, end: Column) -> Column:
        answer = detokenize(token_slice(F.col("sequence"), start["pos"], end["pos"]))
        at_end = F.get(F.col(f"{end_source}_logits"), end["pos"])
        return F.struct(
            start["pos"].alias("start"),
            (end["pos"] + 1).alias("end_excl"),
            (rank + 1).alias("start_rank"),
            end["rank"].alias("end_rank"),
            (-start["order"] + end_weight * at_end).alias("score"),
            answer.alias("answer"),
        )

    def all_spans(ends: Column) -> Column:
        return F.flatten(
            F.transform(
                top_starts(F.col("start_logits"), k),
                lambda s, i: F.transform(top_ends(ends, s["pos"], k), lambda e: span(s, i, e)),
            )
        )

    arrays = ("sequence", "start_logits", "end_logits", "document_start", "term_weights")
    keys = [c for c in read.columns if c not in arrays]
    found = let(_best_first(F.col("end_logits")), all_spans)
    if postprocess is None:
        found = F.filter(found, lambda s: F.length(s["answer"]) >= min_len)
    # The outer form: a plain explode would work out all spans a second time, in
    # a size filter.
    rows = (
        read.select(*keys, F.explode_outer(found).alias("span"))
        .filter(F.col("span").isNotNull())
        .select(*keys, "span.*")
    )
    if postprocess is None:
        return rows
    return rows.withColumn("answer", postprocess(F.col("answer"))).filter(
        F.length("answer") >= min_len
    )


def start_rows(read: DataFrame, k: int = 10) -> DataFrame:
    """The k best starts of each context: ``start_rank, start, start_logit``."""
    starts = F.posexplode_outer(top_starts(F.col("start_logits"), k)).alias("i", "s")
    return read.select("question_id", "doc_pos", starts).select(
        "question_id",
        "doc_pos",
        (F.col("i") + 1).alias("start_rank"),
        F.col("s.pos").alias("start"),
        (-F.col("s.order")).alias("start_logit"),
    )


def end_rows(read: DataFrame, k: int = 10) -> DataFrame:
    """The usable ends of each start: ``start, end_rank, end``."""

    def of_starts(ends: Column) -> Column:
        return F.flatten(
            F.transform(
                top_starts(F.col("start_logits"), k),
                lambda s: F.transform(
                    top_ends(ends, s["pos"], k),
                    lambda e: F.struct(
                        s["pos"].alias("start"), e["rank"].alias("end_rank"), e["pos"].alias("end")
                    ),
                ),
            )
        )

    pairs = let(_best_first(F.col("end_logits")), of_starts)
    return (
        read.select("question_id", "doc_pos", F.explode_outer(pairs).alias("pair"))
        .filter(F.col("pair").isNotNull())
        .select("question_id", "doc_pos", "pair.*")
    )
