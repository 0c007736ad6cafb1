"""Questions to answers: retrieve, read, select."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daedap.functions.text import Tokenizer, marked_tokens
from daedap.operators.contexts import blank_outside_scope, drop_blank, sliding_contexts
from daedap.operators.index import Index
from daedap.operators.reader import Hook, Reader, lexical_reader, packed, reading_questions, spans
from daedap.operators.retrieve import PLUS, Ranker, fetch_text, in_cut, top_units
from daedap.operators.select import (
    acceptable,
    first_of_question,
    length_within,
    trim_genitive,
    trim_particle,
    with_unanswered,
)
from daedap.plans.params import CutParams, RankParams
from daedap.session import SmallSide, materialize, sized

# Adds ``morph`` and ``pos``, the last morpheme of ``answer`` and its tag.
Tagger = Callable[[DataFrame], DataFrame]


def read_contexts(
    contexts: DataFrame,
    questions: DataFrame,
    index: Index,
    small: SmallSide,
    reader: Reader = lexical_reader,
    max_tokens: int | None = None,
    tokenizer: Tokenizer = marked_tokens,
) -> DataFrame:
    """Contexts ``(question_id, text, ..)`` with their token sequences and logits.

    ``tokenizer`` is the reader's own, for questions and contexts alike.
    """
    asked = reading_questions(questions, index, small, tokenizer)
    return reader(packed(contexts, asked, small, max_tokens, tokenizer))


def ranked_contexts(
    index: Index,
    corpus: DataFrame,
    questions: DataFrame,
    params: CutParams,
    small: SmallSide,
    ranker: Ranker = PLUS,
) -> DataFrame:
    """``question_id, doc_pos, rank, in_cut, text``: one context per top document."""
    top = top_units(index, questions, params.documents, ranker, True, small)
    flagged = top.select("question_id", "doc_pos", "rank", in_cut(params.cut).alias("in_cut"))
    return fetch_text(flagged, corpus, small).drop("is_candidate")


def cut_candidates(
    index: Index,
    corpus: DataFrame,
    questions: DataFrame,
    params: CutParams,
    reader: Reader = lexical_reader,
    postprocess: Hook | None = None,
    ranker: Ranker = PLUS,
    tokenizer: Tokenizer = marked_tokens,
) -> DataFrame:
    """The candidate spans of all top documents, with ``rank`` and ``in_cut`` of theirs."""

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        contexts = ranked_contexts(index, corpus, batch, params, small, ranker)
        read = read_contexts(contexts, batch, index, small, reader, params.max_tokens, tokenizer)
        return spans(read, params.end_weight, params.spans, params.end_source, postprocess)

    return sized(questions, run)


def select_answers(candidates: DataFrame, params: CutParams, tagger: Tagger) -> DataFrame:
    """The first acceptable candidate of each question, as ``question_id, answer, stage``.

    Markers are looked for before trimming, the length is checked after it. A
    candidate of the documents in the cut that passes the strict markers comes
    before all others; then follow those of all documents, by the relaxed ones.
    """
    answer = F.col("answer")
    # Trimming takes at most one character, so longer ones can go ahead of the
    # marker search.
    candidates = candidates.filter(length_within(answer, params.min_len, params.max_len + 1))
    strict = F.col("in_cut") & acceptable(answer, params.inside, params.strict)
    relaxed = acceptable(answer, params.inside, params.relaxed)
    passed = candidates.withColumn("step", F.when(strict, 0).when(relaxed, 1)).filter(
        F.col("step").isNotNull()
    )
    trimmed = (
        tagger(passed)
        .withColumn("answer", trim_particle(answer, F.col("morph"), params.particles))
        .filter(length_within(answer, params.min_len, params.max_len))
        .withColumn("stage", F.when(F.col("step") == 0, "cut").otherwise("fallback"))
    )
    order = [F.col("step"), -F.col("score"), F.col("rank"), F.col("start_rank"), F.col("end_rank")]
    return first_of_question(trimmed, order, ["answer", "stage"])


def answer_by_cut(
    index: Index,
    corpus: DataFrame,
    questions: DataFrame,
    params: CutParams,
    tagger: Tagger,
    reader: Reader = lexical_reader,
    postprocess: Hook | None = None,
    read_again: bool = False,
    ranker: Ranker = PLUS,
    tokenizer: Tokenizer = marked_tokens,
) -> DataFrame:
    """``question_id, answer, stage`` for every question; stage cut, fallback or none.

    The documents outside the cut are read along with the others, in one pass.
    Where reading is dear, ``read_again`` first answers from the cut alone and
    reads all documents only for the questions left over; jobs for that run while
    the plan is built.
    """

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        contexts = ranked_contexts(index, corpus, batch, params, small, ranker)

        def answers(rows: DataFrame) -> DataFrame:
            read = read_contexts(rows, batch, index, small, reader, params.max_tokens, tokenizer)
            found = spans(read, params.end_weight, params.spans, params.end_source, postprocess)
            return select_answers(found, params, tagger)

        if not read_again:
            return answers(contexts)
        contexts = materialize(contexts)
        first = materialize(answers(contexts.filter("in_cut")).filter(F.col("stage") == "cut"))
        left_over = contexts.join(small(first.select("question_id")), "question_id", "left_anti")
        return first.unionByName(answers(left_over))

    return with_unanswered(sized(questions, run, in_batches=True), questions)


def answer_by_rank(
    index: Index,
    corpus: DataFrame,
    questions: DataFrame,
    params: RankParams,
    tagger: Tagger,
    reader: Reader = lexical_reader,
    read_first: int = 5,
    postprocess: Hook | None = None,
    ranker: Ranker = PLUS,
    tokenizer: Tokenizer = marked_tokens,
) -> DataFrame:
    """``question_id, answer, stage`` for every question; stage window, single or none.

    All documents are ranked, those that may not be returned as blanks. With
    ``windows`` blanks are dropped, joined contexts are read first, and single
    documents only for the questions these leave unanswered. Without, the
    ``read_first`` best documents are read first, and the others only for the
    questions left over. The texts of ranked documents and first answers are written,
    by jobs that run while the plan is built.
    """

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        top = top_units(index, batch, params.documents, ranker, False, small)
        texts = fetch_text(top.select("question_id", "doc_pos", "rank"), corpus, small)
        texts = blank_outside_scope(texts).select("question_id", "rank", "text")
        # Written once, so that the corpus is read once, whoever reads on.
        ranked = materialize(drop_blank(texts) if params.windows else texts)

        def unanswered(rows: DataFrame, first: DataFrame) -> DataFrame:
            return rows.join(small(first.select("question_id")), "question_id", "left_anti")

        def answers(contexts: DataFrame, stage: str) -> DataFrame:
            read = read_contexts(
                contexts, batch, index, small, reader, params.max_tokens, tokenizer
            )
            found = spans(
                read,
                k=1,
                end_source=params.end_source,
                postprocess=postprocess,
                min_len=params.min_len,
            )
            kept = found.filter(acceptable(F.col("answer"), (), params.anywhere))
            if params.genitive:
                trimmed = trim_genitive(
                    F.col("answer"), F.col("morph"), F.col("pos"), params.genitive
                )
                kept = tagger(kept).withColumn("answer", trimmed)
            kept = kept.filter(length_within(F.col("answer"), params.min_len, params.max_len))
            first = first_of_question(kept, [F.col("rank")], ["answer"])
            return first.withColumn("stage", F.lit(stage))

        if params.windows:
            first = materialize(answers(sliding_contexts(ranked, batch), "window"))
            return first.unionByName(answers(unanswered(ranked, first), "single"))
        best = F.col("rank") <= read_first
        first = materialize(answers(ranked.filter(best), "single"))
        return first.unionByName(answers(unanswered(ranked.filter(~best), first), "single"))

    return with_unanswered(sized(questions, run, in_batches=True), questions)
