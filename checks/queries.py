"""Every operator and pipeline as a query over a folder of test tables.

Roles: ``documents`` is the corpus (title = source), the first 84.33 % of it may be
returned, as 56,737 of 67,277 in the original setting. ``benchmark`` holds the
questions, user turns of ``conversations`` are a second set; assistant turns are
the gold answers to audit. No text is Korean, so rule queries take markers and
particles that occur in Latin text, and ``tagger`` stands in for one of Korean; the
``_korean`` queries put Hangul in place of letters and use the real rules. Every query covers its whole tables and whole texts; only
``pack_truncate`` and ``answers_p3_model_length`` apply a model's length limit, which
is what they show.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daedap.functions.sequences import detokenize
from daedap.functions.text import marked_tokens, normalize, searchable, word_tokens
from daedap.operators.audit import (
    genitive_hits,
    marker_counts,
    marker_hits,
    particle_hits,
    trim_trace,
)
from daedap.operators.contexts import blank_outside_scope, drop_blank, sliding_contexts
from daedap.operators.index import Index, build_index, corpus_tokens, open_index, store_index
from daedap.operators.reader import end_rows, logit_rows, model_reader, spans, start_rows
from daedap.operators.retrieve import (
    OKAPI,
    PLUS,
    L,
    base_scores,
    bounded_matches,
    documents_with_text,
    fetch_text,
    question_weights,
    score_documents,
    score_value,
    top_documents,
    top_units,
)
from daedap.operators.scores import best_scores, score_distribution, score_runs
from daedap.operators.select import (
    acceptable,
    among_candidates,
    answer_report,
    length_within,
    trim_genitive,
    trim_genitive_if_candidate,
    trim_particle,
    with_last_morph,
)
from daedap.plans.params import P0, P1, P2, P3, P4, P5, CutParams, RankParams
from daedap.plans.answering import (
    answer_by_cut,
    answer_by_rank,
    cut_candidates,
    ranked_contexts,
    read_contexts,
)
from daedap.session import SmallSide, shared_dir, sized
from daedap.sources.answers import (
    last_write_wins,
    map_entries,
    read_answer_map,
    write_answer_map,
)
from daedap.sources.corpus import (
    as_corpus,
    load_json_lines,
    load_json_map,
    store_corpus,
    with_scope,
)
from daedap.sources.splits import as_questions, gold_answers, load_arrow_split

SCOPE = 0.8433

# Bytes of a JSON map that a task looks at together, so that a file has several such blocks.
JSON_BLOCK = 1 << 18

# How often a question is said over in ``score_distribution_long``.
REPEATS = 3000

# Settings for Latin text, in place of the Korean markers and particles.
LATIN_INSIDE = ("n.",)
LATIN_STRICT = ("e,", "s,", "d,", "t,", "unk")
LATIN_RELAXED = ("e,", "s,", "d,", "unk")
LATIN_PARTICLES = ("e", "n", "s", "t")
LATIN_GENITIVE = "n"
LATIN_P2 = replace(P2, anywhere=("n.", "unk"), genitive=LATIN_GENITIVE)
LATIN_P3 = replace(
    P3,
    inside=LATIN_INSIDE,
    strict=LATIN_STRICT,
    relaxed=LATIN_RELAXED,
    particles=LATIN_PARTICLES,
)
MODEL_LENGTH = 512


def tagger(answers: DataFrame) -> DataFrame:
    """A stand-in with hits and misses: behind a vowel the last character is the last
    morpheme, otherwise the last two are; answers of even length are tagged JKG."""
    ending = F.right("answer", F.lit(2))
    alone = F.lower(F.left(ending, F.lit(1))).isin("a", "e", "i", "o", "u")
    return answers.withColumn(
        "morph", F.when(alone, F.right("answer", F.lit(1))).otherwise(ending)
    ).withColumn("pos", F.when(F.length("answer") % 2 == 0, "JKG").otherwise("JX"))


# Korean text of the same shape: these letters are replaced, so that the real markers and
# particles of the rules end words and sentences.
LETTERS = "nesdthrialou"
SYLLABLES = "다의을이며데라뿐가를는은"
ALONE_BEHIND = ("가", "의", "뿐", "는", "은")


def in_korean(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.translate("text", LETTERS, SYLLABLES))


def korean_tagger(answers: DataFrame) -> DataFrame:
    """The stand-in ``tagger`` for Korean text."""
    ending = F.right("answer", F.lit(2))
    alone = F.left(ending, F.lit(1)).isin(*ALONE_BEHIND)
    return answers.withColumn(
        "morph", F.when(alone, F.right("answer", F.lit(1))).otherwise(ending)
    ).withColumn("pos", F.when(F.length("answer") % 2 == 0, "JKG").otherwise("JX"))


_stored: dict[tuple, Index] = {}
_blocked: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str, korean: bool = False) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scope = int(SCOPE * documents.count())
    documents = in_korean(documents) if korean else documents
    return with_scope(as_corpus(documents, "doc_id", "source", "text"), scope)


def letters_of(text: Column) -> Column:
    """A tokenizer by single characters: most of its terms are in most documents."""
    return F.filter(F.split(text, ""), lambda c: ~c.isin("", " "))


def index(
    spark: SparkSession,
    sf_dir: str,
    korean: bool = False,
    tokenizer: Callable[[Column], Column] | None = None,
) -> Index:
    """The stored index of this folder, built once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, korean, tokenizer)
    if key not in _stored:
        folder = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
        _stored[key] = store_index(build_index(corpus(spark, sf_dir, korean), tokenizer), folder)
    return _stored[key]


def stored_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus stored in blocks, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _blocked:
        folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
        _blocked[key] = store_corpus(corpus(spark, sf_dir), folder)
    return _blocked[key]


def questions(spark: SparkSession, sf_dir: str, normalized: bool = False) -> DataFrame:
    return as_questions(
        table(spark, sf_dir, "benchmark"), "item_id", "text", normalized=normalized
    )


def batched(
    spark: SparkSession, sf_dir: str, run: Callable[[DataFrame, SmallSide], DataFrame]
) -> DataFrame:
    return sized(questions(spark, sf_dir), run)


def turns(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """One role's turns, as ``id, text``."""
    said = table(spark, sf_dir, "conversations").filter(F.col("role") == role)
    return said.select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text")


def gold(spark: SparkSession, sf_dir: str, korean: bool = False) -> DataFrame:
    said = turns(spark, sf_dir, "assistant")
    said = in_korean(said) if korean else said
    return gold_answers(said.select("id", F.struct(F.array("text", F.upper("text")).alias("text")).alias("answers")))


# Text


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        "doc_pos", normalize(searchable(F.col("title"), F.col("text"))).alias("normalized")
    )


def tokenize_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_tokens(corpus(spark, sf_dir)).select(
        "doc_pos", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


def tokenize_question(spark: SparkSession, sf_dir: str, normalized: bool) -> DataFrame:
    return questions(spark, sf_dir, normalized).select(
        "question_id",
        F.size("tokens").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


def detokenize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        "doc_pos", detokenize(marked_tokens(F.col("text"))).alias("read_back")
    )


# Sources

RECORDS_PER_FILE = 250


def json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON maps, some to a file, and loaded again."""
    record = F.struct(
        F.col("doc_id"),
        F.struct(F.col("source").alias("title"), F.col("text").alias("text")).alias("record"),
    )
    block = F.format_string("%09d", F.floor(F.col("doc_id") / RECORDS_PER_FILE)).alias("block")
    entries = F.array_sort(F.collect_list(record))
    named = F.transform(entries, lambda e: F.struct(e["doc_id"].cast("string"), e["record"]))
    maps = table(spark, sf_dir, "documents").groupBy(block).agg(named.alias("entries"))
    folder = f"{shared_dir(spark)}/json-{uuid.uuid4().hex}"
    lines = maps.select("block", F.to_json(F.map_from_entries("entries")).alias("value"))
    lines.write.partitionBy("block").text(folder)
    return load_json_map(spark, folder, JSON_BLOCK)


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as one JSON record per line, and loaded again."""
    folder = f"{shared_dir(spark)}/json-{uuid.uuid4().hex}"
    corpus(spark, sf_dir).drop("is_candidate").write.json(folder)
    return load_json_lines(spark, folder)


def arrow_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items saved as a dataset folder of Arrow streams, and loaded again.

    A leftover file that the manifest does not name holds them all once more.
    """
    folder = f"{shared_dir(spark)}/arrow-{uuid.uuid4().hex}"
    base = folder.removeprefix("file://").removeprefix("file:")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names = TaskContext.get().partitionId(), []
        for i, batch in enumerate(batches):
            names.append(f"data-{part:05d}-{i:05d}.arrow")
            for name in (names[-1], f"cache-{names[-1]}"):
                with pa.OSFile(f"{base}/{name}", "wb") as sink:
                    with pa.ipc.new_stream(sink, batch.schema) as stream:
                        stream.write_batch(batch)
        yield pa.record_batch({"filename": pa.array(names, pa.string())})

    os.makedirs(base)
    written = table(spark, sf_dir, "benchmark").mapInArrow(write, "filename string").collect()
    with open(f"{base}/state.json", "w") as manifest:
        json.dump({"_data_files": [row.asDict() for row in written]}, manifest)
    return load_arrow_split(spark, folder)


# Index


def retrieve_reopened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked with an index that is opened from the folder it was stored in."""
    folder = f"{shared_dir(spark)}/index-{uuid.uuid4().hex}"
    store_index(build_index(corpus(spark, sf_dir)), folder)
    return top_documents(open_index(spark, folder), questions(spark, sf_dir))


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_index(corpus(spark, sf_dir)).stats


def term_df_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = index(spark, sf_dir)
    with_idf = PLUS.idf(built.terms, built.stats.select("n").scalar())
    return with_idf.select("term", "df", F.round("idf", 6).alias("idf"))


def postings_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_index(corpus(spark, sf_dir)).postings


def corpus_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).agg(F.count("*").alias("n_documents"))


# Retrieval


def retrieve(
    spark: SparkSession, sf_dir: str, normalized: bool = False, **settings
) -> DataFrame:
    asked = questions(spark, sf_dir, normalized)
    return top_documents(index(spark, sf_dir), asked, **settings)


def retrieve_top10_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = as_questions(turns(spark, sf_dir, "user"), "id", "text")
    return top_documents(index(spark, sf_dir), asked)


def retrieve_okapi_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked by characters, whose average idf is below zero."""
    asked = as_questions(table(spark, sf_dir, "benchmark"), "item_id", "text", letters_of)
    return top_documents(index(spark, sf_dir, tokenizer=letters_of), asked, ranker=OKAPI)


def retrieve_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents by way of score bounds, which large question sets take."""

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        built = index(spark, sf_dir)
        weights = question_weights(batch, built, PLUS, small)
        found = bounded_matches(built, weights, P3.documents, PLUS, small)
        best = Window.partitionBy("question_id").orderBy(F.desc("match"), F.desc("doc_pos"))
        ranked = found.withColumn("rank", F.row_number().over(best))
        kept = ranked.filter(F.col("rank") <= P3.documents)
        return kept.select("question_id", "rank", "doc_pos", score_value(F.col("match")).alias("score"))

    return batched(spark, sf_dir, run)


def score_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(index(spark, sf_dir), questions(spark, sf_dir))


def question_base_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_scores(index(spark, sf_dir), questions(spark, sf_dir))


def fetched(spark: SparkSession, sf_dir: str, stored: bool = False) -> DataFrame:
    texts = stored_corpus(spark, sf_dir) if stored else corpus(spark, sf_dir)
    return documents_with_text(index(spark, sf_dir), texts, questions(spark, sf_dir))


def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_distribution(index(spark, sf_dir), questions(spark, sf_dir))


def distribution_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions asked very often over: their scores take another digit."""
    items = table(spark, sf_dir, "benchmark")
    asked = as_questions(items, "item_id", F.repeat(F.concat("text", F.lit(" ")), F.lit(REPEATS)))
    return score_distribution(index(spark, sf_dir), asked)


def top5_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_scores(index(spark, sf_dir), questions(spark, sf_dir))


def sorted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_runs(index(spark, sf_dir), questions(spark, sf_dir))


# Contexts


def ranked30(spark: SparkSession, sf_dir: str, batch: DataFrame, small: SmallSide) -> DataFrame:
    top = top_units(index(spark, sf_dir), batch, P0.documents, PLUS, False, small)
    return blank_outside_scope(
        fetch_text(top.select("question_id", "doc_pos", "rank"), corpus(spark, sf_dir), small)
    )


def nonblank_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        kept = drop_blank(ranked30(spark, sf_dir, batch, small))
        return kept.select("question_id", "rank", "doc_pos", "text")

    return batched(spark, sf_dir, run)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        return sliding_contexts(drop_blank(ranked30(spark, sf_dir, batch, small)), batch)

    return batched(spark, sf_dir, run)


# Reading


def read(
    spark: SparkSession,
    sf_dir: str,
    batch: DataFrame,
    small: SmallSide,
    max_tokens: int | None = None,
) -> DataFrame:
    contexts = ranked_contexts(index(spark, sf_dir), corpus(spark, sf_dir), batch, P3, small)
    return read_contexts(contexts, batch, index(spark, sf_dir), small, max_tokens=max_tokens)


def model_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by a reader in the model slot, whose logits follow token lengths."""

    def load():
        def model(sequences):
            for tokens in sequences:
                lengths = [len(t) for t in tokens]
                yield [n % 7 - 2.0 for n in lengths], [n * 3 % 5 - 1.0 for n in lengths]

        return model

    found = cut_candidates(
        index(spark, sf_dir),
        corpus(spark, sf_dir),
        questions(spark, sf_dir),
        P3,
        reader=model_reader(load),
    )
    return _span_rows(found)


def pack_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        return read(spark, sf_dir, batch, small, MODEL_LENGTH).select(
            "question_id",
            "doc_pos",
            "document_start",
            F.size("sequence").alias("n_tokens"),
            F.array_join("sequence", " ").alias("sequence"),
        )

    return batched(spark, sf_dir, run)


def reader_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        return logit_rows(read(spark, sf_dir, batch, small)).drop("rank")

    return batched(spark, sf_dir, run)


def starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched(spark, sf_dir, lambda b, small: start_rows(read(spark, sf_dir, b, small)))


def ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched(spark, sf_dir, lambda b, small: end_rows(read(spark, sf_dir, b, small)))


def candidates(spark: SparkSession, sf_dir: str, params: CutParams) -> DataFrame:
    return cut_candidates(
        index(spark, sf_dir), corpus(spark, sf_dir), questions(spark, sf_dir), params
    )


def span_candidates(spark: SparkSession, sf_dir: str, params: CutParams) -> DataFrame:
    return _span_rows(candidates(spark, sf_dir, params))


def _span_rows(found: DataFrame) -> DataFrame:
    return found.select(
        "question_id",
        "doc_pos",
        "start",
        "end_excl",
        "start_rank",
        "end_rank",
        F.round("score", 6).alias("score"),
        "answer",
    )


def best_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        best = spans(read(spark, sf_dir, batch, small), k=1, min_len=0)
        return best.select("question_id", "doc_pos", "start", "end_excl", "answer")

    return batched(spark, sf_dir, run)


# Selection


def pool_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("question_id").orderBy(
        F.desc("score"), "rank", "start_rank", "end_rank"
    )
    return candidates(spark, sf_dir, P3).select(
        "question_id", "doc_pos", "start", "end_excl", F.row_number().over(order).alias("place")
    )


SPAN = ("question_id", "doc_pos", "start", "end_excl")


def marker_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.col("answer")
    return candidates(spark, sf_dir, LATIN_P3).select(
        *SPAN,
        acceptable(answer, LATIN_INSIDE, LATIN_STRICT).alias("strict"),
        acceptable(answer, LATIN_INSIDE, LATIN_RELAXED).alias("relaxed"),
    )


def early_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = F.col("answer")

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        best = spans(read(spark, sf_dir, batch, small), k=1, min_len=0)
        return best.select(
            "question_id",
            "doc_pos",
            length_within(answer, P0.min_len, P0.max_len).alias("p0"),
            (length_within(answer, P1.min_len, None) & acceptable(answer, (), ("n.",))).alias("p1"),
            (
                length_within(answer, P2.min_len, None)
                & acceptable(answer, (), LATIN_P2.anywhere)
            ).alias("p2"),
        )

    return batched(spark, sf_dir, run)


def particle_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagger(candidates(spark, sf_dir, LATIN_P3))
    trimmed = trim_particle(F.col("answer"), F.col("morph"), LATIN_PARTICLES)
    return tagged.select(*SPAN, trimmed.alias("trimmed"))


def genitive_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagger(candidates(spark, sf_dir, LATIN_P3))
    trimmed = trim_genitive(F.col("answer"), F.col("morph"), F.col("pos"), LATIN_GENITIVE)
    return tagged.select(*SPAN, trimmed.alias("trimmed"))


def conditional_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tagger(candidates(spark, sf_dir, LATIN_P3))
    trimmed = trim_genitive_if_candidate(tagged, LATIN_GENITIVE)
    return trimmed.select(*SPAN, F.col("answer").alias("trimmed"))


def candidate_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of a question are among its answer candidates?"""
    words = F.array_distinct(word_tokens(F.col("question")))
    wanted = questions(spark, sf_dir).select("question_id", F.explode(words).alias("answer"))
    return among_candidates(wanted, candidates(spark, sf_dir, P3))


# Answers


def answers_cut(spark: SparkSession, sf_dir: str, params: CutParams, **how) -> DataFrame:
    return answer_by_cut(
        index(spark, sf_dir),
        corpus(spark, sf_dir),
        questions(spark, sf_dir),
        params,
        tagger,
        **how,
    )


def answers_rank(spark: SparkSession, sf_dir: str, params: RankParams, **how) -> DataFrame:
    return answer_by_rank(
        index(spark, sf_dir),
        corpus(spark, sf_dir),
        questions(spark, sf_dir),
        params,
        tagger,
        **how,
    )


def answers_p3_korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = as_questions(in_korean(table(spark, sf_dir, "benchmark")), "item_id", "text")
    texts = corpus(spark, sf_dir, korean=True)
    return answer_by_cut(index(spark, sf_dir, korean=True), texts, asked, P3, korean_tagger)


def answers_p2_korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = as_questions(in_korean(table(spark, sf_dir, "benchmark")), "item_id", "text")
    texts = corpus(spark, sf_dir, korean=True)
    return answer_by_rank(index(spark, sf_dir, korean=True), texts, asked, P2, korean_tagger)


def without_marks(answer: Column) -> Column:
    """A hook that changes an answer's text."""
    return F.regexp_replace(answer, "[.,]+$", "")


def answers_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns asked under their conversation: the last one of each counts."""
    said = table(spark, sf_dir, "conversations").filter("role = 'user'")
    asked = as_questions(said, "conv_id", "text", order="turn")
    return answer_by_cut(index(spark, sf_dir), corpus(spark, sf_dir), asked, LATIN_P3, tagger)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answer_report(answers_cut(spark, sf_dir, P3))


def answer_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_entries(answers_cut(spark, sf_dir, P3))


def answer_map_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answer map written as one JSON object over part files, and read again."""
    folder = f"{shared_dir(spark)}/answers-{uuid.uuid4().hex}"
    write_answer_map(answers_cut(spark, sf_dir, P4), folder)
    return read_answer_map(spark, folder)


def answer_map_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns written as answers of their conversation, and read again."""
    said = table(spark, sf_dir, "conversations")
    folder = f"{shared_dir(spark)}/answers-{uuid.uuid4().hex}"
    written = said.select(F.col("conv_id").alias("question_id"), F.col("text").alias("answer"), "turn")
    write_answer_map(written, folder, "turn")
    return read_answer_map(spark, folder)


def last_answer_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written one after the other under their conversation: the last one stays."""
    said = table(spark, sf_dir, "conversations")
    written = said.select(F.col("conv_id").alias("question_id"), F.col("text").alias("answer"), "turn")
    return last_write_wins(written, "turn")


# Audit of gold answers


def audit_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marker_counts(gold(spark, sf_dir), LATIN_INSIDE, LATIN_STRICT)


def audit_marker_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marker_hits(gold(spark, sf_dir), LATIN_INSIDE, LATIN_STRICT)


def audit_genitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genitive_hits(tagger(gold(spark, sf_dir)), ".").select("question_id", "answer")


def audit_particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = particle_hits(tagger(gold(spark, sf_dir)), (".", *LATIN_PARTICLES))
    return hits.select("question_id", "answer", "particle", "particle_order")


def audit_particles_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the last morphemes looked up in a tagger's table, which lacks some."""
    answers = gold(spark, sf_dir)
    endings = (".", *LATIN_PARTICLES)
    known = answers.select("answer").distinct().filter(F.length("answer") % 3 != 0)
    table_of_tagger = tagger(known)
    hits = particle_hits(with_last_morph(answers, table_of_tagger, endings), endings)
    return hits.select("question_id", "answer", "particle", "particle_order")


def audit_trim_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    traced = trim_trace(tagger(gold(spark, sf_dir)), (".", *LATIN_PARTICLES))
    return traced.select("question_id", "final", "morph", "trimmed")


def audit_markers_korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marker_counts(gold(spark, sf_dir, korean=True))


def audit_particles_korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = particle_hits(korean_tagger(without_final_mark(gold(spark, sf_dir, korean=True))))
    return hits.select("question_id", "answer", "particle", "particle_order")


def audit_genitive_korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = genitive_hits(korean_tagger(without_final_mark(gold(spark, sf_dir, korean=True))))
    return hits.select("question_id", "answer")


def without_final_mark(answers: DataFrame) -> DataFrame:
    """Turns end in a full stop; their last word is what may have a particle."""
    return answers.withColumn("answer", F.regexp_replace("answer", "[.]$", ""))


QUERIES = {
    "normalize_text": normalize_text,
    "tokenize_corpus": tokenize_corpus,
    "tokenize_question_raw": partial(tokenize_question, normalized=False),
    "tokenize_question_normalized": partial(tokenize_question, normalized=True),
    "detokenize_text": detokenize_text,
    "corpus_size": corpus_size,
    "index_stats": index_stats,
    "term_df_idf": term_df_idf,
    "postings_tf": postings_tf,
    "retrieve_top10": retrieve,
    "retrieve_top10_normalized": partial(retrieve, normalized=True),
    "retrieve_top10_conversations": retrieve_top10_conversations,
    "retrieve_top10_reopened": retrieve_reopened,
    "load_json_map": json_map,
    "load_json_lines": json_lines,
    "load_arrow_split": arrow_split,
    "spans_model_slot": model_spans,
    "retrieve_top30": partial(retrieve, n=30, candidates_only=False),
    "retrieve_cut_095": partial(retrieve, cut=P3.cut),
    "retrieve_cut_090": partial(retrieve, cut=P4.cut),
    "retrieve_okapi": partial(retrieve, ranker=OKAPI),
    "retrieve_okapi_letters": retrieve_okapi_letters,
    "retrieve_bounded": retrieve_bounded,
    "retrieve_l": partial(retrieve, ranker=L),
    "score_candidates": score_candidates,
    "question_base_score": question_base_score,
    "fetch_text": fetched,
    "fetch_text_stored": partial(fetched, stored=True),
    "score_distribution": distribution,
    "score_distribution_long": distribution_long,
    "score_top5": top5_scores,
    "score_sorted": sorted_scores,
    "nonblank_contexts": nonblank_contexts,
    "sliding_contexts": windows,
    "pack_truncate": pack_truncate,
    "reader_logits": reader_logits,
    "top_starts": starts,
    "top_ends": ends,
    "span_candidates_w100": partial(span_candidates, params=P3),
    "span_candidates_w050": partial(span_candidates, params=P4),
    "span_candidates_w010": partial(span_candidates, params=P5),
    "span_candidates_end_source": partial(span_candidates, params=replace(P3, end_source="end")),
    "best_span": best_span,
    "pool_order": pool_order,
    "marker_filter": marker_filter,
    "early_filters": early_filters,
    "particle_trim": particle_trim,
    "genitive_trim": genitive_trim,
    "conditional_trim": conditional_trim,
    "candidate_membership": candidate_membership,
    "answers_p0": partial(answers_rank, params=P0),
    "answers_p1": partial(answers_rank, params=P1),
    "answers_p2": partial(answers_rank, params=P2),
    "answers_p2_latin": partial(answers_rank, params=LATIN_P2),
    "answers_p3": partial(answers_cut, params=P3),
    "answers_p3_latin": partial(answers_cut, params=LATIN_P3),
    "answers_p3_read_again": partial(answers_cut, params=LATIN_P3, read_again=True),
    "answers_p3_model_length": partial(answers_cut, params=replace(P3, max_tokens=MODEL_LENGTH)),
    "answers_p3_korean": answers_p3_korean,
    "answers_p2_korean": answers_p2_korean,
    "answers_p4": partial(answers_cut, params=P4),
    "answers_p5": partial(answers_cut, params=P5),
    "answers_p0_hook": partial(answers_rank, params=P0, postprocess=without_marks),
    "answers_p3_hook": partial(answers_cut, params=P3, postprocess=without_marks),
    "answers_p3_okapi": partial(answers_cut, params=LATIN_P3, ranker=OKAPI),
    "answers_repeated_ids": answers_repeated_ids,
    "answer_map_repeated_ids": answer_map_repeated_ids,
    "answer_report": report,
    "answer_map": answer_map,
    "answer_map_read_back": answer_map_read_back,
    "last_answer_wins": last_answer_wins,
    "audit_markers": audit_markers,
    "audit_marker_hits": audit_marker_hits,
    "audit_genitive": audit_genitive,
    "audit_particles": audit_particles,
    "audit_particles_lookup": audit_particles_lookup,
    "audit_trim_trace": audit_trim_trace,
    "audit_markers_korean": audit_markers_korean,
    "audit_particles_korean": audit_particles_korean,
    "audit_genitive_korean": audit_genitive_korean,
}
