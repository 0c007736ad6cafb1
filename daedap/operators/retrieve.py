"""Ranking documents for all questions at once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daedap.operators.chunks import best_in_chunks
from daedap.operators.index import Index, length_norm, postings_of
from daedap.session import SmallSide, materialize, sized
from daedap.sources.corpus import block_of, documents_per_block

# Scores are added up as whole billionths: the sum of doubles depends on their
# order, and so on partitions and retries, and would order exact copies by noise.
UNIT = 1_000_000_000

# Fixed value: how fast repeats of a term count less, in all three rankings.
K1 = 1.5


@dataclass(frozen=True)
class Ranker:
    """A lexical ranking, as the parts the sparse form of the score needs.

    A document scores ``idf * (floor + gain)`` for every question token. ``floor``
    is what a document without the term gets, ``gain`` what the term adds. So a
    question has one base score, and only matching documents need a row.

    ``gain`` takes a term's frequency and the length norm; it is 0 or more and grows with
    the quotient of both. ``signed`` says that an idf can be below zero, so that a document
    can lose by a match.
    """

    idf: Callable[[DataFrame, Column], DataFrame]
    gain: Callable[[Column, Column], Column]
    floor: float = 0.0
    signed: bool = False


def _with_idf(formula: Callable[[Column, Column], Column]):
    return lambda terms, n: terms.withColumn("idf", formula(n, F.col("df")))


def _raw_idf(n: Column) -> Column:
    return F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)


def _okapi_idf(terms: DataFrame, n: Column) -> DataFrame:
    """Terms in over half of the documents get a quarter of the average idf.

    That is below zero for a corpus most of whose terms are in most documents.
    """
    raw = _raw_idf(n)
    least = 0.25 * terms.agg(F.avg(raw)).scalar()
    return terms.withColumn("idf", F.when(raw < 0, least).otherwise(raw))


# The usual parameters of the three rankings.
PLUS = Ranker(
    idf=_with_idf(lambda n, df: F.log((n + 1) / df)),
    gain=lambda tf, norm: tf * (K1 + 1) / (K1 * norm + tf),
    floor=1.0,
)
OKAPI = Ranker(
    idf=_okapi_idf, gain=lambda tf, norm: tf * (K1 + 1) / (K1 * norm + tf), signed=True
)
L_DELTA = 0.5
L_FLOOR = (K1 + 1) * L_DELTA / (K1 + L_DELTA)
L = Ranker(
    idf=_with_idf(lambda n, df: F.log((n + 1) / (df + 0.5))),
    gain=lambda tf, norm: (K1 + 1) * (tf / norm + L_DELTA) / (K1 + tf / norm + L_DELTA) - L_FLOOR,
    floor=L_FLOOR,
)


def _units(value: Column) -> Column:
    return F.floor(value * UNIT + 0.5)


def score_value(units: Column) -> Column:
    """Units as a score with six decimals, the same on every run and engine."""
    return F.floor((units + 500) / 1000) / 1_000_000


def question_weights(
    questions: DataFrame, index: Index, ranker: Ranker, small: SmallSide
) -> DataFrame:
    """``question_id, term, qtf, df, densest, idf`` for the question terms that the index knows."""
    asked = (
        questions.select("question_id", F.explode("tokens").alias("term"))
        .groupBy("question_id", "term")
        .agg(F.count("*").alias("qtf"))
    )
    terms = ranker.idf(index.terms, index.stats.select("n").scalar())
    return small(asked).join(terms, "term")


def _met(postings: DataFrame, weights: DataFrame, index: Index, small: SmallSide) -> DataFrame:
    """Postings joined with the question terms they are of, the postings scanned once.

    A question set that fits goes to the postings. A larger one meets them by term in a
    shuffle: the postings of a term in very many documents are dealt over several tasks by
    document, and its question terms go to each of these. Of such terms there are at most
    a thousand times as many as a document has on average.
    """
    if small.broadcasts:
        return postings.join(F.broadcast(weights.drop("df")), "term")
    limit = max(index.documents_per_task, index.n_documents // 1000)
    shares = F.ceil(F.col("df") / limit)
    hot = weights.filter(F.col("df") > limit).select("term", shares.alias("shares")).distinct()
    share = F.coalesce(F.pmod(F.xxhash64("doc_pos"), F.col("shares")), F.lit(0)).alias("share")
    dealt = postings.join(F.broadcast(hot), "term", "left").select(*postings.columns, share)
    last = F.greatest(shares, F.lit(1)) - 1
    spread = weights.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return dealt.join(spread.drop("df"), ["term", "share"]).drop("share")


def match_units(index: Index, weights: DataFrame, ranker: Ranker, small: SmallSide) -> DataFrame:
    """``question_id, doc_pos, match`` for every document sharing a term with a question.

    Postings are partitioned by document, so where the question terms are broadcast the
    sum over terms needs no shuffle.
    """
    norm = length_norm(F.col("dl"), index.stats.select("avgdl").scalar())
    gains = postings_of(index.postings, small.terms).select(
        "doc_pos", "term", ranker.gain(F.col("tf"), norm).alias("gain")
    )
    weight = (F.col("qtf") * F.col("idf")).alias("weight")
    weighted = weights.select("question_id", "term", "df", weight)
    return (
        _met(gains, weighted, index, small)
        .groupBy("doc_pos", "question_id")
        .agg(F.sum(_units(F.col("weight") * F.col("gain"))).alias("match"))
    )


def base_units(
    questions: DataFrame, weights: DataFrame, ranker: Ranker, small: SmallSide
) -> DataFrame:
    """``question_id, base``: what every document scores; 0 without a known term."""
    part = _units(F.col("qtf") * F.col("idf") * ranker.floor)
    known = weights.groupBy("question_id").agg(F.sum(part).alias("known"))
    return (
        questions.select("question_id")
        .join(small(known), "question_id", "left")
        .select("question_id", F.coalesce("known", F.lit(0)).alias("base"))
    )


def _scoped(index: Index, candidates_only: bool) -> Index:
    """The index with only eligible documents; its statistics stay those of all."""
    if not candidates_only:
        return index
    return replace(
        index,
        docs=index.docs.filter("is_candidate"),
        postings=index.postings.filter("is_candidate"),
    )


def score_documents(
    index: Index, questions: DataFrame, ranker: Ranker = PLUS, candidates_only: bool = True
) -> DataFrame:
    """``question_id, doc_pos, score`` for every matching pair.

    A document not listed for a question scores that question's base score.
    """

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        weights = question_weights(batch, index, ranker, small)
        base = base_units(batch, weights, ranker, small)
        matches = match_units(_scoped(index, candidates_only), weights, ranker, small)
        return matches.join(small(base), "question_id").select(
            "question_id", "doc_pos", score_value(F.col("base") + F.col("match")).alias("score")
        )

    return sized(questions, run)


def base_scores(index: Index, questions: DataFrame, ranker: Ranker = PLUS) -> DataFrame:
    """``question_id, score`` of a document that shares no term with the question."""

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        base = base_units(batch, question_weights(batch, index, ranker, small), ranker, small)
        return base.select("question_id", score_value(F.col("base")).alias("score"))

    return sized(questions, run)


def _by_score() -> WindowSpec:
    """Best score first; among equals the higher position first."""
    return Window.partitionBy("question_id").orderBy(F.desc("match"), F.desc("doc_pos"))


def _best_matches(matches: DataFrame, n: int) -> DataFrame:
    """The n best matching documents of each question.

    Every task keeps its own n best of a question before the shuffle, so one
    question matching a huge share of the corpus costs no more than another.
    """
    ranked = matches.withColumn("rank", F.row_number().over(_by_score()))
    return ranked.filter(F.col("rank") <= n)


def _pairs_units(
    pairs: DataFrame, index: Index, weights: DataFrame, ranker: Ranker, small: SmallSide
) -> DataFrame:
    """``question_id, doc_pos, match`` of some ``pairs(question_id, doc_pos)``, by ``weights``.

    Pairs meet the postings of their document, and these the terms of their question.
    """
    norm = length_norm(F.col("dl"), index.stats.select("avgdl").scalar())
    gains = postings_of(index.postings, small.terms).select(
        "doc_pos", "term", ranker.gain(F.col("tf"), norm).alias("gain")
    )
    asked = weights.select("term").distinct()
    weight = (F.col("qtf") * F.col("idf")).alias("weight")
    weighted = weights.select("question_id", "term", weight)
    return (
        gains.join(small(asked), "term", "left_semi")
        .join(pairs.hint("shuffle_hash"), "doc_pos")
        .join(small(weighted), ["question_id", "term"])
        .groupBy("question_id", "doc_pos")
        .agg(F.sum(_units(F.col("weight") * F.col("gain"))).alias("match"))
    )


def bounded_matches(
    index: Index,
    weights: DataFrame,
    n: int,
    ranker: Ranker,
    small: SmallSide,
    probe: int | None = None,
) -> DataFrame:
    """The n best matching documents of each question and more, their ``match`` exact.

    The documents that the rarest terms of a question rank first get their exact scores;
    the n-th best of these is reached by n documents. Then terms are added up rarest first,
    as far as those left over could lift a document above that threshold on their own:
    a document with none of these terms stays below it. Of the others, those that the terms
    left over cannot lift to it are dropped, and only the rest is brought to exact scores.
    Rests and thresholds are written meanwhile; no idf may be below zero.
    """
    probe = 100 * n if probe is None else probe
    most = _units(F.col("qtf") * F.col("idf") * ranker.gain(F.col("densest"), F.lit(1.0))) + 1
    rarest = Window.partitionBy("question_id").orderBy("df", "term")
    before = F.sum("df").over(rarest.rowsBetween(Window.unboundedPreceding, -1))
    weights = materialize(
        weights.withColumn("most", most)
        .withColumn("before", F.coalesce(before, F.lit(0)))
        # What this term and all more frequent ones can add at most.
        .withColumn("rest", F.sum("most").over(rarest.rowsBetween(0, Window.unboundedFollowing)))
    )
    first = match_units(index, weights.filter(F.col("before") < probe), ranker, small)
    candidates = materialize(_best_matches(first, 3 * n).select("question_id", "doc_pos"))
    exact = _best_matches(_pairs_units(candidates, index, weights, ranker, small), n)
    threshold = exact.filter(F.col("rank") == n).select("question_id", F.col("match").alias("threshold"))
    weights = materialize(
        weights.join(small(threshold), "question_id", "left").withColumn(
            "needed", F.col("rest") >= F.coalesce("threshold", F.lit(0))
        )
    )
    left = weights.groupBy("question_id").agg(
        F.coalesce(F.max("threshold"), F.lit(0)).alias("threshold"),
        F.coalesce(F.max(F.when(~F.col("needed"), F.col("rest"))), F.lit(0)).alias("left"),
    )
    partial = match_units(index, weights.filter("needed"), ranker, small)
    hopeful = materialize(
        partial.join(small(left), "question_id")
        .filter(F.col("match") + F.col("left") >= F.col("threshold"))
        .select("question_id", "doc_pos", "match")
    )
    pairs = hopeful.select("question_id", "doc_pos")
    more = _pairs_units(pairs, index, weights.filter("not needed"), ranker, small)
    return hopeful.unionByName(more).groupBy("question_id", "doc_pos").agg(F.sum("match").alias("match"))


def chunk_matches(
    index: Index, weights: DataFrame, n: int, ranker: Ranker, small: SmallSide
) -> DataFrame:
    """The n best matching documents of each question and more, their ``match`` exact.

    Found in chunks of documents, without a row per question and matching document. No
    idf may be below zero.
    """
    norm = length_norm(F.col("dl"), index.stats.select("avgdl").scalar())
    gains = postings_of(index.postings, small.terms).select(
        "doc_pos", "term", ranker.gain(F.col("tf"), norm).alias("gain")
    )
    weighted = weights.select("question_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"))
    return best_in_chunks(gains, weighted, n, UNIT, small)


def _loses_by_matches(index: Index, ranker: Ranker) -> bool:
    """Can a document lose by a match in this corpus? One number comes to the driver."""
    if not ranker.signed:
        return False
    idf = ranker.idf(index.terms, index.stats.select("n").scalar())
    least = idf.agg(F.min("idf").alias("least")).first()["least"]
    return least is not None and least < 0


# Positions in a block, for finding documents that do not match.
GAP_BLOCK = 4096


def unmatched(scope: DataFrame, matches: DataFrame, questions: DataFrame, n: int) -> DataFrame:
    """``question_id, doc_pos``: the n highest positions that do not match each question.

    Where a match can cost a document, those without one stand between the others. They
    are found by counting: of blocks of positions it is known how many documents they have,
    and how many of these match; from the top, the first places not taken are in at most n
    blocks that have some match and in the first blocks of runs that have none. Only in these
    are documents looked at one by one, at most n * (n + 1) blocks to a question.
    """
    block = F.floor(F.col("doc_pos") / GAP_BLOCK)
    from_top = Window.orderBy(F.desc("block"))
    # One row per block: numbered from the top, with the documents in those above it.
    blocks = materialize(
        scope.groupBy(block.alias("block"))
        .agg(F.count("*").alias("size"))
        .withColumn("place", F.row_number().over(from_top))
        .withColumn("above", F.sum("size").over(from_top) - F.col("size"))
    )
    by_place = Window.partitionBy("question_id").orderBy("place")
    taken = (
        matches.groupBy("question_id", block.alias("block"))
        .agg(F.count("*").alias("taken"))
        .join(blocks, "block")
        .select("question_id", "place", "size", "above", "taken")
    )
    # Every question has a last row behind all blocks, so that its last run has an end.
    end = blocks.agg(
        (F.coalesce(F.max("place"), F.lit(0)) + 1).alias("place"),
        F.lit(0).cast("long").alias("size"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("above"),
    )
    ends = questions.select(
        "question_id", F.explode(F.array(F.struct(*[end.select(c).scalar().alias(c) for c in end.columns]))).alias("end")
    ).select("question_id", "end.*", F.lit(0).cast("long").alias("taken"))
    free = (
        taken.unionByName(ends)
        .withColumn("taken_above", F.sum("taken").over(by_place) - F.col("taken"))
        .withColumn("last", F.coalesce(F.lag("place").over(by_place), F.lit(0)))
        .withColumn("last_free", F.col("above") - F.col("taken_above"))
        .withColumn("before_run", F.coalesce(F.lag(F.col("above") + F.col("size") - F.col("taken_above") - F.col("taken")).over(by_place), F.lit(0)))
    )
    own = free.filter((F.col("size") > F.col("taken")) & (F.col("last_free") < n)).select("question_id", "place")
    runs = free.filter((F.col("place") - F.col("last") > 1) & (F.col("before_run") < n)).select(
        "question_id",
        F.explode(F.sequence(F.col("last") + 1, F.least(F.col("place") - 1, F.col("last") + n))).alias("place"),
    )
    wanted = own.unionByName(runs).join(blocks.select("place", "block"), "place").select("question_id", "block")
    positions = scope.select("doc_pos", block.alias("block")).join(wanted, "block").drop("block")
    free_places = positions.join(matches.select("question_id", "doc_pos"), ["question_id", "doc_pos"], "left_anti")
    highest = Window.partitionBy("question_id").orderBy(F.desc("doc_pos"))
    return (
        free_places.withColumn("rank", F.row_number().over(highest))
        .filter(F.col("rank") <= n)
        .select("question_id", "doc_pos")
    )


def top_units(
    index: Index,
    questions: DataFrame,
    n: int,
    ranker: Ranker,
    candidates_only: bool,
    small: SmallSide,
) -> DataFrame:
    """``question_id, doc_pos, rank, units, best``: the n best documents of each question."""
    weights = materialize(question_weights(questions, index, ranker, small))
    scope = _scoped(index, candidates_only)
    base = base_units(questions, weights, ranker, small)
    if _loses_by_matches(index, ranker):
        matches = materialize(match_units(scope, weights, ranker, small))
        others = unmatched(scope.docs, matches, questions, n)
        filler = base.join(others, "question_id", "left")
    else:
        matches = chunk_matches(scope, weights, n, ranker, small)
        # Where fewer than n documents match, those without a match follow, the highest
        # positions first. Fewer than n match then, so the last 2n documents hold
        # enough of the others.
        last = scope.docs.orderBy(F.desc("doc_pos")).limit(2 * n)
        positions = F.explode_outer(last.agg(F.collect_list("doc_pos")).scalar())
        filler = base.select("question_id", "base", positions.alias("doc_pos"))
    filler = filler.select("question_id", "doc_pos", F.lit(0).cast("long").alias("match"), "base")
    matched = _best_matches(matches, n)
    by_question = Window.partitionBy("question_id")
    return (
        matched.select("question_id", "doc_pos", "match", F.lit(None).cast("long").alias("base"))
        .unionByName(filler)
        # At most 3n rows to a question; grouping and ranking share this shuffle.
        .repartition("question_id")
        .groupBy("question_id", "doc_pos")
        .agg(F.max("match").alias("match"), F.max("base").alias("base"))
        .withColumn("base", F.max("base").over(by_question))
        .filter(F.col("doc_pos").isNotNull())
        .withColumn("rank", F.row_number().over(_by_score()))
        .filter(F.col("rank") <= n)
        .withColumn("units", F.col("base") + F.col("match"))
        .select(
            "question_id",
            "doc_pos",
            "rank",
            "units",
            F.max("units").over(by_question).alias("best"),
        )
    )


def in_cut(cut: float) -> Column:
    """Is a document's score above ``cut`` times the question's best score?"""
    return F.col("units") > cut * F.col("best")


def top_documents(
    index: Index,
    questions: DataFrame,
    n: int = 10,
    ranker: Ranker = PLUS,
    candidates_only: bool = True,
    cut: float | None = None,
) -> DataFrame:
    """``question_id, rank, doc_pos, score`` of the n best documents of each question.

    With ``cut`` only those scoring above that share of the best score are kept.
    """

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        top = top_units(index, batch, n, ranker, candidates_only, small)
        kept = top if cut is None else top.filter(in_cut(cut))
        return kept.select("question_id", "rank", "doc_pos", score_value(F.col("units")).alias("score"))

    return sized(questions, run)


def fetch_text(ranked: DataFrame, corpus: DataFrame, small: SmallSide) -> DataFrame:
    """Add ``text`` and ``is_candidate`` to ranked documents; the corpus is not shuffled.

    Of a stored corpus, only the blocks with a ranked document are read.
    """
    texts = corpus.select("doc_pos", "text", "is_candidate")
    if "doc_block" not in corpus.columns:
        return small(ranked).join(texts, "doc_pos")
    texts = corpus.select("doc_pos", "text", "is_candidate", "doc_block")
    blocked = ranked.withColumn("doc_block", block_of(documents_per_block(corpus)))
    return small(blocked).join(texts, ["doc_pos", "doc_block"]).drop("doc_block")


def documents_with_text(
    index: Index, corpus: DataFrame, questions: DataFrame, n: int = 10, ranker: Ranker = PLUS
) -> DataFrame:
    """``question_id, rank, doc_pos, text`` of the n best documents of each question."""

    def run(batch: DataFrame, small: SmallSide) -> DataFrame:
        top = top_units(index, batch, n, ranker, True, small).select("question_id", "rank", "doc_pos")
        return fetch_text(top, corpus, small).select("question_id", "rank", "doc_pos", "text")

    return sized(questions, run)
