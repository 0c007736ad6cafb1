import math
import random
import re
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from helpers import corpus_of, dense_scores, index_of, questions_of, rows, stored_index

from pyspark.sql import functions as F

from daedap import session
from daedap.operators import chunks, retrieve
from daedap.operators import index as index_module
from daedap.operators.index import (
    _token_postings,
    build_index,
    corpus_tokens,
    open_index,
    postings_of,
    store_index,
)
from daedap.operators.retrieve import (
    L,
    OKAPI,
    PLUS,
    base_scores,
    documents_with_text,
    score_documents,
    top_documents,
)
from daedap.session import materialize, shared_dir
from daedap.sources.splits import as_questions

THREE = ["a b", "a a c", "d"]


def test_statistics_cover_all_documents(spark):
    index = index_of(spark, ["a b", "a a c", "", "!!"], scope=1)
    assert rows(index.stats, "n", "total_tokens", "avgdl") == [(4, 5, 1.25)]
    assert sorted(rows(index.terms, "term", "df")) == [("a", 2), ("b", 1), ("c", 1)]
    assert sorted(rows(index.postings, "doc_pos", "term", "tf", "dl")) == [
        (0, "a", 1, 2),
        (0, "b", 1, 2),
        (1, "a", 2, 3),
        (1, "c", 1, 3),
    ]


def test_scores_of_three_documents(spark):
    top = top_documents(index_of(spark, THREE), questions_of(spark, ["a", "a a"]))
    got = {(q, d): (r, s) for q, r, d, s in rows(top, "question_id", "rank", "doc_pos", "score")}
    assert got[0, 1] == (1, 1.546251)
    assert got[0, 0] == (2, 1.386294)
    assert got[0, 2] == (3, 0.693147)
    for d in range(3):
        assert got[1, d][1] == pytest.approx(2 * got[0, d][1], abs=2e-6)


def test_cut_is_strict_and_relative(spark):
    index, asked = index_of(spark, THREE), questions_of(spark, ["a"])
    assert rows(top_documents(index, asked, cut=0.95), "doc_pos") == [(1,)]
    assert rows(top_documents(index, asked, cut=0.90), "doc_pos") == [(1,)]
    assert sorted(rows(top_documents(index, asked, cut=0.89), "doc_pos")) == [(0,), (1,)]


def test_unknown_terms_rank_by_position_and_pass_no_cut(spark):
    index, asked = index_of(spark, THREE), questions_of(spark, ["zzz", ""])
    top = sorted(rows(top_documents(index, asked), "question_id", "rank", "doc_pos", "score"))
    assert [t for t in top if t[0] == 0] == [(0, 1, 2, 0.0), (0, 2, 1, 0.0), (0, 3, 0, 0.0)]
    assert [t[2] for t in top if t[0] == 1] == [2, 1, 0]
    assert rows(top_documents(index, asked, cut=0.95), "doc_pos") == []


def test_scope_limits_results_not_statistics(spark):
    texts = ["a", "b", "a a", "a b"]
    all_of = dense_scores([t.split() for t in texts], ["a"])
    top = top_documents(index_of(spark, texts, scope=2), questions_of(spark, ["a"]))
    got = sorted(rows(top, "rank", "doc_pos", "score"))
    assert [d for _, d, _ in got] == [0, 1]
    for _, d, s in got:
        assert s == pytest.approx(all_of[d], abs=1e-6)


def test_raw_questions_miss_capitals(spark):
    index = index_of(spark, ["Seoul city"])
    raw = questions_of(spark, ["Seoul?"])
    clean = as_questions(raw.select("question_id", "question"), "question_id", normalized=True)
    assert rows(base_scores(index, raw), "score") == [(0.0,)]
    assert rows(base_scores(index, clean), "score")[0][0] > 0


@pytest.mark.parametrize("seed", range(3))
def test_sparse_form_equals_dense_scores(spark, seed):
    """Ranks with copies and few matches, against the definition."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 9))) for _ in range(25)]
    texts += rng.choices(texts, k=8)
    docs = [t.split() for t in texts]
    scope = 28
    asked = [" ".join(rng.choices(words + ["new"], k=rng.randrange(0, 6))) for _ in range(12)]
    top = top_documents(index_of(spark, texts, scope), questions_of(spark, asked), n=10)
    got = {(q, r): (d, s) for q, r, d, s in rows(top, "question_id", "rank", "doc_pos", "score")}
    for q, text in enumerate(asked):
        scores = [round(s, 6) for s in dense_scores(docs, text.split())]
        order = sorted(range(scope), key=lambda d: (-scores[d], -d))[:10]
        assert [got[q, r + 1][0] for r in range(10)] == order
        for r, d in enumerate(order):
            assert got[q, r + 1][1] == pytest.approx(scores[d], abs=2e-6)


def test_all_scores_are_base_or_listed(spark):
    texts = ["a b", "a a c", "d", "", "c c"]
    index, asked = index_of(spark, texts, scope=4), questions_of(spark, ["a c", "d"])
    listed = {(q, d): s for q, d, s in rows(score_documents(index, asked), "question_id", "doc_pos", "score")}
    base = dict(rows(base_scores(index, asked), "question_id", "score"))
    for q, text in enumerate(["a c", "d"]):
        expected = dense_scores([t.split() for t in texts], text.split())
        for d in range(4):
            assert listed.get((q, d), base[q]) == pytest.approx(expected[d], abs=1e-6)
    assert all(d < 4 for _, d in listed)


def test_other_rankers(spark):
    texts = ["a b", "a a c", "d", "a e", "f"]
    index, asked = index_of(spark, texts), questions_of(spark, ["a c"])
    okapi = rows(top_documents(index, asked, ranker=OKAPI, n=2), "rank", "doc_pos")
    assert sorted(okapi) == [(1, 1), (2, 3)]
    scores = dict(rows(top_documents(index, asked, ranker=L), "doc_pos", "score"))
    assert scores[2] == scores[4] > 0
    assert scores[1] > scores[0] > scores[2]


def okapi_scores(docs, question):
    """Every document's Okapi score, by the definition; a negative idf is replaced."""
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = {}
    for doc in docs:
        for term in set(doc):
            df[term] = df.get(term, 0) + 1
    raw = {t: math.log(n - d + 0.5) - math.log(d + 0.5) for t, d in df.items()}
    least = 0.25 * sum(raw.values()) / len(raw)
    scores = []
    for doc in docs:
        norm = 1.5 * (0.25 + 0.75 * len(doc) / avgdl)
        score = 0.0
        for term in question:
            if term in raw:
                idf = least if raw[term] < 0 else raw[term]
                score += idf * doc.count(term) * 2.5 / (norm + doc.count(term))
        scores.append(score)
    return scores, least


@pytest.mark.parametrize("seed, block", [(1, 3), (2, 1)])
def test_okapi_with_a_negative_average_idf(spark, seed, block, monkeypatch):
    """Documents without a match rank between those that gain and those that lose by one."""
    monkeypatch.setattr(retrieve, "GAP_BLOCK", block)
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(6)]
    texts = [" ".join(rng.sample(common, 5) + rng.choices(["r1", "r2"], k=rng.randrange(2))) for _ in range(30)]
    for i in rng.sample(range(30), 6):
        texts[i] = "c0" if rng.random() < 0.5 else ""
    docs = [t.split() for t in texts]
    asked = ["c0", "c1 r1", "c1 c2 c3", "r2", "none", "c5 c5 r1 r2 c4"]
    index = stored_index(corpus_of(spark, texts, scope=27))
    signs = set()
    for n in (3, 10):
        top = top_documents(index, questions_of(spark, asked), n=n, ranker=OKAPI)
        got = {(q, r): (d, s) for q, r, d, s in rows(top, "question_id", "rank", "doc_pos", "score")}
        for q, text in enumerate(asked):
            scores, least = okapi_scores(docs, text.split())
            assert least < 0
            scores = [round(s, 6) + 0.0 for s in scores]
            order = sorted(range(27), key=lambda d: (-scores[d], -d))[:n]
            assert [got[q, r + 1][0] for r in range(n)] == order
            for r, d in enumerate(order):
                assert got[q, r + 1][1] == pytest.approx(scores[d], abs=2e-6)
                signs.add((scores[d] > 0) - (scores[d] < 0))
    assert signs == {-1, 0, 1}


def test_large_question_sets_give_the_same_in_one_scan(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(9)]
    texts = [" ".join(rng.choices(words, k=6)) for _ in range(15)]
    asked = questions_of(spark, [" ".join(rng.choices(words, k=4)) for _ in range(9)])
    index = stored_index(corpus_of(spark, texts))
    columns = ("question_id", "rank", "doc_pos", "score")
    whole = sorted(rows(top_documents(index, asked), *columns))
    for limits in ({"batch_questions": 4}, {"batch_tokens": 3}, {"batch_tokens": 3, "named_tokens": 0}):
        monkeypatch.setattr(session, "LIMITS", session.Limits(**limits))
        large = top_documents(index, asked)
        assert sorted(rows(large, *columns)) == whole
        # No broadcast of questions, and still one scan of the postings.
        assert scans(large, "postings") == 1


def scans(df, folder):
    """How often the plan of ``df`` reads the Parquet files of a folder."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet [^\n]*/{folder}[\],]|FileScan parquet spark_catalog.default.{folder}", plan))


@pytest.mark.parametrize("seed, broadcast, ranker", [(0, True, PLUS), (1, False, L), (2, True, OKAPI)])
def test_score_bounds_change_nothing(spark, seed, broadcast, ranker, monkeypatch):
    """Ties at the last place, copies, unknown words and few matches, in a skewed corpus."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(0, 12))) for _ in range(120)]
    texts += rng.choices(texts, k=40)
    asked = [" ".join(rng.choices(words + ["new"], k=rng.randrange(0, 7))) for _ in range(14)]
    index, questions = stored_index(corpus_of(spark, texts, scope=130)), questions_of(spark, asked)
    columns = ("question_id", "rank", "doc_pos", "score")
    direct = sorted(rows(top_documents(index, questions, ranker=ranker), *columns))
    few = {"direct_pairs": 0} | ({} if broadcast else {"batch_tokens": 1})
    monkeypatch.setattr(session, "LIMITS", session.Limits(**few))
    assert sorted(rows(top_documents(index, questions, ranker=ranker), *columns)) == direct


def test_score_bounds_spare_most_pairs(spark):
    """A question of rare words and words that stand everywhere: few documents are added up."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(["the", "of", "and"] + rng.choices(words, k=12)) for _ in range(3000)]
    index = stored_index(corpus_of(spark, texts))
    questions = questions_of(spark, [f"the w{i} of w{i + 1} and w{i + 2} the" for i in range(5)])
    small = session.SmallSide(True, 0, None)
    known = retrieve.question_weights(questions, index, PLUS, small)
    every = retrieve.match_units(index, known, PLUS, small)
    kept = retrieve.bounded_matches(index, known, 10, PLUS, small)
    exact = {(q, d): m for q, d, m in rows(every, "question_id", "doc_pos", "match")}
    found = {(q, d): m for q, d, m in rows(kept, "question_id", "doc_pos", "match")}
    assert len(exact) == 5 * 3000 and 50 <= len(found) < len(exact) / 10
    assert all(exact[pair] == m for pair, m in found.items())


def rows_read(df):
    """Rows that come out of the scan of a plan that was run."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
    return sum(found)


def test_postings_are_read_by_term(spark):
    """A scan for a rare term reads some pages, not the table."""
    texts = [" ".join(f"w{(i * 31 + k * 7) % 997:03d}" for k in range(60)) for i in range(2000)]
    index = stored_index(corpus_of(spark, texts))
    total = index.postings.count()
    assert rows_read(postings_of(index.postings, ["w500"])) < total / 10
    assert rows_read(postings_of(index.postings, ["w100", "w500", "zzz"])) < total / 5
    wanted = [f"w{i:03d}" for i in range(0, 997, 11)]
    kept = {t for (t,) in rows(postings_of(index.postings, wanted).select("term").distinct(), "term")}
    assert kept >= set(wanted)
    assert postings_of(index.postings, []).count() == 0


def test_a_frequent_term_is_split_without_a_broadcast(spark, monkeypatch):
    """A term in every document, met in a shuffle: no task gets much above its share."""
    texts = [f"the w{i}" for i in range(4000)]
    index = stored_index(corpus_of(spark, texts))
    index = replace(index, partitions=40)
    questions = questions_of(spark, [f"the w{i}" for i in range(6)])
    small = session.SmallSide(False, 12, None)
    known = retrieve.question_weights(questions, index, PLUS, small).select("question_id", "term", "df", "qtf")
    met = retrieve._met(index.postings, known, index, small)
    joined = met.repartition(8, "term", (F.xxhash64("doc_pos") % 40)).count()
    assert joined == 6 * 4000 + 6
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = rows(
            retrieve._met(index.postings, known, index, small)
            .select("doc_pos", "term", "question_id", F.spark_partition_id().alias("task"))
            .filter("term = 'the'").groupBy("task").count(),
            "count",
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    counts = [c for (c,) in per_task]
    assert sum(counts) == 6 * 4000 and len(counts) == 8
    assert max(counts) <= 2 * sum(counts) / len(counts)


def test_stored_index_gives_the_same_and_needs_no_shuffle_of_pairs(spark):
    texts = ["a b", "a a c", "d", ""]
    built = index_of(spark, texts)
    stored = store_index(built, f"{shared_dir(spark)}/stored")
    for name in ("docs", "postings", "terms", "stats"):
        old, new = getattr(built, name), getattr(stored, name)
        assert sorted(rows(old, *old.columns)) == sorted(rows(new, *old.columns))
    asked = questions_of(spark, ["a c"])
    columns = ("question_id", "rank", "doc_pos", "score")
    assert sorted(rows(top_documents(stored, asked), *columns)) == sorted(
        rows(top_documents(built, asked), *columns)
    )
    pairs = stored.postings.groupBy("doc_pos", "term").count()
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_tokenizer_slot(spark):
    import pandas as pd

    @F.pandas_udf("array<string>")
    def halves(text: pd.Series) -> pd.Series:
        return text.map(lambda t: [h for w in t.split() for h in (w[:2], w[2:]) if h])

    corpus = corpus_of(spark, ["abcd ab"])
    assert rows(corpus_tokens(corpus, halves), "tokens") == [(["ab", "cd", "ab"],)]
    index = build_index(corpus, halves, partitions=2)
    assert sorted(rows(index.postings, "term", "tf")) == [("ab", 2), ("cd", 1)]
    top = top_documents(index, questions_of(spark, ["cdab"], halves))
    assert rows(top, "doc_pos", "rank") == [(0, 1)]


def test_fetch_text_without_title(spark):
    corpus = corpus_of(spark, THREE)
    got = documents_with_text(build_index(corpus, partitions=2), corpus, questions_of(spark, ["c"]), n=1)
    assert rows(got, "rank", "doc_pos", "text") == [(1, 1, "a a c")]


def test_stored_corpus_is_pruned_by_block(spark, monkeypatch):
    from daedap.sources import corpus as source

    monkeypatch.setattr(session, "LIMITS", session.Limits(least_block=2))
    corpus = corpus_of(spark, ["a b", "c", "d", "e", "f a", "g"], scope=5)
    stored = source.store_corpus(corpus, f"{shared_dir(spark)}/blocks")
    columns = ("doc_pos", "doc_id", "title", "text", "is_candidate")
    assert sorted(rows(stored, *columns)) == sorted(rows(corpus, *columns))
    index, asked = build_index(corpus, partitions=2), questions_of(spark, ["a", "d"])
    fetched = documents_with_text(index, stored, asked, n=2)
    columns = ("question_id", "rank", "doc_pos", "text")
    assert sorted(rows(fetched, *columns)) == sorted(
        rows(documents_with_text(index, corpus, asked, n=2), *columns)
    )
    assert "dynamicpruning" in fetched._jdf.queryExecution().executedPlan().toString()


def test_a_third_of_the_corpus_being_one_document(spark):
    """A hot term and a hot group of copies: ties at the boundary go to the last copies."""
    copies = ["a a hot"] * 100
    others = [f"a x{i} y{i}" for i in range(200)]
    texts = others[:120] + copies + others[120:]
    top = top_documents(index_of(spark, texts), questions_of(spark, ["a hot", "hot"] + ["hot"] * 20))
    got = {}
    for q, r, d in rows(top, "question_id", "rank", "doc_pos"):
        got.setdefault(q, {})[r] = d
    assert len(got) == 22
    for ranked in got.values():
        assert [ranked[r] for r in range(1, 11)] == list(range(219, 209, -1))


def test_repeated_question_ids(spark):
    """The last one in order counts; without an order they are refused."""
    rows_ = [("q", "b", 1), ("q", "d", 2), ("r", "a", 1)]
    asked = spark.createDataFrame(rows_, "id string, question string, turn int")
    index = index_of(spark, ["a b", "b c", "c d"])
    last = as_questions(asked, order="turn")
    assert sorted(rows(last, "question_id", "question")) == [("q", "d"), ("r", "a")]
    best = rows(top_documents(index, last, n=1), "question_id", "doc_pos")
    assert sorted(best) == [("q", 2), ("r", 0)]
    with pytest.raises(ValueError):
        top_documents(index, as_questions(asked))


def test_index_opened_from_its_folder(spark):
    corpus = corpus_of(spark, [f"w{i % 7} w{i % 5} x{i}" for i in range(40)], scope=30)
    folder = f"{shared_dir(spark)}/index-opened"
    stored = store_index(build_index(corpus, partitions=3), folder)
    opened = open_index(spark, folder)
    asked = questions_of(spark, ["w1 x9", "none"])
    columns = ("question_id", "rank", "doc_pos", "score")
    top = top_documents(opened, asked)
    assert sorted(rows(top, *columns)) == sorted(rows(top_documents(stored, asked), *columns))
    assert (opened.partitions, opened.n_documents) == (3, 40)
    by_document = opened.postings.groupBy("doc_pos").count()
    assert "Exchange" not in by_document._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast", [True, False])
def test_chunks_send_on_the_best_only(spark, broadcast):
    """Many documents share terms with many questions: no row for each pair, the same best ones.

    Scores tie, a position stands twice and one is null.
    """
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(["the"] + rng.choices(words, k=rng.randrange(0, 9))) for _ in range(900)]
    texts += rng.choices(texts, k=100)
    places = [*range(998), 7, None]
    made = spark.createDataFrame(list(zip(places, texts)), "doc_pos long, text string")
    index = stored_index(made.selectExpr("doc_pos", "'' title", "text", "true is_candidate"))
    asked = [" ".join(["the"] + rng.choices([*words, "new"], k=6)) for _ in range(60)]
    questions = questions_of(spark, asked)
    small = session.SmallSide(broadcast, 0, None)
    known = retrieve.question_weights(questions, index, PLUS, small)
    every = rows(retrieve.match_units(index, known, PLUS, small), "question_id", "doc_pos", "match")
    found = rows(retrieve.chunk_matches(index, known, 5, PLUS, small), "question_id", "doc_pos", "match")
    assert len(every) > 50_000 and len(found) < len(every) / 4
    assert set(found) <= set(every)

    def best(matches):
        order = sorted(matches, key=lambda r: (r[0], -r[2], r[1] is None, -(r[1] or 0)))
        return [r for q in range(60) for r in [o for o in order if o[0] == q][:5]]

    assert best(found) == best(every)


def test_batches_copy_neither_postings_nor_question_terms(spark, monkeypatch):
    """A question set in no broadcast goes through the bucketed postings, which stay where they are."""
    texts = [f"w{i % 7} w{i % 5} x{i}" for i in range(60)]
    index, questions = stored_index(corpus_of(spark, texts)), questions_of(spark, ["w1 x9", "w2 w3"] * 6)
    small = session.SmallSide(False, 0, None)
    known = retrieve.question_weights(questions, index, PLUS, small)
    whole = sorted(rows(retrieve.chunk_matches(index, known, 3, PLUS, small), "question_id", "doc_pos", "match"))
    monkeypatch.setattr(session, "LIMITS", session.Limits(batch_tokens=6))
    found = retrieve.chunk_matches(index, materialize(known), 3, PLUS, small)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Generate" not in plan and "CoGroup" not in plan
    assert plan.count("MapInArrow") == 1 and plan.count("step-") > 3

    def best(matches):
        order = sorted(matches, key=lambda r: (r[0], -r[2], -r[1]))
        return [r for q in range(12) for r in [o for o in order if o[0] == q][:3]]

    assert best(rows(found, "question_id", "doc_pos", "match")) == best(whole)


def test_documents_stay_whole_where_files_are_read_in_pieces(spark, monkeypatch):
    """A bucket's file is sorted by term, so that each of its pieces has a part of every document."""
    monkeypatch.setattr(index_module, "LAYOUT", {"parquet.page.row.count.limit": "100", "parquet.block.size": "1024"})
    texts = [" ".join(f"w{(i * k) % 60}" for k in range(1, 40)) for i in range(300)]
    index = stored_index(corpus_of(spark, texts))
    questions = questions_of(spark, ["w1 w20 w41 w59", "w3 w58 w30"])
    small = session.SmallSide(True, 0, None)
    known = materialize(retrieve.question_weights(questions, index, PLUS, small))
    every = rows(retrieve.match_units(index, known, PLUS, small), "question_id", "doc_pos", "match")
    settings = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert index.postings.rdd.getNumPartitions() > 4
        found = rows(retrieve.chunk_matches(index, known, 5, PLUS, small), "question_id", "doc_pos", "match")
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert found and set(found) <= set(every)


@pytest.mark.parametrize("seed", range(4))
def test_chunks_of_documents_give_the_best_of_all(seed, monkeypatch):
    """Chunks and batches end anywhere; frequent and rare terms, ties, twice the same posting."""
    monkeypatch.setattr(chunks, "CHUNK", 20)
    monkeypatch.setattr(chunks, "RUN", 4)
    monkeypatch.setattr(chunks, "CELLS", 60)
    rng = np.random.default_rng(seed)
    place = np.sort(rng.integers(0, 150, 900))
    columns = place, rng.integers(0, 25, 900) ** 2 // 24, rng.integers(1, 4, 900) / 4
    weights = [[(int(t), float(w)) for t, w in zip(rng.integers(0, 27, 6), rng.integers(1, 3, 6))] for _ in range(9)]
    kind = pa.list_(pa.struct([("number", pa.int64()), ("weight", pa.float64())]))
    asked = chunks.Asked(pa.table({"question_id": [*range(8), None], "asked": pa.array(weights, kind)}))
    best = chunks.Best(asked, 5, 1000)
    batches = pa.table(dict(zip("abc", columns))).to_batches(max_chunksize=7)
    parts = list(chunks._chunks(iter(batches)))
    assert [len(np.unique(p[0])) for p in parts][:-1] == [20] * (len(parts) - 1)
    assert all((np.concatenate(c) == columns[i]).all() for i, c in enumerate(zip(*parts)))
    for part in parts:
        best.add(*part)
    expected = []
    for q, pairs in enumerate(weights):
        total = {}
        for p, t, g in zip(*(c.tolist() for c in columns)):
            for term, weight in pairs:
                if term == t:
                    total[p] = total.get(p, 0) + math.floor(weight * g * 1000 + 0.5)
        top = sorted(((m, p) for p, m in total.items()), reverse=True)[:5]
        expected += [(q if q < 8 else None, p, m) for m, p in top]
    found = zip(*(c.to_pylist() for c in best.rows().columns))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_words_are_counted_as_tokens_are(spark):
    """Words counted in Python are those of the cleaning, also where positions repeat or are null."""
    texts = ["İstanbul ΑΣ a A b\\nB", "가나 ㄱa ÉA é", "", "!!", None, "a b", "a b", "b c", "x y z " * 400]
    places = [0, 1, 2, 3, 4, 5, 5, 5, None]
    made = spark.createDataFrame(list(zip(places, texts)) + [(None, "x a")], "doc_pos long, text string")
    corpus = made.selectExpr("doc_pos", "'Ti\ntle' title", "text", "doc_pos < 4 is_candidate")
    names = ("doc_pos", "is_candidate", "dl", "term", "tf")
    built = build_index(corpus, partitions=2)
    expected = sorted(rows(_token_postings(corpus_tokens(corpus)), *names), key=str)
    assert sorted(rows(built.postings, *names), key=str) == expected
    plan = built.postings._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "HashAggregate" not in plan
