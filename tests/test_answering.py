import time

import pytest
from helpers import corpus_of, questions_of, rows, stored_index
from pyspark.sql import functions as F
from daedap import session
from daedap.operators.reader import model_reader
from daedap.operators.select import last_morph_of_text
from daedap.plans.params import P0, P1, P2, P3, CutParams, RankParams
from daedap.plans.answering import answer_by_cut, answer_by_rank

TEXTS = [
    "서울 은 한국 의 수도 이다",
    "부산 은 한국 의 항구 도시",
    "파리 는 프랑스 의 수도",
    "",
    "강 과 산",
]
ASKED = ["한국 수도 서울", "프랑스 수도", "항구 부산", "없는말"]


def longest_word_reader():
    """A model whose best span is the longest document token."""

    def load():
        def model(batch):
            for sequence in batch:
                first = 2 + next(i for i, t in enumerate(sequence) if t == "</s>")
                logits = [
                    float(len(t)) if i >= first and t != "</s>" else -9.0
                    for i, t in enumerate(sequence)
                ]
                yield logits, logits

        return model

    return model_reader(load)


def everything(answers):
    return {q: (a, s) for q, a, s in rows(answers, "question_id", "answer", "stage")}


@pytest.mark.parametrize("scope, with_model", [(5, False), (2, True)])
def test_reading_again_gives_the_same_answers(spark, scope, with_model):
    corpus = corpus_of(spark, TEXTS, scope)
    index, asked = stored_index(corpus), questions_of(spark, ASKED)
    params = CutParams(cut=0.95, end_weight=1.0, documents=3)
    how = {"reader": longest_word_reader()} if with_model else {}
    once = everything(answer_by_cut(index, corpus, asked, params, last_morph_of_text, **how))
    again = answer_by_cut(index, corpus, asked, params, last_morph_of_text, read_again=True, **how)
    assert everything(again) == once
    assert set(once) == {0, 1, 2, 3}


def test_large_question_sets_do_not_change_answers(spark, monkeypatch):
    corpus = corpus_of(spark, TEXTS)
    index, asked = stored_index(corpus), questions_of(spark, ASKED)
    whole = everything(answer_by_cut(index, corpus, asked, P3, last_morph_of_text))
    monkeypatch.setattr(session, "LIMITS", session.Limits(batch_questions=3))
    assert everything(answer_by_cut(index, corpus, asked, P3, last_morph_of_text)) == whole


@pytest.mark.parametrize("by_rank", [False, True])
def test_a_large_question_set_is_answered_batch_by_batch(spark, monkeypatch, by_rank):
    """The answers of each batch are written, so that its texts are not kept for the end."""
    corpus = corpus_of(spark, TEXTS)
    index, asked = stored_index(corpus), questions_of(spark, ASKED * 2)
    answer, params = (answer_by_rank, P2) if by_rank else (answer_by_cut, P3)
    whole = everything(answer(index, corpus, asked, params, last_morph_of_text))
    monkeypatch.setattr(session, "LIMITS", session.Limits(batch_questions=5))
    answers = answer(index, corpus, asked, params, last_morph_of_text)
    plan = answers._jdf.queryExecution().executedPlan().toString()
    assert plan.count("step-") == 2 and "postings" not in plan and "MapInArrow" not in plan
    assert everything(answers) == whole and len(whole) == 2 * len(ASKED)


def test_written_steps_leave_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = disk.getAllBlocks()
        names = {blocks.apply(i).name() for i in range(blocks.size())}
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    rows_ = session.materialize(spark.range(3000).repartition(5).groupBy(F.col("id") % 7).count())
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # they are removed a little later
        time.sleep(0.1)
    assert not shuffled() - before
    assert rows_.count() == 7 and spark.conf.get(session.CLEANUP, "false") == "false"


def test_answer_comes_from_the_model(spark):
    corpus = corpus_of(spark, ["짧다 아주아주긴낱말 끝", "다른 글"])
    index, asked = stored_index(corpus), questions_of(spark, ["짧다 끝"])
    answers = answer_by_cut(
        index, corpus, asked, P3, last_morph_of_text, reader=longest_word_reader()
    )
    assert everything(answers) == {0: ("아주아주긴낱말", "cut")}


def test_rank_order_takes_the_first_acceptable_document(spark):
    texts = ["열쇠 열쇠 가", "열쇠 좋은답", "열쇠 더좋은답 없음"]
    corpus = corpus_of(spark, texts)
    index, asked = stored_index(corpus), questions_of(spark, ["열쇠"])
    tagger = lambda df: last_morph_of_text(df, "JKG")
    reader = longest_word_reader()

    def run(params):
        return everything(answer_by_rank(index, corpus, asked, params, tagger, reader))[0]

    assert run(P0) == ("열쇠", "single")
    assert run(RankParams(anywhere=("열쇠",))) == ("좋은답", "single")
    # The tagger calls every last character a genitive particle.
    assert run(RankParams(anywhere=("열쇠",), genitive="답")) == ("좋은", "single")
    assert run(P1) == ("열쇠", "single")


def test_reading_first_documents_first_changes_nothing(spark):
    texts = [f"열쇠 {'가' * n}" for n in range(1, 8)] + ["열쇠 좋은답"]
    corpus = corpus_of(spark, texts)
    index, asked = stored_index(corpus), questions_of(spark, ["열쇠", "가가가"])
    params = RankParams(anywhere=("열쇠", "가"))
    results = [
        everything(
            answer_by_rank(
                index, corpus, asked, params, last_morph_of_text, longest_word_reader(), n
            )
        )
        for n in (1, 8, 30)
    ]
    assert results[0] == results[1] == results[2]
    assert results[0][0] == ("좋은답", "single")


def test_documents_outside_the_scope_are_blank_but_take_ranks(spark):
    texts = ["낱말 안쪽이다", "낱말 바깥쪽"]
    corpus = corpus_of(spark, texts, scope=1)
    index, asked = stored_index(corpus), questions_of(spark, ["낱말"])
    reader = longest_word_reader()
    two = answer_by_rank(index, corpus, asked, P0, last_morph_of_text, reader)
    assert everything(two) == {0: ("안쪽이다", "single")}
    # The document out of scope is the higher position of two equals, so it is first.
    one = answer_by_rank(index, corpus, asked, RankParams(documents=1), last_morph_of_text, reader)
    assert everything(one) == {0: (None, "none")}


def test_windows_come_before_single_documents(spark):
    corpus = corpus_of(spark, ["열쇠 하나둘", "열쇠 셋넷다섯여섯"])
    index, asked = stored_index(corpus), questions_of(spark, ["열쇠"])
    answers = answer_by_rank(
        index, corpus, asked, P2, last_morph_of_text, longest_word_reader()
    )
    assert everything(answers)[0][1] == "window"


def test_plan_has_no_cross_join_and_ranks_before_the_shuffle(spark):
    corpus = corpus_of(spark, TEXTS)
    index, asked = stored_index(corpus), questions_of(spark, ASKED)
    plan = answer_by_cut(index, corpus, asked, P3, last_morph_of_text)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "WindowGroupLimit" in text
