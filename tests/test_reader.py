import random
import uuid

import pytest
from helpers import corpus_of, questions_of, rows, stored_index
from pyspark.sql import functions as F

from daedap.session import SmallSide
from daedap.operators.reader import (
    end_rows,
    length_batches,
    lexical_reader,
    logit_rows,
    model_reader,
    spans,
    start_rows,
)
from daedap.plans.params import P3
from daedap.plans.answering import cut_candidates, ranked_contexts, read_contexts


def read_of(spark, *sequences):
    """Contexts with given tokens and logits, numbered by ``doc_pos``."""
    data = [(0, i, list(t), [float(x) for x in s], [float(x) for x in e]) for i, (t, s, e) in enumerate(sequences)]
    schema = (
        "question_id long, doc_pos long, sequence array<string>,"
        "start_logits array<double>, end_logits array<double>"
    )
    return spark.createDataFrame(data, schema)


def stable_best(values, k):
    return sorted(range(len(values)), key=lambda i: (-values[i], i))[:k]


def masked_ends(ends, start, k):
    """Ranks and positions of usable ends, by zeroing the logits before the start."""
    masked = [e if i >= start else 0.0 for i, e in enumerate(ends)]
    return [(r, i) for r, i in enumerate(stable_best(masked, k), 1) if i >= start]


def test_masked_zeros_take_the_slots(spark):
    read = read_of(spark, ("abcd", [0, 0, 9, 0], [-1, 2, -3, 1]))
    got = rows(end_rows(read, k=2).filter("start = 2"), "end_rank", "end")
    assert got == [(1, 3)]


def test_starts_and_ends_equal_the_masked_form(spark):
    rng = random.Random(1)
    contexts = []
    for _ in range(400):
        n = rng.randrange(1, 30)
        # Halves, so that zeros and ties are common.
        logits = [[rng.randrange(-6, 5) / 2 for _ in range(n)] for _ in range(2)]
        contexts.append((["t"] * n, *logits))
    read = read_of(spark, *contexts)
    starts, ends = {}, {}
    for d, r, s in rows(start_rows(read, k=4), "doc_pos", "start_rank", "start"):
        starts.setdefault(d, []).append((r, s))
    for d, s, r, e in rows(end_rows(read, k=4), "doc_pos", "start", "end_rank", "end"):
        ends.setdefault((d, s), []).append((r, e))
    for d, (_, start_logits, end_logits) in enumerate(contexts):
        best = stable_best(start_logits, 4)
        assert sorted(starts[d]) == list(enumerate(best, 1))
        for s in best:
            assert sorted(ends.get((d, s), [])) == masked_ends(end_logits, s, 4)


@pytest.mark.parametrize("weight, expected", [(1.0, 2.5), (0.5, 2.75), (0.1, 2.95)])
def test_span_score_uses_the_start_logit_at_the_end(spark, weight, expected):
    read = read_of(spark, (["▁aa", "▁bb", "▁cc", "▁dd"], [0.5, 3.0, 1.0, -0.5], [1, 1, 1, 7]))
    found = {(s, e): (x, a) for s, e, x, a in rows(spans(read, weight), "start", "end_excl", "score", "answer")}
    assert found[1, 4] == (pytest.approx(expected), "bb cc dd")
    usual = spans(read, weight, end_source="end").filter("start = 1 and end_excl = 4")
    assert rows(usual, "score") == [(pytest.approx(3 + weight * 7),)]


def test_short_and_separator_spans_are_dropped(spark):
    tokens = ["<s>", "▁q", "</s>", "</s>", "▁d", "▁de"]
    read = read_of(spark, (tokens, [1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 5, 6]))
    answers = {(s, e): a for s, e, a in rows(spans(read), "start", "end_excl", "answer")}
    assert (4, 5) not in answers and (5, 6) in answers
    assert (1, 6) not in answers and answers[3, 6] == "d de"
    every = spans(read, min_len=0)
    assert {(1, 6, ""), (4, 5, "d"), (0, 2, "q")} <= set(rows(every, "start", "end_excl", "answer"))


def test_postprocess_takes_functions_and_pandas_udfs(spark):
    read = read_of(spark, (["▁'ab'", "▁c"], [2, 1], [2, 1]))
    plain = spans(read, postprocess=lambda a: F.replace(a, F.lit("'"), F.lit("")))

    @F.pandas_udf("string")
    def unquote(texts):
        return texts.str.replace("'", "")

    expected = [("ab",), ("ab c",)]
    assert sorted(rows(plain, "answer")) == expected
    assert sorted(rows(spans(read, postprocess=unquote), "answer")) == expected


def lexical_by_hand(sequence, first, weights):
    n = len(sequence)
    inside = [i >= first and t != "</s>" for i, t in enumerate(sequence)]
    w = [weights.get(t.replace("▁", "").lower(), 0) if ok else 0 for t, ok in zip(sequence, inside)]
    starts = [(sum(w[max(0, i - 8) : i]) - 2 * w[i] - 10000) / 10000 for i in range(n)]
    ends = [(sum(w[i + 1 : i + 9]) - 2 * w[i] - 10000) / 10000 for i in range(n)]
    outside = lambda xs: [x if ok else -20.0 for x, ok in zip(xs, inside)]
    return outside(starts), outside(ends)


def lexical_rows(spark):
    sequence = "<s> ▁Aa ▁b </s> </s> ▁x ▁aa , ▁y ▁B ▁aa ▁z ▁z ▁z ▁z ▁z ▁z ▁z ▁z ▁aa </s>".split()
    return spark.createDataFrame(
        [(0, 0, sequence, 5, {"aa": 12345, "b": 700})],
        "question_id long, doc_pos long, sequence array<string>, document_start int,"
        "term_weights map<string,bigint>",
    )


def test_lexical_reader(spark):
    row = lexical_reader(lexical_rows(spark)).first()
    starts, ends = lexical_by_hand(row["sequence"], 5, row["term_weights"])
    assert row["start_logits"] == starts
    assert row["end_logits"] == ends


def test_model_reader_slot(spark):
    def load():
        def model(batch):
            for sequence in batch:
                yield [float(len(t)) for t in sequence], [float(i) for i in range(len(sequence))]

        return model

    read = model_reader(load)(lexical_rows(spark))
    row = read.first()
    assert row["start_logits"] == [float(len(t)) for t in row["sequence"]]
    assert row["end_logits"] == [float(i) for i in range(len(row["sequence"]))]
    assert logit_rows(read).count() == len(row["sequence"])
    assert spans(read).count() > 0


def test_whole_texts_are_read_unless_a_model_sets_a_limit(spark):
    long = " ".join(f"w{i}" for i in range(900)) + " needle tail needle"
    corpus = corpus_of(spark, [long] + ["x"] * 20)
    index, asked = stored_index(corpus), questions_of(spark, ["needle"])
    contexts = ranked_contexts(index, corpus, asked, P3, SmallSide(True, 0, None)).filter("doc_pos = 0")
    whole = read_contexts(contexts, asked, index, SmallSide(True, 0, None))
    assert rows(whole, F.size("sequence")) == [(1 + 1 + 2 + 903 + 1,)]
    cut = read_contexts(contexts, asked, index, SmallSide(True, 0, None), max_tokens=512)
    assert rows(cut, F.size("sequence"), F.size("start_logits")) == [(512, 512)]
    assert "tail" in {a for (a,) in rows(cut_candidates(index, corpus, asked, P3), "answer")}


def test_empty_document_is_read(spark):
    corpus = corpus_of(spark, ["", "aa bb"])
    index, asked = stored_index(corpus), questions_of(spark, ["aa"])
    contexts = ranked_contexts(index, corpus, asked, P3, SmallSide(True, 0, None))
    read = read_contexts(contexts, asked, index, SmallSide(True, 0, None))
    sequences = dict(rows(read, "doc_pos", "sequence"))
    assert sequences[0] == ["<s>", "▁aa", "</s>", "</s>", "</s>"]


def test_batches_for_the_model_are_of_similar_length():
    rng = random.Random(3)
    lengths = [rng.randrange(0, 60) for _ in range(300)] + [500, 7]
    batches = length_batches(lengths, 256)
    assert sorted(i for batch in batches for i in batch) == list(range(302))
    padded = [max(lengths[i] for i in batch) * len(batch) for batch in batches]
    assert all(size <= 256 or len(batch) == 1 for size, batch in zip(padded, batches))
    assert sum(padded) < 1.2 * sum(lengths)
    unsorted = [range(i, min(i + 4, 302)) for i in range(0, 302, 4)]
    assert sum(padded) < 0.75 * sum(max(lengths[i] for i in batch) * len(batch) for batch in unsorted)
    assert length_batches([], 256) == []


def test_the_model_is_loaded_once_per_worker_and_sees_bounded_batches(spark, tmp_path):
    """Many tasks, few loads; each sequence gets its own logits back."""

    def load():
        (tmp_path / uuid.uuid4().hex).touch()

        def model(batch):
            longest = max(map(len, batch))
            assert longest * len(batch) <= 64 or len(batch) == 1
            for sequence in batch:
                yield [float(len(sequence))] * len(sequence), [float(i) for i in range(len(sequence))]

        return model

    data = [(0, i, [f"t{i}"] * (1 + i * 7 % 30), {"x": 1}, 0) for i in range(200)]
    schema = "question_id long, doc_pos long, sequence array<string>, term_weights map<string,long>, document_start int"
    contexts = spark.createDataFrame(data, schema).repartition(40)
    read = model_reader(load, batch_tokens=64)(contexts)
    for r in read.collect():
        n = 1 + r.doc_pos * 7 % 30
        assert r.sequence == [f"t{r.doc_pos}"] * n
        assert r.start_logits == [float(n)] * n and r.end_logits == [float(i) for i in range(n)]
    # Eight cores run forty tasks; a worker that is taken again has its model.
    assert 1 <= len(list(tmp_path.iterdir())) <= 20
