"""Measures, weak supervision, the classifier and the pipeline against plain forms."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from fixtures import TEXTS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daedap.llm import cotraining, measures, supervision
from daedap.llm.minhash import near_duplicates
from daedap.llm.queries import QUERIES, table
from daedap.llm.supervision import BAD, GOOD, RULES, Estimate, expectation_maximisation

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    """The first five measures, word by word."""
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {r for r, n in Counter(runs).items() if n > 1}
    inside = {i + k for i, r in enumerate(runs) if r in often for k in range(8)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        repeated += bool(WORD.search(line)) and line in seen
        seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(inside)


@settings(max_examples=300, deadline=None)
@given(st.text("a b\n\t\x0b\x0c\r#|é 　日", max_size=200))
def test_measures(text):
    assert measures.measure(text.encode())[:5] == plain(text)


def repeating(seed):
    r = random.Random(seed)
    base = [f"w{r.randint(0, 40)}" for _ in range(60)]
    parts = [base[(a := r.randint(0, 50)) : a + r.randint(1, 20)] for _ in range(12)]
    return "\n".join(" ".join(p) for p in parts)


@pytest.mark.parametrize("seed", range(20))
def test_repeated_words(seed):
    text = repeating(seed)
    assert measures.measure(text.encode())[:5] == plain(text)


def judged_by_hand(rows):
    """base_failed and kept by the documented formulas, from the fitted estimate."""
    return [(d, *(m := plain(t)), m[0] < 20 or 100 * m[4] > 30 * m[0]) for d, t in rows]


def test_rules_over_awkward_rows(spark):
    docs = documents(spark)
    found = supervision.judged(docs).collect()
    names = ("doc_id", *measures.NAMES[:5], "base_failed")
    ours = sorted((tuple(r[n] for n in names) for r in found), key=str)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert ours == sorted(judged_by_hand(rows), key=str)
    assert not any(r.kept for r in found if r.base_failed)
    assert supervision.judged(empty(spark)).count() == 0
    left = supervision.without_bad(docs)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id for r in found if r.kept), key=str)
    assert sorted((r.doc_id for r in left.collect()), key=str) == kept
    assert supervision.without_bad(empty(spark)).count() == 0


def test_posterior_is_that_of_the_estimate(spark):
    """Posterior columns against Bayes' rule in numpy, document by document."""
    found = QUERIES["op5_quality_rules"](spark, SF).collect()
    docs = table(spark, SF, "documents")
    m = docs.select("doc_id", measures.measured("text").alias("m"))
    votes = m.select("doc_id", F.array(*supervision._votes(RULES, "m")).alias("v")).collect()
    votes = {r.doc_id: r.v for r in votes}
    patterns = Counter(tuple(v) for v in votes.values())
    keys = np.array(sorted(patterns))
    fitted = expectation_maximisation(
        keys, np.array([patterns[tuple(k)] for k in keys], float), [r.kind for r in RULES]
    )
    for row in found:
        each = [
            fitted.prior[c] * np.prod([fitted.votes[r, c, v] for r, v in enumerate(votes[row.doc_id])])
            for c in range(len(fitted.prior))
        ]
        assert row.quality == pytest.approx(each[0] / sum(each), abs=1e-6)
        assert row.kept == (not row.base_failed and row.quality >= 0.5)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    names = ("doc_id", *measures.NAMES[:5], "base_failed")
    assert sorted(tuple(r[n] for n in names) for r in found) == sorted(judged_by_hand(rows))


def test_estimation_recovers_accuracies():
    """Votes drawn from known accuracies, two kinds of bad documents."""
    r = np.random.default_rng(8)
    kinds, n = ["x", "x", "x", "y", "y", "y"], 20_000
    truth = r.choice(3, n, p=[0.7, 0.2, 0.1])  # good, bad as x, bad as y
    rates = np.array([[0.02, 0.85, 0.1], [0.05, 0.7, 0.1], [0.02, 0.8, 0.05]])
    bad = np.concatenate([rates, rates[:, [0, 2, 1]]])
    cast = np.where(r.random((n, 6)) < bad[:, truth].T, BAD, GOOD)
    keys, counts = np.unique(cast, axis=0, return_counts=True)
    found = expectation_maximisation(keys, counts.astype(float), kinds)
    assert abs(found.prior - [0.7, 0.2, 0.1]).max() < 0.05
    assert abs(found.votes[:, :, BAD] - bad).max() < 0.12
    one_hot = np.eye(3)[np.array(list(product([BAD, GOOD], repeat=6)))]
    best = Estimate(np.array([0.7, 0.2, 0.1]), np.stack([bad, 1e-9 + 0 * bad, 1 - bad], 2))

    def right(estimate):
        good = dict(zip(map(tuple, one_hot.argmax(2)), estimate.good(one_hot)))
        return np.mean([(good[tuple(v)] >= 0.5) == (t == 0) for v, t in zip(cast.tolist(), truth)])

    # As often right as one who knows all the probabilities.
    assert right(found) > right(best) - 0.003
    assert min(found.accuracies()) > 0.7


def test_rules_find_bad_documents(spark):
    sf = SF.replace("0.001", "0.01")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = QUERIES["op5_quality_rules"](spark, sf).filter("n_words >= 20").join(labels, "doc_id")
    rows = [(r.label, r.kept) for r in rows.collect()]
    good, bad = [k for y, k in rows if y == 1], [k for y, k in rows if y == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


def test_classifier_on_labels_it_has_not_seen(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0
    found = cotraining.classified(docs, labels.filter(~unseen))
    rows = found.join(labels.filter(unseen).withColumnRenamed("quality", "label"), "doc_id").collect()
    assert len(rows) > 80
    assert np.mean([r.kept == (r.label == 1) for r in rows]) > 0.95


def test_classifier_over_awkward_rows(spark):
    more = "lang string, source string, kept string"
    docs = documents(spark, more=more).withColumn("n_chars", F.length("text").cast("long"))
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    one_kind = spark.createDataFrame([(0, 1, 0), (None, 0, 0), (1, None, 1)], schema)
    for labels in (none, one_kind):
        found = cotraining.classified(docs, labels).collect()
        assert len(found) == docs.count() and all(r.kept and r.quality == 1 for r in found)
        assert cotraining.without_rejected(docs, labels).count() == docs.count()
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(1, 0, 0), (1, 1, 0)], schema)
    found = cotraining.classified(docs, mixed).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted(
        (r.doc_id for r in docs.collect()), key=str
    )
    assert all(0 <= r.quality <= 1 for r in found)
    left = cotraining.without_rejected(docs, mixed)
    assert left.columns == docs.columns
    assert left.count() == sum(r.kept for r in found)
    assert cotraining.classified(docs.limit(0), mixed).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Columns named as those that the stages work with stay, and change no verdict."""
    docs = table(spark, SF, "documents").limit(300).cache()
    labels = table(spark, SF, "labels")
    names = ("_m", "_odds", "_salt", "_source", "_lang", "_length", "_row", "_group", "_kept", "m", "row", "quality")
    more = docs.withColumns({n: F.concat(F.lit(f"{n} "), "doc_id") for n in names})
    for stage in (supervision.without_bad, lambda d: cotraining.without_rejected(d, labels)):
        left = stage(more)
        assert left.schema == more.schema
        rows = left.collect()
        assert all(r[n] == f"{n} {r.doc_id}" for r in rows for n in names)
        assert 0 < len(rows) and sorted(r.doc_id for r in rows) == sorted(
            r.doc_id for r in stage(docs).select("doc_id").collect()
        )


def test_fit_counts_every_row(spark):
    """Naive Bayes tables against counting by hand."""
    r = random.Random(1)
    rows = [
        ([r.randrange(65) for _ in range(10)], [r.randrange(65) for _ in range(4)], r.choice([0, 1, None]), r.choice([0, 1]))
        for _ in range(300)
    ]
    frame = spark.createDataFrame(rows, "text array<int>, page array<int>, text_label int, page_label int")
    model = cotraining.Model()
    cotraining._fit(frame, model)
    for view, at, label in (("text", 0, 2), ("page", 1, 3)):
        table_ = np.ones((len(rows[0][at]), 65, 2))
        for row in rows:
            if row[label] is not None:
                for f, b in enumerate(row[at]):
                    table_[f, b, row[label]] += 1
        seen = table_.sum(1, keepdims=True)
        logs = np.log(table_ / seen)
        assert np.allclose(model.steps[view], logs[:, :, 1] - logs[:, :, 0])


def test_words_of_a_text():
    def slot(word):
        return int(measures.word_hashes([word.encode()])[0] % cotraining.SLOTS)

    found = cotraining.slots_of("It's it, IT! x-1 été\n日本。".encode()).tolist()
    assert found == sorted(map(slot, ["it", "s", "x", "1", "été", "日本。"]))
    assert len(cotraining.slots_of(None)) == len(cotraining.slots_of(b" .,\n")) == 0


def test_words_tell_fluent_texts_apart(spark):
    """Texts alike in all measures, from pages alike; only their words differ."""
    r = random.Random(5)
    common, good, bad = ([f"{k}{i:02}" for i in range(40)] for k in ("able", "geld", "bank"))
    rows = []
    for i in range(900):
        words = [r.choice(common if r.random() < 0.8 else (bad, good)[i % 2]) for _ in range(80)]
        rows.append((i, " ".join(words) + ".", "en", "one.example", 480, i % 2))
    made = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, quality int"
    )
    labels = made.filter("doc_id % 9 < 5").select("doc_id", "quality", F.lit(0).alias("toxic"))
    found = cotraining.classified(made.drop("quality"), labels).collect()
    assert np.mean([x.kept == (x.doc_id % 2 == 1) for x in found if x.doc_id % 9 >= 5]) > 0.97
    left = cotraining.without_rejected(made, labels)
    assert {x.doc_id for x in left.collect()} == {x.doc_id for x in found if x.kept}


def binned(value, low, high):
    place = np.floor((value - low) * cotraining.BINS / (high - low))
    return int(min(max(place, 0), cotraining.BINS - 1))


def logistic_by_rows(x, y, usual, shrink):
    """Shrunk maximum likelihood by plain Newton steps over rows, level first."""
    x, usual = np.column_stack([np.ones(len(y)), x]), np.array(usual)
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (y - p) - shrink * (w - usual)
        curve = (x * (p * (1 - p))[:, None]).T @ x + shrink * np.eye(len(w))
        w += np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return w


def cotrained(docs, rounds=3, sure=0.95):
    """Co-training document by document: scores of both views and of the two together.

    ``docs`` are (features of the text, words, half, bin of the page, keys of the page,
    label or None, held out).
    """
    n, odds = len(docs), {}

    def fit(text_label, page_label):
        told = [(d, y) for d, y in zip(docs, text_label) if y is not None]
        of_word = [{}, {}]
        for half in (0, 1):
            other = [(d[1], y) for d, y in told if d[2] != half]
            n_good = sum(y for _, y in other)
            part = (n_good + 1) / (len(other) + 2)
            good, all_ = Counter(), Counter()
            for words, y in other:
                all_.update(words)
                good.update(words if y else ())
            for w, k in all_.items():
                g, b = good[w] + 2 * part, k - good[w] + 2 * (1 - part)
                of_word[half][w] = np.log(g / b) - np.log(part / (1 - part))
        seen = []
        for features, words, half, page, keys, *_ in docs:
            each = [of_word[half].get(w, 0.0) for w in words]
            seen.append(([*features, binned(np.mean(each), -4, 4) if each else 64], [page]))
        raw = {}
        for view, name, labels in ((0, "text", text_label), (1, "page", page_label)):
            bins = [s[view] for s in seen]
            total = [Counter(), Counter()]
            for b, y in zip(bins, labels):
                if y is not None:
                    total[y].update(enumerate(b))
            size = [65 + sum(y == k for y in labels) for k in (0, 1)]
            raw[name] = np.array([
                np.log(size[1] / size[0])
                + sum(np.log((total[1][c] + 1) / size[1]) - np.log((total[0][c] + 1) / size[0]) for c in enumerate(b))
                for b in bins
            ])
        size = [65 + sum(y == k for y in page_label) for k in (0, 1)]
        prior, part = np.log(size[1] / size[0]), size[1] / sum(size)
        for k in range(len(docs[0][4])):
            good, all_ = Counter(), Counter()
            for d, y in zip(docs, page_label):
                if y is not None:
                    all_[d[4][k]] += 1
                    good[d[4][k]] += y
            for i, d in enumerate(docs):
                if c := all_[d[4][k]]:
                    g = good[d[4][k]]
                    raw["page"][i] += np.log(g + 2 * part) - np.log(c - g + 2 * (1 - part)) - prior
        held = [i for i in range(n) if docs[i][6] and docs[i][5] is not None]
        y = np.array([docs[i][5] for i in held], float)
        for name in raw:
            raw[name] = np.clip(raw[name], -50, 50)
            level, slope = logistic_by_rows(np.round(raw[name][held] * 4) / 4, y, (0, 0), 1e-3)
            odds[name] = raw[name] * slope + level, np.round(raw[name][held] * 4) / 4 * slope + level
            assert slope > 0
        usual = np.log((y.sum() + 1) / ((1 - y).sum() + 1))
        both = np.column_stack([odds["text"][1], odds["page"][1]])
        level, *mix = logistic_by_rows(both, y, (-usual, 1, 1), 1)
        mix = np.maximum(mix, 0)
        odds["both"] = level + odds["text"][0] * mix[0] + odds["page"][0] * mix[1], None

    def pseudo(name):
        p = 1 / (1 + np.exp(-odds[name][0]))
        guess = [1 if q >= sure else 0 if q <= 1 - sure else None for q in p]
        return [own[i] if docs[i][5] is not None else guess[i] for i in range(n)]

    own = [None if d[6] else d[5] for d in docs]
    fit(own, own)
    for _ in range(rounds):
        fit(pseudo("page"), pseudo("text"))
    return [1 / (1 + np.exp(-odds[name][0])) for name in ("text", "page", "both")]


def test_classifier_against_plain_cotraining(spark):
    """The whole query against co-training worked out document by document."""
    sf = SF.replace("0.001", "0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    told = {}
    for r in labels.collect():
        told.setdefault(r.doc_id, []).append(r.quality)
    more = (cotraining.text_half("text").alias("half"), F.pmod(F.xxhash64("doc_id"), F.lit(4)).alias("fold"))

    def share(a, b):
        return a / b if b else 0.0

    def log2(x):
        return np.log(1 + max(x, 0)) / np.log(2)

    rows, ids = [], []
    for r in docs.select("*", *more).collect():
        m = dict(zip(measures.NAMES, measures.measure((r.text or "").encode())))
        features = [
            binned(log2(m["n_words"]), 0, 16),
            binned(share(m["n_repeat_words"], m["n_words"]), 0, 1),
            binned(share(m["n_dup_lines"], m["n_lines"]), 0, 1),
            binned(share(m["n_symbols"], m["n_words"]), 0, 4),
            binned(share(m["word_chars"], m["n_words"]), 0, 16),
            binned(share(m["n_distinct"], m["n_words"]), 0, 1),
            binned(share(m["n_top"], m["n_words"]), 0, 1),
            binned(share(m["n_upper"], m["n_upper"] + m["n_lower"]), 0, 1),
            binned(share(m["n_shouted"], m["n_words"]), 0, 1),
            binned(share(m["n_ended"], m["n_lines"]), 0, 1),
        ]
        keys = (r.source, r.lang, (r.lang, int(log2(r.n_chars))))
        label = None if r.doc_id not in told else int(np.mean(told[r.doc_id]) >= 0.5)
        words = cotraining.slots_of((r.text or "").encode()).tolist()
        rows.append((features, words, r.half, binned(log2(r.n_chars), 0, 32), keys, label, r.fold == 0))
        ids.append(r.doc_id)
    found = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, sf).collect()}
    assert len(found) == len(ids)
    for name, by_hand in zip(("text_score", "page_score", "quality"), cotrained(rows)):
        ours = np.array([found[i][name] for i in ids])
        assert abs(ours - by_hand).max() < 1e-6, name
    assert all(r.kept == (r.quality >= 0.5) for r in found.values())


def test_pipeline_stages(spark):
    """Each stage against what its operator says of its own input."""
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "quality rules", "near-deduplication", "best-fit packing"]
    for (_, stage), judge in zip(
        corpus_pipeline.STAGES,
        [
            lambda d: cotraining.classified(d, labels),
            supervision.judged,
            near_duplicates,
        ],
    ):
        kept = {r.doc_id for r in judge(docs).filter("kept").collect()}
        after = corpus_pipeline.materialize(stage(spark, docs, SF))
        assert after.schema == docs.schema
        assert {r.doc_id for r in after.select("doc_id").collect()} == kept
        assert 0 < after.count() == len(kept) < docs.count()
        docs = after
    pieces = corpus_pipeline.STAGES[3][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.collect()} == kept
    whole = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32")
    assert sorted(map(tuple, whole.collect())) == sorted(
        map(tuple, pieces.select("doc_id", "piece", "length", "ids_crc32").collect())
    )
    assert zlib.crc32(b"") == 0 and len(TEXTS) > 10


def test_every_source_counts_for_itself(spark):
    """Thousands of sources, a tenth of them bad, with texts that tell nothing."""
    n, each = 2000, 6
    rows = [
        (s * each + k, f"some text of {s} and {k}", "en", f"site{s}.example", 100, int(s % 10 > 0))
        for s in range(n)
        for k in range(each)
    ]
    made = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, quality int"
    )
    docs = made.drop("quality")
    labels = made.filter("doc_id % 6 < 5").select("doc_id", "quality", F.lit(0).alias("toxic"))
    found = cotraining.classified(docs, labels).join(made.select("doc_id", "quality").withColumnRenamed("quality", "label"), "doc_id")
    unseen = [(r.label, r.kept) for r in found.filter("doc_id % 6 = 5").collect()]
    assert np.mean([k for y, k in unseen if y == 1]) > 0.97
    assert np.mean([k for y, k in unseen if y == 0]) < 0.1
    model = cotraining.train(cotraining._labelled(cotraining._features(docs), labels))
    assert model.pages.select("_source").distinct().count() == n


def test_texts_of_a_batch_come_a_few_at_a_time():
    """All of them in order, null included, and odds are those of the whole batch."""
    texts = [None if i % 7 == 0 else f"w{i} w{i % 5} é" for i in range(3 * measures.TEXTS + 5)]
    batch = pa.array(texts)
    assert list(measures.texts_of(batch)) == [t if t is None else t.encode() for t in texts]
    words, half = cotraining._slot_lists(batch), pa.array([i % 2 for i in range(len(batch))], pa.int32())
    table = np.arange(2.0 * cotraining.SLOTS).reshape(2, -1)
    found = cotraining._mean_odds(table, words, half)
    assert found.equals(cotraining._odds_of(table, words, half)) and found.null_count == len(texts[::7])


def test_rows_with_words_are_shuffled_once_and_left_behind(spark):
    """Labels meet rows alike at any size, and all but two counts read rows without words."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = cotraining._labelled(cotraining._features(docs), labels)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    model, seen = cotraining._trained(corpus_pipeline.materialize(rows), 1, 0.95)
    assert not {"words", "base", "half"} & set(seen.columns)
    assert seen.count() == docs.count() and model.pages is not None
