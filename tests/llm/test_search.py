"""Ranked search against every document scored for every item."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from fixtures import LONG, TEXTS, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st

from daedap.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=20):
    """(item row, rank, doc_id, score); ``docs`` and ``items`` are lists of (id, text)."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    found = []
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 75 + (25 * sum(c.values()) * n) // length
            score = 0
            for term in terms(text):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        found += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return found


def as_set(rows):
    return sorted(map(tuple, rows), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB0 _-.~@[`{\x00\x7fé日🙂İ ") | st.characters(codec="utf-8")))
def test_terms(text):
    assert [t.decode() for t in search.terms_of(text.encode())] == terms(text)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(st.sampled_from("abcdef "), max_size=30), min_size=1, max_size=40),
    st.text(st.sampled_from("abcdef "), max_size=14),
    st.integers(1, 4),
)
def test_a_block_holds_its_best(texts, asked, k):
    """Limited accumulators lose nothing, ties at the k-th place included."""
    data = [search.terms_of(t.encode()) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted({t for d in data for t in d} | set(search.terms_of(asked.encode()))))}
    full = [(i, d) for i, d in enumerate(data) if d]
    if not full or not vocabulary:
        return
    rows = [(at, vocabulary[t], n) for at, (_, d) in enumerate(full) for t, n in Counter(d).items()]
    at, term, tf = (np.array(c) for c in zip(*rows))
    n = np.array([len(d) for _, d in full])
    weights = search.term_weights(len(full), np.bincount(term, minlength=len(vocabulary)))
    stats = search.Statistics(len(full), int(n.sum()), weights)
    wanted = Counter(search.terms_of(asked.encode()))
    number = np.array([vocabulary[t] for t in wanted], int)
    order = np.argsort(-weights[number], kind="stable")
    repeats = np.array(list(wanted.values()), int)
    block = search.Block(n, at, term, tf, stats)
    places, scores, _ = block.best(number[order], (weights[number] * repeats)[order], k)
    found = sorted((-s, full[p][0]) for p, s in zip(places.tolist(), scores.tolist()))[:k]
    expected = brute(list(enumerate(texts)), [(0, asked)], k)
    assert [(-s, d) for _, _, d, s in expected] == found


def test_accumulators_are_limited():
    """A common term alone opens no accumulator once rare ones have filled the best."""
    n = 2000
    data = [["common"] + (["rare", "rarer"] if i < 30 else []) for i in range(n)]
    numbers = {"rarer": 0, "rare": 1, "common": 2}
    rows = [(i, numbers[t], 1) for i, d in enumerate(data) for t in d]
    at, term, tf = (np.array(c) for c in zip(*rows))
    lengths = np.array([len(d) for d in data])
    stats = search.Statistics(n, int(lengths.sum()), search.term_weights(n, np.array([30, 30, 1900])))
    block = search.Block(lengths, at, term, tf, stats)
    places, scores, opened = block.best(np.array([0, 1, 2]), stats.weights[[0, 1, 2]], 20)
    assert opened == 30 and set(places.tolist()) <= set(range(30))
    alone = [int(stats.weights[t] * block.gains[block.starts[t]]) for t in range(3)]
    assert set(scores.tolist()) == {sum(alone)}


@pytest.mark.parametrize("block", [1, 3, 100])
def test_odd_rows(spark, block):
    asked = [(1, "plain text they'll"), (2, None), (3, ""), (None, "Word5 ünd TEXT-5 Word5"), (5, "日本語のテキスト"), (1, "x a")]
    items = spark.createDataFrame([(i, t, "x", "y") for i, t in asked], "item_id long, text string, score string, rank string")
    docs = documents(spark, more="n string, terms string, score string").repartition(3)
    pairs = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a text without an id"), (1, TEXTS[1])]
    assert as_set(search.ranked(docs, items, block=block).collect()) == as_set(brute(pairs, asked))
    assert as_set(search.ranked(docs, items, pass_terms=2).collect()) == as_set(brute(pairs, asked))
    assert LONG in TEXTS


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search.ranked(empty(spark), items).collect() == []
    nothing = search.ranked(documents(spark), items.limit(0))
    assert nothing.collect() == [] and nothing.columns == ["item_id", "rank", "doc_id", "score"]
