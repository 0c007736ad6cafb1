"""Near-duplicates, components and the multi-index join against brute force."""

import random

import numpy as np
import pytest
from fixtures import TEXTS, documents, empty

from daedap.llm import minhash
from daedap.llm.graph import components
from daedap.llm.queries import QUERIES, table
from daedap.llm.shingles import SPACE, shingle_set

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = [w for w in re_split(text or "") if w]
    lowered = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if 0 < len(lowered) < 5:
        return {tuple(lowered)}
    return {tuple(lowered[i : i + 5]) for i in range(len(lowered) - 4)}


def re_split(text):
    for c in SPACE.decode():
        text = text.replace(c, " ")
    return text.split(" ")


def brute_force(rows):
    """component_id and number of shingles per row, by comparing all pairs."""
    rows = [(d, shingles(t)) for d, t in rows]
    group = list(range(len(rows)))
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = [min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group]
    return sorted(
        ((d, len(s), i if s else d, d == i if s else True) for (d, s), i in zip(rows, ids)), key=str
    )


def ours(docs, **more):
    found = minhash.near_duplicates(docs, **more)
    return sorted(map(tuple, found.collect()), key=str)


def copies(seed=7):
    """Groups of copies with more and more edits, and passages that many share."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6)))
    passage = [word() for _ in range(40)]
    texts = []
    for group in range(12):
        base = [word() for _ in range(r.choice([3, 6, 30, 90, 200]))]
        if group % 3 == 0:
            base = passage + base
        for copy in range(r.choice([1, 3, 12])):
            edited = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                edited[r.randrange(len(edited))] = word().upper()
            texts.append(r.choice([" ", "\n", " \t"]).join(edited))
    texts += texts[:4] + [" ".join(passage + [word() for _ in range(12)]) for _ in range(25)]
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("few_nodes", [64, 2])
def test_same_groups_as_all_pairs(spark, few_nodes):
    rows = list(enumerate(copies()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_force(rows)
    assert len({r[2] for r in expected}) < len(expected)
    assert ours(docs, few_nodes=few_nodes) == expected


def test_awkward_rows(spark):
    docs = documents(spark)
    expected = brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert ours(docs) == expected
    assert ours(empty(spark)) == []


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op4_near_duplicates"](spark, SF).collect()
    assert sorted(map(tuple, found), key=str) == brute_force(rows)


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    left = minhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted(
        [None, 0, *range(2, len(TEXTS))], key=str
    )


def test_common_key_within_the_distance():
    """Signatures with up to 31 places changed always share a key."""
    numbers = np.random.default_rng(2)
    for _ in range(300):
        a = numbers.integers(0, 2**16, minhash.PLACES, np.uint16)
        b = a.copy()
        changed = numbers.choice(minhash.PLACES, minhash.MOST_DIFFERENT, replace=False)
        b[changed] ^= 1
        keys = minhash.index_keys(np.stack([a, b]))
        assert set(keys[0]) & set(keys[1])


def test_signatures_estimate_similarity():
    numbers = np.random.default_rng(4)
    for common in (100, 600, 900):
        x = numbers.integers(0, 2**64, 1000, np.uint64)
        y = np.concatenate([x[:common], numbers.integers(0, 2**64, 1000 - common, np.uint64)])
        found = [minhash.signature(np.unique(v)) for v in (x, y)]
        assert abs((found[0] == found[1]).mean() - common / (2000 - common)) < 0.2
    long = numbers.integers(0, 2**64, 5000, np.uint64)
    assert (minhash.signature(long) == minhash.signature(long[::-1])).all()
    assert len(shingle_set(b"a b")) == len(shingle_set(b"a b c d e")) == 1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)]
    links = chain[::-1] + star + [(900, 901), (901, 900), (5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)} | {900: 900, 901: 900}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_around_a_passage_send_few_shingles(spark, monkeypatch):
    """Under full keys only shingles that can meet another text's make rows."""
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    passage = [word() for _ in range(60)]
    texts = [" ".join(passage + [word() for _ in range(40)]) for _ in range(150)]
    texts += [t + " " + word() for t in texts[:10]]
    rows, sent = list(enumerate(texts)), []
    written = minhash.materialize

    def spied(df):
        stored = written(df)
        if "shingle" in df.columns:
            sent.append(stored.count())
        return stored

    monkeypatch.setattr(minhash, "materialize", spied)
    assert ours(spark.createDataFrame(rows, "doc_id long, text string"), few_nodes=2) == brute_force(rows)
    quarters = sum(len(shingles(t)) // 4 for t in texts)
    assert sent and 0 < sent[0] < quarters / 5
