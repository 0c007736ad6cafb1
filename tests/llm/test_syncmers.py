"""Fingerprints in column expressions against the same in plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
from fixtures import documents, empty
from pyspark.sql import functions as F

from daedap.llm import syncmers
from daedap.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hashes(spark):
    """xxhash64 of Spark for strings, pairs of numbers and arrays of numbers."""

    def of(values, kind):
        rows = [(i, v) for i, v in enumerate(values)]
        if kind == "pair":
            frame = spark.createDataFrame([(i, *v) for i, v in rows], "i int, a long, b long")
            found = frame.select("i", F.xxhash64("a", "b").alias("h"))
        else:
            frame = spark.createDataFrame(rows, f"i int, v {kind}")
            found = frame.select("i", F.xxhash64("v").alias("h"))
        return [r.h for r in sorted(found.collect(), key=lambda r: r.i)]

    return of


def plain_sketches(texts, hashes):
    """All sketches of some texts, run by run."""
    pieces = [[p for w in re.findall(r"[^ \t\n\x0b\f\r]+", t) for p in re.findall("(?s).{1,8}", w)] for t in texts]
    words = sorted({p for each in pieces for p in each})
    named = dict(zip(words, hashes(words, "string")))
    numbers = [[named[p] for p in each] for each in pieces]
    pairs = sorted({p for n in numbers for p in zip(n, n[1:])})
    inner = dict(zip(pairs, hashes(pairs, "pair")))
    runs = set()
    chosen = []
    for n in numbers:
        found = []
        for i in range(len(n) - 4):
            inside = [inner[n[i + j], n[i + j + 1]] for j in range(4)]
            if min(inside) in (inside[0], inside[-1]):
                found.append(tuple(n[i : i + 5]))
        if 0 < len(n) < 5:
            found = [tuple(n)]
        chosen.append(found)
        runs |= set(found)
    runs = sorted(runs)
    final = {r: (h >> 32) & 0xFFFFFFFF for r, h in zip(runs, hashes([list(r) for r in runs], "array<long>"))}
    return [sorted({final[r] for r in found})[:64] for found in chosen]


def likeness(a, b):
    both = sorted(set(a) | set(b))[:64]
    return sum(x in a and x in b for x in both) / len(both) if both else 1.0


def expected(rows, hashes):
    """All columns, for rows without repeated ids."""
    rows = [(d, t or "") for d, t in rows]
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    after = {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}
    edited = [t[: len(t) - len(t) // 4] + after.get(d, "")[: len(t) // 4] for d, t in rows]
    nexts = [after.get(d, "") for d, _ in rows]
    n = len(rows)
    found = plain_sketches([t for _, t in rows] + edited + nexts, hashes)
    return sorted(
        (
            (
                d,
                len(t),
                hashlib.sha256(e.encode()).hexdigest(),
                "".join(f"{v:08X}" for v in found[i]),
                "".join(f"{v:08X}" for v in found[n + i]),
                likeness(found[i], found[n + i]),
                likeness(found[i], found[2 * n + i]),
            )
            for i, ((d, t), e) in enumerate(zip(rows, edited))
        ),
        key=str,
    )


def test_whole_table(spark, hashes):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    found = sorted(map(tuple, QUERIES["op8_closed_syncmers"](spark, SF).collect()), key=str)
    assert found == expected(rows, hashes)
    near = [r for r in found if r[1] > 200]
    assert sum(r[5] > r[6] for r in near) > 0.9 * len(near)


def test_awkward_rows(spark, hashes):
    docs = documents(spark).dropDuplicates(["doc_id"])
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, syncmers.fingerprints(docs).collect()), key=str) == expected(rows, hashes)
    assert syncmers.fingerprints(empty(spark)).count() == 0


def test_rows_that_repeat_an_id(spark):
    rows = [(1, "one two three four"), (1, "one two three four"), (2, "zz"), (2, "aa bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = syncmers.fingerprints(docs).collect()
    assert len(found) == 4
    edited = [r.edited_sha256 for r in found if r.doc_id == 1]
    # The smaller begin of the two rows with the next id: "aa b".
    assert edited == [hashlib.sha256(b"one two three aa b").hexdigest()] * 2


def test_only_columns(spark):
    plan = QUERIES["op8_closed_syncmers"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_anchors_do_not_depend_on_what_is_around(spark):
    passage = " ".join(f"word{i * 37 % 101}" for i in range(60))
    rows = [("a", passage), ("b", f"some other begin {passage} and an end"), ("c", ""), ("d", None), ("e", "x y")]
    frame = spark.createDataFrame(rows, "k string, text string")
    found = {r.k: r.a for r in frame.select("k", syncmers.anchors(F.col("text")).alias("a")).collect()}
    first = [(p, h) for p, h in found["a"]]
    moved = {(p - 3, h) for p, h in found["b"]}
    assert len(first) > 15 and set(first) <= moved
    assert found["c"] == found["d"] == [] and [p for p, _ in found["e"]] == [0]


def plain_passages(own, other):
    """shared, aligned and offset of two lists of (position, hash), place by place."""
    places = {}
    for side, found in enumerate((own, other)):
        for p, h in sorted(map(tuple, found)):
            places.setdefault(h, ([], []))[side].append(p)
    offsets = Counter(b - a for mine, theirs in places.values() for a, b in zip(mine, theirs))
    best = max(((n, -abs(o), o) for o, n in offsets.items()), default=(0, 0, None))
    return sum(offsets.values()), best[0], best[2]


def test_passages_of_long_texts_are_seen_where_they_stand(spark):
    r = random.Random(4)

    def words(n):
        return " ".join(f"w{r.randrange(10**6)}" for _ in range(n))

    passage, paragraphs = words(50), [words(300) for _ in range(4)]
    rows = [
        (1, f"{words(20_000)} {passage} {words(3000)}"),
        (2, f"{words(400)} {passage} {words(9000)}"),
        (3, " ".join(paragraphs)),
        (4, " ".join(reversed(paragraphs))),
        (5, "same words " * 500),
        (6, "same words " * 700),
        (6, "same words " * 700 + words(50)),
        (7, None),
        (8, ""),
        (None, words(30)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    with_anchors = docs.select("doc_id", syncmers.anchors(F.col("text")).alias("a")).collect()
    found = syncmers.shared_passages(docs).collect()
    assert len(found) == len(rows)
    got = {(f.doc_id, f.n_anchors): f for f in found}
    for row in with_anchors:
        f = got[row.doc_id, len(row.a)]
        after = None if row.doc_id is None else row.doc_id % 8 + 1
        theirs = min((n.a for n in with_anchors if n.doc_id == after and after), default=[])
        assert (f.shared, f.aligned, f.offset) == plain_passages(row.a, theirs)
        assert f.next_anchors == len(theirs)
        assert sum(p.n_anchors for p in f.passages) == f.shared
    first, third, both_empty = (next(f for f in found if f.doc_id == i) for i in (1, 3, 7))
    assert first.aligned > 15 and first.offset == 400 - 20_000
    assert any(p.begin < 20_010 and p.end > 20_040 for p in first.passages)
    assert third.near > 0.9 and third.in_place < 0.4
    assert (both_empty.near, both_empty.in_place, both_empty.passages) == (1.0, 1.0, [])
    plan = syncmers.shared_passages(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_passages_of_the_whole_table(spark):
    docs = table(spark, SF, "documents")
    own = sorted(docs.select("doc_id", syncmers.anchors(F.col("text")).alias("a")).collect())
    found = {f.doc_id: f for f in QUERIES["syncmer_passages"](spark, SF).collect()}
    for row, after in zip(own, own[1:] + own[:1]):
        f = found[row.doc_id]
        assert (f.shared, f.aligned, f.offset) == plain_passages(row.a, after.a)
    assert len(found) == len(own) and syncmers.shared_passages(empty(spark)).count() == 0


def test_anchors_of_moved_and_edited_passages_without_blanks(spark):
    r = random.Random(9)

    def signs(n, begin=0x4E00):
        return "".join(chr(begin + r.randrange(2000)) for _ in range(n))

    for passage in (signs(200), signs(200, 0x1F300), f"{signs(100)}\u3000{signs(50)}\xa0{signs(50)}"):
        rows = [
            (0, passage),
            *((i, signs(i) + passage + signs(7)) for i in range(1, 10)),
            (10, f"{passage[:60]}{signs(1)}{passage[60:]}"),
            (11, passage[:60] + passage[61:]),
        ]
        frame = spark.createDataFrame(rows, "k int, text string")
        found = {w.k: w.a for w in frame.select("k", syncmers.anchors(F.col("text")).alias("a")).collect()}
        own = {tuple(a) for a in found[0]}
        assert len(own) > 40
        for i in range(1, 10):
            missing = {h for _, h in own} - {h for _, h in found[i]}
            assert not missing
        for i in (10, 11):
            shared = {h for _, h in own} & {h for _, h in found[i]}
            assert len(shared) > 0.85 * len(own)


def test_pieces_of_short_and_long_words(spark):
    text = "ab  seven77 eight888 ninechars\n 😀bcdefghi x"
    frame = spark.createDataFrame([(text,)], "t string")
    pieces = F.regexp_extract_all("t", F.lit(syncmers.MOVABLE), F.lit(1))
    assert frame.select(pieces).first()[0] == [
        "ab", "seven77", "eight888", "ninechar", "inechars", "😀bcdefgh", "bcdefghi", "x",
    ]


def test_anchors_are_found_once_for_each_text(spark):
    """What follows works on written anchors; no text is read or cut up again."""
    docs = table(spark, SF, "documents")
    plan = syncmers.shared_passages(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "text" not in plan
