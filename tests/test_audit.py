from helpers import rows

from daedap.operators.audit import (
    genitive_hits,
    marker_counts,
    marker_hits,
    particle_hits,
    trim_trace,
)
from daedap.plans.params import TRIMMED_PARTICLES
from daedap.sources.splits import gold_answers

GOLD = ["서울이다.", "이다. 그", "하며, 가", "하고, 나"]


def gold(spark, answers):
    return spark.createDataFrame(list(enumerate(answers)), "question_id long, answer string")


def test_marker_counts_list_every_marker(spark):
    assert dict(rows(marker_counts(gold(spark, GOLD)), "marker", "n")) == {
        "다.": 1,
        "며,": 1,
        "데,": 0,
        "뿐,": 0,
        "라,": 0,
        "고,": 1,
    }


def test_marker_hits(spark):
    assert sorted(rows(marker_hits(gold(spark, GOLD)), "answer", "marker")) == [
        ("이다. 그", "다."),
        ("하고, 나", "고,"),
        ("하며, 가", "며,"),
    ]


TAGGED = [
    ("왕의", "의", "JKG"),
    ("주의", "의", "NNG"),
    ("회의", "회의", "NNG"),
    ("서울은", "은", "JX"),
    ("나라를", "를", "JKO"),
    ("난이", "이", "JKS"),
    ("외톨이", "외톨이", "NNG"),
]


def tagged(spark):
    return spark.createDataFrame(TAGGED, "answer string, morph string, pos string")


def test_genitive_hits(spark):
    assert rows(genitive_hits(tagged(spark)), "answer") == [("왕의",)]


def test_particle_hits_in_list_order(spark):
    hits = particle_hits(tagged(spark))
    assert sorted(rows(hits, "particle_order", "particle", "answer")) == [
        (2, "를", "나라를"),
        (3, "이", "난이"),
        (6, "은", "서울은"),
    ]


def test_trim_trace(spark):
    traced = trim_trace(tagged(spark), TRIMMED_PARTICLES)
    got = {a: (f, t) for a, f, t in rows(traced, "answer", "final", "trimmed")}
    assert got["난이"] == ("이", "난")
    assert got["외톨이"] == ("이", "외톨이")
    assert got["서울은"] == ("은", "서울은")


def test_first_gold_answer(spark):
    df = spark.createDataFrame(
        [("a", (["x", "y"],)), ("b", ([],))], "id string, answers struct<text: array<string>>"
    )
    assert rows(gold_answers(df), "question_id", "answer") == [("a", "x"), ("b", None)]
