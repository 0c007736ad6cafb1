from helpers import rows

from daedap.operators.contexts import blank_outside_scope, drop_blank, sliding_contexts


def test_windows_equal_list_slices(spark):
    """Windows over L documents, L from 0 to 9, as slices of their list."""
    counts = range(10)
    ranked = spark.createDataFrame(
        [(n, r, f"d{r}") for n in counts for r in range(1, n + 1)],
        "question_id long, rank int, text string",
    )
    questions = spark.createDataFrame([(n,) for n in counts], "question_id long")
    got = {(q, e): t for q, e, t in rows(sliding_contexts(ranked, questions), "question_id", "rank", "text")}
    assert len(got) == 7 * len(counts)
    for n in counts:
        docs = [f"d{r}" for r in range(1, n + 1)]
        for e in range(1, 8):
            first = e - 3
            assert got[n, e] == " \n".join(docs[max(0, first) : min(first + 3, n)])


def test_blanks_use_up_ranks_until_dropped(spark):
    ranked = spark.createDataFrame(
        [(0, 1, "a", True), (0, 2, "b", False), (0, 3, "", True), (0, 4, "c", True)],
        "question_id long, rank int, text string, is_candidate boolean",
    )
    blanked = blank_outside_scope(ranked)
    assert sorted(rows(blanked, "rank", "text")) == [(1, "a"), (2, ""), (3, ""), (4, "c")]
    assert sorted(rows(drop_blank(blanked), "rank", "text")) == [(1, "a"), (2, "c")]
