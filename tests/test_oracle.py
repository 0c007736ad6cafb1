"""Registered queries against their SQL, on the smallest test tables."""

import os

import pytest
from helpers import rows

from checks.compare import database, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES, corpus, index, questions, table
from daedap.operators.retrieve import top_documents

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")

SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == []


@pytest.mark.parametrize("name", ["retrieve_top10", "reader_logits", "answers_p3", "audit_particles"])
def test_same_types_as_sql(spark, con, name):
    ours = {c: SPARK_TYPES[t] for c, t in QUERIES[name](spark, SF_DIR).dtypes}
    described = con.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert ours == {c[0]: str(c[1]) for c in described}


def test_a_document_holding_the_question_ranks_first(spark):
    """Clean questions that stand verbatim in a document find one such document."""
    texts = dict(rows(corpus(spark, SF_DIR).filter("is_candidate"), "doc_pos", "text"))
    asked = dict(rows(table(spark, SF_DIR, "benchmark"), "item_id", "text"))
    holding = {
        q: {d for d, t in texts.items() if text in t} for q, text in asked.items()
    }
    clean = questions(spark, SF_DIR, normalized=True)
    first = dict(
        rows(top_documents(index(spark, SF_DIR), clean, n=1), "question_id", "doc_pos")
    )
    found = [first[q] in docs for q, docs in holding.items() if docs]
    assert found and all(found)
