"""Registered queries against their SQL, on the smallest test tables."""

import sys

import __spark_entry__ as entry
import pytest

from checks.compare import _sorted, database
from daedap.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_rows_as_sql(spark, name):
    ours = [row.asDict() for row in QUERIES[name](spark, SF).collect()]
    result = database(SF).execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert _sorted(ours) == _sorted([dict(zip(columns, row)) for row in result.fetchall()])


def test_every_operator_is_registered():
    names = set(entry.queries())
    for n in range(1, 14):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
    assert "corpus_pipeline" in sys.modules
