"""Run registered queries and their SQL on one folder and compare the rows."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sorted(rows: list[dict]) -> list[tuple]:
    return sorted(
        (tuple(row[c] for c in sorted(row)) for row in rows), key=lambda r: [str(v) for v in r]
    )


def _equal(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list:
    """Up to five pairs of rows that differ; empty if the results are equal."""
    ours = _sorted([row.asDict() for row in QUERIES[name](spark, sf_dir).collect()])
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    theirs = _sorted([dict(zip(columns, row)) for row in result.fetchall()])
    if len(ours) != len(theirs):
        return [("row counts", len(ours), len(theirs))]
    pairs = zip(ours, theirs)
    wrong = [(a, b) for a, b in pairs if len(a) != len(b) or not all(map(_equal, a, b))]
    return wrong[:5]


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    for name in names or list(QUERIES):
        begun = time.time()
        try:
            wrong = differences(spark, con, name, sf_dir) if name in ORACLE else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            wrong = [repr(error)[:600]]
        print(f"{name}: {'equal' if not wrong else wrong} ({time.time() - begun:.1f} s)", flush=True)


if __name__ == "__main__":
    import sys

    main(sys.argv[1], sys.argv[2:])
