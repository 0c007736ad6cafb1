"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. The index
is built and stored first, as ``index_build``; the other queries use it, as the
original job builds its index once and asks all questions of it. Each query runs
once, its rows counted by Spark and not sent to the driver.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES, index

HEADLINE = (
    "postings_tf",
    "term_df_idf",
    "retrieve_top10",
    "retrieve_cut_095",
    "retrieve_top30",
    "score_candidates",
    "score_distribution",
    "fetch_text",
    "sliding_contexts",
    "reader_logits",
    "span_candidates_w100",
    "best_span",
    "answers_p0",
    "answers_p1",
    "answers_p2",
    "answers_p3",
    "answers_p4",
    "answers_p5",
    "audit_markers",
    "audit_particles",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "5g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    n_questions = spark.read.parquet(f"{sf_dir}/benchmark.parquet").count()

    def seconds(run) -> float:
        begun = time.perf_counter()
        run()
        return round(time.perf_counter() - begun, 3)

    times = {"index_build": seconds(lambda: index(spark, sf_dir))}
    for name in HEADLINE:
        times[name] = seconds(
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "questions_per_second": round(n_questions / times["answers_p3"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
