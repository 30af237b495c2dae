"""Wall time of headline queries; prints one JSON line.

``landing`` builds and writes the nested documents and their three tables, and
``mart`` the fact that rankings and models read; the queries read these. Each query runs once, after a short warm-up, into a sink
that computes every row and keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from legwork.session import build_session  # noqa: E402
from suite import current, learning  # noqa: E402, F401
from suite.registry import QUERIES, mart_fact  # noqa: E402
from suite.staging import staged  # noqa: E402

HEADLINE = [
    "flights",
    "legs",
    "delays",
    "merge_latest",
    "merge_composite",
    "congestion_inner",
    "congestion_full",
    "int_delays_leg",
    "fct_flight_legs",
    "fct_from_documents",
    "star_join",
    "entity_flight_leg",
    "entity_airport",
    "airline_rank",
    "chronic_flights",
    "delay_causes",
    "missing_pct",
    "anova_topk",
    "roc_auc",
    "stratified_split",
    "stream_merge",
    "smote_neighbours",
    "smote_balanced",
    "forest_scored",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "legwork-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    staged(spark, sf_dir, "documents")
    seconds["landing"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    mart_fact(spark, sf_dir)
    seconds["mart"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr)
    result = {
        "metric": "headline_queries_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
