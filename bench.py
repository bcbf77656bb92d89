"""Time the headline queries; print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local threads.  Results
go to the ``noop`` sink, so that every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oreline.session import build_session  # noqa: E402
from oreline.suite import QUERIES  # noqa: E402
from oreline.suite.model import star  # noqa: E402

HEADLINES = (
    "profitability_ranking",
    "profitability_natural_key",
    "star_join_rollup",
    "contract_cast",
    "q_split_strict",
    "q_reasons",
    "constraint_audit",
    "t_hash",
    "t_dedupe_latest",
    "dedupe_ties",
    "surrogate_keys",
    "scd2_history",
    "scd2_merge",
    "lookup_active_sliced",
    "lookup_as_of",
    "fact_append_idempotent",
    "partitioned_sink_dynamic",
    "sorted_layout",
    "ledger_state",
    "silver_job",
    "gold_job",
    "daily_load_facts",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "oreline-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    timings: dict[str, float] = {}

    def timed(name, work):
        began = time.perf_counter()
        work()
        timings[name] = round(time.perf_counter() - began, 3)

    timed("star_load", lambda: star(spark, sf_dir))
    for name in sys.argv[1:] or HEADLINES:
        timed(
            name,
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(),
        )
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
