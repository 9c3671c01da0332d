"""Time the headline queries: ``BENCH_SF_DIR=... BENCH_CPUS=... python bench.py`` prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from barloom.queries import QUERIES
from barloom.session import build_session

HEADLINE = [
    "change_conditions", "change_conditions_at_scale", "forward_returns", "forward_returns_long_series",
    "band_median", "hourly_bars", "domestic_bars", "foreign_bars", "universe_bars", "missing_symbols",
    "quote_snapshot", "quote_message", "infer_types", "not_null_report", "tolerant_csv", "refresh_table",
    "dual_sink", "load_ndjson_append", "incremental_land", "model_chain",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "barloom-bench", f"local[{cpus}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
        # Small test files: let them and their shuffles spread over the cores.
        spark__sql__files__maxPartitionBytes="4m",
        spark__sql__files__openCostInBytes="64k",
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64k",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "band_counts", sf_dir)  # start-up costs are not a query's
    timings = {name: round(min(seconds(spark, name, sf_dir) for _ in range(2)), 3) for name in names}
    print(
        json.dumps(
            {"metric": "headline queries, warm, best of 2", "value": round(sum(timings.values()), 3), "unit": "sec",
             "queries": timings, "sf": float(sf_dir.rsplit("sf", 1)[-1]), "cpus": int(cpus)}
        )
    )


if __name__ == "__main__":
    main()
