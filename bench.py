"""Headline queries timed at one scale: one JSON line with seconds per query (median of warm runs).

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (warm runs per query),
BENCH_KEYS (comma-separated keys instead of the headline list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lotwise.plans import CATALOGUE  # noqa: E402
from lotwise.session import local_session  # noqa: E402
from lotwise.sources.tables import Tables  # noqa: E402
from lotwise.sources.workspace import mark, release  # noqa: E402

HEADLINE = [
    "SRC-13", "FLT-2", "JOIN-2", "JOIN-12", "JOIN-13", "AGG-2", "AGG-6", "AGG-9", "AGG-10", "AGG-11", "SUB-9", "SUB-16",
    "WIN-1", "WIN-4", "WIN-5", "WIN-6", "WIN-8", "WIN-11", "WIN-12", "WIN-14", "SET-5", "TXT-5", "TXT-7", "TXT-11", "VEC-2",
    "VEC-4", "VEC-6", "GRF-2", "GRF-4", "GRF-5", "UPS-1", "CDC-1", "CDC-3", "TXN-1", "DQ-6", "DW-3", "DW-5", "DW-7", "ST-3", "ST-5", "ST-9", "ST-17",
]

# The five filters with published timings, on the line table in the part of the ads.
FILTERS = {
    "Q1": lambda t: t.lineitem.where("l_extendedprice > 70000 AND l_returnflag IN ('A', 'N')").select(
        "l_orderkey", "l_extendedprice", "l_returnflag"
    ),
    "Q2": lambda t: t.lineitem.where("l_extendedprice < 2500").select("l_orderkey", "l_extendedprice"),
    "Q3": lambda t: t.lineitem.where("l_extendedprice = 50000").select("l_orderkey", "l_extendedprice"),
    "Q4": lambda t: t.orders.where(F.col("o_orderpriority").contains("MEDIUM")).select("o_orderkey", "o_orderpriority"),
    "Q5": lambda t: t.orders.where(F.col("o_orderpriority").startswith("1-UR")).select("o_orderkey", "o_orderpriority"),
}


def seconds_of(build) -> float:
    before = mark()
    started = time.perf_counter()
    result = build()
    result.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - started
    release(result.sparkSession, before)
    return seconds


def scale_of(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    keys = os.environ.get("BENCH_KEYS", "")
    spark = local_session(cores, shuffle_partitions=cores, name="bench")
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)
    jobs = {key: (lambda q=CATALOGUE[key]: q(spark, folder)) for key in (keys.split(",") if keys else HEADLINE)}
    if not keys:
        jobs.update({name: (lambda f=build: f(tables)) for name, build in FILTERS.items()})
    timed = {}
    for name, build in jobs.items():
        seconds_of(build)
        timed[name] = round(statistics.median(seconds_of(build) for _ in range(runs)), 4)
    result = {
        "metric": "headline queries, total of median warm seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": scale_of(folder),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
