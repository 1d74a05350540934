"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (test tables), BENCH_CPUS (local cores) and BENCH_RUNS (timed runs, of which the
median counts, after one warm-up) may be set. The stand-in tables are stored before the clock
starts, so that the operators are timed and not the SQL that makes their inputs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from checks.queries import QUERIES, Standins
from readsift import build_session
from readsift.session import drop_staged, stage

HEADLINE = [
    "refine_report",
    "coverage_profile",
    "species_top",
    "extract_all_genera",
    "clade_report",
    "classify_reads",
]


class Stored(Standins):
    """Stand-ins that are written once, when the warm-up run first asks for them."""

    def __getattr__(self, name: str) -> DataFrame:
        df = stage(super().__getattr__(name), f"standin_{name}")
        setattr(self, name, df)
        return df


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": str(2 * cpus),
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    inputs = Stored(spark, sf_dir)
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(QUERIES[name](inputs))
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:] or taken), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf,
                "cores": cpus, "runs": runs,
            }
        )
    )
    drop_staged(spark)
    spark.stop()


if __name__ == "__main__":
    main()
