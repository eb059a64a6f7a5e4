"""Time the headline queries once each, after one warm-up query; prints one JSON line.

Each time covers building the DataFrame, planning and running it to the end into the
`noop` sink, over the whole input tables.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from areaweave.plans import entries  # noqa: E402
from areaweave.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "pipe_income", "pipe_industry", "pipe_housing_value", "pipe_weeks", "pipe_zipmap",
    "m09", "q07", "join_full_chain", "join_left_chain", "j01", "a05", "a07", "a09", "a10",
    "a11_unfiltered", "x01_unfiltered", "x02", "x03", "x04", "chk_unique", "k01",
    "sink_replace", "job_staged",
]


def session() -> SparkSession:
    spark = build_session(
        "areaweave-bench", f"local[{CPUS}]", int(CPUS), spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    df = entries.queries()[name](spark, FOLDER)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    run(spark, "m04")
    times = {name: round(run(spark, name), 3) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(FOLDER).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
