"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line.

Each query runs once to warm up, then three times; its time is the median, with
the result fully computed and thrown away. The streams run once, as each run lands
and follows a whole table. The given pages are one file of one row group, which is one
task; they are landed once in as many files as there are cores, so that extraction is
timed as it runs on a table of many files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

import pyarrow.parquet as pq

from rollbook.plans.queries import QUERIES
from rollbook.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = (
    "admit_big",
    "admit_big_rows",
    "page_accounting",
    "page_rows",
    "page_envelope",
    "harvest_pool",
    "status_sweep",
    "dispatch_list",
    "outcome_join",
    "outcome_unmatched",
    "outcome_fold",
    "alive_now_upsert",
    "freshest_topk",
    "random_assign",
    "ledger_replay",
    "ledger_members",
)
STREAMS = ("stream_harvest", "stream_fold", "stream_ledger", "stream_readmission")
RUNS = 3


def landed(sf_dir: str, files: int) -> str:
    """The given tables, with the pages dealt over ``files`` files."""
    folder = Path(tempfile.mkdtemp(prefix="rollbook-bench-"))
    for path in Path(sf_dir).iterdir():
        if path.name != "pages.parquet":
            (folder / path.name).symlink_to(path)
    pages = pq.read_table(f"{sf_dir}/pages.parquet")
    (folder / "pages.parquet").mkdir()
    step = -(-len(pages) // files)
    for i in range(files):
        pq.write_table(pages.slice(i * step, step), folder / "pages.parquet" / f"part-{i}.parquet")
    return str(folder)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        "rollbook-bench",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    tables = landed(SF_DIR, int(CPUS))
    for name in HEADLINE:
        timed(spark, name, tables)
        seconds[name] = statistics.median(timed(spark, name, tables) for _ in range(RUNS))
        print(name, round(seconds[name], 3), file=sys.stderr, flush=True)
    for name in STREAMS:
        seconds[name] = timed(spark, name, tables)
        print(name, round(seconds[name], 3), file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "rollbook headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(s, 3) for name, s in seconds.items()},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
