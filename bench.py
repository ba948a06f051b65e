"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query runs to
completion into Spark's no-op sink (every row is produced, nothing is
collected to the driver).  A warm-up pass runs every timed query once on the
smaller sf0.01 tables first, so the timings measure steady-state execution
rather than the JVM's first compilation of each plan shape.  Each query is then
timed BENCH_REPEAT times (default 2) and its best time reported, which damps
the run-to-run noise of a shared machine.

The test tables are one Parquet row group each, which is one scan task however many
cores there are; large tables are not like that.  So the two large tables are
copied into BENCH_CPUS files first (BENCH_SPREAD=0 times the tables as they are).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from runway.plans import catalog  # noqa: E402
from runway.session import build_session  # noqa: E402
from runway.sources.tables import TABLES  # noqa: E402

HEADLINE = [
    "final_features", "union_features", "normalise_flights", "prior_arrival_late",
    "hourly_obs", "decode_packed", "station_match", "local_weather", "remote_weather",
    "two_hop_motif", "pagerank_top50", "delays_by_carrier", "mean_delay_by_dst",
    "carrier_stats", "corr_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = build_session(f"local[{cpus}]", app="runway-bench", shuffle_partitions=cpus * 2,
                          conf={"spark.driver.memory": "16g",
                                "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    queries = catalog.registered()

    def spread(data_dir: str) -> str:
        out = tempfile.mkdtemp(prefix="runway-bench-")
        for name in TABLES:
            source, target = f"{data_dir}/{name}.parquet", f"{out}/{name}.parquet"
            if name in ("lineitem", "events") and os.path.exists(source):
                spark.read.parquet(source).repartition(cpus).write.parquet(target)
            elif os.path.exists(source):
                os.symlink(os.path.abspath(source), target)
        return out

    def run(name: str, data_dir: str) -> float:
        t0 = time.perf_counter()
        queries[name](spark, data_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    data_dir = spread(sf_dir) if os.environ.get("BENCH_SPREAD", "1") != "0" else sf_dir
    for name in names:
        run(name, warm_dir if os.path.isdir(warm_dir) else data_dir)
    repeat = max(int(os.environ.get("BENCH_REPEAT", "2")), 1)
    timings = {name: round(min(run(name, data_dir) for _ in range(repeat)), 3) for name in names}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf.group(1)) if sf else None,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
