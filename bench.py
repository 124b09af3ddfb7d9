"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (tables, default sf0.1), BENCH_CPUS (local cores,
default 8), BENCH_KEYS (comma-separated keys; default all), BENCH_COLD=1 to add
the first, cold run of each query under "cold", BENCH_BUDGET (seconds, default
900): past half of it every query runs once only, past all of it the rest is
named under "skipped".
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakekit.plans import catalog  # noqa: E402
from lakekit.session import build_session  # noqa: E402


def run(df) -> None:
    """Compute every output row and column without collecting any."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = catalog.queries()
    wanted = os.environ.get("BENCH_KEYS")
    keys = [k for k in wanted.split(",") if k in queries] if wanted else list(queries)
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g")})
    spark.sparkContext.setLogLevel("OFF")
    run(queries["scan_parquet"](spark, sf_dir))  # starts the session's machinery
    budget, began = float(os.environ.get("BENCH_BUDGET", "900")), time.perf_counter()
    cold, warm, skipped = {}, {}, []
    for key in keys:
        spent = time.perf_counter() - began
        if spent > budget:
            skipped.append(key)
            continue
        for times in (cold, warm) if spent < budget / 2 else (warm,):
            start = time.perf_counter()
            run(queries[key](spark, sf_dir))
            times[key] = round(time.perf_counter() - start, 3)
    line = {"metric": "warm seconds over all queries", "value": round(sum(warm.values()), 3), "unit": "sec",
            "queries": warm, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}
    if skipped:
        line["skipped"] = skipped
    if os.environ.get("BENCH_COLD"):
        line["cold"] = cold
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
