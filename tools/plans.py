"""List physical-plan traits that would hurt at scale, per registered query.

usage: python tools/plans.py SF_DIR [key-substring ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakekit.plans import catalog  # noqa: E402
from lakekit.session import build_session  # noqa: E402

TRAITS = ("CartesianProduct", "BroadcastNestedLoopJoin", "Exchange SinglePartition", "BatchEvalPython",
          "ArrowEvalPython", "BroadcastExchange")


def main(sf_dir, wanted):
    # broadcasts by table size are switched off, so what remains was forced by the query
    spark = build_session("plans", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setLogLevel("OFF")
    for key, run in catalog.queries().items():
        if wanted and not any(w in key for w in wanted):
            continue
        df = run(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = {t: len(re.findall(re.escape(t), plan)) for t in TRAITS if t in plan}
        if found:
            print(key, found, flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
