"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully materialised (every column) through the ``noop`` sink.
One untimed warm-up run of the flagship on the smallest scale first takes the
one-time costs (JVM JIT, Python worker start-up) out of the timings.
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.  The
value is the sum of the queries and of what they share and is stored once:
"numbered_bars" (the clean bars with their numbers, which the window queries
read), "feature_store" (the feature table) and "panel_blocks" (its dense
blocks, which the sequence and evaluation queries read).  "apart" times the
derivation of the raw bars alone, which is no part of the sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.plans.queries import QUERIES, bars, blocks, clean_up, store  # noqa: E402
from panelkit.session import get_session  # noqa: E402
from panelkit.sources import fixtures as X  # noqa: E402

HEADLINE = [
    "feature_table",      # flagship: 138 features + 11 labels
    "clean_bars",         # scan + string gates
    "stock_volume",       # F14-F17 volume windows
    "linreg",             # T12-T15 regression windows
    "macd",               # T1 block scans
    "index_enrich",       # J1 join by date
    "label_return_class",  # L5 deciles per symbol
    "relative_labels",    # L7 relative return + index lead
    "sequence_windows",   # D1 windows, long form
    "eval_confusion",     # E3/E4 per label, one aggregation
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # warm the JVM and the Python workers on the smallest scale (not timed)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        QUERIES["feature_table"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        QUERIES["clean_bars"](spark, sf_dir).limit(1).collect()
    times, apart = {}, {}
    t0 = time.time()
    X.raw_bars(spark, sf_dir).write.format("noop").mode("overwrite").save()
    apart["bars"] = round(time.time() - t0, 3)
    shared = {"numbered_bars": bars, "feature_store": store, "panel_blocks": blocks}
    for name, make in shared.items():
        if name == "numbered_bars" or {"sequence_windows", "eval_confusion"} & set(names):
            t0 = time.time()
            make(spark, sf_dir)
            times[name] = round(time.time() - t0, 3)
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    clean_up(spark)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": int(cpus), "apart": apart}))


if __name__ == "__main__":
    main()
