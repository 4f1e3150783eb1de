"""

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and writes it to the ``noop`` sink; the time per query
is the median of ``$BENCH_RUNS`` warm runs (default 3) after one warm-up run.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codefacts.plans import registry  # noqa: E402
from codefacts.session import get_spark  # noqa: E402

HEADLINE = {
    "callgraph": ["callgraph_callers", "callgraph_stats"],      # C1-C8
    "reachability": ["reachability"],                          # K1
    "api_methods": ["client_api_methods"],                     # T1, T2, H4, H5
    "form_fields_options": ["client_form_fields", "client_select_options"],  # H22, H25
    "go_call_classification": ["go_calls", "go_function_sets"],  # G3-G8
    "schema_expansion": ["schema_expansion"],                  # E1-E12
    "evidence_resolution": ["spec_resolution"],                # F3, F4
    "url_resolution": ["component_call_requirements"],         # L4
}


def run_once(spark, fn, sf_dir):
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    registry.load_all()
    out = {}
    for name, keys in HEADLINE.items():
        if only and name not in only:
            continue
        fns = [registry.QUERIES[k] for k in keys]

        def q():
            return sum(run_once(spark, f, sf_dir) for f in fns)
        q()  # warm-up
        times = [q() for _ in range(runs)]
        out[name] = round(statistics.median(times), 3)
        print(f"# {name}: {out[name]}s {[round(x, 2) for x in times]}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "runs": runs, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
