"""Benchmark: headline queries plus the end-to-end job on the test tables.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_TREES (trees of the job's model; default: the tuned 287).
Prints one JSON line. Each query is timed from plan construction to a full
``noop`` write (every row computed, nothing collected), over source files that
are written before (``staging_seconds``). The job time covers
features, checkpoints, model fit, scoring, the CSV sink and the metrics, the
same stages as the original single-machine run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rateforge.operators import model as M  # noqa: E402
from rateforge.plans.catalog import QUERIES  # noqa: E402
from rateforge.plans.job import train_and_score  # noqa: E402
from rateforge.session import local_session  # noqa: E402
from rateforge.sources import tables as T  # noqa: E402

HEADLINE = [
    "feature_matrix",
    "scoring_matrix",
    "cold_start_mix",
    "missing_profile",
    "item_visits",
    "latest_tip_per_pair",
    "pair_tip_likes",
    "attribute_frequency",
    "attribute_values",
    "rmse",
    "error_histogram",
    "rmse_by_split",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    trees = os.environ.get("BENCH_TREES")
    spark = local_session(cpus, shuffle_partitions=cpus, app="rateforge-bench")

    # The input files are made of the test tables once; a real folder has them. Reported apart.
    t = time.time()
    for source in T.SOURCES:
        T.staged(spark, sf_dir, source)
    staging = round(time.time() - t, 3)

    # Warm-up: JVM, code generation, file footers (not timed).
    QUERIES["ratings"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    params = dict(M.TUNED_PARAMS)
    if trees:
        params["maxIter"] = int(trees)
    out = os.path.join(tempfile.mkdtemp(prefix="rateforge-bench-"), "predictions")
    t = time.time()
    error, rmse = None, None
    try:
        res = train_and_score(spark, T.load(spark, sf_dir, evaluate=True), out, params=params)
        job = round(time.time() - t, 3)
        times["job_total"] = job
        for k, v in res.timings.items():
            times[f"job_{k}"] = round(v, 3)
        rmse = res.metrics.get("rmse")
    except Exception as e:  # still report the query times
        job, error = None, f"{type(e).__name__}: {str(e)[:300]}"

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "end_to_end_job_seconds",
                "value": job,
                "unit": "sec",
                "queries": times,
                "sf": sf,
                "cpus": cpus,
                "trees": params["maxIter"],
                "rmse": rmse,
                "staging_seconds": staging,
                "queries_total": round(sum(v for k, v in times.items() if not k.startswith("job_")), 3),
                **({"error": error} if error else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
