"""Print the physical plan of a catalogue query.

    python -m rateforge.plans.explain feature_matrix [SF_DIR] [--run]

Without ``--run`` the plan before execution is shown (``explain("formatted")``);
with it, the query runs (``noop`` sink) and the final adaptive plan is printed,
showing the join strategies and skew splits chosen at run time.
"""

from __future__ import annotations

import argparse

from ..session import local_session
from .catalog import QUERIES


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("query", choices=sorted(QUERIES))
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--run", action="store_true")
    a = ap.parse_args(argv)
    spark = local_session()
    df = QUERIES[a.query](spark, a.sf_dir)
    if a.run:
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        print(qe.executedPlan().toString())
    else:
        df.explain("formatted")


if __name__ == "__main__":
    main()
