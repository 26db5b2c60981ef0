"""Run registered queries and write each result as a parquet table.

    python -m quire.plans.export --sf /data/sf1 --out /shared/results [--stage /shared/views] [names...]

Each query runs on the executors and is written by them; nothing passes
through the driver. A query that fails is reported and the others go on.
"""

from __future__ import annotations

import argparse
import sys
import time

from quire.plans.catalog import QUERIES
from quire.session import get_session
from quire.sources.sinks import write_parquet


def export(spark, sf_dir: str, out_dir: str, names: list[str] | None = None) -> dict[str, float]:
    """Write ``<out_dir>/<name>`` for each query; returns seconds per query (negative on failure)."""
    done: dict[str, float] = {}
    for name in names or list(QUERIES):
        t0 = time.perf_counter()
        try:
            write_parquet(QUERIES[name](spark, sf_dir), f"{out_dir.rstrip('/')}/{name}")
            done[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report and continue with the next query
            print(f"{name}: {type(exc).__name__}: {exc}", file=sys.stderr)
            done[name] = -1.0
    return done


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf", required=True, help="folder with the input tables")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--master", default=None, help="e.g. local[8]; leave empty under spark-submit")
    ap.add_argument("--stage", default=None,
                    help="write the shared views (merged reviews etc.) here first and run the queries on them")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    spark = get_session(args.master)
    if args.stage:
        from quire.sources.fixtures import stage_views
        stage_views(spark, args.sf, args.stage)
    for name, sec in export(spark, args.sf, args.out, args.names or None).items():
        print(f"{name}\t{sec}")


if __name__ == "__main__":
    main()
