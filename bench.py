"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full into Spark's no-op sink (nothing is
collected to the driver); the best of $BENCH_REPEAT (default 2) runs is kept.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_rated_books", "book_stats", "user_features", "category_year_pivot", "trend_top_categories",
    "monthly_volume", "merge_match_report", "clean_dedupe_report", "profile_missing", "profile_summary",
    "clean_winsorize", "features_cap_p99", "hist_length", "kde_score", "length_by_score_box",
    "corr_matrix", "sentiment_label", "top_keywords_by_label", "term_weights", "idf_weights",
    "string_index", "ratings_matrix", "cold_start_pairs", "nearest_center",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from quire.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    from quire.plans.catalog import QUERIES

    # warm-up (untimed): JVM code paths, parquet footers, Python workers for the Arrow batches
    for w in ("book_stats", "sentiment_distribution"):
        QUERIES[w](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    times, errors = {}, {}
    for n in names:
        best = None
        try:
            for _ in range(repeat):  # each run builds and executes the query from scratch
                spark.catalog.clearCache()  # no run may reuse data cached by an earlier one
                t0 = time.perf_counter()
                QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[n] = round(best, 3)
        except Exception as exc:  # noqa: BLE001 - record and go on; the JSON line must still be printed
            errors[n] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "repeat": repeat}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
