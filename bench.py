"""Runs the headline queries and prints one JSON line: total and seconds a query."""

import json
import os
import time

os.environ.setdefault("OMP_NUM_THREADS", "1")

from claimloom.plans import catalogue  # noqa: E402
from claimloom.session import local_session  # noqa: E402

HEADLINE = [
    "resolve_claims", "collapse_runs", "arc_restart", "main_line", "ranked_lookup", "audit_rules", "majority_overlap", "cascade_fallback",
    "near_names", "longest_prefix", "contamination", "snapshot_diff", "crosstab_other", "clean_dates", "multi_aggregate", "hash_ids", "html_extract", "event_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), 8)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
