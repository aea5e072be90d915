"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the cores. Each query runs once to warm up
generated code and once timed; results go to a sink that reads every row and stores nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from herdframe.catalog import run  # noqa: E402
from herdframe.session import local_session  # noqa: E402

HEADLINE = [
    "E2_summarise", "E4_group_size", "F1_fill_downup", "F3_top_with_ties", "F16_impute_age", "C9_id_cascade",
    "C17_interval_join", "C18_nearest_feature", "J1_inflation_factor", "J2_gc_adjust", "J3_qvalue", "J5_meta_analysis",
    "J7_allele_stats", "J8_parent_conflicts", "J11_grm_standardised", "J13_snp_regression", "J22_term_enrichment",
    "H2_clean_joined", "H7_contemporary_groups", "H10_year_files",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    times: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
