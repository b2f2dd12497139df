"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder with the tables, ``BENCH_CPUS`` the cores.
Results go to the ``noop`` sink, so the whole result is computed and nothing is
gathered in the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caselume.plans.catalog import QUERIES  # noqa: E402
from caselume.session import local_session  # noqa: E402

HEADLINE = [
    "signals_prr_chi2",
    "signals_all_pairs",
    "signals_by_case",
    "pair_counts_grouping_sets",
    "top_pairs",
    "signal_lookup",
    "month_country_pivot",
    "column_profile",
    "duplicate_stats",
    "value_share",
    "grouped_describe",
    "clean_demo_table",
    "clean_drug_table",
    "clean_reac_table",
    "join_multiway_inner",
    "joined_pair_counts",
    "common_keys",
    "case_assembly",
    "undersample",
    "knn_exact",
    "tomek_links",
    "enn",
    "smote",
    "adasyn",
    "smote_nc",
    "term_entropy",
    "mutual_information",
    "stratified_split",
    "ordinal_encode",
    "class_report",
    "roc_auc",
    "risk_alerts",
    "stream_batch_alerts",
    "stream_window_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "caselume-bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # Start the JVM, the code cache and the Python workers before the clock.
    QUERIES["value_share"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
