"""Time the headline queries; prints one JSON line.

Each query runs twice into the no-op sink, so every row and column is computed, and the
faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures.registered import QUERIES  # noqa: E402

HEADLINE = (
    "e1_count_establishments", "e2_capital_by_category", "e3_active_by_place_activity",
    "e4_regime_distribution", "e5_regime_summary", "e8_capital_ranking", "d4_branch_view",
    "d3_partner_company", "d5_partner_network", "d6_company_documents", "d7_coherent_sample",
    "d8_orphan_codes", "d9_enrich_ids", "b2_state_partitions", "b3_keep_first", "b6_refresh_marts",
    "c1_empresa", "c1_estabelecimento", "c1_socio", "c1_regime", "i12_explode_codes",
    "l1_name_similarity", "l2_by_activity", "l3_openings_by_month", "l6_profile_activity",
    "a1_zip_scan", "h1_load_audit", "j1_ingest_new_months", "b1_full_load",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("regiscope-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
