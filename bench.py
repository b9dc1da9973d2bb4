"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query runs once untimed on the
same session, then BENCH_REPEATS times; the best run counts. Results are written to Spark's
no-op sink, so that every row is produced and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from commerce_lens.catalog.queries import named_queries
from commerce_lens.session import clear_scratch, local_session

HEADLINE = (
    "agg_sales_daily",
    "agg_sales_by_city",
    "agg_aspect_score_by_product",
    "review_aspect_geo",
    "clean_order_reviews",
    "row_number_rank",
    "left_join_chain",
    "update_from_join",
    "pivot_category_city_masked",
    "trend_by_month",
    "describe_numeric",
    "histogram_20",
    "box_stats",
    "kde_1d",
    "kde_2d",
    "profile_columns",
    "profile_top_values",
    "enrich_reviews",
    "csv_infer_load",
    "refresh_all_layers",
)


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    named_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    seconds = {}
    for name in names:
        run(spark, sf_dir, name)
        seconds[name] = round(min(run(spark, sf_dir, name) for _ in range(repeats)), 3)
    clear_scratch(spark)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
