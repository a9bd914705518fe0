"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillstream.plans import catalog  # noqa: E402

BATCH = ["route_app_log", "ods_fanout_array", "ods_fanout_object", "dau_first_visit",
         "dau_by_hour", "realtime_hour", "first_order_flag", "order_with_province",
         "order_with_user", "detail_with_sku", "latest_per_key", "latest_dim_upsert",
         "order_wide_join", "order_wide_hop_join", "order_wide_interval_join",
         "order_full_outer", "order_wide_dedup", "apportion", "order_amount_by_day", "order_amount_by_day_hour",
         "encode_wide_json", "search_match_top"]
STREAMS = ["stream_dau", "stream_first_order", "stream_order_wide", "stream_hop_wide",
           "stream_full_outer", "stream_apportion"]


def session(cpus: int) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="tillstream-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tillstream-bench")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", f"{scratch}/shared")
             .config("spark.local.dir", f"{scratch}/local")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    only = set(sys.argv[1:])
    spark, registry = session(cpus), catalog.queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start-up is not measured
    times: dict[str, float] = {}
    for name in BATCH + STREAMS:
        if only and name not in only:
            continue
        began = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir)[2:]}))


if __name__ == "__main__":
    main()
