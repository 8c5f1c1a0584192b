"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from caudal.session import local_session  # noqa: E402
from workload import lake  # noqa: E402
from workload.queries import CATALOG  # noqa: E402

HEADLINE = (
    "kpi_01_climate_water", "kpi_02_mobility", "kpi_03_critical_zones", "kpi_04_health_risk", "kpi_05_urban_rural_gap",
    "kpi_06_water_income", "kpi_07_water_sanitation_gap", "zone_summary", "metric_registry", "dim_customer", "chained_lookups",
    "salted_verified_lookup", "group_statistic_on_detail", "supplier_trend", "yearly_changes", "largest_balances_by_nation",
    "overall_ranking", "ranking_with_many_ties", "descriptive_statistics_by_group", "column_profile", "duplicate_rows",
    "unresolved_keys", "landing_by_country_year", "replace_one_partition",
)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, int(cores) if cores.isdigit() else 8)
    spark.read.parquet(f"{d}/orders.parquet").count()  # start the executors before the first timing

    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("refresh_clean_layer", lambda: lake.clean_layer(spark, d))
    timed("refresh_star_schema", lambda: lake.model_layer(spark, d))
    timed("refresh_gold_layer", lambda: lake.gold_layer(spark, d))
    for name in HEADLINE:
        timed(name, lambda: CATALOG[name].run(spark, d).write.format("noop").mode("overwrite").save())
    sf = Path(d).name.removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
