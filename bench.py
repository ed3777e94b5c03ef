"""Times the headline queries and prints one JSON line.

Every query starts without stored tables, so its time includes building all it needs
from the raw tables. The ``_from_history`` figures start from stored field history and
landed intervals, as a build does once these exist.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stakeline.plans import registry, store  # noqa: E402
from stakeline.plans.domain import Domain  # noqa: E402
from stakeline.session import build_session  # noqa: E402

HEADLINES = (
    "Q1_country_by_commodity",
    "A2_field_history",
    "A4_operator_rollup",
    "J5_match_cascade",
    "X19_field_month_category",
    "A18_attribution",
    "A13_window_candidates",
    "X17_company_values",
    "A21_group_series",
    "A23_group_field_breakdown",
    "Q4_by_field_top_n",
    "A28_policy_comparison",
    "A31_zero_interest_profile",
)

FROM_HISTORY = ("X19_field_month_category", "A18_attribution", "Q16_history_join_diagnostic", "Q16_history_diagnostic_report")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false",
                          spark_driver_memory=os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = registry.queries(), {}
    # one untimed run, so that the first figures are not those of a cold virtual machine
    queries["A23_group_field_breakdown"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def timed(name: str) -> float:
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.time() - started, 3)

    for name in HEADLINES:
        store.forget()
        times[name] = timed(name)
    store.forget()
    ready = Domain(spark, sf_dir)
    ready.side_by_side("history", "stakes")
    for name in FROM_HISTORY:
        store.forget(keep=("history", "stakes"))
        times[f"{name}_from_history"] = timed(name)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
