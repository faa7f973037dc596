"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the folder of the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import suite  # noqa: E402
from tools.compare import local_session  # noqa: E402

HEADLINE = """
    gold_product_performance gold_daily_sales gold_fact_orders gold_fact_order_items
    gold_fact_events silver_order_items dedup_by_key dedup_rows agg_group agg_stats
    agg_distinct pivot_sum join_left join_full join_hot_inner win_row_number win_rank
    win_row_number_global win_rank_global sort_rows write_partitioned str_remove_special
""".split()


RUNS = 2


def run(spark, name: str, folder: str) -> float:
    """Seconds to build a query and produce every row of it."""
    start = time.monotonic()
    suite.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.monotonic() - start


def best(spark, name: str, folder: str) -> float:
    """The better of two runs: the first one also compiles."""
    return round(min(run(spark, name, folder) for _ in range(RUNS)), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # start-up is not a query
    seconds = {name: best(spark, name, folder) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total of the better of two runs per query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
