"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores), BENCH_RUNS (timed runs after
one warm-up, median reported), BENCH_QUERIES (comma-separated names; default: the headline set).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tapemill import session
from tapemill.catalog import QUERIES

HEADLINE = (
    "upsert_trades", "upsert_quotes", "upsert_events", "dedup_trades", "trade_event_enrich", "silver_trades",
    "silver_quotes", "silver_events", "dq_trades", "dq_quotes", "row_count_gate", "ohlcv_1m", "vwap_daily",
    "spread_1m", "event_window_join", "realized_vol", "event_window", "upsert_gold", "wap_trades",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
