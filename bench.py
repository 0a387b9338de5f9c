"""Time the catalog's queries; prints one JSON line.

Every query is planned and run to the end with its result thrown away, after a small
warm-up. Stream faces, which each start and drain a real streaming query, are timed
only with BENCH_STREAMS=1.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rillmart.catalog import QUERIES
from rillmart.session import build_session

#: headline queries: every mart, the joins behind them, and the history operators
HEADLINE = (
    "dws_traffic_page_view", "dws_keyword", "dws_home_detail_uv", "dws_user_login",
    "dws_user_register", "dws_cart_uu", "dws_order_users", "dws_payment_users",
    "dws_province_order", "dws_sku_order", "dws_refund",
    "order_wide", "dwd_trade_order_detail", "dwd_trade_pay_detail_suc", "dwd_trade_order_refund",
    "dwd_trade_refund_pay_suc", "dwd_trade_cancel_detail", "dwd_trade_cart_add", "base_log", "scan_changelog",
    "new_visitor_fix", "unique_visitors", "user_jump", "login_backflow", "order_user_flags",
    "dedup_latest", "upsert_latest", "cdc_current_state", "dim_upsert", "dim_snowflake",
    "join_within_interval", "window_keyed_sum", "window_count_distinct", "keyword_tokens",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        zone="UTC",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(HEADLINE)
    if os.environ.get("BENCH_STREAMS") == "1":
        names += [n for n in QUERIES if n.startswith("stream_")]

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in ("dws_traffic_page_view", "dws_province_order"):
        run(name)
    times = {name: round(run(name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
