"""Headline-query benchmark: prints one JSON line with seconds per query.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Each query is run to
completion through the no-op sink (full computation, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.registry import load_all  # noqa: E402
from tidemark.session import get_session  # noqa: E402

HEADLINE = ["q2_coin_features", "q4_spot_features", "q6_btc_feature_table", "j1_asof_spot",
            "j6_range_join_trades", "e9_tau_sigma_grid", "l8_fifo_lots", "m13_posterior_predictive"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="tidemark-bench")
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    # warm-up: JVM, codegen caches, parquet footers
    reg["f1_coin_filter"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    out = {}
    for n in names:
        t0 = time.time()
        reg[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        out[n] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
