"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and executed fully into a no-op sink (no collect), once
to warm up, then timed twice; the faster run is reported (local-mode timings
vary by 20-30 % between runs). Prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from barlake import fixtures as fx  # noqa: E402
from barlake.operators import bars as bars_op  # noqa: E402
from barlake.operators import blocked, indicators, marts, metrics, normalize, serving  # noqa: E402
from barlake.operators import dataset as ds  # noqa: E402
from barlake.operators.staging import stg_ohlcv  # noqa: E402
from barlake.plans import catalog  # noqa: E402
from barlake.session import build_spark, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
LINEITEM_WIDTH = "1 day"


def lineitem_bars(spark):
    trades = fx.trades_from_lineitem(fx.table(spark, SF_DIR, "lineitem"))
    return bars_op.ohlcv_bars(trades, LINEITEM_WIDTH, fx.LINEITEM_ORDER)


def build(spark):
    ready: dict[str, catalog.Prepared] = {}

    def prepare_lineitem():
        """Bars of lineitem saved with their checks, and their blocks: what the li_* queries below share."""
        ready["li"] = catalog.prepare(lineitem_bars(spark), scratch_path(spark, "bench"))
        return ready["li"].blocks

    def prepare_events():
        catalog.forget()
        return catalog.prepared(spark, SF_DIR).blocks

    def li():
        if not ready:
            prepare_lineitem()
        return ready["li"]

    li_stg = lambda: stg_ohlcv(li().raw)
    li_ind = lambda: blocked.block_indicators(li().blocks)
    ev = lambda name: catalog.QUERIES[name](spark, SF_DIR)
    return {
        # lineitem as trades: ~600k trades at sf0.1, 6 symbols, day bars. li_bars and li_prepare start from the trades;
        # the others from the saved bars, as the warehouse's models start from its raw table
        "li_bars": lambda: lineitem_bars(spark),
        "li_prepare": prepare_lineitem,
        "li_features": lambda: indicators.technical_features(li_stg()),   # per-symbol windows, for comparison
        "li_features_blocked": lambda: li_ind().drop("future_close_3"),
        "li_ml_features": lambda: blocked.mart_from_indicators(li_ind()),
        "li_snapshot": lambda: marts.symbol_snapshot(li_stg()),
        "li_snapshot_onepass": lambda: marts.symbol_snapshot_onepass(li_ind()),
        "li_symbol_bars": lambda: serving.recent_symbol_bars(li_stg(), "NO", 300),
        "li_training_frame": lambda: ds.training_frame_from(blocked.mart_from_indicators(li_ind())),
        "li_roc_auc": lambda: metrics.roc_auc(
            blocked.mart_from_indicators(li_ind()).withColumn("prob_up", F.expr(catalog.FIXED_SCORE))),
        # events as trades / messages
        "ev_bars": lambda: ev("ohlcv_bars"),
        "ev_prepare": prepare_events,
        "ev_normalize": lambda: normalize.normalize_trades(
            fx.messages_from_events(fx.table(spark, SF_DIR, "events")), keep=("msg_id",)),
        "ev_technical_features": lambda: ev("technical_features"),
        "ev_ml_features": lambda: ev("ml_features"),
        "ev_snapshot": lambda: ev("symbol_snapshot"),
        "ev_quality_report": lambda: ev("quality_report"),
        "ev_market_summary": lambda: ev("market_summary"),
        "ev_stream_bars": lambda: ev("stream_bars"),
    }


def run(df_fn) -> float:
    t0 = time.time()
    df_fn().write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main():
    spark = build_spark("barlake-bench", master=f"local[{CPUS}]", shuffle_partitions=int(CPUS),
                        extra={"spark.driver.memory": "16g"})
    qs = build(spark)
    only = set(sys.argv[1:])
    times = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        run(fn)                      # warm-up
        times[name] = round(min(run(fn), run(fn)), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
