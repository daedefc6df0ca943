"""Registry of named queries: each takes (spark, sf_dir) and returns a
DataFrame over the driver's tables; most carry a DuckDB oracle statement.

Queries over ``events`` fold trades into 1-hour bars (FIXTURES §2.1): at
10 s nearly every bar would hold a single trade. DOUBLE outputs are rounded
to 6 places on both sides so the comparison does not hinge on the last bits
of floating-point sums taken in a different order."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import fixtures as fx
from barlake.functions.exprs import fixed_text, round_doubles, utc_wall_clock
from barlake.operators import bars as bars_op
from barlake.operators import blocked
from barlake.operators import dataset as ds
from barlake.operators import indicators as ind
from barlake.operators import marts
from barlake.operators import metrics as mx
from barlake.operators import model as ml
from barlake.operators import normalize as norm
from barlake.operators import quality, report, serving
from barlake.operators.normalize import decode_trades
from barlake.operators.staging import stg_ohlcv
from barlake.plans import oracle as O
from barlake.plans.warehouse import refresh
from barlake.schemas import BAR_COLUMNS, FEATURE_COLUMNS
from barlake.session import scratch_path
from barlake.sources import lake
from barlake.sources.metadata import read_metadata, write_metadata
from barlake.streaming import bars_stream
from barlake.streaming import files as sfiles
from barlake.streaming import reconcile
from barlake.streaming import state as stream_state

WIDTH = O.BAR_WIDTH

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run
    return deco


# ---------------------------------------------------------------- inputs
def trades(spark, sf):
    return fx.trades_from_events(fx.table(spark, sf, "events"))


def bars(spark, sf):
    return bars_op.ohlcv_bars(trades(spark, sf), WIDTH, fx.EVENTS_ORDER)


def stg(spark, sf):
    return stg_ohlcv(bars(spark, sf))


@dataclass
class Prepared:
    """What the indicator, snapshot and report queries share, as the warehouse's models share the raw table: the bars,
    aggregated from the trades once and saved, and their blocks."""
    raw: DataFrame
    raw_checks: quality.Checks
    blocks: DataFrame


_PREPARED: dict = {}


def prepare(raw: DataFrame, path: str) -> Prepared:
    """Saves bars, with their checks counted on the way, and their blocks below ``path``."""
    checks = quality.Checks(quality.RAW)
    checks.on(raw).write.parquet(f"{path}/raw")
    saved = raw.sparkSession.read.schema(raw.schema).parquet(f"{path}/raw")
    blocks = blocked.save_blocks(stg_ohlcv(saved), f"blocks_{uuid.uuid4().hex}", f"{path}/blocks")
    return Prepared(saved, checks, blocks)


def prepared(spark, sf) -> Prepared:
    """Of the trades of a table folder, once in a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARED:
        _PREPARED[key] = prepare(bars(spark, sf), scratch_path(spark, "prepared"))
    return _PREPARED[key]


def forget() -> None:
    """The next query of every folder prepares its bars again."""
    _PREPARED.clear()


def stg_saved(spark, sf):
    return stg_ohlcv(prepared(spark, sf).raw)


def indicators_all(spark, sf):
    """Indicators + 3-bar look-ahead over the saved blocks (skew-safe, no exchange)."""
    return blocked.block_indicators(prepared(spark, sf).blocks)


def feats(spark, sf):
    return indicators_all(spark, sf).drop("future_close_3")


def mart(spark, sf):
    return blocked.mart_from_indicators(indicators_all(spark, sf))


# ---------------------------------------------------------------- bars
BAR_DOUBLES = ("open", "high", "low", "close", "volume", "vwap", "net_signed_volume",
               "order_flow_imbalance")


@register("ohlcv_bars", O.with_ctes(*O.CHAIN_BARS, body="SELECT * FROM bars", doubles=BAR_DOUBLES))
def q_ohlcv_bars(spark, sf):
    """OHLCV + order-flow bars per (1 h window, symbol)."""
    return bars(spark, sf)


@register("order_flow", O.with_ctes(*O.CHAIN_BARS[:1], body="""
SELECT symbol, trade_id, event_ts, price, quantity, is_buyer_maker,
       CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END AS signed_qty,
       price * quantity AS notional
FROM trades""", doubles=("price", "quantity", "signed_qty", "notional")))
def q_order_flow(spark, sf):
    """Signed quantity and notional per trade."""
    return bars_op.order_flow(trades(spark, sf))


@register("stg_ohlcv", O.with_ctes(*O.CHAIN_STG, body="SELECT * FROM stg", doubles=BAR_DOUBLES))
def q_stg_ohlcv(spark, sf):
    """Typed staging with the degenerate-bar guard."""
    return stg(spark, sf)


# ---------------------------------------------------------------- indicators
FEAT_DOUBLES = BAR_DOUBLES + ("ret_1", "log_ret_1", "sma_6", "sma_30", "px_vs_sma30",
                              "volatility_30", "ofi_6", "rel_volume")


@register("returns", O.with_ctes(*O.CHAIN_FEATS, body="""
SELECT symbol, window_start, close, ret_1, log_ret_1 FROM feats""",
                                 doubles=("close", "ret_1", "log_ret_1")))
def q_returns(spark, sf):
    """Simple and log return against the previous bar."""
    return feats(spark, sf).select("symbol", "window_start", "close", "ret_1", "log_ret_1")


@register("moving_averages", O.with_ctes(*O.CHAIN_FEATS, body="""
SELECT symbol, window_start, close, sma_6, sma_30, px_vs_sma30 FROM feats""",
                                         doubles=("close", "sma_6", "sma_30", "px_vs_sma30")))
def q_moving_averages(spark, sf):
    """6- and 30-bar moving averages, distance to the 30-bar one."""
    return feats(spark, sf).select("symbol", "window_start", "close", "sma_6", "sma_30", "px_vs_sma30")


@register("volatility", O.with_ctes(*O.CHAIN_FEATS, body="""
SELECT symbol, window_start, log_ret_1, volatility_30 FROM feats""",
                                    doubles=("log_ret_1", "volatility_30")))
def q_volatility(spark, sf):
    """30-bar sample standard deviation of log returns."""
    return feats(spark, sf).select("symbol", "window_start", "log_ret_1", "volatility_30")


@register("flow_and_volume", O.with_ctes(*O.CHAIN_FEATS, body="""
SELECT symbol, window_start, order_flow_imbalance, ofi_6, volume, rel_volume FROM feats""",
                                         doubles=("order_flow_imbalance", "ofi_6", "volume",
                                                  "rel_volume")))
def q_flow_and_volume(spark, sf):
    """6-bar mean order-flow imbalance, volume relative to its 30-bar mean."""
    return feats(spark, sf).select("symbol", "window_start", "order_flow_imbalance", "ofi_6", "volume",
                                   "rel_volume")


@register("future_close", O.with_ctes(*O.CHAIN_MART, body="""
SELECT symbol, window_start, close, future_close_3 FROM ahead""", doubles=("close", "future_close_3")))
def q_future_close(spark, sf):
    """Close three bars ahead."""
    return indicators_all(spark, sf).select("symbol", "window_start", "close", "future_close_3")


@register("technical_features", O.with_ctes(*O.CHAIN_FEATS, body="SELECT * FROM feats",
                                            doubles=FEAT_DOUBLES))
def q_technical_features(spark, sf):
    """The 20-column indicator table (blocked windows, the default)."""
    return feats(spark, sf)


@register("technical_features_window", O.with_ctes(*O.CHAIN_FEATS, body="SELECT * FROM feats",
                                                   doubles=FEAT_DOUBLES))
def q_technical_features_window(spark, sf):
    """The same table with plain per-symbol windows, the reference's plan
    (one task per symbol: fine for many small symbols, not for a hot one)."""
    return ind.technical_features(stg_saved(spark, sf))



# Small blocks on the small fixture so that every symbol spans many blocks
# and the halo logic is exercised; the library default is 200,000 rows.
QUERY_BLOCK_ROWS = 97


@register("technical_features_blocked", O.with_ctes(*O.CHAIN_FEATS, body="SELECT * FROM feats",
                                                    doubles=FEAT_DOUBLES))
def q_technical_features_blocked(spark, sf):
    """Section 4 scale design: indicators over bounded blocks with halos."""
    return blocked.blocked_technical_features(stg(spark, sf), QUERY_BLOCK_ROWS)


# ---------------------------------------------------------------- marts
MART_DOUBLES = ("close", "ret_1", "log_ret_1", "px_vs_sma30", "volatility_30", "order_flow_imbalance",
                "ofi_6", "rel_volume", "future_close_3")


@register("ml_features", O.with_ctes(*O.CHAIN_MART, body="SELECT * FROM mart", doubles=MART_DOUBLES))
def q_ml_features(spark, sf):
    """Labelled model mart."""
    return mart(spark, sf)


@register("ml_features_blocked", O.with_ctes(*O.CHAIN_MART, body="SELECT * FROM mart", doubles=MART_DOUBLES))
def q_ml_features_blocked(spark, sf):
    """The labelled mart from the blocked pass (indicators + look-ahead together)."""
    return blocked.blocked_ml_features(stg(spark, sf), QUERY_BLOCK_ROWS)


@register("ml_features_from_raw", O.with_ctes(*O.CHAIN_MART, body="""
SELECT * EXCLUDE (future_close_3) FROM mart""", doubles=MART_DOUBLES[:-1]))
def q_ml_features_from_raw(spark, sf):
    """K2: the mart rebuilt in one plan from raw bars, with the rebuild's
    column list (no future_close_3)."""
    return blocked.blocked_ml_features(stg_saved(spark, sf)).drop("future_close_3")


@register("latest_bar", O.with_ctes(*O.CHAIN_SNAPSHOT, body="""
SELECT *, CAST(1 AS BIGINT) AS rn FROM newest""", doubles=FEAT_DOUBLES))
def q_latest_bar(spark, sf):
    """Newest indicator row per symbol."""
    return marts.latest_indicators(stg_saved(spark, sf))


@register("symbol_totals", O.with_ctes(*O.CHAIN_SNAPSHOT, body="SELECT * FROM extent",
                                       doubles=("high_window", "low_window", "total_volume")))
def q_symbol_totals(spark, sf):
    """Per-symbol high, low, volume and bar count over all history."""
    return marts.symbol_totals(stg_saved(spark, sf))


SNAP_DOUBLES = ("last_price", "last_return", "px_vs_sma30", "volatility_30", "order_flow_imbalance",
                "rel_volume", "high_window", "low_window", "total_volume")
SNAPSHOT_SQL = O.with_ctes(*O.CHAIN_SNAPSHOT, body="SELECT * FROM snapshot", doubles=SNAP_DOUBLES)


@register("symbol_snapshot", SNAPSHOT_SQL)
def q_symbol_snapshot(spark, sf):
    """Latest row per symbol joined to its totals."""
    return marts.symbol_snapshot(stg_saved(spark, sf))


@register("symbol_snapshot_onepass", SNAPSHOT_SQL)
def q_symbol_snapshot_onepass(spark, sf):
    """Same snapshot from the whole indicator table by a single aggregation, as
    the warehouse derives it from the saved table."""
    return marts.symbol_snapshot_onepass(feats(spark, sf))


# ---------------------------------------------------------------- messages

CANON_SQL = """
SELECT event_id AS msg_id, lower(upper(event_type)) AS symbol, event_id AS trade_id, value AS price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
       CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS trade_time,
       (user_id % 2 = 0) AS is_buyer_maker
FROM events"""


@register("normalize_trades", f"""
SELECT * REPLACE (round(price, 6) AS price, round(quantity, 6) AS quantity) FROM ({CANON_SQL}
WHERE event_type <> 'error' AND event_id % 101 <> 0) q""")
def q_normalize_trades(spark, sf):
    """Envelope unwrap, trade filter, canonical projection of raw messages."""
    msgs = fx.messages_from_events(fx.table(spark, sf, "events"))
    return norm.normalize_trades(msgs, keep=("msg_id",), with_ingest_time=False)


@register("normalize_rejects", """
SELECT event_id AS msg_id, 'malformed' AS reason FROM events WHERE event_id % 101 = 0""")
def q_normalize_rejects(spark, sf):
    """Q8, Q9: unreadable messages go to a reject set with a reason."""
    msgs = fx.messages_from_events(fx.table(spark, sf, "events"))
    return norm.normalize_rejects(msgs, keep=("msg_id",)).select("msg_id", "reason")


@register("trade_messages", O.with_ctes(O.TRADES_CTE, body="""
SELECT symbol AS key,
       to_json({'symbol': symbol, 'trade_id': trade_id, 'price': price, 'quantity': quantity,
                'trade_time': trade_time, 'is_buyer_maker': is_buyer_maker}) AS value
FROM trades"""))
def q_trade_messages(spark, sf):
    """A2: keyed JSON records of normalised trades (key = symbol)."""
    return norm.encode_trades(trades(spark, sf).drop("ingest_time"))


@register("decode_trades", O.with_ctes(O.TRADES_CTE, body="""
SELECT symbol, trade_id, round(price, 6) AS price, round(quantity, 6) AS quantity, trade_time,
       is_buyer_maker, epoch_ms(trade_time) AS event_ts
FROM trades"""))
def q_decode_trades(spark, sf):
    """Bus records (bytes) -> typed trades with event time from epoch ms."""
    records = norm.encode_trades(trades(spark, sf)).select(F.col("value").cast("binary").alias("value"))
    return norm.decode_trades(records).drop("ingest_time").withColumn("event_ts", utc_wall_clock("event_ts"))


# ---------------------------------------------------------------- lake

BARS_SQL = O.with_ctes(*O.CHAIN_BARS, body="SELECT * FROM bars", doubles=BAR_DOUBLES)


@register("lake_roundtrip", BARS_SQL)
def q_lake_roundtrip(spark, sf):
    """Bars written partitioned by symbol and scanned back (symbol from the path)."""
    path = scratch_path(spark, "lake")
    lake.write_bars(bars(spark, sf), path)
    return lake.scan_lake(spark, path)


@register("raw_table_refresh", BARS_SQL)
def q_raw_table_refresh(spark, sf):
    """Full refresh of raw.ohlcv_10s, read back as a table."""
    # a warehouse root of its own per call: a DataFrame returned earlier keeps its files
    return lake.refresh_raw_table(spark, bars(spark, sf), root=scratch_path(spark, "warehouse"))


@register("load_audit", O.with_ctes(*O.CHAIN_BARS, body="""
SELECT CAST(count(*) AS BIGINT) AS rows, count(DISTINCT symbol) AS files FROM bars"""))
def q_load_audit(spark, sf):
    """Row and file count of a lake (here with one file per symbol)."""
    path = scratch_path(spark, "lake")
    bars(spark, sf).repartition("symbol").write.partitionBy("symbol").parquet(path)
    return lake.load_audit(lake.scan_lake(spark, path))


@register("union_bars", BARS_SQL)
def q_union_bars(spark, sf):
    """G1: the per-symbol frames of a bar lake stacked by column name."""
    path = scratch_path(spark, "lake")
    lake.write_bars(bars(spark, sf), path)
    return lake.read_partitioned(spark, path, merge=True).select(*BAR_COLUMNS)


WITHOUT_VWAP = "symbol < 'p'"


@register("union_bars_merged", O.with_ctes(*O.CHAIN_BARS, body=f"""
SELECT * REPLACE (CASE WHEN NOT ({WITHOUT_VWAP}) THEN vwap END AS vwap) FROM bars""", doubles=BAR_DOUBLES))
def q_union_bars_merged(spark, sf):
    """G1: folders whose files lack a column, stacked by name in one scan."""
    path = scratch_path(spark, "lake")
    every = bars(spark, sf)
    lake.write_bars(every.where(WITHOUT_VWAP).drop("vwap"), path)
    lake.write_bars(every.where(f"NOT ({WITHOUT_VWAP})"), path, mode="append")
    return lake.read_partitioned(spark, path, merge=True).select(*BAR_COLUMNS)


# ---------------------------------------------------------------- serving

SERIES_COLS = ", ".join(serving.BAR_SERIES)
SERIES_DOUBLES = tuple(c for c in serving.BAR_SERIES if c != "window_start")


@register("symbol_bars", O.with_ctes(*O.CHAIN_FEATS, body=f"""
SELECT * FROM (SELECT {SERIES_COLS} FROM feats WHERE symbol = lower('VIEW')
               ORDER BY window_start DESC LIMIT 300) ORDER BY window_start""",
                                     doubles=SERIES_DOUBLES))
def q_symbol_bars(spark, sf):
    """Last 300 bars of one symbol (upper-case input), ascending."""
    return serving.recent_symbol_bars(stg_saved(spark, sf), "VIEW", 300)


@register("symbol_bars_padded", ORACLES["symbol_bars"])
def q_symbol_bars_padded(spark, sf):
    """F1 over the bar lake with a padded read: the symbol and the time of its
    newest 300 + 30 bars are filters of the scan."""
    path = scratch_path(spark, "lake")
    lake.write_bars(bars(spark, sf), path)
    return serving.recent_symbol_bars(stg_ohlcv(lake.scan_lake(spark, path)), "VIEW", 300)


@register("symbols", O.with_ctes(*O.CHAIN_FEATS, body="SELECT DISTINCT symbol FROM stg ORDER BY symbol"))
def q_symbols(spark, sf):
    """Distinct symbols, sorted."""
    return serving.symbols(stg_saved(spark, sf))


@register("kpi_tiles", O.with_ctes(*O.CHAIN_SNAPSHOT, body="""
SELECT symbol, close, px_vs_sma30, volatility_30, order_flow_imbalance,
       '$' || format('{:,.2f}', close) AS last_price_text,
       printf('%+.2f', px_vs_sma30 * 100) || '%' AS vs_sma30_text,
       printf('%.3f', volatility_30 * 100) || '%' AS volatility_text,
       printf('%+.2f', order_flow_imbalance) AS ofi_text
FROM newest""", doubles=("close", "px_vs_sma30", "volatility_30", "order_flow_imbalance")))
def q_kpi_tiles(spark, sf):
    """KPI texts of the latest bar per symbol."""
    return serving.kpi_tiles(marts.latest_indicators(stg_saved(spark, sf)).drop("rn"))


REQ_DEFAULTS_SQL = ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), {serving.REQUEST_DEFAULTS[c]}) AS {c}" for c in serving.FEATURE_COLUMNS)


@register("validate_requests", O.with_ctes(*O.CHAIN_FEATS, f"""
req AS (SELECT symbol, window_start, {REQ_DEFAULTS_SQL} FROM feats)""", body="""
SELECT *, (volatility_30 >= 0 AND rel_volume >= 0 AND trade_count >= 0) AS accepted FROM req""",
                                           doubles=tuple(serving.FEATURE_COLUMNS)))
def q_validate_requests(spark, sf):
    """Scoring requests (every indicator row) with defaults and constraints."""
    req = feats(spark, sf).select("symbol", "window_start", *serving.FEATURE_COLUMNS)
    return serving.validate_requests(req)


FIXED_SCORE = "1.0 / (1.0 + exp(-50.0 * px_vs_sma30))"


@register("decide", O.with_ctes(*O.CHAIN_MART, body=f"""
SELECT symbol, window_start, round({FIXED_SCORE}, 4) AS prob_up,
       CASE WHEN {FIXED_SCORE} >= 0.5 THEN 'up' ELSE 'down' END AS direction,
       round(abs({FIXED_SCORE} - 0.5) * 2, 4) AS confidence
FROM mart""", doubles=("prob_up", "confidence")))
def q_decide(spark, sf):
    """K8: direction and confidence over a fixed logistic score of px_vs_sma30."""
    scored = mart(spark, sf).select("symbol", "window_start", F.expr(FIXED_SCORE).alias("prob_up"))
    return serving.decide(scored).select("symbol", "window_start", "prob_up", "direction", "confidence")


# ---------------------------------------------------------------- quality


def _nn(table, rel, c):
    return (f"SELECT '{table}.not_null.{c}' AS check_name, "
            f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {rel}")


QUALITY_SQL = O.with_ctes(*O.CHAIN_MART, O.SNAPSHOT_CTE, body="\nUNION ALL\n".join([
    _nn("raw.ohlcv_10s", "bars", "symbol"), _nn("raw.ohlcv_10s", "bars", "window_start"),
    _nn("raw.ohlcv_10s", "bars", "close"),
    _nn("marts.mart_ml_features", "mart", "symbol"), _nn("marts.mart_ml_features", "mart", "label_up_3"),
    _nn("marts.mart_ml_features", "mart", "volatility_30"),
    "SELECT 'marts.mart_ml_features.accepted_values.label_up_3', CAST(count(*) FILTER "
    "(WHERE label_up_3 IS NOT NULL AND label_up_3 NOT IN (0, 1)) AS BIGINT) FROM mart",
    "SELECT 'marts.mart_ml_features.positive_prices', CAST(count(*) FILTER (WHERE close <= 0) AS BIGINT) "
    "FROM mart",
    _nn("marts.mart_symbol_snapshot", "snapshot", "symbol"),
    _nn("marts.mart_symbol_snapshot", "snapshot", "last_price"),
    "SELECT 'marts.mart_symbol_snapshot.unique.symbol', CAST(count(*) AS BIGINT) FROM "
    "(SELECT symbol FROM snapshot WHERE symbol IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
]))


@register("quality_report", QUALITY_SQL)
def q_quality_report(spark, sf):
    """Failing-row count of every declared check, counted while the tables are written."""
    p, path = prepared(spark, sf), scratch_path(spark, "checked")
    of_mart, of_snapshot = quality.Checks(quality.MART), quality.Checks(quality.SNAPSHOT)
    of_mart.on(mart(spark, sf)).write.parquet(f"{path}/mart")
    of_snapshot.on(snapshot(spark, sf)).write.parquet(f"{path}/snapshot")
    return quality.observed_report(spark, p.raw_checks, of_mart, of_snapshot,
                                   spark.read.parquet(f"{path}/snapshot"))


@register("nonpositive_prices", O.with_ctes(*O.CHAIN_MART, body="SELECT * FROM mart WHERE close <= 0",
                                            doubles=MART_DOUBLES))
def q_nonpositive_prices(spark, sf):
    """Singular test rows (expected empty)."""
    return quality.nonpositive_prices(mart(spark, sf))


# ---------------------------------------------------------------- reports


def snapshot(spark, sf):
    return marts.symbol_snapshot(stg_saved(spark, sf))


def _z(c):
    return f"coalesce(CASE WHEN isnan({c}) THEN 0 ELSE {c} END, 0)"


LINE_SQL = (
    "replace(upper(symbol), 'USDT', '') || ': last move ' || printf('%+.2f', " + _z("last_return") + " * 100)"
    " || '%, trading ' || CASE WHEN " + _z("px_vs_sma30") + " > 0 THEN 'above' ELSE 'below' END"
    " || ' its 30-bar average (' || CASE WHEN " + _z("px_vs_sma30") + " > 0 THEN 'bullish' ELSE 'bearish' END"
    " || ' momentum), ' || CASE WHEN " + _z("volatility_30") + " > 0.004 THEN 'elevated' ELSE 'subdued' END"
    " || ' volatility, order flow shows ' || CASE WHEN " + _z("order_flow_imbalance") + " > 0.05 THEN "
    "'net buying' WHEN " + _z("order_flow_imbalance") + " < -0.05 THEN 'net selling' ELSE 'balanced flow' "
    "END || '.'")
FACTS_SQL = "SELECT " + ", ".join(report.FACT_COLUMNS) + " FROM snapshot"


@register("summary_facts", O.with_ctes(*O.CHAIN_SNAPSHOT, body=FACTS_SQL + " ORDER BY symbol",
                                       doubles=tuple(report.FACT_COLUMNS[1:])))
def q_summary_facts(spark, sf):
    """Snapshot facts of the summary, ordered by symbol."""
    return report.summary_facts(snapshot(spark, sf))


@register("symbol_descriptions", O.with_ctes(*O.CHAIN_SNAPSHOT, body=f"""
SELECT symbol, {LINE_SQL} AS line FROM snapshot"""))
def q_symbol_descriptions(spark, sf):
    """L1: one templated sentence per symbol."""
    return report.symbol_descriptions(snapshot(spark, sf).select(*report.FACT_COLUMNS))


TONE = "CASE WHEN above > assets / 2 THEN 'broadly constructive' ELSE 'cautious' END"


@register("market_tone", O.with_ctes(*O.CHAIN_SNAPSHOT, body=f"""
SELECT above, assets, {TONE} AS tone FROM (
  SELECT CAST(count(*) FILTER (WHERE {_z('px_vs_sma30')} > 0) AS BIGINT) AS above,
         CAST(count(*) AS BIGINT) AS assets FROM snapshot)"""))
def q_market_tone(spark, sf):
    """Conditional count of symbols above their average, and the tone."""
    return report.market_tone(snapshot(spark, sf).select(*report.FACT_COLUMNS))


@register("market_summary", O.with_ctes(*O.CHAIN_SNAPSHOT, body=f"""
SELECT assets, CASE WHEN assets = 0 THEN '{report.EMPTY_SUMMARY}'
  ELSE 'Market read (' || assets || ' assets) — tone is ' || {TONE} || '.' || chr(10) || chr(10) ||
       lines END AS summary
FROM (SELECT CAST(count(*) AS BIGINT) AS assets,
             count(*) FILTER (WHERE {_z('px_vs_sma30')} > 0) AS above,
             string_agg('- ' || line, chr(10) ORDER BY symbol) AS lines
      FROM (SELECT symbol, px_vs_sma30, {LINE_SQL} AS line FROM snapshot))"""))
def q_market_summary(spark, sf):
    """L3: the assembled market summary text."""
    return report.market_summary(snapshot(spark, sf).select(*report.FACT_COLUMNS))


# ---------------------------------------------------------------- streaming

STREAM_FILES = 8


def replayed(spark, sf, base: str):
    """The trades as time-ordered record files, read as a stream."""
    sfiles.write_record_files(trades(spark, sf), f"{base}/in", STREAM_FILES)
    return decode_trades(sfiles.record_stream(spark, f"{base}/in"))


def streamed_bars(spark, sf) -> str:
    """Lake root after the bar query has run to completion."""
    base = scratch_path(spark, "stream")
    bars_stream.start_bar_sink(replayed(spark, sf, base), f"{base}/lake", f"{base}/chk", width=WIDTH,
                               available_now=True,
                               state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return f"{base}/lake"


STREAM_BARS_SQL = O.with_ctes(O.TRADES_MS_CTE, O.BARS_CTE, body="""
SELECT * FROM bars
WHERE window_end <= (SELECT max(event_ts) FROM trades) - INTERVAL 30 SECOND""", doubles=BAR_DOUBLES)


@register("stream_bars", STREAM_BARS_SQL)
def q_stream_bars(spark, sf):
    """Watermarked bars streamed to a partitioned Parquet sink
    (windows still open at the end of the input are not emitted)."""
    root = streamed_bars(spark, sf)
    return sfiles.ntz_bars(lake.read_partitioned(spark, f"{root}/features/bars"))


@register("lake_scan", STREAM_BARS_SQL)
def q_lake_scan(spark, sf):
    """A5: the batch loader's scan of the bar lake written by the streaming job
    (recursive, symbol recovered from the folder names)."""
    root = streamed_bars(spark, sf)
    return sfiles.ntz_bars(lake.scan_lake(spark, f"{root}/features/bars"))


@register("stream_raw_trades", O.with_ctes(O.TRADES_MS_CTE, body="""
SELECT symbol, trade_id, round(price, 6) AS price, round(quantity, 6) AS quantity, trade_time,
       is_buyer_maker, event_ts FROM trades"""))
def q_stream_raw_trades(spark, sf):
    """A3: decoded trades streamed to a Parquet lake partitioned by symbol."""
    base = scratch_path(spark, "stream")
    bars_stream.start_raw_sink(replayed(spark, sf, base), f"{base}/lake", f"{base}/chk",
                               available_now=True).awaitTermination()
    raw = lake.read_partitioned(spark, f"{base}/lake/raw/trades")
    return raw.select("symbol", "trade_id", "price", "quantity", "trade_time", "is_buyer_maker",
                      utc_wall_clock("event_ts").alias("event_ts"))


@register("stream_state", O.with_ctes(O.TRADES_MS_CTE, O.BARS_CTE, body="""
SELECT * FROM bars
WHERE window_end > (SELECT max(event_ts) FROM trades) - INTERVAL 30 SECOND""", doubles=BAR_DOUBLES))
def q_stream_state(spark, sf):
    """The bars that the state of the bar query still holds when the replay has ended."""
    base = scratch_path(spark, "stream")
    bars_stream.start_bar_sink(replayed(spark, sf, base), f"{base}/lake", f"{base}/chk", width=WIDTH,
                               available_now=True,
                               state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return sfiles.ntz_bars(stream_state.open_bars(spark, f"{base}/chk/bars"))


# Trades that reach the bus only after all others, in a run of their own.
LATE = "trade_id % 50 = 0"


def late_run(spark, sf) -> str:
    """Folder with the lake of raw trades and bars (compacted) after a replay whose late trades came last."""
    base = scratch_path(spark, "late")
    t = trades(spark, sf)
    sfiles.write_record_files(t.where(f"NOT ({LATE})"), f"{base}/in", 2)
    for late in (None, t.where(LATE)):
        if late is not None:
            norm.encode_trades(late).write.mode("append").json(f"{base}/in")
        records = decode_trades(sfiles.record_stream(spark, f"{base}/in", 1000 if late is not None else 1))
        for q in bars_stream.start_pipeline(records, f"{base}/lake", f"{base}/chk", width=WIDTH, available_now=True,
                                            state_partitions=spark.sparkContext.defaultParallelism):
            q.awaitTermination()
    lake.compact(spark, f"{base}/lake/features/bars", f"{base}/bars")
    return base


LATE_BARS_SQL = O.with_ctes(O.TRADES_MS_CTE, body=f"""
SELECT symbol, window_start, window_start + INTERVAL 1 HOUR AS window_end,
       count(*) FILTER (WHERE NOT ({LATE})) AS emitted, count(*) AS actual
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, event_ts) AS window_start FROM trades)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM trades WHERE NOT ({LATE})) - INTERVAL 30 SECOND
GROUP BY symbol, window_start HAVING count(*) FILTER (WHERE {LATE}) > 0""")


@register("late_bars", LATE_BARS_SQL)
def q_late_bars(spark, sf):
    """I4: emitted bars that lack trades which came after their window was closed."""
    base = late_run(spark, sf)
    found = reconcile.late_bars(lake.read_partitioned(spark, f"{base}/lake/raw/trades"),
                                lake.read_partitioned(spark, f"{base}/bars"), WIDTH)
    return sfiles.ntz_bars(found)


@register("repaired_bars", STREAM_BARS_SQL)
def q_repaired_bars(spark, sf):
    """I4: the bar lake after its late bars were computed again and their symbol folders overwritten."""
    base = late_run(spark, sf)
    reconcile.repair(spark, lake.read_partitioned(spark, f"{base}/lake/raw/trades"), f"{base}/bars", WIDTH)
    return sfiles.ntz_bars(lake.read_partitioned(spark, f"{base}/bars"))


# ---------------------------------------------------------------- dataset

CLEAN_CTE = """
clean AS (
  SELECT * FROM mart
  WHERE label_up_3 IS NOT NULL
    AND """ + " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)) AND NOT isinf(CAST({c} AS DOUBLE))"
                        for c in FEATURE_COLUMNS) + """),
indexed AS (
  SELECT *, CAST(row_number() OVER (ORDER BY window_start, symbol) - 1 AS BIGINT) AS row_idx FROM clean),
sized AS (SELECT *, count(*) OVER () AS n_rows FROM indexed)"""
CHAIN_INDEXED = O.CHAIN_MART + (CLEAN_CTE,)


def frame(spark, sf):
    return ds.training_frame_from(mart(spark, sf))


@register("time_index", O.with_ctes(*CHAIN_INDEXED, body="SELECT symbol, window_start, row_idx FROM indexed"))
def q_time_index(spark, sf):
    """Global position in (window_start, symbol) order, computed distributed."""
    return frame(spark, sf).select("symbol", "window_start", "row_idx")


@register("training_frame", O.with_ctes(*CHAIN_INDEXED, body="SELECT * FROM indexed", doubles=MART_DOUBLES))
def q_training_frame(spark, sf):
    """Cleaned, time-ordered training frame."""
    return frame(spark, sf)


@register("latest_features", O.with_ctes(*CHAIN_INDEXED, body="SELECT symbol, window_start, " + ", ".join(
    FEATURE_COLUMNS) + """ FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM indexed) WHERE rn = 1""",
                                         doubles=tuple(c for c in FEATURE_COLUMNS if c != "trade_count")))
def q_latest_features(spark, sf):
    """the last feature row of every symbol of the training frame."""
    return marts.latest_features(ds.clean(mart(spark, sf))).select("symbol", "window_start", *FEATURE_COLUMNS)


@register("feature_matrix", O.with_ctes(*CHAIN_INDEXED, body="SELECT symbol, window_start, " + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS) + ", label_up_3 FROM indexed",
                                        doubles=tuple(FEATURE_COLUMNS)))
def q_feature_matrix(spark, sf):
    """Features as DOUBLE in fixed order, label as INT."""
    return ds.feature_matrix(frame(spark, sf))


@register("walk_forward_folds", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT symbol, window_start, row_idx,
       CAST(CASE WHEN n_rows // 6 > 0 AND row_idx >= n_rows - 5 * (n_rows // 6)
                 THEN (row_idx - (n_rows - 5 * (n_rows // 6))) // (n_rows // 6) END AS INTEGER) AS test_fold
FROM sized"""))
def q_walk_forward_folds(spark, sf):
    """K3: the fold that tests each row (5 expanding folds)."""
    return ds.walk_forward_folds(frame(spark, sf)).select("symbol", "window_start", "row_idx", "test_fold")


@register("holdout_split", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT symbol, window_start, row_idx,
       CASE WHEN row_idx < floor(n_rows * 0.8) THEN 'train' ELSE 'test' END AS split
FROM sized"""))
def q_holdout_split(spark, sf):
    """K4: time-ordered 80/20 hold-out."""
    return ds.holdout_split(frame(spark, sf)).select("symbol", "window_start", "row_idx", "split")


@register("split_stats", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT count(*) FILTER (WHERE row_idx < floor(n_rows * 0.8)) AS n_train,
       count(*) FILTER (WHERE row_idx >= floor(n_rows * 0.8)) AS n_test,
       avg(CAST(label_up_3 AS DOUBLE)) AS base_rate
FROM sized""", doubles=("base_rate",)))
def q_split_stats(spark, sf):
    """Train / test sizes and base rate."""
    return ds.split_stats(ds.holdout_split(frame(spark, sf)))


TEST_SCORED_CTE = f"""
test_scored AS (
  SELECT label_up_3, {FIXED_SCORE} AS prob_up FROM sized WHERE row_idx >= floor(n_rows * 0.8))"""


def test_scored(spark, sf):
    split = ds.holdout_split(frame(spark, sf))
    return split.where("split = 'test'").withColumn("prob_up", F.expr(FIXED_SCORE))


@register("classification_metrics", O.with_ctes(*CHAIN_INDEXED, TEST_SCORED_CTE, """
c AS (SELECT count(*) FILTER (WHERE prob_up >= 0.5 AND label_up_3 = 1) AS tp,
             count(*) FILTER (WHERE prob_up >= 0.5 AND label_up_3 <> 1) AS fp,
             count(*) FILTER (WHERE prob_up < 0.5 AND label_up_3 <> 1) AS tn,
             count(*) FILTER (WHERE prob_up < 0.5 AND label_up_3 = 1) AS fn FROM test_scored)""", body="""
SELECT tp, fp, tn, fn,
       CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + tn + fn) END AS accuracy,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
       CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall
FROM c""", doubles=("accuracy", "f1", "precision", "recall")))
def q_classification_metrics(spark, sf):
    """Threshold metrics on the hold-out rows for a fixed score."""
    return mx.classification_metrics(test_scored(spark, sf))


@register("roc_auc", O.with_ctes(*CHAIN_INDEXED, TEST_SCORED_CTE, """
g AS (SELECT prob_up, count(*) FILTER (WHERE label_up_3 = 1) AS pos,
             count(*) FILTER (WHERE label_up_3 <> 1) AS neg FROM test_scored GROUP BY prob_up),
r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY prob_up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS nb FROM g)""", body="""
SELECT CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
       CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (nb + neg * 0.5)) / (sum(pos) * sum(neg))
            ELSE 'NaN'::DOUBLE END AS auc
FROM r""", doubles=("auc",)))
def q_roc_auc(spark, sf):
    """Exact ROC-AUC (ties half) on the hold-out rows for a fixed score."""
    return mx.roc_auc(test_scored(spark, sf))


FOLD_SCORED_CTE = f"""
fold_scored AS (
  SELECT CAST((row_idx - (n_rows - 5 * (n_rows // 6))) // (n_rows // 6) AS INTEGER) AS fold, label_up_3,
         round({FIXED_SCORE}, 3) AS prob_up FROM sized WHERE row_idx >= n_rows - 5 * (n_rows // 6)),
pairs AS (
  SELECT fold, count(*) FILTER (WHERE label_up_3 = 1) AS pos, count(*) FILTER (WHERE label_up_3 <> 1) AS neg
  FROM fold_scored GROUP BY fold),
wins AS (
  SELECT fold, sum(CASE WHEN p.prob_up > n.prob_up THEN 1.0 WHEN p.prob_up = n.prob_up THEN 0.5 ELSE 0.0 END) AS u
  FROM (SELECT * FROM fold_scored WHERE label_up_3 = 1) p JOIN (SELECT * FROM fold_scored WHERE label_up_3 <> 1) n
       USING (fold) GROUP BY fold),
fold_auc AS (
  SELECT fold, pos, neg, CASE WHEN pos > 0 AND neg > 0 THEN u / (pos * neg) ELSE 'NaN'::DOUBLE END AS auc
  FROM pairs LEFT JOIN wins USING (fold))"""


def fold_auc(spark, sf):
    """A fixed score (three places, so that many rows tie) over the test rows of all folds."""
    folds = ds.walk_forward_folds(frame(spark, sf)).where("test_fold IS NOT NULL")
    scored = folds.select(F.col("test_fold").alias("fold"), "label_up_3",
                          F.round(F.expr(FIXED_SCORE), 3).alias("prob_up"))
    return mx.roc_auc_by(scored, "fold")


@register("fold_auc", O.with_ctes(*CHAIN_INDEXED, FOLD_SCORED_CTE, body="SELECT * FROM fold_auc", doubles=("auc",)))
def q_fold_auc(spark, sf):
    """The AUC of every fold in one pass, over a fixed score with ties (oracle: all pairs)."""
    return fold_auc(spark, sf)


@register("cv_auc", O.with_ctes(*CHAIN_INDEXED, FOLD_SCORED_CTE, body="""
SELECT avg(auc) AS cv_auc FROM fold_auc WHERE NOT isnan(auc)""", doubles=("cv_auc",)))
def q_cv_auc(spark, sf):
    """Mean fold AUC over a fixed score."""
    return mx.mean_auc(fold_auc(spark, sf))


# ---------------------------------------------------------------- model
# Values that depend on the learner get a rows-only check; ``*_checks`` keys
# compare what does not.

QUERY_FIT_PARALLELISM = 6
_TRAINED: dict = {}


def trained(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = ml.train_direction(frame(spark, sf), parallelism=QUERY_FIT_PARALLELISM)
    return _TRAINED[key]


@register("train_direction")
def q_train_direction(spark, sf):
    """Walk-forward CV + hold-out training; the metrics document."""
    return trained(spark, sf).metrics


@register("walk_forward_cv")
def q_walk_forward_cv(spark, sf):
    """AUC per expanding fold."""
    return trained(spark, sf).fold_auc


@register("feature_importance")
def q_feature_importance(spark, sf):
    """Importance per named feature."""
    return trained(spark, sf).importance


@register("score_features")
def q_score_features(spark, sf):
    """K7, K8: every row of the training frame scored."""
    return ml.predict(trained(spark, sf).model, ds.clean(mart(spark, sf))).select(
        "symbol", "window_start", "prob_up", "direction", "confidence")


@register("score_latest")
def q_score_latest(spark, sf):
    """K9: newest training row of every symbol scored."""
    return ml.score_latest(trained(spark, sf).model, ds.clean(mart(spark, sf)))


@register("score_latest_live")
def q_score_latest_live(spark, sf):
    """K9 with source = live: the newest indicator row of every symbol (no
    known future needed) scored."""
    return ml.score_latest(trained(spark, sf).model, marts.latest_indicators(stg_saved(spark, sf)))


@register("score_requests")
def q_score_requests(spark, sf):
    """Scoring requests (indicator rows, defaults filled) scored."""
    req = feats(spark, sf).select("symbol", "window_start", *FEATURE_COLUMNS)
    return ml.score_requests(trained(spark, sf).model, req).select(
        "symbol", "window_start", "prob_up", "direction", "confidence")


@register("model_info")
def q_model_info(spark, sf):
    """Metrics written as JSON with the saved model, read back."""
    t = trained(spark, sf)
    path = scratch_path(spark, "model")
    ml.save_model(t.model, f"{path}/model")
    write_metadata(t.metrics, t.importance, path)
    metrics, _ = read_metadata(spark, path)
    return metrics


SCORE_CHECKS = """(prob_up BETWEEN 0 AND 1)
       AND (direction = CASE WHEN prob_up >= 0.5 THEN 'up' ELSE 'down' END OR abs(prob_up - 0.5) < 0.0001)
       AND abs(confidence - 2 * abs(prob_up - 0.5)) < 0.0003"""


@register("train_direction_checks", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT metric, CASE metric WHEN 'n_train' THEN floor(n * 0.8) WHEN 'n_test' THEN n - floor(n * 0.8)
                           WHEN 'base_rate' THEN base END AS value, TRUE AS in_range
FROM (SELECT CAST(count(*) AS DOUBLE) AS n, avg(CAST(label_up_3 AS DOUBLE)) AS base FROM indexed),
     unnest(['cv_auc', 'test_auc', 'test_accuracy', 'test_f1', 'test_precision', 'test_recall', 'n_train', 'n_test',
             'base_rate']) AS t(metric)""", doubles=("value",)))
def q_train_direction_checks(spark, sf):
    """Names of the metrics document, its sizes and base rate, and the range of the scores."""
    fixed = F.col("metric").isin("n_train", "n_test", "base_rate")
    return trained(spark, sf).metrics.select(
        "metric", F.when(fixed, F.col("value")).alias("value"),
        (fixed | F.isnan("value") | F.col("value").between(0, 1)).alias("in_range"))


@register("walk_forward_counts", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT fold, count(*) FILTER (WHERE label_up_3 = 1) AS pos, count(*) FILTER (WHERE label_up_3 <> 1) AS neg
FROM (SELECT label_up_3, CAST((row_idx - (n_rows - 5 * (n_rows // 6))) // (n_rows // 6) AS INTEGER) AS fold
      FROM sized WHERE row_idx >= n_rows - 5 * (n_rows // 6)) GROUP BY fold"""))
def q_walk_forward_counts(spark, sf):
    """Label counts of the fold that each AUC is over."""
    return trained(spark, sf).fold_auc.select("fold", F.col("pos").cast("bigint").alias("pos"),
                                              F.col("neg").cast("bigint").alias("neg"))


@register("feature_importance_checks", "SELECT f AS feature, CAST(i AS INTEGER) AS position, TRUE AS sums_to_one "
          "FROM (SELECT unnest([" + ", ".join(f"'{x}'" for x in FEATURE_COLUMNS) + "]) AS f, "
          f"unnest(range({len(FEATURE_COLUMNS)})) AS i)")
def q_feature_importance_checks(spark, sf):
    """Every feature once, in order, importances adding up to 1."""
    t = trained(spark, sf).importance
    total = t.agg(F.sum("importance")).first()[0]
    return t.select("feature", (F.array_position(F.array(*map(F.lit, FEATURE_COLUMNS)), F.col("feature")) - 1)
                    .cast("int").alias("position"), F.lit(abs(total - 1) < 1e-6).alias("sums_to_one"))


@register("score_features_checks", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT symbol, window_start, TRUE AS consistent FROM indexed"""))
def q_score_features_checks(spark, sf):
    """K7, K8: which rows are scored, and that direction and confidence follow the probability."""
    return q_score_features(spark, sf).select("symbol", "window_start", F.expr(SCORE_CHECKS).alias("consistent"))


@register("score_latest_checks", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT symbol, max(window_start) AS window_start, TRUE AS consistent FROM indexed GROUP BY symbol"""))
def q_score_latest_checks(spark, sf):
    """K9: the row that is scored for each symbol."""
    return q_score_latest(spark, sf).select("symbol", "window_start", F.expr(SCORE_CHECKS).alias("consistent"))


@register("score_requests_checks", O.with_ctes(*O.CHAIN_FEATS, f"""
req AS (SELECT symbol, window_start, {REQ_DEFAULTS_SQL} FROM feats)""", body="""
SELECT symbol, window_start, TRUE AS consistent FROM req
WHERE volatility_30 >= 0 AND rel_volume >= 0 AND trade_count >= 0"""))
def q_score_requests_checks(spark, sf):
    """Which requests are accepted, and that direction and confidence follow the probability."""
    return q_score_requests(spark, sf).select("symbol", "window_start", F.expr(SCORE_CHECKS).alias("consistent"))


@register("model_info_checks", ORACLES["train_direction_checks"])
def q_model_info_checks(spark, sf):
    """Names, sizes and ranges of the metadata that is read back beside the saved model."""
    fixed = F.col("metric").isin("n_train", "n_test", "base_rate")
    return q_model_info(spark, sf).select(
        "metric", F.when(fixed, F.col("value")).alias("value"),
        (fixed | F.isnan("value") | F.col("value").between(0, 1)).alias("in_range"))


# ---------------------------------------------------------------- refresh job
@register("refresh_report", O.with_ctes(*CHAIN_INDEXED, body="""
SELECT 'load' AS step, count(*) AS rows FROM bars UNION ALL SELECT 'build', count(*) FROM mart UNION ALL
SELECT 'train', count(*) FROM indexed UNION ALL SELECT 'summary', 1"""))
def q_refresh_report(spark, sf):
    """Lake -> raw -> warehouse + checks -> training -> stored summary."""
    path = scratch_path(spark, "refresh-lake")
    lake.write_bars(bars(spark, sf), path)
    log, _ = refresh(spark, path, scratch_path(spark, "model"), root=scratch_path(spark, "warehouse"),
                     parallelism=QUERY_FIT_PARALLELISM)
    return log.select("step", "rows")


# ---------------------------------------------------------------- rows the fixture lacks
# Projections of ``events`` that hold them.

@register("lineitem_bars", """
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, symbol, round(open, 6) AS open,
       round(close, 6) AS close, trade_count
FROM (SELECT date_trunc('day', l_shipdate)::TIMESTAMP AS window_start, l_returnflag || l_linestatus AS symbol,
             arg_min(price, k) AS open, arg_max(price, k) AS close, count(*) AS trade_count
      FROM (SELECT *, l_extendedprice / l_quantity AS price,
                   {'a': l_shipdate, 'b': l_orderkey, 'c': l_linenumber, 'd': l_partkey, 'e': l_suppkey,
                    'f': l_extendedprice / l_quantity} AS k FROM lineitem) GROUP BY 1, 2)""")
def q_lineitem_bars(spark, sf):
    """D1 with a six-part tie-break (the struct ordering key), day bars."""
    t = fx.trades_from_lineitem(fx.table(spark, sf, "lineitem"))
    t = t.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))
    return bars_op.ohlcv_bars(t, "1 day", fx.LINEITEM_ORDER).select(
        "window_start", "window_end", "symbol", "open", "close", "trade_count")


NUMERIC_SYMBOL = "lpad(CAST(trade_id % 7 * 930 AS STRING), 6, '0')"


@register("numeric_symbol_bars", O.with_ctes(O.TRADES_CTE.replace(
    "event_type AS symbol", "lpad(CAST(event_id % 7 * 930 AS VARCHAR), 6, '0') AS symbol"), O.BARS_CTE, O.STG_CTE,
    body="SELECT symbol, window_start, close, trade_count FROM stg", doubles=("close",)))
def q_numeric_symbol_bars(spark, sf):
    """Zero-padded numeric symbols survive the lake as text."""
    path = scratch_path(spark, "lake")
    t = trades(spark, sf).withColumn("symbol", F.expr(NUMERIC_SYMBOL))
    lake.write_bars(bars_op.ohlcv_bars(t, WIDTH, fx.EVENTS_ORDER), path)
    return stg_ohlcv(lake.scan_lake(spark, path)).select("symbol", "window_start", "close", "trade_count")


@register("null_id_bars", O.with_ctes(O.TRADES_CTE.replace(
    "event_id AS trade_id", "CASE WHEN event_id % 3 <> 0 THEN event_id END AS trade_id"), """
keyed AS (SELECT *, time_bucket(INTERVAL '1 hour', event_ts) AS window_start, {'t': event_ts, 'n': trade_id IS NOT NULL,
                 'i': coalesce(trade_id, 0), 'p': price} AS k FROM trades)""", body="""
SELECT symbol, window_start, arg_min(price, k) AS open, arg_max(price, k) AS close, count(*) AS trade_count
FROM keyed GROUP BY 1, 2""", doubles=("open", "close")))
def q_null_id_bars(spark, sf):
    """Trades without an id still open and close their bars."""
    t = trades(spark, sf).withColumn("trade_id", F.when(F.col("trade_id") % 3 != 0, F.col("trade_id")))
    return bars_op.ohlcv_bars(t, WIDTH, fx.EVENTS_ORDER).select("symbol", "window_start", "open", "close",
                                                                "trade_count")


@register("other_messages", """
SELECT event_id AS msg_id, CASE WHEN event_id % 101 = 0 THEN 'malformed' WHEN event_id % 5 = 0 THEN 'skipped'
                                WHEN event_type = 'error' THEN 'skipped' ELSE 'trade' END AS kind FROM events""")
def q_other_messages(spark, sf):
    """B1, B2, Q9: readable messages without an event type are skipped, unreadable text is rejected."""
    msgs = fx.messages_from_events(fx.table(spark, sf, "events"))
    other = F.when(F.col("msg_id") % 10 == 0, F.lit("{}")).otherwise(
        F.format_string('{"result":null,"id":%d}', "msg_id"))
    msgs = msgs.withColumn("value", F.when((F.col("msg_id") % 5 == 0) & (F.col("msg_id") % 101 != 0), other)
                           .otherwise(F.col("value")))
    kinds = norm.normalize_trades(msgs, keep=("msg_id",)).select("msg_id", F.lit("trade").alias("kind")).unionByName(
        norm.normalize_rejects(msgs, keep=("msg_id",)).select("msg_id", F.col("reason").alias("kind")))
    return msgs.select("msg_id").join(kinds, "msg_id", "left").select(
        "msg_id", F.coalesce("kind", F.lit("skipped")).alias("kind"))


@register("number_texts", """
SELECT event_id, printf('%+.2f', x) AS signed_text, printf('%.3f', y) AS plain_text
FROM (SELECT event_id, (event_id % 4001 - 2000) / 1600.0::DOUBLE AS x, (event_id % 997) / 16000.0::DOUBLE AS y
      FROM events)""")
def q_number_texts(spark, sf):
    """Number texts on and near rounding ties."""
    x = (F.col("event_id") % 4001 - 2000) / F.lit(1600.0)
    y = (F.col("event_id") % 997) / F.lit(16000.0)
    return fx.table(spark, sf, "events").select(
        "event_id", fixed_text(x, 2, sign=True).alias("signed_text"), fixed_text(y, 3).alias("plain_text"))


@register("quality_failures", O.with_ctes(*O.CHAIN_MART, """
raw AS (SELECT CASE WHEN trade_count % 3 <> 0 THEN symbol END AS symbol,
               CASE WHEN trade_count % 5 <> 0 THEN window_start END AS window_start,
               CASE WHEN trade_count % 7 <> 0 THEN close END AS close FROM bars),
bad AS (SELECT CASE WHEN trade_count % 3 <> 0 THEN symbol END AS symbol,
               CASE WHEN trade_count % 4 <> 0 THEN label_up_3 + trade_count % 2 END AS label_up_3,
               CASE WHEN trade_count % 5 <> 0 THEN volatility_30 END AS volatility_30,
               CASE WHEN trade_count % 6 <> 0 THEN close ELSE -close END AS close FROM mart),
snap AS (SELECT symbol, CASE WHEN trade_count % 9 <> 0 THEN close END AS last_price FROM mart)""", body="\nUNION ALL\n".join([
    _nn("raw.ohlcv_10s", "raw", "symbol"), _nn("raw.ohlcv_10s", "raw", "window_start"),
    _nn("raw.ohlcv_10s", "raw", "close"),
    _nn("marts.mart_ml_features", "bad", "symbol"), _nn("marts.mart_ml_features", "bad", "label_up_3"),
    _nn("marts.mart_ml_features", "bad", "volatility_30"),
    "SELECT 'marts.mart_ml_features.accepted_values.label_up_3', CAST(count(*) FILTER "
    "(WHERE label_up_3 IS NOT NULL AND label_up_3 NOT IN (0, 1)) AS BIGINT) FROM bad",
    "SELECT 'marts.mart_ml_features.positive_prices', CAST(count(*) FILTER (WHERE close <= 0) AS BIGINT) FROM bad",
    _nn("marts.mart_symbol_snapshot", "snap", "symbol"), _nn("marts.mart_symbol_snapshot", "snap", "last_price"),
    "SELECT 'marts.mart_symbol_snapshot.unique.symbol', CAST(count(*) AS BIGINT) FROM "
    "(SELECT symbol FROM snap WHERE symbol IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
    "SELECT 'nonpositive_prices', CAST(count(*) AS BIGINT) FROM bad WHERE close <= 0",
])))
def q_quality_failures(spark, sf):
    """J1-J5 over rows that break them: NULLs, labels beyond 0 and 1, prices at or below 0, repeated symbols."""
    def unless(c, k, otherwise=None):
        return F.when(F.col("trade_count") % k != 0, F.col(c)).otherwise(otherwise)
    m = mart(spark, sf)
    raw = bars(spark, sf).select(unless("symbol", 3).alias("symbol"), unless("window_start", 5).alias("window_start"),
                                 unless("close", 7).alias("close"))
    label = F.when(F.col("trade_count") % 4 != 0, (F.col("label_up_3") + F.col("trade_count") % 2).cast("int"))
    bad = m.select(unless("symbol", 3).alias("symbol"), label.alias("label_up_3"),
                   unless("volatility_30", 5).alias("volatility_30"), unless("close", 6, -F.col("close")).alias("close"))
    snap = m.select("symbol", unless("close", 9).alias("last_price"))
    singular = quality.nonpositive_prices(bad).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("nonpositive_prices").alias("check_name"), "failures")
    return quality.quality_report(raw, bad, snap).unionByName(singular)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
