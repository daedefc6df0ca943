"""DuckDB SQL that states, independently of Spark, what each registered
query must return on the driver's tables. Used only as a test oracle."""
from __future__ import annotations

BAR_WIDTH = "1 hour"

TRADES_CTE = """
trades AS (
  SELECT event_type AS symbol, event_id AS trade_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS trade_time,
         (user_id % 2 = 0) AS is_buyer_maker, ts AS event_ts
  FROM events)"""

BARS_CTE = f"""
bars AS (
  SELECT time_bucket(INTERVAL '{BAR_WIDTH}', event_ts) AS window_start,
         time_bucket(INTERVAL '{BAR_WIDTH}', event_ts) + INTERVAL '{BAR_WIDTH}' AS window_end,
         symbol,
         arg_min(price, {{'t': event_ts, 'i': trade_id}}) FILTER (WHERE price IS NOT NULL) AS open,
         max(price) AS high,
         min(price) AS low,
         arg_max(price, {{'t': event_ts, 'i': trade_id}}) FILTER (WHERE price IS NOT NULL) AS close,
         sum(quantity) AS volume,
         sum(price * quantity) / nullif(sum(quantity), 0) AS vwap,
         count(*) AS trade_count,
         sum(CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END) AS net_signed_volume,
         sum(CASE WHEN is_buyer_maker THEN -quantity ELSE quantity END) / nullif(sum(quantity), 0)
           AS order_flow_imbalance
  FROM trades WHERE event_ts IS NOT NULL
  GROUP BY 1, 2, 3)"""

STG_CTE = """
stg AS (
  SELECT window_start, window_end, symbol, open, high, low, close, volume, vwap, trade_count,
         net_signed_volume, order_flow_imbalance
  FROM bars WHERE close > 0 AND volume > 0)"""

# The indicators are stated over lists, one per symbol, instead of window frames: position i of a list is the
# i-th bar, a frame is a slice, the bar before and the bar three ahead are neighbours in the list.
FEATS_CTE = """
series AS (
  SELECT symbol, list(s ORDER BY window_start) AS bar, list(close ORDER BY window_start) AS px,
         list(volume ORDER BY window_start) AS vol, list(order_flow_imbalance ORDER BY window_start) AS flow
  FROM stg s GROUP BY symbol),
moves AS (
  SELECT *, list_transform(range(1, len(px) + 1), lambda i: px[i] / nullif(px[i - 1], 0)) AS move FROM series),
at_bar AS (
  SELECT *, list_transform(move, lambda m: ln(m)) AS log_move, unnest(range(1, len(px) + 1)) AS i FROM moves),
feats AS (
  SELECT symbol, bar[i].window_start AS window_start, bar[i].window_end AS window_end, bar[i].open AS open,
         bar[i].high AS high, bar[i].low AS low, px[i] AS close, vol[i] AS volume, bar[i].vwap AS vwap,
         bar[i].trade_count AS trade_count, bar[i].net_signed_volume AS net_signed_volume,
         flow[i] AS order_flow_imbalance, move[i] - 1 AS ret_1, log_move[i] AS log_ret_1,
         list_avg(px[greatest(i - 5, 1):i]) AS sma_6, list_avg(px[greatest(i - 29, 1):i]) AS sma_30,
         px[i] / nullif(list_avg(px[greatest(i - 29, 1):i]), 0) - 1 AS px_vs_sma30,
         list_aggregate(log_move[greatest(i - 29, 1):i], 'stddev_samp') AS volatility_30,
         list_avg(flow[greatest(i - 5, 1):i]) AS ofi_6,
         vol[i] / nullif(list_avg(vol[greatest(i - 29, 1):i]), 0) AS rel_volume
  FROM at_bar)"""

# The close three bars ahead is looked up by the next bars' times.
MART_CTE = """
ahead AS (
  SELECT f.*, (SELECT close FROM stg n WHERE n.symbol = f.symbol AND n.window_start > f.window_start
               ORDER BY n.window_start LIMIT 1 OFFSET 2) AS future_close_3
  FROM feats f),
mart AS (
  SELECT symbol, window_start, close, ret_1, log_ret_1, px_vs_sma30, volatility_30,
         order_flow_imbalance, ofi_6, rel_volume, trade_count, future_close_3,
         CAST(future_close_3 > close AS INTEGER) AS label_up_3
  FROM ahead WHERE future_close_3 + volatility_30 IS NOT NULL)"""

SNAPSHOT_CTE = """
newest AS (SELECT unnest(arg_max(f, f.window_start)) FROM feats f GROUP BY f.symbol),
extent AS (
  SELECT symbol, max(high) AS high_window, min(low) AS low_window, sum(volume) AS total_volume,
         count(*) AS bars
  FROM stg GROUP BY symbol),
snapshot AS (
  SELECT symbol, window_start AS as_of, close AS last_price, ret_1 AS last_return, px_vs_sma30, volatility_30,
         order_flow_imbalance, rel_volume, high_window, low_window, total_volume, bars
  FROM newest NATURAL JOIN extent)"""


def with_ctes(*ctes: str, body: str, doubles: tuple[str, ...] = ()) -> str:
    sql = "WITH " + ",".join(ctes) + "\n" + body
    if doubles:
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
        sql = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) q"
    return sql


CHAIN_BARS = (TRADES_CTE, BARS_CTE)
CHAIN_STG = CHAIN_BARS + (STG_CTE,)
CHAIN_FEATS = CHAIN_STG + (FEATS_CTE,)
CHAIN_MART = CHAIN_FEATS + (MART_CTE,)
CHAIN_SNAPSHOT = CHAIN_FEATS + (SNAPSHOT_CTE,)

# Streamed trades carry event time at millisecond grain (epoch ms on the bus).
TRADES_MS_CTE = """
trades AS (
  SELECT event_type AS symbol, event_id AS trade_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS trade_time,
         (user_id % 2 = 0) AS is_buyer_maker,
         epoch_ms(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) AS event_ts
  FROM events)"""
