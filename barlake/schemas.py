"""Fixed schemas of the data model."""
from pyspark.sql import types as T

TRADE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("trade_id", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("trade_time", T.LongType()),
    T.StructField("is_buyer_maker", T.BooleanType()),
    T.StructField("ingest_time", T.LongType()),
])

# Exchange messages are JSON text {stream, data:{e,E,s,t,p,q,T,m}} or the bare
# payload; price and quantity arrive as decimal text. They are read with
# json_tuple (see barlake.operators.normalize), not a struct schema, because
# the payload keys differ only in case.

BAR_COLUMNS = [
    "window_start", "window_end", "symbol", "open", "high", "low", "close", "volume", "vwap",
    "trade_count", "net_signed_volume", "order_flow_imbalance",
]

BAR_TYPES = {
    "window_start": "timestamp", "window_end": "timestamp", "symbol": "string",
    "open": "double", "high": "double", "low": "double", "close": "double", "volume": "double",
    "vwap": "double", "trade_count": "bigint", "net_signed_volume": "double",
    "order_flow_imbalance": "double",
}

FEATURE_COLUMNS = [
    "ret_1", "log_ret_1", "px_vs_sma30", "volatility_30", "order_flow_imbalance", "ofi_6",
    "rel_volume", "trade_count",
]
LABEL_COLUMN = "label_up_3"

TECHNICAL_COLUMNS = [
    "symbol", "window_start", "window_end", "open", "high", "low", "close", "volume", "vwap",
    "trade_count", "net_signed_volume", "order_flow_imbalance", "ret_1", "log_ret_1", "sma_6",
    "sma_30", "px_vs_sma30", "volatility_30", "ofi_6", "rel_volume",
]

ML_MART_COLUMNS = [
    "symbol", "window_start", "close", "ret_1", "log_ret_1", "px_vs_sma30", "volatility_30",
    "order_flow_imbalance", "ofi_6", "rel_volume", "trade_count", "future_close_3", "label_up_3",
]
