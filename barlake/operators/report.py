"""Templated market summary as DataFrames.

Texts are built with built-in string functions; no Python per row."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.exprs import fixed_text

# Fixed values of the summary template (must read exactly like this).
VOLATILITY_ELEVATED_ABOVE = 0.004
FLOW_THRESHOLD = 0.05
QUOTE_SUFFIX = "USDT"
EMPTY_SUMMARY = "No market data available yet. Start the pipeline or run the sample-data generator."

FACT_COLUMNS = ["symbol", "last_price", "last_return", "px_vs_sma30", "volatility_30",
                "order_flow_imbalance", "rel_volume"]


def summary_facts(snapshot: DataFrame) -> DataFrame:
    """Snapshot columns the summary reads, ordered by symbol."""
    return snapshot.select(*FACT_COLUMNS).orderBy("symbol")


def _or_zero(c: str) -> F.Column:
    """A missing number counts as 0 (NaN too)."""
    return F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))


def _line() -> F.Column:
    sym = F.replace(F.upper("symbol"), F.lit(QUOTE_SUFFIX), F.lit(""))
    above = _or_zero("px_vs_sma30") > 0
    trend = F.when(above, F.lit("above")).otherwise(F.lit("below"))
    momentum = F.when(above, F.lit("bullish")).otherwise(F.lit("bearish"))
    vol_word = F.when(_or_zero("volatility_30") > VOLATILITY_ELEVATED_ABOVE, F.lit("elevated")) \
        .otherwise(F.lit("subdued"))
    ofi = _or_zero("order_flow_imbalance")
    flow = (F.when(ofi > FLOW_THRESHOLD, F.lit("net buying"))
            .when(ofi < -FLOW_THRESHOLD, F.lit("net selling"))
            .otherwise(F.lit("balanced flow")))
    line = F.concat(
        sym, F.lit(": last move "), fixed_text(_or_zero("last_return") * 100, 2, sign=True),
        F.lit("%, trading "), trend, F.lit(" its 30-bar average ("), momentum,
        F.lit(" momentum), "), vol_word, F.lit(" volatility, order flow shows "), flow, F.lit("."))
    return line


def symbol_descriptions(facts: DataFrame) -> DataFrame:
    """One sentence per symbol (L1)."""
    return facts.select("symbol", _line().alias("line"))


def market_tone(facts: DataFrame) -> DataFrame:
    """Symbols above their 30-bar average, total, and the tone."""
    agg = facts.agg(F.count_if(_or_zero("px_vs_sma30") > 0).alias("above"),
                    F.count(F.lit(1)).alias("assets"))
    tone = F.when(F.col("above") > F.col("assets") / 2, F.lit("broadly constructive")) \
        .otherwise(F.lit("cautious"))
    return agg.select("above", "assets", tone.alias("tone"))


def market_summary(facts: DataFrame) -> DataFrame:
    """The assembled text in one row (L3). One line per symbol meets in a
    single row because the summary is one document; partial aggregation
    keeps every task to its own symbols until the final merge."""
    above = _or_zero("px_vs_sma30") > 0
    agg = facts.select("symbol", _line().alias("line"), above.alias("is_above")).agg(
        F.count(F.lit(1)).alias("assets"),
        F.count_if("is_above").alias("above"),
        F.array_sort(F.collect_list(F.struct("symbol", "line"))).alias("lines"),
    )
    tone = F.when(F.col("above") > F.col("assets") / 2, F.lit("broadly constructive")) \
        .otherwise(F.lit("cautious"))
    header = F.concat(F.lit("Market read ("), F.col("assets").cast("string"),
                      F.lit(" assets) — tone is "), tone, F.lit("."))
    body = F.array_join(F.transform("lines", lambda r: F.concat(F.lit("- "), r["line"])), "\n")
    text = F.when(F.col("assets") == 0, F.lit(EMPTY_SUMMARY)) \
        .otherwise(F.concat(header, F.lit("\n\n"), body))
    return agg.select("assets", text.alias("summary"))


def summary_of_table(spark: SparkSession, table: str) -> DataFrame:
    """The summary of a snapshot table; the fixed message when it does not exist (A10)."""
    if spark.catalog.tableExists(table):
        return market_summary(spark.table(table).select(*FACT_COLUMNS))
    return spark.range(1).select(F.lit(0).cast("bigint").alias("assets"), F.lit(EMPTY_SUMMARY).alias("summary"))
