"""Data-quality checks (J1-J6): the failing-row count of every check on a table, taken
while the table is written or by one aggregation pass over it."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    pass


RAW, MART, SNAPSHOT = "raw.ohlcv_10s", "marts.mart_ml_features", "marts.mart_symbol_snapshot"


def _not_null(table: str, cols: list[str]) -> list[tuple[str, F.Column]]:
    return [(f"{table}.not_null.{c}", F.count_if(F.col(c).isNull())) for c in cols]


def declared(table: str) -> list[tuple[str, F.Column]]:
    """The checks declared on a table: name and the count of failing rows."""
    if table == RAW:
        return _not_null(RAW, ["symbol", "window_start", "close"])
    if table == MART:
        return [*_not_null(MART, ["symbol", "label_up_3", "volatility_30"]),
                (f"{MART}.accepted_values.label_up_3",
                 F.count_if(F.col("label_up_3").isNotNull() & ~F.col("label_up_3").isin(0, 1))),
                (f"{MART}.positive_prices", F.count_if(F.col("close") <= 0))]
    return _not_null(SNAPSHOT, ["symbol", "last_price"])


class Checks:
    """The declared checks of a table and its row count, taken from the rows while they are written (``observe``), so
    that they cost no scan of their own. The observed aggregation sits right below the write, in its last stage, where
    each task counts once. :attr:`failures` waits for the write to end."""

    def __init__(self, table: str):
        self.table, self.names = table, [name for name, _ in declared(table)]
        self._seen = Observation()

    def on(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"),
                          *[expr.alias(f"c{i}") for i, (_, expr) in enumerate(declared(self.table))])

    @property
    def rows(self) -> int:
        return int(self._seen.get["rows"])

    @property
    def failures(self) -> dict[str, int]:
        found = self._seen.get
        return {name: int(found[f"c{i}"]) for i, name in enumerate(self.names)}

    def report(self, spark: SparkSession) -> DataFrame:
        """(check_name, failures), one row per check."""
        return report_of(spark, self.failures)

    def enforce(self) -> None:
        _raise_on({k: v for k, v in self.failures.items() if v})


def report_of(spark: SparkSession, failures: dict[str, int]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(k).alias("check_name"), F.lit(v).cast("bigint").alias("failures"))
                     for k, v in failures.items()])
    return spark.range(1).select(F.inline(rows))


def _report(table: str, df: DataFrame) -> DataFrame:
    checks = declared(table)
    row = df.agg(*[expr.alias(f"c{i}") for i, (_, expr) in enumerate(checks)])
    stack = ", ".join(f"'{name}', c{i}" for i, (name, _) in enumerate(checks))
    return row.selectExpr(f"stack({len(checks)}, {stack}) AS (check_name, failures)") \
        .select("check_name", F.col("failures").cast("bigint"))


def raw_checks(raw_bars: DataFrame) -> DataFrame:
    return _report(RAW, raw_bars)


def mart_checks(mart: DataFrame) -> DataFrame:
    return _report(MART, mart)


def unique_symbols(snapshot: DataFrame) -> DataFrame:
    return (snapshot.where(F.col("symbol").isNotNull()).groupBy("symbol").count()
            .where(F.col("count") > 1)
            .agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
            .select(F.lit(f"{SNAPSHOT}.unique.symbol").alias("check_name"), "failures"))


def snapshot_checks(snapshot: DataFrame) -> DataFrame:
    return _report(SNAPSHOT, snapshot).unionByName(unique_symbols(snapshot))


def quality_report(raw_bars: DataFrame, mart: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The checks over tables that are not being written: one aggregation each."""
    return raw_checks(raw_bars).unionByName(mart_checks(mart)).unionByName(snapshot_checks(snapshot))


def observed_report(spark: SparkSession, raw: Checks, mart: Checks, snapshot: Checks, saved_snapshot: DataFrame) -> DataFrame:
    """The same report from the writes of the three tables; only repeated symbols are looked for in a table, the
    snapshot, which has a row per symbol."""
    return report_of(spark, {**raw.failures, **mart.failures, **snapshot.failures}).unionByName(
        unique_symbols(saved_snapshot))


def nonpositive_prices(mart: DataFrame) -> DataFrame:
    """Singular test: failing rows of the mart (J5); passes when empty."""
    return mart.where(F.col("close") <= 0)


def enforce(report: DataFrame) -> DataFrame:
    """Raise when any check has failures (J6); returns the report otherwise."""
    _raise_on({r.check_name: r.failures for r in report.where(F.col("failures") > 0).collect()})  # one row per check
    return report


def _raise_on(failed: dict[str, int]) -> None:
    if failed:
        raise QualityError("data-quality checks failed: " + ", ".join(f"{k}={v}" for k, v in failed.items()))
