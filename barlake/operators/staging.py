"""Typed staging over raw bars with the degenerate-bar guard."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.schemas import BAR_COLUMNS, BAR_TYPES

GUARD = "close > 0 AND volume > 0"


def _stg_types(raw_bars: DataFrame, keep_ntz: bool) -> list[tuple[str, str]]:
    """(column, target type); a TIMESTAMP_NTZ source keeps its type so batch
    results stay wall-clock values."""
    types = {f.name: f.dataType.simpleString() for f in raw_bars.schema.fields}
    out = []
    for c in BAR_COLUMNS:
        t = BAR_TYPES[c]
        if t == "timestamp" and keep_ntz and types.get(c) == "timestamp_ntz":
            t = "timestamp_ntz"
        out.append((c, t))
    return out


def stg_ohlcv(raw_bars: DataFrame, keep_ntz: bool = True) -> DataFrame:
    """Explicit casts by name, then the guard."""
    cols = [F.col(c).cast(t).alias(c) for c, t in _stg_types(raw_bars, keep_ntz)]
    return raw_bars.select(*cols).where(F.expr(GUARD))


def stg_view_sql(raw_bars: DataFrame, source_table: str, keep_ntz: bool = True) -> str:
    """The same projection as SQL text over a catalog table, for a catalog
    view of the staging layer (built from the same column / type list)."""
    cols = ", ".join(f"CAST({c} AS {t.upper()}) AS {c}" for c, t in _stg_types(raw_bars, keep_ntz))
    return f"SELECT {cols} FROM {source_table} WHERE {GUARD}"
