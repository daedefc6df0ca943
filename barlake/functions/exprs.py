"""Scalar expressions shared by batch and streaming plans."""
from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_zero(c) -> Column:
    c = _c(c)
    return F.when(c != 0, c)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(_c(num), nullif_zero(den))


def ratio_minus_one(num, den) -> Column:
    return safe_div(num, den) - F.lit(1.0)


def log_ratio(num, den) -> Column:
    """ln(num / den); NULL when den is 0 or the ratio is not positive."""
    r = safe_div(num, den)
    return F.when(r > 0, F.ln(r))


def signed_quantity(qty="quantity", buyer_is_maker="is_buyer_maker") -> Column:
    """Seller-initiated trades (buyer is maker) count negative; a NULL flag counts positive."""
    q = _c(qty)
    return F.when(_c(buyer_is_maker), -q).otherwise(q)


def notional(price="price", qty="quantity") -> Column:
    return _c(price) * _c(qty)


def epoch_micros(ts: Column, dtype: T.DataType) -> Column:
    """Microseconds since the epoch for TIMESTAMP and TIMESTAMP_NTZ alike; a
    wall-clock (NTZ) value is read as UTC whatever the session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        day = F.unix_date(F.to_date(ts)).cast("bigint")
        secs = F.date_part(F.lit("SECOND"), ts)                  # seconds with fraction
        return (day * 86_400_000_000 + F.hour(ts).cast("bigint") * 3_600_000_000
                + F.minute(ts).cast("bigint") * 60_000_000 + (secs * 1_000_000).cast("bigint"))
    return F.unix_micros(ts)


def utc_wall_clock(ts) -> Column:
    """An instant (TIMESTAMP) as its UTC wall-clock TIMESTAMP_NTZ, independent
    of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), epoch)


def _dec(literal: str) -> Column:
    return F.expr(f"CAST({literal} AS DECIMAL(38,0))")


def ordering_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """A total-order key for min_by / max_by.

    (timestamp, integral id) packs into one DECIMAL(38,0) =
    micros * 10^20 + (id + 2^63 + 1), a fixed-width value that keeps the
    aggregation in HashAggregate; longer keys fall back to a struct
    (SortAggregate, still exact). A NULL id sorts before every id of the same
    instant in both forms, so its row still counts."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols)
    integral = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
    if (len(cols) == 2 and isinstance(types[cols[0]], (T.TimestampType, T.TimestampNTZType))
            and isinstance(types[cols[1]], integral)):
        micros = epoch_micros(F.col(cols[0]), types[cols[0]]).cast("decimal(38,0)")
        shift, offset = _dec("100000000000000000000"), _dec("9223372036854775809")  # 10^20, 2^63 + 1
        return micros * shift + F.coalesce(F.col(cols[1]).cast("decimal(38,0)") + offset, _dec("0"))
    if len(cols) == 1:
        return F.col(cols[0])
    return F.struct(*[F.col(c) for c in cols])


def fixed_text(c, places: int, sign: bool = False) -> Column:
    """A number with ``places`` decimals, rounded from its binary value with
    ties to even, as the common ``printf`` does; NULL and NaN keep the texts
    of ``format_string``."""
    c = _c(c)
    zeros = "0." + "0" * places if places else "0"
    pattern = f"+{zeros};-{zeros}" if sign else zeros
    # Below one unit of the last place the JVM's formatter rounds the shortest decimal text; there the choice
    # between zero and one unit compares with the binary value nearest to half a unit.
    half = Decimal(1).scaleb(-places) / 2
    up = F.abs(c) >= float(half) if Decimal(float(half)) > half else F.abs(c) > float(half)
    unit = F.when(up, F.lit(float(2 * half))).otherwise(0.0)
    small = F.when(F.abs(c) < float(2 * half), F.when(c < 0, -unit).otherwise(unit)).otherwise(c)
    return F.when(c.isNull() | F.isnan(c), F.format_string(f"%{'+' if sign else ''}.{places}f", c)).otherwise(
        F.call_function("format_number", small, F.lit(pattern)))


def round_doubles(df: DataFrame, scale: int = 6) -> DataFrame:
    """Round every DOUBLE column (presentation / oracle comparison).

    Scale, round half away from zero, scale back: the common rule of SQL
    engines for binary doubles, so a value that prints as ...5 at the cut
    rounds the same way everywhere."""
    p = float(10 ** scale)
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            out.append(F.when(F.isnan(c) | (F.abs(c) == float("inf")), c)
                       .otherwise(F.round(c * p) / p).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
