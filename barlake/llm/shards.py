"""Sharding by histogram sort (DataFrame operations only); the law is ``bytes``: shards nearly equal in size.

The size of a row is the UTF-8 bytes of its text plus one. The key of a row is (60 bits of the text's MD5, id, number
of the row), so equal texts adjoin and the copies of one text, even with one id, can still be told apart.

1. One pass over the texts writes the keys and sizes as a table; the texts are not read again.
2. Splitters: each round counts exact bytes and rows below candidate boundaries, at most ``PROBES`` over all open
   intervals, by one grouped aggregation over all partitions. A boundary that an end of a bucket meets is settled; the
   bucket around any other becomes its next interval. An interval with a single text goes on by id, one with a single
   id by row number, so a text that a third of all rows share is split like any other.
   A shard ends at the end of a group of equal texts if one lies within ``tolerance`` of a shard's size from the exact
   place, the nearest one (the lower of two); otherwise at the nearest end of a row. Beside these ``shards - 1``
   splitters there are loose ones, a multiple of ``part_rows`` rows apart, that only cut the exchange into more tasks.
3. One exchange by the parts between splitters. Rows below every splitter are known from the histograms, so the place
   of a row within its shard is its number within its part plus a constant.

Only histograms reach the driver (``PROBES`` rows a round); splitters go back as literals, fewer than ``shards`` plus
``MAX_PARTS``. Null texts count as empty. Ids may be null or repeated: integers order as numbers (null first), other
ids by hash. An empty table gives no rows; a shard is empty when one row is larger than its neighbours."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.graph import saved

KEY = ("h", "i", "r")
PROBES = 1 << 14
MAX_PARTS = 4096
PART_ROWS = 10_000
TOLERANCE = 100          # a hundredth of a shard
LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Target:
    """A place to cut: ``goal / scale`` of the measure (``bytes`` or ``rows``)."""
    measure: str
    goal: int
    scale: int
    near: int                                   # an edge within near / scale of the place settles it
    splitter: tuple | None = None               # the last key on the left
    rows_below: int = 0


@dataclass(frozen=True)
class Interval:
    """Keys that agree in their first columns, with the next one in low..high."""
    fixed: tuple
    low: int
    high: int
    next_low: int = field(compare=False, default=LOW)
    next_high: int = field(compare=False, default=HIGH)
    left: tuple = field(compare=False, default=(LOW,) * 3)     # the last key before the interval
    bytes_below: int = field(compare=False, default=0)
    rows_below: int = field(compare=False, default=0)

    @property
    def first(self) -> tuple:
        return (*self.fixed, self.low, *(LOW,) * (2 - len(self.fixed)))

    @property
    def last(self) -> tuple:
        return (*self.fixed, self.high, *(HIGH,) * (2 - len(self.fixed)))


def _numbers(values) -> Column:
    """A constant array of longs."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _below(bounds: list[tuple], inclusive: bool = False) -> Column:
    """How many of the sorted keys lie below the row's key (or equal it): a binary search with one step per bit."""
    if not bounds:
        return F.lit(0)
    arrays = [_numbers(column) for column in zip(*bounds)]

    def lies_below(at: Column) -> Column:
        b, k = [F.element_at(a, at) for a in arrays], [F.col(c) for c in KEY]
        last = b[2] <= k[2] if inclusive else b[2] < k[2]
        return (b[0] < k[0]) | ((b[0] == k[0]) & ((b[1] < k[1]) | ((b[1] == k[1]) & last)))

    steps = [1 << s for s in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda found, step: F.when(
        (found + step <= len(bounds)) & lies_below(F.least(found + step, F.lit(len(bounds)))), found + step
    ).otherwise(found))


def keyed(df: DataFrame, doc_id: str, text: str, columns: list[str]) -> DataFrame:
    """(row, size, text_crc32, h, i, r) per row; ``row`` holds the columns asked for."""
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    of = F.col(f"`{doc_id}`")
    number = F.coalesce(of.cast("long"), F.lit(LOW)) if isinstance(df.schema[doc_id].dataType, T.IntegralType) \
        else F.xxhash64(of.cast("string"))
    return df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                     (F.octet_length(content) + 1).cast("long").alias("size"), F.crc32(content).alias("text_crc32"),
                     F.conv(F.substring(F.md5(content), 1, 15), 16, 10).cast("long").alias("h"),
                     number.alias("i"), F.monotonically_increasing_id().alias("r"))


def _histogram(rows: DataFrame, intervals: list[Interval]) -> dict[int, list]:
    """Buckets of each interval in key order: (bytes, rows, least and greatest value of its column and of the next)."""
    bits = max(1, (PROBES // len(intervals)).bit_length() - 1)
    shifts = [max(0, (x.high - x.low).bit_length() - bits) for x in intervals]
    found = rows.withColumn("_at", _below([x.first for x in intervals], inclusive=True)).where("_at > 0")
    level = _numbers(len(x.fixed) for x in intervals)

    def of(array: Column) -> Column:
        return F.get(array, F.col("_at") - 1)

    def column(step: int) -> Column:
        return F.when(of(level) + step == 0, F.col("h")).when(of(level) + step == 1, F.col("i")).otherwise(F.col("r"))
    same = [(of(level) <= k) | (F.col(KEY[k]) == of(_numbers((*x.fixed, 0, 0)[k] for x in intervals))) for k in (0, 1)]
    found = (found.where(same[0] & same[1]).withColumn("_v", column(0)).withColumn("_w", column(1))
             .where(F.col("_v") <= of(_numbers(x.high for x in intervals))))
    shift = of(_numbers(shifts)).cast("int")
    # both ends are shifted before the difference, which a range of more than 63 bits would overflow
    bucket = F.call_function("shiftright", F.col("_v"), shift) - F.call_function(
        "shiftright", of(_numbers(x.low for x in intervals)), shift)
    out: dict[int, list] = {k: [] for k in range(len(intervals))}
    for b in sorted(found.groupBy("_at", bucket.alias("_bucket")).agg(
            F.sum("size"), F.count("size"), F.min("_v"), F.max("_v"), F.min("_w"), F.max("_w")).collect()):
        out[b[0] - 1].append(tuple(b)[2:])
    return out


def _settle(t: Target, at: Interval, buckets: list) -> Interval | None:
    """Gives the target its splitter, or returns the interval to look at next."""
    by, left, total, rows = t.measure == "bytes", at.left, at.bytes_below, at.rows_below
    for size, count, low, high, next_low, next_high in buckets:
        begin, end = (total, total + size) if by else (rows, rows + count)
        right = (*at.fixed, high, *(HIGH,) * (2 - len(at.fixed)))
        if end * t.scale >= t.goal:
            before, after = t.goal - begin * t.scale, end * t.scale - t.goal
            one_text = not at.fixed and low == high
            exact = count == 1 or (by and one_text) or not by
            if count == 1 or (exact and min(before, after) <= t.near):
                t.splitter, t.rows_below = (left, rows) if before <= after else (right, rows + count)
                return None
            fixed, lo, hi = ((*at.fixed, low), next_low, next_high) if low == high else (at.fixed, low, high)
            return Interval(fixed, lo, hi, left=left, bytes_below=total, rows_below=rows)
        left, total, rows = right, total + size, rows + count
    raise AssertionError("a target beyond the last row")


def splitters(rows: DataFrame, shards: int, part_rows: int = PART_ROWS, tolerance: int = TOLERANCE) -> list[Target]:
    """Settled targets: the ends of the first ``shards - 1`` shards in order, then the loose ones of the exchange."""
    total, count, low, high = rows.agg(F.sum("size"), F.count("size"), F.min("h"), F.max("h")).first()
    if not count:
        return []
    parts = max(1, min(MAX_PARTS, -(-count // part_rows)))
    targets = [Target("bytes", k * total, shards, total // tolerance) for k in range(1, shards)]
    targets += [Target("rows", k * count, parts, count // 2) for k in range(1, parts)]
    todo = {Interval((), low, high): targets}
    while todo:
        intervals = sorted(todo, key=lambda x: x.first)
        found, after = _histogram(rows, intervals), {}
        for k, at in enumerate(intervals):
            for t in todo[at]:
                if (deeper := _settle(t, at, found[k])) is not None:
                    after.setdefault(deeper, []).append(t)
        todo = after
    return targets


def shards(df: DataFrame, n: int = 16, doc_id: str = "doc_id", text: str = "text", columns: list[str] | None = None,
           part_rows: int = PART_ROWS, tolerance: int = TOLERANCE) -> DataFrame:
    """(row, size, text_crc32, shard, slot) of every row: its columns, its shard and its place there from 0.

    ``columns`` are carried in ``row`` (all unless told). ``tolerance`` is the divisor of a shard's size."""
    rows = saved(keyed(df, doc_id, text, df.columns if columns is None else columns))
    targets = splitters(rows, n, part_rows, tolerance)
    ends = sorted(t.splitter for t in targets if t.measure == "bytes")
    below = {t.splitter: t.rows_below for t in targets}
    cuts = sorted(below)
    shard_of = [sum(e <= cut for e in ends) for cut in cuts]
    shard_of, begin = [0, *shard_of], [0, *(below[c] for c in cuts)]
    opened: dict[int, int] = {}
    for s, b in zip(shard_of, begin):
        opened.setdefault(s, b)
    offset = [b - opened[s] for s, b in zip(shard_of, begin)]
    part = F.col("_part") + 1
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*KEY))
    return (rows.withColumn("_part", _below(cuts)).withColumn("_number", number)
            .select("row", "size", "text_crc32", F.element_at(_numbers(shard_of), part).cast("int").alias("shard"),
                    (F.col("_number") - 1 + F.element_at(_numbers(offset), part)).alias("slot")))


def write(df: DataFrame, path: str, n: int = 16, **how) -> None:
    """The shards as Parquet folders ``shard=0`` onwards; each file holds a run of slots in order."""
    shards(df, n, **how).write.partitionBy("shard").parquet(path)
