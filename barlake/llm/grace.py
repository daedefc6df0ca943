"""Exact duplicates by Grace hash partitioning.

Texts are equal when identical after deleting ASCII white space; null counts as empty. Of equal texts the row with the
most code points in the original text stays, then the smallest id (null last), then the first read.

1. Each task folds its rows into local groups with an open-addressing table that compares complete contents, in runs
   of bounded content, so a content goes on once per run however many copies it has. The local groups, with their
   members, are the spill files: a table in the shared folder.
2. Buckets are prefixes of the content hash. A histogram of content bytes per prefix is refined recursively: while a
   bucket of several contents exceeds the limit, the next bits split the buckets (their hashes are uniform, so one
   depth serves all). A single content is never split and may be larger.
3. Each record goes to its bucket; the sorted partitions are read bucket by bucket into an open-addressing table that
   compares complete contents. The table holds each distinct content once, so copies need no room in it.
4. The group of a local group is joined back to its members by the local group's own number: no key is hotter than a
   run is long, also when a third of all rows are copies of one text."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.graph import saved
from barlake.llm.text import WHITE

RUN_BYTES = 32_000_000     # contents of one local run
RUN_ROWS = 100_000         # rows of one local run
BUCKET_BYTES = 8_000_000   # distinct contents of one bucket
FAN_BITS = 8               # bits per level of the recursion


class Table:
    """Open addressing with linear probing over 64-bit hashes; equal hashes compare complete contents."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, bool]:
        """(entry, is new)"""
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (e := slots[at]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e, False
            at = (at + 1) & mask
        slots[at] = e = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return e, True

    def _grow(self):
        size = 4 * len(self.slots)
        self.slots = slots = [-1] * size
        for e, h in enumerate(self.hashes):
            at = h & (size - 1)
            while slots[at] >= 0:
                at = (at + 1) & (size - 1)
            slots[at] = e


def content_of(text: str | None) -> bytes:
    return (text or "").encode().translate(None, WHITE)


def _rank(length: int, doc_id: int | None, order: int) -> tuple:
    """Smaller stays."""
    return (-length, doc_id is None, doc_id or 0, order)


def _local_groups(batches: Iterator[pa.RecordBatch], run_bytes: int, rest: list[str]) -> Iterator[pa.RecordBatch]:
    import xxhash
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    table, best, members, rows = Table(), [], [], 0

    def flush():
        nonlocal number, table, best, members, rows
        if best:
            kept = [b[1] for b in best]
            columns = [pa.array(range(number, number + len(best)), pa.int64()),
                       pa.array(np.array(table.hashes, np.uint64).view(np.int64)),
                       pa.array([len(c) for c in table.contents], pa.int64()),
                       pa.array([-b[0][0] for b in best], pa.int64()),
                       pa.array([b[0][3] for b in best], pa.int64()),
                       pa.array(members, pa.list_(pa.int64()))]
            stay = pa.Table.from_batches([b.slice(i, 1) for b, i in kept]).combine_chunks()
            for b in pa.Table.from_arrays(
                    columns + [stay.column("text"), stay.column("doc_id")]
                    + [stay.column(n) for n in rest],
                    names=["lid", "hash", "bytes", "length", "place", "members", "text", "doc_id",
                           *rest]).to_batches(max_chunksize=2000):
                yield b
            number += len(best)
        table, best, members, rows = Table(), [], [], 0

    for batch in batches:
        for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                               batch.column("text").to_pylist(), strict=True)):
            content = content_of(text)
            e, new = table.find(xxhash.xxh64_intdigest(content), content)
            if new:
                best.append(((1,), None))
                members.append([])
            rank = _rank(len(text or ""), doc_id, len(members[e]))
            members[e].append(doc_id)
            if rank < best[e][0] or best[e][1] is None:
                best[e] = (rank, (batch, i))
            rows += 1
            if table.bytes > run_bytes or rows >= RUN_ROWS:
                yield from flush()
    yield from flush()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records sorted by bucket -> per record its group; a bucket's table is dropped when the next bucket begins."""
    import hashlib

    bucket, table, records, groups = None, Table(), [], []

    def flush():
        if not records:
            return
        digest = [hashlib.sha256(c).hexdigest() for c in table.contents]
        for lo in range(0, len(records), 20_000):
            part = records[lo:lo + 20_000]
            g = [groups[e] for _, e in part]
            yield pa.RecordBatch.from_arrays([
                pa.array([lid for lid, _ in part], pa.int64()), pa.array([x[0][2] if not x[0][1] else None for x in g],
                                                                        pa.int64()),
                pa.array([x[1] for x in g], pa.int64()), pa.array([x[2] for x in g], pa.int64()),
                pa.array([x[3] for x in g], pa.int64()), pa.array([digest[e] for _, e in part], pa.string())],
                names=["lid", "keep_id", "group_size", "best_lid", "best_place", "text_sha256"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("bucket", "lid", "hash", "length", "place", "copies", "doc_id",
                                                      "text")]
        for b, lid, h, length, place, copies, doc_id, text in zip(*cols, strict=True):
            if b != bucket:
                yield from flush()
                bucket, table, records, groups = b, Table(), [], []
            e, new = table.find(h & 0xFFFFFFFFFFFFFFFF, content_of(text))
            rank = _rank(length, doc_id, lid)
            if new:
                groups.append([rank, copies, lid, place])
            else:
                g = groups[e]
                g[1] += copies
                if rank < g[0]:
                    g[0], g[2], g[3] = rank, lid, place
            records.append((lid, e))
    yield from flush()


def _prefix(depth: int, fan_bits: int):
    return F.shiftrightunsigned("hash", 64 - fan_bits * depth) if depth else F.lit(0).cast("long")


def depth(records: DataFrame, bucket_bytes: int = BUCKET_BYTES, fan_bits: int = FAN_BITS) -> int:
    """Levels of ``fan_bits`` hash bits after which every bucket of several hashes fits.

    Each level splits the buckets of the one before; the recursion runs on byte counts per prefix, so the records
    move once, straight to their last bucket. Only one yes or no per level reaches the driver."""
    sized = records.groupBy("hash").agg(F.max("bytes").alias("bytes"))
    for level in range(64 // fan_bits):
        large = (sized.groupBy(_prefix(level, fan_bits)).agg(F.sum("bytes").alias("b"), F.count("hash").alias("n"))
                 .where((F.col("b") > bucket_bytes) & (F.col("n") > 1)))
        if not large.limit(1).count():
            return level
    return 64 // fan_bits


def _grouped(df: DataFrame, doc_id: str, text: str, run_bytes: int, bucket_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(local groups, group of each local group)"""
    others = [c for c in df.columns if c not in (doc_id, text)]
    plain = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                      *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)])
    extra = T.StructType([f for f in plain.schema.fields if f.name not in ("doc_id", "text")])
    rest = extra.names
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("lid", "hash", "bytes", "length", "place")]
                          + [T.StructField("members", T.ArrayType(T.LongType())), T.StructField("text", T.StringType()),
                             T.StructField("doc_id", T.LongType()), *extra.fields])
    local = saved(plain.mapInArrow(lambda it: _local_groups(it, run_bytes, rest), schema))
    level = depth(local.select("hash", "bytes"), bucket_bytes)
    records = local.select("lid", "hash", "length", "place", F.size("members").cast("long").alias("copies"), "doc_id",
                           "text", _prefix(level, FAN_BITS).alias("bucket"))
    grouped = (records.repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(_groups, "lid long, keep_id long, group_size long, best_lid long, "
                                                       "best_place long, text_sha256 string"))
    return local, grouped


def copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", run_bytes: int = RUN_BYTES,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    local, grouped = _grouped(df.select(doc_id, text), doc_id, text, run_bytes, bucket_bytes)
    rows = local.select("lid", F.posexplode("members").alias("_place", "_id")).join(grouped, "lid")
    kept = (F.col("lid") == F.col("best_lid")) & (F.col("_place") == F.col("best_place"))
    return rows.select(F.col("_id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def distinct(df: DataFrame, doc_id: str = "doc_id", text: str = "text", run_bytes: int = RUN_BYTES,
             bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; a null text comes back as it was."""
    local, grouped = _grouped(df, doc_id, text, run_bytes, bucket_bytes)
    keep = grouped.where("lid = best_lid").select("lid")
    others = {c: f"_{i}" for i, c in enumerate(x for x in df.columns if x not in (doc_id, text))}
    return local.join(keep, "lid", "left_semi").select(*[
        F.col({doc_id: "doc_id", text: "text"}.get(c, others.get(c))).alias(c) for c in df.columns])
