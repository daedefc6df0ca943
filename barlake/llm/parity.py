"""N-gram Jaccard join by parity sketches.

A text's set is its distinct shingles of ``width`` words (three unless told; ASCII lower case; fewer words are one
shingle, no words the empty set), each a 64-bit hash. A parity sketch of b blocks throws each shingle at one bit and
keeps the parity of every bit; the exclusive or of two sketches is the sketch of the symmetric difference, so their
Hamming distance is at most its size. Similarity of at least p/q of two sets of sizes a and b bounds that size by
(a + b)(q - p)/(q + p). Sizes fall into bands such that partners lie in the same band or the next; within a join
band the bound is at most d, so of d + m blocks at least m of two partners agree (pigeonhole). A block's key is the
exclusive or of the hashes of its shingles: 64 parities of random halves of them. A set with fewer than m empty blocks
shares a block that is not empty with each partner, so its empty ones, which unlike texts share, are no keys; m grows
with the empty blocks to expect. Each text is keyed by its blocks in its own band and in the next.

1. One pass over the texts writes, per row, size, digest of the set and a small sketch. Equal sets are one class; its
   copies are never paired.
2. A second pass makes the keys, of the first copy that a task sees only. They are never written one by one: a run of
   rows sends its keys packed by ``parts`` of the key space, four bytes a key (the part holds the rest of it) and two for
   the row, each key once. A part finds the keys of several runs; those that a run holds more than once are known to
   be shared, and their rows go straight on. So a part gets at most one entry of a key from each run, however many rows
   share it, and only shared keys become rows. Two keys that agree in these bits are one more candidate, no error.
   Keys that several classes share give candidates. Each class is first compared with the smallest class under the
   same key (a star, so candidates grow with the rows under a key, not with their square).
3. Candidates whose sketches differ by more than the bound are no partners; the rest are verified on the full sets.
4. Components of the verified links. Then every pair under a shared key that is still in different components is
   compared by sketch inside the join and, if it passes, verified: no link is lost, and copies or chains that already
   hang together cost nothing.

Rows with a null id get a size and no component. Repeated ids with equal sets count as copies."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from barlake.llm.graph import components, outcome, saved
from barlake.llm.text import coded_words, filled, list_array, slices

SHINGLE = 3
RUN_KEYS = 1_000_000
_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    import xxhash

    per_row, codes, vocab = coded_words(pc.ascii_lower(texts))
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer()) for w in vocab), np.uint64, len(vocab))
    h, at = hashes[codes], 0
    for n in per_row.tolist():
        w = h[at:at + n]
        at += n
        if n == 0:
            yield w
            continue
        k = min(width, n)
        s = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            s = _mix(s * _P1 + w[j:j + n - k + 1] + np.uint64(j + 1))
        yield np.unique(s)


class Bands:
    """Size bands for similarity ``p/q`` and the number of blocks of each join band."""

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q
        first = 1
        while self._partner(first) == first:
            first += 1  # smaller sets are partners of equal sets only
        self.edges = [first]
        self._spare: dict[int, tuple[int, int]] = {}

    def _partner(self, n: int) -> int:
        return n * self.q // self.p

    def bound(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (self.q - self.p) // (self.q + self.p)

    def band(self, n: int) -> int:
        while self.edges[-1] <= n:
            self.edges.append(self._partner(self.edges[-1]) + 1)
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def spare(self, j: int) -> tuple[int, int]:
        """(largest difference of partners in join band j, blocks beyond it)."""
        if j not in self._spare:
            self.band(self.edges[j])
            top = self.edges[j + 1] - 1
            d, least = self.bound(top, top), self.edges[max(0, j - 1)]
            self._spare[j] = d, 1 + math.ceil(2.5 * d * math.exp(-3 * least / (4 * max(d, 1))))
        return self._spare[j]

    def blocks(self, j: int) -> int:
        return sum(self.spare(j))


def parity(s: np.ndarray, blocks: int) -> np.ndarray:
    """Parity sketch of a set as 64-bit blocks."""
    bits = np.bincount((s % np.uint64(blocks * 64)).astype(np.int64), minlength=blocks * 64) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def block_keys(s: np.ndarray, j: int, bands: Bands) -> np.ndarray:
    """Keys of a set (sorted hashes) in join band ``j``; empty blocks only where all blocks that agree may be empty."""
    nb = bands.blocks(j)
    block = ((s >> np.uint64(32)) * np.uint64(nb)) >> np.uint64(32)
    starts = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1))
    content, at = np.bitwise_xor.reduceat(_mix(s), starts), block[starts]
    if nb - len(at) >= bands.spare(j)[1]:
        empty = np.setdiff1d(np.arange(nb, dtype=np.uint64), at)
        content, at = np.concatenate((content, np.zeros(len(empty), np.uint64))), np.concatenate((at, empty))
    return _mix(content * _P1 ^ _mix(at + (np.uint64(j) << np.uint64(32)))).view(np.int64)


def small_sketch(s: np.ndarray, bound: int) -> np.ndarray:
    """Parity sketch of a power of two bits, about sixteen per possible difference; halves fold by exclusive or."""
    blocks = 1 << max(0, (bound * 16 - 1).bit_length() - 6)
    return parity(_mix(s), blocks)


def _rows(batches: Iterator[pa.RecordBatch], p: int, q: int, width: int) -> Iterator[pa.RecordBatch]:
    import xxhash

    bands = Bands(p, q)
    for batch in batches:
        texts, ids = filled(batch.column("text")), batch.column("doc_id")
        known = ids.is_valid().to_pylist()
        for lo, hi in slices(texts):
            sizes, digests, sketches = [], [], []
            for i, s in enumerate(shingle_sets(texts.slice(lo, hi - lo), width), lo):
                n = len(s)
                sizes.append(n)
                digests.append(xxhash.xxh128_digest(s.tobytes()) if n else None)
                sketches.append(small_sketch(s, bands.bound(n, n) + 1) if n >= bands.edges[0] and known[i]
                                else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 list_array(np.array([len(x) for x in sketches]), pa.array(np.concatenate(sketches), pa.int64()))],
                names=["doc_id", "n", "digest", "sketch"])


def _packed(keys: np.ndarray, rows: np.ndarray, ids: np.ndarray, parts: int, run: int) -> pa.RecordBatch:
    """Keys of a run of rows by part: the distinct ones; and, in one more row (part below 0), all entries of those that
    occur more than once."""
    part = ((keys.view(np.uint64) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    whole = (part << np.uint64(32)) | (keys.view(np.uint64) & np.uint64(0xFFFFFFFF))
    order = np.argsort(whole, kind="stable")
    whole, rows = whole[order], rows[order]
    first = np.concatenate(([True], whole[1:] != whole[:-1]))
    more = ~first
    more[:-1] |= ~first[1:]                                 # every entry of a key that occurs again
    cells = []
    single, row1 = whole[first], rows[first]
    cuts = np.searchsorted(single >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
    for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        used, place = np.unique(row1[cuts[k]:cuts[k + 1]], return_inverse=True)
        cells.append((k, (single[cuts[k]:cuts[k + 1]] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                      place.astype(np.uint16).tobytes(), ids[used].tobytes()))
    if more.any():
        used, place = np.unique(rows[more], return_inverse=True)
        cells.append((-1 - run % parts, whole[more].tobytes(), place.astype(np.uint16).tobytes(), ids[used].tobytes()))
    columns = list(zip(*cells)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                      names=["part", "keys", "rows", "ids"])


def _keys(batches: Iterator[pa.RecordBatch], p: int, q: int, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Packed keys of the first copies that this task sees, in runs of at most ``RUN_KEYS`` keys and 2^16 rows."""
    import xxhash

    bands, seen = Bands(p, q), set()
    keys, ids, held = [], [], 0

    def packed() -> pa.RecordBatch:
        counts = [len(k) for k in keys]
        return _packed(np.concatenate(keys), np.repeat(np.arange(len(keys)), counts), np.array(ids, np.int64), parts,
                       ids[0])

    for batch in batches:
        texts, numbers = filled(batch.column("text")), batch.column("doc_id").to_pylist()
        for lo, hi in slices(texts):
            for i, s in enumerate(shingle_sets(texts.slice(lo, hi - lo), width), lo):
                if len(s) < bands.edges[0] or numbers[i] is None:
                    continue
                if (digest := xxhash.xxh128_digest(s.tobytes())) in seen:
                    continue
                seen.add(digest)
                j = bands.band(len(s))
                # a row's own keys are distinct: a key met twice in a run is shared by two rows
                keys.append(np.unique(np.concatenate((block_keys(s, j, bands), block_keys(s, j + 1, bands)))))
                ids.append(int(numbers[i]))
                held += len(keys[-1])
                if held >= RUN_KEYS or len(ids) == 1 << 16:
                    yield packed()
                    keys, ids, held = [], [], 0
    if ids:
        yield packed()


def _shared(cells: pa.Table) -> pa.Table:
    """(key, doc_id) of the keys of a part that several runs hold; of known ones, all."""
    part = cells["part"][0].as_py()
    lists = [[np.frombuffer(x.as_buffer(), kind) for x in cells[c]] for c, kind in (
        ("keys", np.uint64 if part < 0 else np.uint32), ("rows", np.uint16), ("ids", np.int64))]
    keys = np.concatenate(lists[0]).astype(np.uint64)
    ids = np.concatenate([i[r] for r, i in zip(lists[1], lists[2])])
    if part >= 0:
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        again = np.concatenate(([False], keys[1:] == keys[:-1]))
        again[:-1] |= again[1:]
        keys, ids = keys[again] | np.uint64(part << 32), ids[again]
    return pa.table({"key": pa.array(keys.view(np.int64)), "doc_id": pa.array(ids)})


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = filled(batch.column("text"))
        for lo, hi in slices(texts):
            s = list(shingle_sets(texts.slice(lo, hi - lo), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()),
                 list_array(np.array([len(x) for x in s]), pa.array(np.concatenate(s).view(np.int64)))],
                names=["node", "items"])


def _distance(a, b):
    """Hamming distance of two small sketches, the longer folded to the shorter (partners differ by one doubling)."""
    def fold(x, other):
        half = F.floor(F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(other), F.zip_with(
            F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(x)
    return F.aggregate(F.zip_with(fold(a, b), fold(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0),
                       lambda t, x: t + F.coalesce(x, F.lit(0)))


def _may_link(p: int, q: int):
    na, nb = F.col("x.n"), F.col("y.n")
    return ((F.least(na, nb) * q >= F.greatest(na, nb) * p)
            & (_distance(F.col("x.sketch"), F.col("y.sketch")) <= F.floor((na + nb) * (q - p) / (q + p))))


def _verified(pairs: DataFrame, docs: DataFrame, p: int, q: int, width: int) -> DataFrame:
    """Pairs (a, b) of class representatives whose full sets are similar enough."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = saved(docs.join(wanted, "doc_id", "left_semi")
                 .mapInArrow(lambda it: _sets(it, width), "node long, items array<long>").dropDuplicates(["node"]))
    x, y = sets.select(F.col("node").alias("a"), F.col("items").alias("u")), \
        sets.select(F.col("node").alias("b"), F.col("items").alias("v"))
    common = F.size(F.array_intersect("u", "v"))
    return (pairs.join(x, "a").join(y, "b")
            .where(common * q >= (F.size("u") + F.size("v") - common) * p).select("a", "b"))


def link(df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: tuple[int, int] = (9, 10),
         width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the smallest id reachable over links of Jaccard >= p/q."""
    p, q = similarity
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = saved(docs.mapInArrow(lambda it: _rows(it, p, q, width),
                                 "doc_id long, n long, digest binary, sketch array<long>"))
    slim = rows.select("doc_id", "n", "digest")
    classes = slim.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("node"))
    # keys that at least two runs of rows share, or two rows of a run; a class has a row in each task that saw it
    w = Window.partitionBy("key")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = docs.mapInArrow(lambda it: _keys(it, p, q, width, parts), "part int, keys binary, rows binary, ids binary")
    shared = cells.groupBy("part").applyInArrow(_shared, "key long, doc_id long")
    node_of = slim.where("n > 0 AND doc_id IS NOT NULL").join(classes, "digest").select("doc_id", "node").distinct()
    shared = saved(shared.join(node_of, "doc_id").select("key", "node").distinct())
    nodes = saved(rows.join(shared.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
                  .select(F.col("doc_id").alias("node"), "n", "sketch").dropDuplicates(["node"]))
    star = (shared.withColumn("a", F.min("node").over(w)).where("a < node")
            .select("a", F.col("node").alias("b")).distinct())
    near = (star.join(nodes.alias("x"), F.col("a") == F.col("x.node"))
            .join(nodes.alias("y"), F.col("b") == F.col("y.node")).where(_may_link(p, q)).select("a", "b"))
    first = saved(_verified(saved(near), docs, p, q, width))
    comp = components(first)
    # pairs under a key that the star left in different components
    split = (shared.join(comp, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
             .withColumn("_lo", F.min("comp").over(w)).withColumn("_hi", F.max("comp").over(w))
             .where("_lo < _hi").select("key", "node", "comp").join(nodes, "node"))
    split = saved(split)
    rest = (split.alias("x").join(split.alias("y"), (F.col("x.key") == F.col("y.key"))
                                  & (F.col("x.comp") < F.col("y.comp")) & _may_link(p, q))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    links = first.unionByName(_verified(saved(rest), docs, p, q, width))
    comp = components(links)
    by_class = classes.join(comp, "node", "left").select("digest", F.coalesce("component", "node").alias("_c"))
    return (slim.join(by_class, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id")).alias("component_id")))


def first_of_each(df: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    """``df`` without the rows whose id is not the smallest of their component; rows without an id stay."""
    gone = outcome(df.sparkSession, lambda: link(df, doc_id, **how).where("doc_id <> component_id")
                   .select(F.col("doc_id").alias(doc_id)).distinct())
    return df.join(gone, doc_id, "left_anti").select(*df.columns)
