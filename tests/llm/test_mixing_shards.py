"""The permutations of blocks, the shards that the tree deals, and tables with names of the operator's own."""
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barlake.llm import mixing, queries


@pytest.mark.parametrize("blocks", [1, 2, 3, 4, 8, 32, 65, 400])
def test_each_copy_has_a_permutation_of_its_own(spark, blocks):
    df = spark.range(blocks).crossJoin(spark.range(6).withColumnRenamed("id", "copy")).select("id", "copy", mixing._place(
        F.col("id"), F.lit(blocks).cast("long"), F.col("copy"), F.lit(3).cast("long"), 0).alias("place"))
    orders = defaultdict(dict)
    for r in df.collect():
        orders[r.copy][r.id] = r.place
    for o in orders.values():
        assert sorted(o.values()) == list(range(blocks)) and o[blocks - 1] == blocks - 1
    if blocks >= 32:                                           # all different, none is a shift or a reversal
        lists = [tuple(o[i] for i in range(blocks)) for o in orders.values()]
        assert len(set(lists)) == len(lists)
        for x in lists:
            steps = {(b - a) % (blocks - 1) for a, b in zip(x[:-2], x[1:-1])}
            assert len(steps) > blocks // 4


def test_places_are_spread_evenly(spark):
    """Over many copies a block meets every place about as often."""
    df = spark.range(4000).select(mixing._place(F.lit(5).cast("long"), F.lit(17).cast("long"), F.col("id"), F.lit(0), 1).alias("p"))
    n = {r.p: r["count"] for r in df.groupBy("p").count().collect()}
    assert len(n) == 16 and all(190 < v < 310 for v in n.values())


def test_the_deal_is_the_one_of_the_tree(rows):
    """Blocks counted by brute force from the pieces of rows: each copy of a block is whole in one shard, and shards
    hold as many of a source's blocks as their leaf says."""
    b = 8
    df = rows([" ".join(f"d{i}w{k}" for k in range(5 + i % 9)) for i in range(90)], sources=["a", "b", "b", "b", "c", "c"] * 15)
    m = mixing.mix(df, block_words=b, shard_words=64, least_levels=2)
    of = {r.rid: r for r in m.rows.collect()}
    names = sorted({r.source for r in of.values()})
    start, at = {}, defaultdict(int)
    for rid in sorted(of):
        start[rid] = at[of[rid].source]
        at[of[rid].source] += of[rid]["size"]
    shard_of, words = defaultdict(set), defaultdict(int)
    for p in m.pieces.collect():
        first = start[p.rid] + p.first_word
        assert first // b == (first + p.n_words - 1) // b
        block = (names.index(of[p.rid].source), p.copy, first // b)
        shard_of[block].add(p.shard)
        words[block] += p.n_words
    assert all(len(x) == 1 for x in shard_of.values()) and max(words.values()) <= b
    got = defaultdict(int)
    for (source, _, _), x in shard_of.items():
        got[next(iter(x)), source] += 1
    assert got == {(q.shard, q.rank): q.n_blocks for q in m.quotas.collect()}
    assert len({s for s, _ in got}) > 4
    for r in mixing.taken(m).collect():
        parts = [tuple(map(int, x.split(":"))) for x in r.shards.split(",") if x]
        assert sum(n for _, n in parts) == r.taken and [s for s, _ in parts] == sorted({s for s, _ in parts})


def test_the_query_deals_over_shards(spark):
    got = queries.op2_mixing(spark, "/root/testdata/sf0.001").collect()
    used = {x.split(":")[0] for r in got for x in r.shards.split(",") if x}
    assert len(used) == 16


def test_names_of_its_own_and_rows_alike(spark):
    texts = [("a b c", 1), ("a b c", 2), ("d e f", 3), (None, 4), ("g h i", 5), ("g h i", 6)]
    df = spark.createDataFrame([(None if k < 5 else 7, t, "s", k, 900 + k, "x", k * 1.5, k, "r", k) for t, k in texts],
                               "doc_id long, text string, source string, _no long, _id long, _src string, _size double, "
                               "_hash long, _ranges string, _n long")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted((tuple(r) for r in df.collect() if r.text), key=repr)
