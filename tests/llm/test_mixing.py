import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barlake.llm import mixing, queries
from tests.llm.conftest import ODD


def plain_targets(sizes, weights=(1, 2, 3), cap=3):
    """Share by weight, stop at the cap, share the excess again until nothing is above it."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, left = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in capped]
        unit = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if unit * w[s] > cap * sizes[s]]
        if not over:
            return {**target, **{s: unit * w[s] for s in free}}
        for s in over:
            capped.add(s)
            target[s] = float(cap * sizes[s])
            left -= target[s]


def check(df, m, block_words):
    got = mixing.taken(m).collect()
    texts = df.select("doc_id", "text", "source").collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(map(repr, ((r.doc_id, r["size"]) for r in got))) == sorted(
        map(repr, ((r.doc_id, count(r.text)) for r in texts)))
    sizes = Counter()
    for r in texts:
        sizes[r.source] += count(r.text)
    want = plain_targets(sizes)
    source = {r.doc_id: r.source for r in texts}
    total = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * r["size"]
        total[s] += r.taken
    for s, n in total.items():
        assert abs(n - want[s]) <= 1


def test_query_meets_targets_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.table(spark, sf, "documents")
    check(df, mixing.mix(df), mixing.BLOCK_WORDS)
    a = sorted(map(tuple, queries.op2_mixing(spark, sf).collect()))
    b = sorted(map(tuple, queries.op2_mixing(spark, sf).collect()))
    assert a == b


def test_skewed_sources_caps_and_odd_rows(rows):
    texts = ["w " * n for n in (500, 400, 300, 3, 2, 1)] + ODD[:9]
    sources = ["big"] * 3 + ["é", "a", None] + [None, "z", "z", "b", "b", "a", "a", "c", "c"]
    df = rows(texts, sources=sources)
    m = mixing.mix(df, block_words=16, shard_words=100)
    check(df, m, 16)
    pieces = m.pieces.collect()
    by_shard = Counter()
    for p in pieces:
        by_shard[p.shard] += 1
    assert len(by_shard) > 4
    # no word of a row is taken twice in one copy
    for (rid, copy), ps in _grouped(pieces).items():
        spans = sorted((p.first_word, p.first_word + p.n_words) for p in ps)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def _grouped(pieces):
    out = defaultdict(list)
    for p in pieces:
        out[p.rid, p.copy].append(p)
    return out


def test_leaves_split_quotas_exactly_and_like_a_draw(spark):
    q = spark.createDataFrame([(0, 40), (1, 5), (2, 0), (3, 83)], "rank long, n_blocks long")
    leaves = mixing.split_quotas(q, 3, seed=5).collect()
    by = defaultdict(list)
    for r in leaves:
        by[r.rank].append((r.first_copy, r.n_blocks))
    assert {k: sum(n for _, n in v) for k, v in by.items()} == {0: 40, 1: 5, 3: 83}
    for v in by.values():                                    # disjoint, without gaps
        at = 0
        for first, n in sorted(v):
            assert first == at
            at += n
    per = Counter()
    for r in leaves:
        per[r.shard] += r.n_blocks
    assert set(per) == set(range(8)) and max(per.values()) - min(per.values()) <= 1


def test_hypergeometric_is_exact(spark):
    """Inverse CDF on a grid of u against the exact distribution."""
    from math import comb
    total, marked, draws, steps = 50, 18, 21, 4000
    df = spark.range(steps).select(mixing.hypergeometric(
        F.lit(total), F.lit(marked), F.lit(draws), (F.col("id") + 0.5) / steps).alias("k"))
    got = Counter(r.k for r in df.collect())
    for k in range(0, 19):
        p = comb(marked, k) * comb(total - marked, draws - k) / comb(total, draws) if draws >= k else 0
        assert abs(got[k] / steps - p) < 2 / steps


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_blank_tables(rows, n):
    df = rows(["  "] * n)
    out = mixing.taken(mixing.mix(df)).collect()
    assert len(out) == n and all(r.taken == 0 and r.target == 0 for r in out)
    assert mixing.mixed(df).count() == 0


def test_mixed_rows_hold_the_taken_words(rows):
    texts = [" ".join(f"d{i}w{k}" for k in range(20 + i)) for i in range(12)]
    df = rows(texts, sources=["a", "b", "c"] * 4)
    how = dict(block_words=8, shard_words=64)
    m = mixing.mix(df, **how)
    want = {r.doc_id: r.taken for r in mixing.taken(m).collect()}
    out = mixing.mixed(df, **how)
    assert out.columns == df.columns
    got = Counter()
    for r in out.collect():
        words = r.text.split()
        assert set(words) <= set(texts[r.doc_id].split()) and len(words) == len(set(words))
        assert r.n_chars == len(r.text)
        got[r.doc_id] += len(words)
    assert got == {k: v for k, v in want.items() if v}
