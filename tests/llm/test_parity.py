import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from barlake.llm import graph, parity, queries
from barlake.llm.text import filled
from tests.llm.conftest import ODD


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2)))


def plain(docs):
    """(n_shingles, component) by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    for a, b in {p for h in holders.values() for p in combinations(sorted(h), 2)}:
        k = len(sets[a] & sets[b])
        if 100 * k >= 90 * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    assert result(queries.op4_ngram_jaccard(spark, sf)) == plain(docs)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
        gone = rng.integers(0, 60)
        b = np.unique(np.concatenate((a[gone:], rng.integers(0, 2**63, rng.integers(0, 40)).astype(np.uint64))))
        diff = len(np.setxor1d(a, b))
        for blocks in (1, 4, 33):
            x, y = parity.parity(a, blocks), parity.parity(b, blocks)
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= diff


def test_bands_cover_every_possible_pair():
    bands = parity.Bands(9, 10)
    for a in range(1, 400):
        for b in range(a, 10 * a // 9 + 1):
            d = bands.bound(a, b)
            assert all((2 * d >= 0, 19 * d <= a + b, 19 * (d + 1) > a + b))
            if a >= bands.edges[0]:
                x, y = bands.band(a), bands.band(b)
                assert y - x in (0, 1)
                assert d + 1 <= bands.blocks(y)
            else:
                assert a == b and d == 0 or b > 10 * a // 9 or b >= bands.edges[0] and 10 * a // 9 < b


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "c", "É", "d"]), max_size=12), st.sampled_from([" ", "\n ", "\t"]))
def test_sets_are_shingle_sets(words, blank):
    text = blank.join(words)
    got = next(parity.shingle_sets(filled(pa.array([text]))))
    assert len(got) == len(shingles(text))


def near(seed, n, edits):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(n)]
    for at in rng.integers(0, n, edits):
        words[at] = f"x{seed}{at}"
    return " ".join(words)


def test_chains_groups_of_copies_and_odd_rows(rows):
    texts = ([near(k, 200, 2) for k in range(40)] + [near(0, 200, 2)] * 60 + [near(100 + k, 200, 9) for k in range(20)]
             + [near(k, 30, 1) for k in range(20)] + ["only two"] * 3 + ["Only TWO"] + ODD)
    chain, words = [], [f"c{i}" for i in range(120)]
    for k in range(12):                                       # each linked to the next only
        words = words[1:] + [f"n{k}"]
        chain.append(" ".join(words))
    texts += chain
    ids = list(range(1000, 1000 + len(texts)))
    df = rows(texts, ids=ids)
    assert result(parity.link(df)) == plain(list(zip(ids, texts)))
    kept = parity.first_of_each(df)
    assert kept.columns == df.columns
    want = plain(list(zip(ids, texts)))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_null_and_repeated_ids_and_empty_table(rows):
    df = rows(["a b c d", "a b c d", "a b c d", "q"], ids=[None, 7, 7, None])
    got = sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in parity.link(df).collect())))
    assert got == sorted(map(repr, [(None, 2, None), (7, 2, 7), (7, 2, 7), (None, 1, None)]))
    assert parity.first_of_each(df).count() == 4
    assert parity.link(df.limit(0)).count() == 0


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i + 1, i) for i in range(0, 40)] + [(100, k) for k in range(101, 150)] + [(200, 200), (None, 3)]
    got = {r.node: r.component for r in graph.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
