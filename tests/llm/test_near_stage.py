"""The near-copies stage links five-word shingles at 0.8."""
from itertools import combinations

import numpy as np

import corpus_pipeline
from barlake.llm import parity
from tests.llm.conftest import ODD
from tests.llm.test_parity import near, result


def plain(docs, width=5, p=4, q=5):
    """(n_shingles, component) by comparing all pairs."""
    sets, parent = {}, {i: i for i, _ in docs}
    for i, t in docs:
        w = "".join(c.lower() if c < "\x80" else c for c in t or "").split(" ")
        w = [x for y in w for x in y.split("\n") for x in x.split("\t") if x]
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        k = len(sets[a] & sets[b])
        if k and q * k >= p * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_appended_and_edited_copies_go(rows, spark):
    texts = [" ".join(f"{k}w{i}" for i in range(n)) for k, n in enumerate((8, 20, 60, 200, 700))]
    texts += [t + " " + " ".join(f"z{k}{i}" for i in range(len(t.split()) // 5)) for k, t in enumerate(texts)]
    texts += [near(k, 200, 4) for k in range(40)] + [near(k, 40, 1) for k in range(20)] + ["one two", "One TWO", *ODD]
    df = rows(texts, ids=list(range(len(texts))))
    want = plain(list(enumerate(texts)))
    assert result(parity.link(df, similarity=(4, 5), width=5)) == want
    kept = {r.doc_id for r in corpus_pipeline.near_copies(spark, df, "").collect()}
    assert kept == {i for i, (_, c) in want.items() if c == i} and not kept & {7, 8, 9}


def test_partners_share_a_key_and_unlike_sets_do_not():
    rng, bands = np.random.default_rng(3), parity.Bands(4, 5)
    draw = lambda n: np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    def keys(s):
        b = bands.band(len(s))
        return {k for j in (b, b + 1) for k in parity.block_keys(s, j, bands).tolist()}
    shared = 0
    for n in [*range(4, 60), *range(60, 900, 7)]:
        a = draw(n)
        most = bands.bound(n, n) // 2
        b = np.unique(np.concatenate((a[rng.permutation(n)[most:]], draw(most))))
        assert keys(a) & keys(b)
        longer = np.unique(np.concatenate((a, draw(n // 4))))
        assert keys(a) & keys(longer)
        shared += bool(keys(a) & keys(draw(n)))
    assert shared <= 5


def test_tables_made_on_the_way_are_deleted(rows, spark):
    import os

    from barlake.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    tables = lambda: {x for x in os.listdir(folder) if x.startswith("table-")}
    before = tables()
    df = rows([near(k, 40, 1) for k in range(20)] + ["one two", None], ids=list(range(22)))
    kept = parity.first_of_each(df, similarity=(4, 5), width=5)
    assert len(tables() - before) == 1       # the ids that go
    assert kept.count() == kept.count() <= 22
