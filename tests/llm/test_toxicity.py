import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import queries, toxicity
from tests.llm.conftest import ODD


@pytest.mark.parametrize("dense", [0, 7, 512])
def test_index_is_exact(monkeypatch, dense):
    """k nearest with ties, against all cosines; with no, some and all terms kept as arrays."""
    monkeypatch.setattr(toxicity, "DENSE", dense)
    rng = np.random.default_rng(3)
    examples = {}
    for _ in range(900):
        t = np.unique(rng.integers(0, 40, rng.integers(1, 7)))
        w = rng.random(len(t)).astype(np.float32)
        examples.setdefault(tuple(t), (t, (w / np.sqrt((w * w).sum())).astype(np.float32)))
    vectors = list(examples.values())
    count = rng.integers(1, 5, len(vectors))
    index = toxicity.Index(vectors, count // 2, count, 40)
    dense = np.zeros((len(vectors), 40))
    for row, e in enumerate(index.order):
        dense[row, vectors[e][0]] = vectors[e][1]
    for t, w in vectors[::17]:
        cosines = dense[:, t] @ w.astype(float)
        rank = np.argsort(-cosines, kind="stable")
        at = int(np.searchsorted(np.cumsum(index.count[rank]), 25))
        floor = cosines[rank[min(at, len(rank) - 1)]]
        e, s = index.similar([(t, w.astype(float)), (t[:0], w[:0])], 25)[0]
        assert set(e.tolist()) == set(np.flatnonzero((cosines >= floor - 1e-6) & (cosines > 0)).tolist())
        assert np.allclose(s, cosines[e], atol=1e-6) and (np.diff(s) <= 0).all()


def test_terms_are_words_and_beginnings():
    assert toxicity.terms_of("(fools,") == ["fools", "fools~"]
    assert toxicity.terms_of("worthless") == ["worthless", "worth~"]
    assert toxicity.terms_of("mob") == ["mob"] and toxicity.terms_of("12!") == []


def plain_scores(docs: dict, labels: dict, k: int, power: float, prior: float, floor: float) -> dict:
    """Score and neighbours (id: cosine) of every text, by comparing it with every labelled one."""
    def bag(text):
        c = Counter()
        for w in re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()):
            w = w.strip(toxicity._EDGE)
            c.update([w, w[:5] + "~"] if len(w) >= 5 else [w] if w else [])
        return c
    bags = {i: bag(t) for i, t in docs.items()}
    terms = {t for i in labels for t in bags[i]}
    df = Counter(t for b in bags.values() for t in b if t in terms)
    n, toxic = len(labels), sum(labels.values())
    strength = {}
    for t in terms:
        a = sum(labels[i] for i in labels if t in bags[i]) + 0.5
        b = sum(1 - labels[i] for i in labels if t in bags[i]) + 0.5
        sure = math.log(a / b) - math.log((toxic + 1) / (n - toxic + 1)) - 1.64 * math.sqrt(1 / a + 1 / b)
        strength[t] = max(math.log((1 + len(docs)) / (1 + df[t])), 0) * (floor + max(sure, 0))

    def unit(b):
        v = {t: (1 + math.log(m)) * strength[t] for t, m in b.items() if strength.get(t, 0) > 0}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}
    vectors = {i: unit(b) for i, b in bags.items()}
    out = {}
    for i, v in vectors.items():
        s = sorted(((sum(x * vectors[e].get(t, 0) for t, x in v.items()), e) for e in labels), reverse=True)
        s = [x for x in s if x[0] > 0]
        last = s[k - 1][0] if len(s) >= k else 0
        s = [x for x in s if x[0] >= last - 1e-6]
        votes = sum(c ** power for c, _ in s)
        out[i] = ((sum(c ** power * labels[e] for c, e in s) + prior * toxic / n) / (votes + prior), {e: c for c, e in s})
    return out


def test_fit_and_score_against_all_pairs(spark, rows):
    """Terms, frequencies over all texts, weights, neighbours, votes and evidence on a small table."""
    rng = np.random.default_rng(5)
    common = [f"w{i}ord{i % 7}" for i in range(60)]
    texts = []
    for i in range(160):
        words = rng.choice(common, rng.integers(3, 25)).tolist() + ["the"]
        if i % 6 == 0:
            words += rng.choice(["vile", "scummy", "scummier"], 2).tolist()
        texts.append(" ".join(rng.permutation(words)) + ("!" if i % 3 else ""))
    texts += [None, "", "unheard alone", *texts[:3]]
    docs = rows(texts)
    toxic = {i: int(i % 6 == 0) for i in range(0, 160, 2)}
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, label int")
    options = {"k": 9, "power": 2.0, "prior": 0.03, "floor": 0.1}
    want = plain_scores(dict(enumerate(texts)), toxic, **options)
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs, toxicity.fit(labels, docs, **options)).collect()}
    assert got.keys() == want.keys()
    for i, (s, near) in want.items():
        assert abs(got[i].score - s) < 1e-4, i
        assert sum(v.texts for v in got[i].evidence) == len(near)
        for v in got[i].evidence:
            assert abs(v.cosine - near[v.id]) < 1e-5 and v.toxic == toxic[v.id]
    assert got[160].score == got[161].score == got[162].score and got[160].evidence == []


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.1"
    return queries.op8_toxicity(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").cache()


def test_held_out_accuracy(scored):
    held = scored.where("held_out").select("score", "predicted", "toxic").toPandas()
    assert len(held) > 500 and held.score.between(0, 1).all()
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.02
    ranks = held.score.rank()
    n, m = len(toxic), len(clean)
    assert (ranks[held.toxic == 1].sum() - n * (n + 1) / 2) / (n * m) > 0.93


def test_held_out_split_and_calibration(scored):
    import zlib
    for r in scored.select("doc_id", "held_out", "score", "predicted").limit(300).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3)
    low = scored.where("held_out AND score < 0.3").agg(F.avg("toxic"), F.avg("score")).first()
    assert abs(low[0] - low[1]) < 0.05


def test_score_of_the_odd_texts(spark, rows):
    docs = rows([f"plain words number {i} here" + (" vile" if i % 5 == 0 else "") for i in range(400)])
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("label"))
    m = toxicity.fit(labels, docs)
    out = {r.doc_id: r.toxicity for r in toxicity.score(rows([*ODD, "so vile", "so plain"]), m).collect()}
    assert out[len(ODD)].score > 0.8 and out[len(ODD)].evidence[0].toxic == out[len(ODD)].evidence[0].texts
    assert all(0 <= r.score <= 1 for r in out.values())
    assert out[0].score == out[1].score < 0.3 and out[len(ODD) + 1].score < 0.3


def test_copies_are_one_neighbour(spark, rows):
    """A third of the labelled rows are one text: one entry of the evidence, under its smallest id, with all its labels."""
    docs = rows(["vile same text"] * 40 + [f"other kind {i}" for i in range(80)])
    labels = docs.select("doc_id", (F.col("doc_id") < 30).cast("int").alias("label"))
    near = toxicity.score(docs, toxicity.fit(labels, docs)).where("doc_id = 35").first().toxicity
    assert [(v.id, v.toxic, v.texts) for v in near.evidence] == [(0, 30, 40)] and 0.7 < near.score < 0.76


def test_sample_is_bounded_and_nothing_to_learn_from(spark, rows):
    docs = rows([f"text {i}" for i in range(50)])
    labels = docs.select("doc_id", F.lit(0).alias("label"))
    m = toxicity.fit(labels, docs, max_examples=20)
    assert m.index.count.sum() == 20
    assert toxicity.fit(labels, docs, max_chars=30).index.count.sum() in (4, 5)
    assert toxicity.fit(labels, docs, max_chars=1).index.count.sum() == 1
    empty = toxicity.fit(labels.limit(0), docs)
    assert all(r.toxicity.score == 0.5 for r in toxicity.score(docs, empty).collect())
    blank = rows([None, "", " 12 "])
    assert toxicity.score(blank, toxicity.fit(labels, blank)).count() == 3
    assert toxicity.score(docs.limit(0), m).count() == 0


def test_repeated_ids(spark, rows):
    docs = rows(["b vile", "a vile", "c"], ids=[1, 1, 2])
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (2, None)], "doc_id long, label int")
    m = toxicity.fit(labels, docs)
    assert m.index.count.sum() == 2 and m.index.toxic.sum() == 1 and "a" in m.names.to_pylist() and "b" not in m.names.to_pylist()
