import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barlake.llm import language, queries
from barlake.llm.text import filled
from tests.llm.conftest import ODD


def plain_trigrams(text):
    b = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in (text or "").encode())
    out = Counter()
    for i in range(len(b) - 2):
        if b[i + 1] == 32 and (b[i] == 32 or b[i + 2] == 32):
            continue
        h = (b[i] << 16) | (b[i + 1] << 8) | b[i + 2]
        out[(h * 2654435761 % 2**32) >> 16] += 1
    return out, sum(c != 32 for c in b)


def test_trigrams():
    texts = ["", "ab", "A b", "Hello, wörld 12", None, "x" * 40]
    bucket, row, letters = language._trigrams(filled(pa.array(texts)))
    for i, t in enumerate(texts):
        want, n = plain_trigrams(t)
        assert Counter(bucket[row == i].tolist()) == want and letters[i] == n


def test_query_against_a_plain_version(spark):
    """The whole fusion in plain Python on the fixture."""
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents").collect()
    grams = {d.doc_id: plain_trigrams(d.text) for d in docs}
    langs = sorted({d.lang for d in docs})
    counts = {x: Counter() for x in langs}
    for d in docs:
        counts[d.lang] += grams[d.doc_id][0]
    size = {x: sum(counts[x].values()) + 0.5 * language.BUCKETS for x in langs}
    ll = {d.doc_id: [sum(n * math.log((counts[x][b] + 0.5) / size[x]) for b, n in grams[d.doc_id][0].items())
                     for x in langs] for d in docs}
    read = {d.doc_id: langs[int(np.argmax(ll[d.doc_id]))] if grams[d.doc_id][1] else None for d in docs}
    n = Counter(d.lang for d in docs)
    share = [(n[x] + 1) / (len(docs) + len(langs)) for x in langs]
    pair = Counter((read[d.doc_id], d.lang) for d in docs if read[d.doc_id])
    given = {(a, b): math.log((pair[a, b] + 1) / (sum(pair[a, v] for v in langs) + len(langs)))
             for a in langs for b in langs}
    host = {}
    for d in docs:
        host.setdefault(d.source, Counter())[d.lang] += 1
    got = {r.doc_id: r for r in queries.op10_language_id(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        h, m = host[d.source], sum(host[d.source].values())
        prior = [(h[x] + 20 * p) / (m + 20) for x, p in zip(langs, share)]
        s = [0.2 * a + math.log(p) + given[x, d.lang] for a, p, x in zip(ll[d.doc_id], prior, langs)]
        top = max(s)
        prob = 1 / sum(math.exp(v - top) for v in s)
        r = got[d.doc_id]
        assert r.language == langs[int(np.argmax(s))] and abs(r.probability - prob) < 1e-3
        assert r.kept == (grams[d.doc_id][1] > 0 and prob >= 0.5) and r.text_language == read[d.doc_id]


def test_accuracy_without_the_label(spark):
    """Half of the declarations are removed; the others teach the model to read them."""
    sf = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf, "documents")
    half = docs.withColumn("declared", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = language.identify(half, ("doc_id", "lang"), declared="declared", host="source").where("doc_id % 2 = 1")
    right = got.where("language = lang").count() / got.count()
    assert right > 0.97 and got.where("NOT kept").count() == 0


def test_pages_use_markup_suffix_and_host(spark):
    rows = [(i, f"http://{'a' if i % 2 else 'b'}.site.{'de' if i % 2 else 'fr'}/p", "de-AT" if i % 2 else "FR",
             "der die das und ist nicht" if i % 2 else "le la les et est dans") for i in range(60)]
    rows += [(100, "http://x.other.de/", None, "z"), (101, None, None, "le les dans la"), (102, "//b.site.fr", "??", "12 !"),
             (103, "nonsense", "de", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, declared string, text string")
    got = {r.page_id: r for r in language.identify(df, ("page_id",), declared="declared", url="url").collect()}
    assert got[1].language == "de" and got[2].language == "fr" and got[1].declared_language == "de"
    assert got[100].language == "de"                           # address suffix and host prior decide
    assert got[101].language == "fr" and got[101].kept
    assert not got[102].kept and not got[103].kept             # no letters


def test_odd_rows(rows):
    df = rows(ODD, langs=["en", None, "xx", "en", "de", "de", "en", "e", "english", "en"])
    out = language.identify(df, ("doc_id", "n", "key"), declared="lang", host="source")
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(ODD) and not got[0].kept and not got[2].kept
    assert language.identify(df.limit(0), declared="lang").count() == 0
    none = language.identify(rows(["a b"], langs=[None]), declared="lang").collect()
    assert len(none) == 1 and not none[0].kept
