"""Texts of small groups are judged by a band they borrow."""
import random

from pyspark.sql import functions as F

from barlake.llm import quality, queries
from barlake.llm.graph import saved

WORDS = ("the of and to in a is that for it was on with as his they be at one have this from or had by word but what "
         "some we can out other were all there when up use your how said each she which their time if will way about "
         "many then them write would like so these her long make thing see him two has look more day could go come did "
         "number sound no most people my over know water than call first who may down side been now find any new work "
         "part take get place made live where after back little only round man year came show every good").split()


def clean(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def junk(rng, n):
    return " ".join("".join(rng.choices("\U0001d11e\u2603\u263a\u0416\u4e00#@~qxz", k=7)) for _ in range(n))


def test_junk_of_a_rare_language_or_length_goes(rows):
    rng = random.Random(3)
    texts = [clean(rng, rng.randint(140, 250)) for _ in range(120)]
    langs = ["en"] * 120
    for lang, n, k in (("es", 180, 5), (None, 180, 4), ("en", 3000, 3), ("en", 400, 3)):
        texts += [clean(rng, n) for _ in range(k)] + [junk(rng, n // 3)]
        langs += [lang] * (k + 1)
    got = quality.judge(saved(quality.measure(rows(texts, langs=langs)).select("doc_id", "lang", "measures"))).collect()
    assert len(got) == len(texts) and not any(r.base_failed for r in got)
    kept = {r.doc_id for r in got if r.kept}
    bad = {i for i, t in enumerate(texts) if "\u4e00" in t}
    assert len(bad) == 4 and kept == set(range(len(texts))) - bad


def test_large_groups_keep_their_own_band(spark):
    sf = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf, "documents").select("doc_id", "lang", "text")
    rows = saved(quality.measure(docs).select("doc_id", "lang", "measures")).withColumn("_lang", F.col("lang")).withColumn(
        "_octave", F.floor(F.log2("measures.n_tokens"))).where(~quality.base_failed())
    good = rows.select("_lang", "_octave", "measures.*")
    sizes = {(r._lang, r._octave): r["count"] for r in good.groupBy("_lang", "_octave").count().collect()}
    bands = {(r._lang, r._octave): r for r in quality._fences(good, quality.BANDS, quality.LEAST).collect()}
    assert bands.keys() == sizes.keys() and min(sizes.values()) < quality.LEAST
    for g in (g for g, n in sizes.items() if n >= quality.LEAST):
        low, high = good.where((F.col("_lang") == g[0]) & (F.col("_octave") == g[1])).agg(F.percentile_approx(
            "chars_per_token", F.array(F.lit(0.25), F.lit(0.75)), F.lit(2000))).first()[0]
        spread = max(high - low, 0.02 * high)
        assert abs(bands[g]._chars_per_token.low - (low - 4 * spread)) < 1e-9
