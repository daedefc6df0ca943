import re
from collections import Counter

from pyspark.sql import functions as F

from barlake.llm import quality, queries
from barlake.llm.vocab import PIECES, vocab_path
from tests.llm.conftest import ODD


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op3_quality(spark, sf).collect()}
    for d in queries.table(spark, sf, "documents").collect():
        r = got[d.doc_id]
        assert tuple(r[c] for c in COLUMNS) == plain(d.text)
        assert not (r.kept and r.base_failed)


def test_fertility_against_the_vocabulary(rows):
    import math

    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=vocab_path(PIECES))
    texts = [*ODD[:9], "the cat sat 𝄞 on the mat\nthe the", "日本語 😀 text"]
    for r, t in zip(quality.measure(rows(texts)).orderBy("doc_id").collect(), texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        ids = [i for w in words for i in sp.encode(w)]
        m = r.measures
        assert m.n_tokens == len(ids)
        if ids:
            c = Counter(ids)
            assert abs(m.chars_per_token - sum(map(len, words)) / len(ids)) < 1e-9
            assert abs(m.byte_share - sum(map(sp.is_byte, ids)) / len(ids)) < 1e-9
            h = -sum(v / len(ids) * math.log2(v / len(ids)) for v in c.values())
            assert abs(m.entropy - h) < 1e-9


def test_labelled_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op3_quality(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").where("NOT base_failed")
    c = {(r.quality, r.kept): r["count"] for r in got.groupBy("quality", "kept").count().collect()}
    assert c[1, True] / (c[1, True] + c.get((1, False), 0)) > 0.99       # clean texts stay
    assert c[0, False] / (c[0, False] + c.get((0, True), 0)) > 0.75      # labelled junk mostly goes


def test_odd_rows(rows):
    df = rows([*ODD, "same line\nsame line\n \n \n"])
    out = quality.measure(df)
    assert out.drop("measures").columns == df.columns and out.count() == len(ODD) + 1
    got = {r.doc_id: r.measures for r in out.collect()}
    for i, t in enumerate([*ODD, "same line\nsame line\n \n \n"]):
        assert tuple(got[i][c] for c in COLUMNS[:5]) == plain(t)[:5]
    judged = quality.judge(out.select("doc_id", F.lit(None).cast("string").alias("lang"), "measures"))
    assert judged.count() == len(ODD) + 1 and quality.measure(df.limit(0)).count() == 0
