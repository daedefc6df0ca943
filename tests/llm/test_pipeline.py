import hashlib
from collections import Counter

import corpus_pipeline
from barlake.llm import mixing, pieces
from barlake.llm.graph import saved
from barlake.llm.vocab import PIECES, vocab_path
from tests.llm.test_grace import plain as plain_copies
from tests.llm.test_near_stage import plain as plain_links

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    import sentencepiece
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF))
        out[name] = docs
        if name != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {n: out[n].collect() for n in names[:4]}
    first = [(r.doc_id, r.text) for r in rows["language"]]
    assert len(first) == spark.read.parquet(f"{SF}/documents.parquet").count()   # clean documents stay
    stay = {k[0] for k in plain_copies(first) if k[3]}
    assert {r.doc_id for r in rows["exact copies"]} == stay
    links = plain_links([(r.doc_id, r.text) for r in rows["exact copies"]])
    assert {r.doc_id for r in rows["near copies"]} == {i for i, (_, c) in links.items() if i == c}
    want = {r.doc_id: r.taken for r in mixing.taken(mixing.mix(out["near copies"])).collect() if r.taken}
    got = Counter()
    for r in rows["mix"]:
        got[r.doc_id] += len(r.text.encode().split())
    assert got == want
    sp = sentencepiece.SentencePieceProcessor(model_file=vocab_path(PIECES))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = Counter()
    for r in rows["mix"]:
        ids = sp.encode(r.text, add_eos=True)
        expected[r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))] += 1
    assert Counter(map(tuple, out[names[-1]].collect())) == expected
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == expected


def test_empty_and_null_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in ([], [(1, None, None, None, None)], [(1, "a b c d", "en", "s", 7), (2, "", "en", None, 0)]):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, SF))
        assert docs.count() <= 3 * len(data)
    assert pieces.KEPT_UNITS > 0
