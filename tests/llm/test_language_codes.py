"""Many declared codes that are no languages."""
import itertools
import string

from barlake.llm import language


def test_junk_codes_are_no_languages_and_their_rows_are_judged(rows):
    words = {"de": "der die das und ist nicht ein haus am see", "fr": "le la les et est dans une maison au bord"}
    junk = ["".join(x) for x in itertools.islice(itertools.product(string.ascii_lowercase, repeat=3), 5000)]
    texts = [words["de" if i % 2 else "fr"] for i in range(400)] + [words["de"]] * len(junk)
    langs = ["de" if i % 2 else "fr" for i in range(400)] + junk
    df = rows(texts, langs=langs)
    parts = language.evidence_rows(df, declared="lang", host="source").select("doc_id", "text", "_declared", "_host", "_suffix")
    codes = language.frequent_codes(parts)
    assert len(codes) == language.MOST_LANGUAGES and {"de", "fr"} <= set(codes)
    got = language.identify(df, declared="lang", host="source", most=2).collect()
    assert len(got) == len(texts) and all(r.kept for r in got)
    for r in got:
        assert r.language == ("fr" if r.doc_id < 400 and r.doc_id % 2 == 0 else "de")
        assert r.declared_language == (langs[r.doc_id] if r.doc_id < 400 else None)
    assert language.frequent_codes(parts, 3) == ["de", "fr", "aaa"]
