import pytest


@pytest.fixture()
def rows(spark):
    """DataFrame of (doc_id, text, lang, source, n_chars, n, key) rows; the last two clash with internal names."""
    def make(texts, langs=None, sources=None, ids=None):
        data = [(ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "s",
                 None if t is None else len(t), i, "k") for i, t in enumerate(texts)]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "n int, key string")
    return make


LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [None, "", "   \n\t", "x", "a b", "é ß 日本 𝄞", "a\x00b", "tie tie tie", "tie tie tie", LONG]
