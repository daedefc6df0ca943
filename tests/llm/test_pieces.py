import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from barlake.llm import pieces, queries
from barlake.llm.vocab import PIECES, vocab_path
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocab_path(PIECES))


@pytest.fixture(scope="module")
def table():
    return pieces.PrefixTable(vocab_path(PIECES))


PARTS = ["▁", " ", "  ", "   ", "\n", "\t", "a", "b", "th", "he", "ing", "é", "é", "日", "𝄞", "\x00", "...", ".", ",", "==",
         "0", "12", "<s>", "</s>", "<0x0A>", "--", "אב", "한", " ⁇ ", "�", "​", "½", "A", "The", "A.B", "x,y"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_equals_the_library(library, table, text):
    ids = table.encode(text).tolist()
    assert ids == library.encode(text, add_eos=True)
    assert table.decode(ids) == library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(library, table, text):
    ids = table.encode(text).tolist()
    assert ids == library.encode(text, add_eos=True) and table.decode(ids) == library.decode(ids)


def test_small_tables_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_UNITS", 50)
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 40)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 50)
    table = pieces.PrefixTable(vocab_path(PIECES))
    text = " ".join(f"unit{i % 300}ation" for i in range(2000))
    assert table.encode(text).tolist() == library.encode(text, add_eos=True)
    for text in ("▁ ", " ▁", "a ▁b", "a▁ b ", "a\n b", "a. .b  c,", "x ", "  x"):
        assert table.encode(text).tolist() == library.encode(text, add_eos=True)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_query_on_the_fixture(spark, library):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op5_sentencepiece(spark, sf).collect()}
    for d in queries.table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = library.encode(d.text or "", add_eos=True)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_odd_rows(rows, library):
    df = rows([*ODD, "a" * 100_000, "ab" * 30_000])
    out = {r.doc_id: r for r in pieces.encode(df, out="key").collect()}
    for i, t in enumerate([*ODD, "a" * 100_000, "ab" * 30_000]):
        ids = library.encode(t or "", add_eos=True)
        assert out[i].key.ids == ids and out[i].key.decoded == library.decode(ids)
    assert pieces.encode(df.limit(0)).count() == 0
