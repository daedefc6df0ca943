import hashlib
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barlake.llm import pii, queries
from tests.llm.conftest import ODD

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in re.sub(r"[ -]", "", s)]
    return sum(sum(divmod(x * 2, 10)) if i % 2 else x for i, x in enumerate(reversed(d))) % 10 == 0


CHECKS = {
    "email": lambda s: True,
    "ip": lambda s: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in s.split(".")),
    "card": lambda s: 12 <= len(re.sub(r"[ -]", "", s)) <= 19 and luhn(s),
    "phone": lambda s: 9 <= len(re.sub(r"[^0-9]", "", s)) <= 15,
}


def plain(text):
    """The base kinds by regular expressions over the whole text."""
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items())
             for m in re.finditer(p, text) if CHECKS[kind](m.group())]
    return [(list(PATTERNS)[k], a, b) for a, k, b in sorted(found)]


def base(text, automaton=pii._automaton()):
    return [s for s in pii.spans_of(text, automaton) if s[0] in pii.BASE_KINDS]


TEXTS = ["mail und.34@mail7.example.com now", "a@b@c.de", "a@b.c.d@e.f", "x@y", "..@a.b-", "1.2.3.4.5 999.1.1.1 1..2.3.4.5",
         "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (017) 555-7713.", "+1", "+12", "+1-2", "++49 30 1234567 (",
         "0" * 30, "1 2 3 4 5 6 7 8 9 0 1 2", "0000.0.0.0255", "é1.2.3.4é", "@" * 50, "9" * 5000 + ".1.2.3"]


def test_base_kinds_equal_the_patterns():
    for t in TEXTS:
        assert base(t) == plain(t), t


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1925@.+-( )é_%", max_size=60))
def test_base_kinds_on_random_texts(text):
    assert base(text) == plain(text)


def test_added_kinds():
    a = pii._automaton()

    def kinds(t):
        return {(k, t[s:e]) for k, s, e in pii.spans_of(t, a)}
    assert ("mailbox", "jörg.maier@example.org") in kinds("an jörg.maier@example.org,")
    assert ("address", "https://ex.com/a?b=1") in kinds("(see https://ex.com/a?b=1).")
    assert ("account", "DE89 3704 0044 0532 0130 00") in kinds("IBAN: DE89 3704 0044 0532 0130 00 bitte")
    assert ("account", "12345678") in kinds("account no. 12345678")
    assert not kinds("accountant 12345678 ibanez www.nothing https:// plain")


def test_query_against_patterns_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries.op1_pii(spark, sf).collect()}
    docs = queries.table(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = plain(d.text or "")
        r = got[d.doc_id]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))


def test_odd_rows_and_redaction(rows):
    df = rows([*ODD, "to a@b.cd and +49 30 1234567"])
    out = pii.find_spans(df, out="key")                        # replaces a clashing column
    assert out.count() == len(ODD) + 1 and out.columns == df.columns
    r = out.select(*pii.digest_columns(F.col("key"))).collect()
    assert r[0].spans == "" and r[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    red = {x.doc_id: x.text for x in pii.redact(df).collect()}
    assert red[len(ODD)] == "to <email> and <phone>" and red[0] is None and red[1] == ""
    assert pii.find_spans(df.limit(0)).count() == 0
