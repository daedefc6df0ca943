"""Addresses against a plain version, long runs, cues in any case, clashing names."""
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from barlake.llm import pii

AUTOMATON = pii._automaton()


def plain(s):
    """Addresses by the definition, each start on its own."""
    found, pos = [], 0
    for m in re.finditer(r"(?i)(?=(http://|https://|ftp://|mailto:|www\.))", s):
        at = m.start()
        if at < pos or at and s[at - 1].isalnum():
            continue
        end = re.compile(r"[^\s<>\"'`{}|\\^]+").match(s, at).end()
        while end > at and (s[end - 1] in ".,;:!?*&$%#" or s[end - 1] in ")]"
                            and s.count("(["[s[end - 1] == "]"], at, end) < s.count(s[end - 1], at, end)):
            end -= 1
        scheme = m.group(1).lower()
        body = s[at + (0 if scheme == "www." else len(scheme)):end]
        if scheme == "mailto:":
            host = body.rpartition("@")[2]
        else:
            cut = re.split("[/?#]", body)[0]
            host = re.split("[/?#:]", body[cut.index("@") + 1:] if "@" in cut else body)[0]
        labels = host.split(".")
        if len(host) <= 253 and len(labels) >= (3 if labels[0].lower() == "www" else 2) and all(labels) and len(labels[-1]) > 1:
            found.append((at, end))
            pos = end
    return found


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(["http://", "HTTPS://", "ftp://", "mailto:", "www.", "Www.", "a", "bc", ".de", ".", "@", "/", ":",
                                 "?", "#", "(", ")", "[", "]", ",", " ", "é", "x.yz", "1"]), max_size=16).map("".join))
def test_addresses_equal_the_plain_version(s):
    assert [(a, b) for k, a, b in pii.spans_of(s, AUTOMATON) if k == "address"] == plain(s)


@pytest.mark.parametrize("text", [
    "http://" * 150_000, "www.a:" * 150_000, "www." * 250_000 + "x", "mailto:" * 150_000, "http://a@" * 100_000,
    ",www.x" * 150_000 + ")" * 100_000, "http://(" * 100_000 + ")" * 100_000, "mailto:a@" * 100_000 + "b", "iban " * 60_000,
    "IBAN " + "A1" * 500_000, "@" * 1_000_000, "a@" * 500_000, "1." * 500_000, "+1" * 500_000, "1 " * 500_000])
def test_a_run_of_a_megabyte_is_linear(text):
    at = time.process_time()
    pii.spans_of(text, AUTOMATON)
    assert time.process_time() - at < 10


def test_cues_and_schemes_in_any_case():
    for cue in ("iban", "IBAN", "IBan", "iBAN"):
        assert pii.spans_of(f"İ {cue}: DE89370400440532013000", AUTOMATON) == [("account", len(cue) + 4, len(cue) + 26)]
    assert ("address", 4, 22) in pii.spans_of("see HTTP://Example.Org!", AUTOMATON)


def test_redaction_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "to a@b.cd", "mine"), (2, None, None)], "doc_id long, text string, _spans string")
    out = pii.redact(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "to <email>", "mine"), (2, None, None)]
    named = pii.redact(df, out="_spans")
    assert {r.doc_id: r["_spans"] for r in named.collect()} == {1: "to <email>", 2: None}
    assert pii.redact(df, out="pii").select(F.col("pii")).count() == 2
