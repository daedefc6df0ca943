import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from barlake.llm import queries, variants
from tests.llm.conftest import ODD


def plain_words(docs, min_length=7, min_count=2):
    out = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += len(run) >= min_length
    return {w: n for w, n in out.items() if n >= min_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:k] + a[k + 1:] == b for k in range(len(a)))


def plain(words):
    near = defaultdict(set)
    for w in words:
        gaps = {w[:k] + "*" + w[k + 1:] for k in range(len(w))} | {w[:k] + "*" + w[k:] for k in range(len(w) + 1)}
        for g in gaps:
            near[g].add(w)
    others = defaultdict(set)
    for group in near.values():
        for a in group:
            others[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(others[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(others[w]), words[form[w]] if form[w] else None))
    return out


def result(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    assert result(queries.op12_spelling(spark, sf)) == plain(plain_words(docs))


@pytest.mark.parametrize("letters,lengths,seed", [("ab", (4, 9), 0), ("abc", (7, 12), 1), ("aé", (4, 7), 2),
                                                  ("abcdefgh", (4, 6), 3)])
def test_every_near_pair_of_few_letters(spark, letters, lengths, seed):
    """Few letters: repeated bigrams, overlapping pivots, prefixes longer than three, hot keys."""
    pick = random.Random(seed)
    words = {}
    for _ in range(900):
        w = "".join(pick.choice(letters) for _ in range(pick.randint(*lengths)))
        words[w] = int(10 ** pick.uniform(0.4, 5))
    words.update({"a" * k: 3 ** k for k in range(4, 16)})
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert result(variants.group(df)) == plain(words)


def test_pivots_share_no_letter_and_are_cheapest():
    pick = random.Random(5)
    for _ in range(500):
        places = sorted(pick.sample(range(12), pick.randint(3, 7)))
        counts = [pick.randint(1, 9) for _ in places]
        cost = dict(zip(places, counts))
        a, b = variants.pivots(places, counts)
        assert b - a >= 2 and cost[a] + cost[b] == min(cost[x] + cost[y] for x in places for y in places if y - x >= 2)


def test_odd_texts_and_repeated_rows(rows):
    texts = ODD + ["Señorita SEÑORITA señorita×÷ÿ niñoniño1niñoniño"] * 40 + ["banana-bananaa bananab"] * 30
    df = rows(texts, ids=[*range(len(ODD) + 60), *[3, None] * 5]).repartition(4)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    assert result(variants.group(variants.occurrences(df))) == plain(plain_words(docs))
    assert result(variants.group(variants.occurrences(df.withColumnRenamed("n", "word"), min_length=4))) == plain(
        plain_words(docs, 4))


def test_empty_table_and_ratio(rows):
    assert variants.group(variants.occurrences(rows(["x"]).limit(0))).count() == 0
    with pytest.raises(ValueError):
        variants.group(variants.occurrences(rows(["x"])), ratio=1)
