"""Keys behind a name, in a query string or inside a path are tested as well."""
import random

from tests.llm.test_secrets import find

B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
FORMS = [("AWS_SECRET_ACCESS_KEY=", B62 + "+/", 40, ""), ("export PRIVATE_KEY=", "0123456789abcdef", 64, " "),
         ("https://x.example/get?a=1&sig=", B62 + "-_", 43, "&b=2"), ("KEY=", B62 + "+/", 42, "=="),
         ("some/long-name/of_it/", B62, 40, "/more-of_it"), ("/reset/the-link/", B62 + "-_", 43, "?x=1"),
         ("a-name_of-key-", "0123456789abcdef", 48, "/x"), ("some-name-of_it-", B62 + "+/", 60, "-x")]


def test_values_are_spans(rows):
    rng = random.Random(8)
    texts, want = [], []
    for before, alphabet, n, after in FORMS * 15:
        key = "".join(rng.choice(alphabet) for _ in range(n))
        texts.append(f"see {before}{key}{after} for it")
        want.append((4 + len(before), 4 + len(before) + n))
    hits = {f: 0 for f in range(len(FORMS))}
    for r in find(rows(texts)).collect():
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("random")]
        a, b = want[r.doc_id]
        hits[r.doc_id % len(FORMS)] += any(x <= a and b <= y for x, y in spans)
    assert all(h >= 12 for h in hits.values()), hits


def test_names_and_paths_are_no_keys(rows):
    texts = ["AWS_SECRET_ACCESS_KEY_ID2=x", "path/to/some-name/of_a_file/in-2024/and-so_on/1", "==========a1==========",
             "a_very-long/name1=another_very-long/name2=", "x" * 30 + "=1"]
    assert [r.spans for r in find(rows(texts)).collect()] == [""] * len(texts)
