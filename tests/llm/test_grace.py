import hashlib
from collections import Counter, defaultdict

from barlake.llm import grace, queries
from tests.llm.conftest import ODD

WHITE = b" \t\n\x0b\x0c\r"


def plain(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[(t or "").encode().translate(None, WHITE)].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for content, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for k, m in enumerate(members):
            out[m[3], members[0][3], len(members), k == 0, hashlib.sha256(content).hexdigest()] += 1
    return out


def result(df):
    return Counter(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))


def docs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    assert result(queries.op7_exact_dedup(spark, sf)) == plain(docs_of(queries.table(spark, sf, "documents")))


def test_many_buckets_runs_and_copies(rows):
    texts = [f"text {i % 700} " * (1 + i % 3) for i in range(2500)] + ["copy"] * 900 + [" c o p y\n"] * 3 + ODD
    df = rows(texts).repartition(5)
    small = dict(run_bytes=2_000, bucket_bytes=3_000)
    assert result(grace.copies(df, **small)) == plain(docs_of(df))
    kept = grace.distinct(df, **small)
    assert kept.columns == df.columns and kept.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    want = {i: t for i, t in docs_of(df)}
    stay = {k[0] for k in plain(docs_of(df)) if k[3]}
    got = kept.collect()
    assert {r.doc_id for r in got} == stay and all(r.text == want[r.doc_id] and r.n == r.doc_id for r in got)


def test_equal_hashes_compare_contents():
    t = grace.Table()
    assert t.find(7, b"one") == (0, True) and t.find(7, b"two") == (1, True) and t.find(7, b"one") == (0, False)
    for i in range(5000):
        t.find(i % 11, str(i).encode())
    assert all(not t.find(i % 11, str(i).encode())[1] for i in range(5000))


def test_null_ids_repeated_rows_and_empty_table(rows):
    df = rows(["a", " a", "a", "a", None, "", "b"], ids=[5, None, 5, 3, 9, 8, None])
    assert result(grace.copies(df)) == plain(docs_of(df))
    assert sorted(map(repr, (r.doc_id for r in grace.distinct(df).collect()))) == ["8", "None", "None"]
    assert grace.copies(df.limit(0)).count() == 0 and grace.distinct(df.limit(0)).count() == 0


def test_depth_grows_until_buckets_fit(spark):
    df = spark.range(4000).selectExpr("xxhash64(id) AS hash", "100L AS bytes")
    assert grace.depth(df, 1_000_000) == 0
    assert grace.depth(df, 50_000) == 1
    assert grace.depth(df, 500) == 2
    one = spark.createDataFrame([(1, 10**9)], "hash long, bytes long")
    assert grace.depth(one, 500) == 0                          # a single content is never split
