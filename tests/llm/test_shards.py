import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barlake.llm import queries, shards
from tests.llm.conftest import ODD


def plain(docs, n, tolerance=100):
    """Shard of each row by sorting everything; copies with one id are alike, so a multiset of rows comes back."""
    def key(row):
        h = int(hashlib.md5((row[1] or "").encode()).hexdigest()[:15], 16)
        return h, row[0] is not None, row[0] or 0
    docs = sorted(docs, key=key)
    sizes = [len((t or "").encode()) + 1 for _, t in docs]
    total, ends, edges = sum(sizes), [0], {0}
    for k, s in enumerate(sizes):
        ends.append(ends[-1] + s)
        if k + 1 == len(docs) or key(docs[k + 1])[0] != key(docs[k])[0]:
            edges.add(ends[-1])
    cuts = []
    for k in range(1, n):
        def off(e):
            return abs(n * e - k * total), e
        near = [e for e in edges if off(e)[0] <= total // tolerance]
        cuts.append(min(near or ends, key=off))
    out, slots = Counter(), Counter()
    for (i, t), size, begin in zip(docs, sizes, ends):
        s = sum(c <= begin for c in cuts)
        out[i, size, zlib.crc32((t or "").encode()), s, slots[s]] += 1
        slots[s] += 1
    return out


def result(df):
    return Counter(map(tuple, df.select("row.doc_id", "size", "text_crc32", "shard", "slot").collect()))


def docs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op13_sharding(spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = docs_of(queries.table(spark, sf, "documents"))
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got.collect()) == plain(docs, 16)


@pytest.mark.parametrize("n,part_rows,probes", [(1, 7, 64), (5, 40, 16), (16, 3, 1 << 14)])
def test_hot_texts_hot_ids_and_odd_rows(rows, monkeypatch, n, part_rows, probes):
    """A third of all rows share a text, and half of these one id too; few probes make many rounds."""
    monkeypatch.setattr(shards, "PROBES", probes)
    texts = [f"text {i} " * (1 + i % 9) for i in range(300)] + ["the same"] * 200 + ODD
    ids = list(range(300)) + [7] * 100 + [-(1 << 63) + 5 + i for i in range(50)] + [None] * 50 + list(range(len(ODD)))
    df = rows(texts, ids=ids).repartition(5).cache()
    got = shards.shards(df, n, part_rows=part_rows).cache()
    assert result(got) == plain(docs_of(df), n)
    r = got.first().row
    assert set(r.asDict()) == set(df.columns)


def test_shards_are_near_equal_and_keep_texts_together(rows):
    df = rows([f"words of text {i % 1500} " * 10 for i in range(3000)])
    got = shards.shards(df, 8, part_rows=100)
    size = [r[1] for r in got.groupBy("shard").agg(F.sum("size")).collect()]
    assert len(size) == 8 and max(size) - min(size) <= 2 * sum(size) / 8 / 100 + 1
    assert got.groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).where("n > 1").count() == 0


def test_empty_one_row_and_rerun(rows):
    df = rows(["a", "b", None, ""])
    assert shards.shards(df.limit(0)).count() == 0
    assert result(shards.shards(df.limit(1))) == plain(docs_of(df.limit(1)), 16)
    assert result(shards.shards(df)) == result(shards.shards(df.repartition(3)))


def test_clashing_names_other_id_types_and_files(spark, tmp_dir):
    data = [(f"id{i}", f"some text {i % 60}", i, i, "x", None) for i in range(200)]
    df = spark.createDataFrame(data, "`the id` string, text string, h long, size int, row string, shard string")
    shards.write(df, tmp_dir, n=4, doc_id="the id", part_rows=20)
    back = spark.read.parquet(tmp_dir)
    assert {tuple(r.row) for r in back.collect()} == set(data)
    for r in back.groupBy("shard").agg(F.count("*"), F.min("slot"), F.max("slot"), F.countDistinct("slot")).collect():
        assert tuple(r)[2:] == (0, r[1] - 1, r[1])


def test_no_python_and_one_exchange_of_rows(spark):
    plan = queries.op13_sharding(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "Python" not in physical and "Arrow" not in physical and physical.count("Exchange") == 1
