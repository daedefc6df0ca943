"""Registered queries of this package: each applies one operator to its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import grace, language, mixing, pages, parity, pieces, pii, quality, secrets, shards, toxicity, variants, whitening
from barlake.llm.graph import saved


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_spans(docs).select("doc_id", *pii.digest_columns(F.col("pii_spans")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = saved(quality.measure(docs).select("doc_id", "lang", "measures"))
    return quality.judge(rows).select("doc_id", "measures.*", "base_failed", "kept")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.link(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace.copies(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.fit(labels.where(~held_out), docs)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "toxicity.score",
        (F.col("toxicity.score") >= 0.3).cast("int").alias("predicted"), "toxicity.evidence")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secrets.digest_columns(F.col("spans")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), declared="lang", host="source")


def op10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of the main text of pages: markup language, address suffix, host, domain and suffix priors."""
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    rows = saved(found.select("page_id", "url", "text", language.markup_language(F.col("html")).alias("markup")))
    return language.identify(rows, ("page_id",), declared="markup", url="url")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.vectors(table(spark, sf_dir, "embeddings"))
    m = whitening.fit_list(rows)
    shares = F.array(*map(F.lit, m.explained.tolist() if m else [])).cast("array<double>")
    found = whitening.whiten(rows, m).select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return found.select(F.col("id").alias("vec_id"), (F.col("place") + 1).alias("component"),
                        F.lit(m.n if m else 0).cast("long").alias("n"), "deviation", "whitened",
                        F.get(shares, F.col("place")).alias("explained"),
                        F.lit(m.identity_error if m else 0.0).alias("identity_error"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.occurrences(table(spark, sf_dir, "documents")))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shards.shards(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return found.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


# DuckDB statements; where SQL cannot express an operator its tests compare with a plain version instead.
# The table of CRC-32, and the CRC-32 of the text t.
CRC_TABLE = r"""SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i:
                       CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""
CRC = r"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                         regexp_extract_all(hex(t), '..'), lambda b: ('0x' || b)::BIGINT)), lambda c, b:
                         xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""
ORACLES: dict[str, str] = {
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents),
        g AS (SELECT *, count(*) OVER same AS group_size,
                     first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id
              FROM d WINDOW same AS (PARTITION BY text_sha256))
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op4_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS shingle
              FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
                   FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * k >= 90 * (x.n + y.n - k)),
        both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        reach AS (SELECT doc_id AS root, doc_id FROM documents UNION
                  SELECT root, b FROM reach JOIN both_ways ON a = doc_id WHERE b > root)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)""",
    "op12_spelling": r"""
        WITH RECURSIVE tab AS (""" + CRC_TABLE + r"""),
        runs AS (SELECT doc_id, run, count(*) AS c, coalesce(doc_id::VARCHAR, '') || ':' || run AS t
                 FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
                       FROM documents) GROUP BY ALL HAVING length(run) >= 7),
        coded AS (SELECT run, c, """ + CRC + r""" AS h FROM runs, tab),
        words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                         ELSE run END AS word, sum(c)::BIGINT AS n
                  FROM coded GROUP BY 1 HAVING sum(c) >= 2 AND length(word) >= 7),
        less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS d
                 FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
        near AS (SELECT x.word AS a, y.word AS b FROM less x JOIN less y ON x.i = y.i AND x.d = y.d AND x.word <> y.word
                 UNION SELECT word, d FROM less SEMI JOIN words w ON less.d = w.word
                 UNION SELECT d, word FROM less SEMI JOIN words w ON less.d = w.word),
        best AS (SELECT a, count(*) AS n_near, (array_agg(b ORDER BY n DESC, b))[1] AS b, max(n) AS m
                 FROM near JOIN words ON word = b GROUP BY a),
        formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN b END AS form,
                          CASE WHEN m >= 10 * n THEN m END AS form_n
                   FROM words LEFT JOIN best ON a = word),
        reach AS (SELECT word, word AS root, form AS further FROM formed UNION ALL
                  SELECT r.word, r.further, f.form FROM reach r JOIN formed f ON f.word = r.further)
        SELECT f.word, form, root, n, n_near, form_n
        FROM formed f JOIN reach r ON r.word = f.word AND r.further IS NULL""",
    "op13_sharding": r"""
        WITH RECURSIVE tab AS (""" + CRC_TABLE + r"""),
        d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        k AS (SELECT doc_id, strlen(t) + 1 AS size, ('0x' || substr(md5(t), 1, 15))::BIGINT AS h,
                     """ + CRC + r""" AS text_crc32
              FROM d, tab),
        p AS (SELECT *, sum(size) OVER (ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)::BIGINT AS below,
                     row_number() OVER (ORDER BY h, doc_id NULLS FIRST) AS place FROM k),
        total AS (SELECT sum(size)::BIGINT AS total FROM k),
        edges AS (SELECT below AS edge, false AS ends_text FROM p UNION ALL SELECT 0, true
                  UNION ALL SELECT max(below), true FROM p GROUP BY h),
        cuts AS (SELECT s, coalesce(
                     (array_agg(edge ORDER BY abs(16 * edge - s * total), edge)
                         FILTER (WHERE ends_text AND abs(16 * edge - s * total) <= total // 100))[1],
                     (array_agg(edge ORDER BY abs(16 * edge - s * total), edge))[1]) AS cut
                 FROM edges, total, range(1, 16) r(s) GROUP BY s),
        z AS (SELECT p.*, (SELECT count(*) FROM cuts WHERE cut <= p.below - p.size) AS shard FROM p)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
               place - min(place) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
        FROM z""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_pii, op2_mixing, op3_quality, op4_ngram_jaccard, op5_sentencepiece, op6_html, op7_exact_dedup, op8_toxicity,
    op9_secrets, op10_language_id, op10_pages, op11_whitening, op12_spelling,
    op13_sharding)}
