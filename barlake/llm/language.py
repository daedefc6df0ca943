"""Language by Bayesian evidence fusion.

Four kinds of evidence on a text's language are multiplied as likelihoods:

* text: byte trigrams of its letters, one model per declared language, from counts over all texts that declare it
  (add-half smoothing); trigrams overlap, so their log-likelihood ratio counts for ``temper`` of its sum
* declared markup language: P(declared | language), from how often texts that read like a language declare each
* address suffix: P(suffix | language), likewise
* host prior: the share of each language on the host, smoothed toward the parent domain's, that toward the suffix's
  and that toward the corpus's, each with weight ``smooth``, by grouped counts

Declared values count as a language when they are two or three letters (region cut off) and among the ``most``
codes that most texts declare (256, more than the languages that have a two-letter code; ties by code); a text with any
other code is judged like one without a declaration. Counts per (language, trigram bucket) reach the driver and the tasks, which
the codes and buckets bound, not the rows: 256 x 65,536 numbers. What a language declares, suffixes and host priors stay tables
and are joined to narrow rows (no text), so a host with a third of all rows is only a join key that Spark may split.

A text is rejected (``kept`` false) when it has no letter at all or no language reaches ``least`` probability. Null
counts as empty; a null declaration, address or host is no evidence."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.graph import saved
from barlake.llm.text import filled, slices

BUCKETS = 1 << 16
SLICE = 1_000_000  # bytes of text at once: a dozen arrays of eight bytes per byte of text
TEMPER, SMOOTH, LEAST = 0.2, 20.0, 0.5
MOST_LANGUAGES = 256
# letters in lower case, every other ASCII character a blank; bytes beyond ASCII as they are
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256)], np.uint8)


@dataclass
class Fit:
    languages: list[str]
    table: np.ndarray                          # languages x buckets, log-probabilities
    declared: DataFrame | None                 # declared -> array of log P in the order of languages
    suffix: DataFrame | None                   # suffix -> array of log P
    hosts: DataFrame | None                    # host -> array of shares in the order of languages
    share: list[float]


def code(declared: Column) -> Column:
    """Language code of a declaration, or null."""
    c = F.lower(F.regexp_extract(declared, r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(F.length(c) > 0, c)


def markup_language(html: Column) -> Column:
    """Value of the lang attribute (or xml:lang) of a page's html tag, or null."""
    tag = F.regexp_extract(html, r"(?is)<html\b(?:\s+[^>]*?)?\s(?:xml:)?lang\s*=\s*[\"']?([A-Za-z][A-Za-z0-9_-]*)", 1)
    return F.nullif(tag, F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)),
                    F.lit(""))


def suffix_of(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def parent_of(host: Column) -> Column:
    return F.when(host.contains("."), F.substring_index(host, ".", -2))


def evidence_rows(df: DataFrame, text: str = "text", declared: str | None = None, url: str | None = None,
                  host: str | None = None) -> DataFrame:
    """``df`` with the evidence columns _declared, _host and _suffix beside its own."""
    none = F.lit(None).cast("string")
    named = F.col(host) if host else host_of(F.col(url)) if url else none
    return df.withColumns({"_declared": code(F.col(declared)) if declared else none, "_host": named,
                           "_suffix": suffix_of(named) if url else none})


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of each trigram with at least one letter inside its text, and letters per row."""
    joined = pa.array([""]).cast(pa.large_string()) if not len(texts) else texts
    size = pc.binary_length(joined).to_numpy(zero_copy_only=False).astype(np.int64)
    buffers = joined.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    b = _FOLD[data]
    rows = np.repeat(np.arange(len(joined), dtype=np.int32), size)
    letters = np.bincount(rows, weights=b != 32, minlength=len(joined)).astype(np.int64)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), letters
    x = b.astype(np.uint32)
    h = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    blank = (b[1:-1] == 32) & ((b[:-2] == 32) | (b[2:] == 32))
    inside = (rows[:-2] == rows[2:]) & ~blank
    return ((h[inside] * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), rows[:-2][inside], letters


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        texts = filled(batch.column("text"))
        coded = pc.dictionary_encode(batch.column("_declared"))
        names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in slices(texts, SLICE):
            bucket, row, _ = _trigrams(texts.slice(lo, hi - lo))
            of = at[lo:hi][row]
            for k, name in enumerate(names):
                found = np.bincount(bucket[of == k], minlength=BUCKETS)
                total[name] = total[name] + found if name in total else found
    for name, c in total.items():
        some = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()),
                                          pa.array(c[some], pa.int64())], names=["lang", "bucket", "n"])


def text_table(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities per trigram bucket, from all rows that declare a language."""
    got = (rows.where(F.col("_declared").isNotNull()).select(F.col("text"), "_declared")
           .mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
           .groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n")))
    counts = {r.lang: (r.bucket, r.n) for r in got.collect()}
    languages = sorted(counts)
    table = np.full((len(languages), BUCKETS), 0.5)
    for i, name in enumerate(languages):
        table[i, counts[name][0]] += counts[name][1]
    return languages, np.log(table / table.sum(axis=1, keepdims=True)) if languages else table


def likelihoods(df: DataFrame, languages: list[str], table: np.ndarray, text: str = "text",
                out: str = "likelihood") -> DataFrame:
    """``df`` with the log-likelihood of its letters per language and their number."""
    wide = table.astype(np.float32)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, sums, letters = filled(batch), [], []
            for lo, hi in slices(texts, SLICE):
                bucket, row, n = _trigrams(texts.slice(lo, hi - lo))
                letters.append(n)
                sums.append(np.stack([np.bincount(row, weights=t[bucket], minlength=hi - lo) for t in wide], axis=1)
                            if len(wide) else np.zeros((hi - lo, 0)))
            flat = np.concatenate(sums).reshape(-1) if sums else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(wide), pa.int32()),
                                             pa.array(flat, pa.float64()))
            yield pa.StructArray.from_arrays([lists, pa.array(np.concatenate(letters) if letters else [], pa.int64())],
                                             ["by", "letters"])
    return df.withColumn(out, F.arrow_udf(run, "struct<by:array<double>,letters:bigint>")(F.col(text)))


def _log_conditional(pairs: DataFrame, languages: list[str]) -> DataFrame | None:
    """value -> log P(value | language) from rows (_read, value), add-one over the values seen; None without any. The
    number of values and one sum per language reach the driver."""
    counts = saved(pairs.groupBy("value").agg(F.array(*[F.count_if(F.col("_read") == n) for n in languages]).alias("_n")))
    values, *sums = counts.agg(F.count("*"), *[F.sum(F.get("_n", F.lit(i))) for i in range(len(languages))]).first()
    if not values:
        return None
    totals = F.array(*[F.lit(float(x + values)) for x in sums])
    return counts.select("value", F.zip_with("_n", totals, lambda n, t: F.ln((n + 1) / t)).alias("logs"))


def _best(languages: list[str], scores: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, languages)), F.array_position(scores, F.array_max(scores)).cast("int"))


def _shares(rows: DataFrame, key: Column, languages: list[str], above: DataFrame | None, up: Column,
            base: list[float], smooth: float) -> DataFrame:
    """(key, shares): counts of a level smoothed toward the level above it, or the corpus."""
    counts = (rows.withColumn("_k", key).where(F.col("_k").isNotNull()).groupBy("_k").agg(
        F.first(up, ignorenulls=True).alias("_up"),
        F.array(*[F.count_if(F.col("_seen") == n) for n in languages]).alias("_n")))
    corpus = F.array(*map(F.lit, base))
    if above is not None:
        counts = counts.join(above.select(F.col("key").alias("_up"), F.col("shares").alias("_above")), "_up", "left")
    prior = F.coalesce("_above", corpus) if above is not None else corpus
    total = F.aggregate("_n", F.lit(0).cast("long"), lambda a, x: a + x)
    return counts.select(F.col("_k").alias("key"), F.zip_with(
        "_n", prior, lambda n, p: (n + smooth * p) / (total + smooth)).alias("shares"))


def frequent_codes(rows: DataFrame, most: int = MOST_LANGUAGES) -> list[str]:
    """The ``most`` codes that most rows declare, ties by code."""
    found = rows.where(F.col("_declared").isNotNull()).groupBy("_declared").count()
    return [r[0] for r in found.orderBy(F.desc("count"), "_declared").limit(most).collect()]


def fit(rows: DataFrame, smooth: float = SMOOTH, most: int = MOST_LANGUAGES) -> tuple[Fit, DataFrame]:
    """Model of evidence rows (id columns, text, _declared, _host, _suffix), and the rows without their text but
    with their likelihoods."""
    codes = frequent_codes(rows, most)
    rows = rows.withColumn("_declared", F.when(F.col("_declared").isin(codes), F.col("_declared")))
    languages, table = text_table(rows)
    read = likelihoods(rows, languages, table).drop("text")
    read = saved(read.withColumn("_read", F.when(F.col("likelihood.letters") > 0, _best(
        languages, F.col("likelihood.by"))) if languages else F.lit(None).cast("string")))
    if not languages:
        return Fit([], table, None, None, None, []), read
    seen = read.withColumn("_seen", F.coalesce("_declared", "_read"))
    n = dict(seen.groupBy("_seen").count().collect())
    total = sum(n.get(x, 0) for x in languages)
    share = [(n.get(x, 0) + 1) / (total + len(languages)) for x in languages]
    host = F.col("_host")
    top = _shares(seen, suffix_of(host), languages, None, F.lit(None).cast("string"), share, smooth)
    mid = _shares(seen, parent_of(host), languages, top, suffix_of(host), share, smooth)
    low = _shares(seen, host, languages, mid, parent_of(host), share, smooth)
    known = read.where(F.col("_read").isNotNull())
    return Fit(languages, table,
               _log_conditional(known.where("_declared IS NOT NULL").select("_read", F.col("_declared").alias("value")),
                                languages),
               _log_conditional(known.where("_suffix IS NOT NULL").select("_read", F.col("_suffix").alias("value")),
                                languages), low, share), read


def fuse(read: DataFrame, model: Fit, temper: float = TEMPER, least: float = LEAST) -> DataFrame:
    """``read`` with language, probability, text_language and kept."""
    if not model.languages:
        return read.select("*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("probability"),
                           F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("kept"))
    hosts = model.hosts.select(F.col("key").alias("_host"), "shares")
    out = read.join(hosts, "_host", "left")
    prior = F.coalesce("shares", F.array(*map(F.lit, model.share)))
    zero = F.array(*[F.lit(0.0)] * len(model.languages))
    given = {"_declared": zero, "_suffix": zero}
    for value, logs in (("_declared", model.declared), ("_suffix", model.suffix)):
        if logs is not None:  # a null or unseen value is no evidence
            out = out.join(logs.select(F.col("value").alias(value), F.col("logs").alias("_log" + value)), value, "left")
            given[value] = F.coalesce("_log" + value, zero)

    ll = F.transform("likelihood.by", lambda x: x * temper)
    fused = F.zip_with(F.zip_with(ll, prior, lambda a, p: a + F.ln(p)),
                       F.zip_with(given["_declared"], given["_suffix"], lambda a, b: a + b), lambda a, b: a + b)
    out = out.withColumn("_log", fused)
    top = F.array_max("_log")
    mass = F.aggregate(F.transform("_log", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    return (out.withColumn("probability", 1 / mass).withColumn("language", _best(model.languages, F.col("_log")))
            .withColumn("text_language", F.col("_read"))
            .withColumn("kept", (F.col("likelihood.letters") > 0) & (F.col("probability") >= least))
            .drop("_log", "shares", "_log_declared", "_log_suffix"))


def identify(df: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", declared: str | None = None,
             url: str | None = None, host: str | None = None, temper: float = TEMPER, smooth: float = SMOOTH,
             least: float = LEAST, most: int = MOST_LANGUAGES) -> DataFrame:
    """Per row: the keys, language, probability, text_language, declared_language (null where its code is not among the
    ``most`` languages) and kept."""
    cols = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    rows = evidence_rows(df, text, declared, url, host).select(*cols, F.col(text).alias("text"), "_declared", "_host",
                                                              "_suffix")
    model, read = fit(rows, smooth, most)
    return fuse(read, model, temper, least).select(
        *[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], "language", "probability", "text_language",
        F.col("_declared").alias("declared_language"), "kept")
