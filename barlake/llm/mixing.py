"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (DataFrame operations only).

The size of a row is its number of words. Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and share as
many words as there are; a target stops at ``cap`` times its source's size and the excess is shared again by weight.

1. Rows of a source, in a seeded hash order, are one stream of words cut into blocks. Offsets come from distributed
   prefix sums over (source, hash), so a source with a third of all rows spreads over many tasks.
2. A source takes every block ``epochs`` times, then the first blocks of one more permutation until its target is
   reached, the last one in part: targets are met to the word and no word is taken more than ``cap`` times. A
   permutation is keyed by source and copy and is a swap-or-not shuffle: in each round a hash decides whether a place
   and its mirror image around a keyed centre change, which permutes any number of blocks without a sort (the short last
   block stays last).
3. The exact block quotas of all sources are split over 2^levels output shards (16 or more) by a binary tree: a node gives its
   left child half of its blocks, drawn without replacement - a multivariate hypergeometric draw, source by source,
   each an inverse-CDF draw from a hashed uniform (tails beyond twelve standard deviations, below 1e-30, are cut).
   A node row holds one number per source.
4. A leaf takes the next so many permuted copies of each source, so leaves draw disjoint blocks; joined by copy number
   to the pieces of rows in that block, and ordered within the shard by a hash.

``taken`` reports where the words of a row go, shard by shard. Reruns agree: every choice is a hash of the seed and of data. Null, empty and blank texts have size 0 and are not
taken; equal rows are taken as separate rows."""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.index import with_global_index, with_prefix_sums
from barlake.llm.graph import saved
from barlake.llm.text import WORD, free_name

BLOCK_WORDS = 4096
SHARD_WORDS = 2_000_000
LEAST_LEVELS = 4
ROUNDS = 64  # of the shuffle; about twice the bits of the largest number of blocks of a source
LN_FACT = [math.lgamma(k + 1) for k in range(16)]


@dataclass
class Mix:
    rows: DataFrame     # rid, doc_id, source, size, hash (of row and text), source_size, target
    pieces: DataFrame   # rid, copy, first_word, n_words, shard, place: words of a row, and where they go
    quotas: DataFrame   # shard, rank, n_blocks, first_copy: the leaves of the tree


def word_count(text) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)),
                      F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source keys, source_size) with rank, weight and target. Two numbers reach the driver: all words, and the
    words per unit of weight of the sources below their cap."""
    s = with_global_index(sources, ("_null", "_source"), "rank")
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1)
                                            .cast("int")).cast("double"))
    s = saved(s.withColumn("_cap", (F.col("source_size") * cap).cast("double"))
              .withColumn("_at", F.col("_cap") / F.col("weight")))
    total, all_weight = s.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return s.withColumn("target", F.lit(0.0))
    # a source is below its cap from the first one on, by cap per weight, whose share of the rest fits
    p = with_prefix_sums(s, ("_at", "rank"), {"_caps": "_cap", "_weights": "weight"})
    share = (F.lit(float(total)) - F.col("_caps")) / (F.lit(float(all_weight)) - F.col("_weights"))
    unit = p.withColumn("_share", share).where("_share <= _at").agg(F.min_by("_share", F.struct("_at", "rank"))).first()[0]
    return s.withColumn("target", F.least("_cap", F.lit(unit) * F.col("weight")))


def _ln_fact(x: Column) -> Column:
    """ln x! of a whole number: a table, then Stirling's series (error below 1e-12)."""
    z = x.cast("double") + 1
    series = ((z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
              + 1 / (1260 * z * z * z * z * z))
    return F.when(x < len(LN_FACT), F.element_at(F.array(*map(F.lit, LN_FACT)), F.least(
        x, F.lit(len(LN_FACT) - 1)).cast("int") + 1)).otherwise(series)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once (a lambda variable, not a repeated expression)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(total: Column, marked: Column, draws: Column, u: Column) -> Column:
    """Marked items among ``draws`` of ``total``, the inverse CDF at ``u``."""
    def log_weight(p, x):
        return -(_let(x, _ln_fact) + _let(p["k"] - x, _ln_fact) + _let(p["n"] - x, _ln_fact)
                 + _let(p["t"] - p["k"] - p["n"] + x, _ln_fact))

    def window(p):
        share = p["k"] / F.greatest(p["t"], F.lit(1.0))
        reach = 12 + F.ceil(12 * F.sqrt(F.greatest(F.lit(0.0), p["n"] * share * (1 - share) * (p["t"] - p["n"])
                                                   / F.greatest(p["t"] - 1, F.lit(1.0)))))
        mode = F.least(F.greatest(F.floor((p["n"] + 1) * (p["k"] + 1) / (p["t"] + 2)), p["low"]), p["high"])
        return _let(F.struct(mode.alias("mode"), reach.alias("reach")), lambda m: F.struct(
            F.greatest(p["low"], m["mode"] - m["reach"]).cast("long").alias("first"),
            F.least(p["high"], m["mode"] + m["reach"]).cast("long").alias("last"),
            log_weight(p, m["mode"]).alias("top")))

    def drawn(p, q):
        weights = F.transform(F.sequence(q["first"], q["last"]), lambda x: F.exp(log_weight(p, x) - q["top"]))
        return _let(weights, lambda w: _let(u * F.aggregate(w, F.lit(0.0), lambda a, x: a + x), lambda goal: F.least(
            q["last"], q["first"] + F.aggregate(
                w, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below")),
                lambda a, x: F.struct((a["sum"] + x).alias("sum"),
                                      (a["below"] + (a["sum"] + x < goal).cast("long")).alias("below")),
                lambda a: a["below"]))))

    given = F.struct(total.cast("double").alias("t"), marked.cast("double").alias("k"), draws.cast("double").alias("n"),
                     F.greatest(F.lit(0), draws - (total - marked)).cast("long").alias("low"),
                     F.least(draws, marked).cast("long").alias("high"))
    return _let(given, lambda p: _let(window(p), lambda q: drawn(p, q)))


def _uniform(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53)


def _halves(level: int, seed: int) -> Column:
    """Per source of a node: blocks for the left child, drawn without replacement from all of the node's."""
    parts = F.col("parts")
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    empty = F.lit(None).cast("array<bigint>")
    start = F.struct(total.alias("items"), F.floor(total / 2).alias("draws"),
                     F.coalesce(empty, F.array().cast("array<bigint>")).alias("got"))

    def step(a, x):
        k = hypergeometric(a["items"], x["n"], a["draws"],
                           _uniform(F.lit(seed), F.lit(level), F.col("node"), x["rank"])).cast("long")
        return _let(k, lambda d: F.struct((a["items"] - x["n"]).alias("items"), (a["draws"] - d).alias("draws"),
                                          F.concat(a["got"], F.array(d)).alias("got")))
    return F.aggregate(parts, start, step, lambda a: a["got"])


def split_quotas(quotas: DataFrame, levels: int, seed: int = 0) -> DataFrame:
    """(rank, n_blocks) -> (shard, rank, n_blocks, first_copy) over 2^levels shards."""
    part = F.struct("rank", F.col("n_blocks").alias("n"), F.lit(0).cast("long").alias("first"))
    nodes = quotas.agg(F.sort_array(F.collect_list(part)).alias("parts")).select(
        F.lit(0).cast("long").alias("node"), "parts")
    for level in range(levels):
        def side(pairs, k, name):
            return F.struct((F.col("node") * 2 + k).alias("node"), F.transform(pairs, lambda p: p[name]).alias("parts"))
        pairs = F.zip_with("parts", _halves(level, seed), lambda x, k: F.struct(
            F.struct(x["rank"].alias("rank"), k.alias("n"), x["first"].alias("first")).alias("left"),
            F.struct(x["rank"].alias("rank"), (x["n"] - k).alias("n"), (x["first"] + k).alias("first")).alias("right")))
        nodes = nodes.select(F.explode(_let(pairs, lambda p: F.array(side(p, 0, "left"), side(p, 1, "right"))))
                             .alias("c")).select("c.node", "c.parts")
        if level == 6 and levels > 8:
            nodes = nodes.repartition("node")
    return (nodes.select(F.col("node").alias("shard"), F.explode("parts").alias("p"))
            .select("shard", "p.rank", F.col("p.n").alias("n_blocks"), F.col("p.first").alias("first_copy"))
            .where("n_blocks > 0"))


def _place(block: Column, blocks: Column, copy: Column, rank: Column, seed: int) -> Column:
    """Place of a block in permutation number ``copy`` of a source; the short last block stays last."""
    m = F.greatest(blocks - 1, F.lit(1).cast("long"))

    def swapped(x, r):
        mirror = F.pmod(F.pmod(F.xxhash64(F.lit(seed), rank, copy, r), m) - x, m)
        return F.when(F.xxhash64(F.lit(seed), rank, copy, r, F.greatest(x, mirror)) % 2 == 0, mirror).otherwise(x)
    moved = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), block, swapped)
    return F.when(block < blocks - 1, moved).otherwise(block)


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = 0, least_levels: int = LEAST_LEVELS) -> Mix:
    b = block_words
    sized = df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                      F.xxhash64(F.col(text)).alias("text_hash"))
    sized = sized.select("doc_id", "source", "size", F.col("source").isNull().alias("_null"),
                         F.coalesce(F.col("source"), F.lit("")).alias("_source"),
                         F.xxhash64(F.lit(seed), "doc_id", "size", "text_hash").alias("hash"), F.lit(1).alias("_one"))
    rows = saved(with_prefix_sums(sized, ("_null", "_source", "hash", "doc_id", "size"),
                                  {"_pos": "size", "rid": "_one"}).drop("_one"))
    by_source = rows.groupBy("_null", "_source").agg(F.sum("size").alias("source_size"), F.min("_pos").alias("_base"))
    s = targets(by_source, weights, cap)
    size, want = F.col("source_size"), F.round("target").cast("long")
    s = (s.withColumn("_want", want).withColumn("_epochs", F.when(size > 0, F.floor(F.col("_want") / size)).otherwise(0))
         .withColumn("_rest", F.col("_want") - F.col("_epochs") * size).withColumn("_blocks", F.ceil(size / b))
         .withColumn("_full", F.floor(F.col("_rest") / b)).withColumn("_part", F.col("_rest") % b)
         .withColumn("n_blocks", F.col("_epochs") * F.col("_blocks") + F.col("_full")
                     + (F.col("_part") > 0).cast("long")))
    s = saved(s)
    words = s.agg(F.sum("_want")).first()[0] or 0
    levels = max(least_levels, math.ceil(math.log2(words / shard_words))) if words else 0
    quotas = saved(split_quotas(s.where("n_blocks > 0").select("rank", "n_blocks"), levels, seed))
    # a row per block copy: Spark sees only the size of the quotas, so it must be kept from broadcasting them
    copies = quotas.select("shard", "rank", F.explode(F.sequence(
        F.col("first_copy"), F.col("first_copy") + F.col("n_blocks") - 1)).alias("_copy_no"))
    rows = rows.join(s, ["_null", "_source"])
    start = F.col("_pos") - F.col("_base")
    pieces = (rows.where("size > 0 AND n_blocks > 0").withColumn("_start", start)
              .withColumn("_block", F.explode(F.sequence(F.floor(start / b), F.floor((start + F.col("size") - 1) / b))))
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_epochs").cast("long"))))
              .withColumn("_place", _place(F.col("_block"), F.col("_blocks"), F.col("copy"), F.col("rank"), seed)))
    more = F.col("copy") == F.col("_epochs")
    pieces = pieces.where(~more | (F.col("_place") < F.col("_full"))
                          | ((F.col("_place") == F.col("_full")) & (F.col("_part") > 0)))
    end = F.when(more & (F.col("_place") == F.col("_full")), F.col("_block") * b + F.col("_part")).otherwise(
        F.col("_block") * b + b)
    lo = F.greatest(F.col("_start"), F.col("_block") * b)
    pieces = (pieces.select("rid", "rank", "copy", (F.col("copy") * F.col("_blocks") + F.col("_place")).alias("_copy_no"),
                            (lo - F.col("_start")).alias("first_word"),
                            (F.least(F.col("_start") + F.col("size"), end) - lo).alias("n_words"))
              .where("n_words > 0").join(copies.hint("merge"), ["rank", "_copy_no"])
              .select("rid", "copy", "first_word", "n_words", "shard",
                      F.xxhash64(F.lit(seed), "shard", "rank", "_copy_no", "rid").alias("place")))
    return Mix(rows.select("rid", "doc_id", "source", "size", "hash", "source_size", "target"), pieces, quotas)


def taken(m: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards) of every row; shards lists shard:words, by shard."""
    got = m.pieces.groupBy("rid", "shard").agg(F.sum("n_words").alias("n")).groupBy("rid").agg(
        F.sum("n").alias("taken"), F.sort_array(F.collect_list(F.struct("shard", "n"))).alias("parts"))
    parts = F.transform("parts", lambda x: F.concat_ws(":", x["shard"].cast("string"), x["n"].cast("string")))
    return m.rows.join(got, "rid", "left").select("doc_id", "size", "source_size", "target", F.coalesce(
        "taken", F.lit(0)).cast("long").alias("taken"), F.coalesce(F.array_join(parts, ","), F.lit("")).alias("shards"))


def mixed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
          **how) -> DataFrame:
    """The mix as rows of ``df``: one row per row and copy taken, its text the taken words with the white space
    behind them (whole texts unchanged). Rows alike in id, source, size and text are numbered. ``df`` may have columns of
    any name."""
    m = mix(df, doc_id, text, source, seed=seed, **how)
    name = {x: free_name(df, x) for x in ("_id", "_src", "_size", "_hash", "_no", "_n", "_ranges")}
    key = [name[x] for x in ("_id", "_src", "_size", "_hash")]
    no, n, ranges = name["_no"], name["_n"], name["_ranges"]
    take = m.pieces.groupBy("rid", "copy").agg(F.sum("n_words").alias(n), F.sort_array(
        F.collect_list(F.struct("first_word", "n_words"))).alias(ranges))
    numbered = m.rows.select("rid", *[F.col(c).alias(k) for c, k in zip(("doc_id", "source", "size", "hash"), key, strict=True)])
    take = take.join(numbered.withColumn(no, F.row_number().over(Window.partitionBy(*key).orderBy("rid"))), "rid")
    size = word_count(text)
    docs = df.withColumns(dict(zip(key, (F.col(doc_id), F.col(source), size, F.xxhash64(
        F.lit(seed), F.col(doc_id), size, F.xxhash64(F.col(text)))), strict=True)))
    docs = docs.withColumn(no, F.row_number().over(Window.partitionBy(*key).orderBy(text)))
    on = [docs[k].eqNullSafe(take[k]) for k in (*key, no)]
    words = F.regexp_extract_all(text, F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    some = F.array_join(F.flatten(F.transform(ranges, lambda r: F.slice(
        words, (r["first_word"] + 1).cast("int"), r["n_words"].cast("int")))), "")
    out = docs.join(take, on).select(*[docs[c] for c in df.columns], take[n], take[ranges], docs[name["_size"]])
    out = out.withColumn(text, F.when(F.col(n) == F.col(name["_size"]), F.col(text)).otherwise(some))
    if "n_chars" in df.columns:
        out = out.withColumn("n_chars", F.length(text).cast(df.schema["n_chars"].dataType))
    return out.select(*df.columns)
