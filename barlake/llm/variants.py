"""Spelling variant grouping by pivotal grams, for words one insertion, deletion or replacement apart.

1. Words are counted over all whole texts (``occurrences``; partial counts before the shuffle, so a word with a third
   of all occurrences is one row a task).
2. Bigrams are ordered by the number of distinct words that hold them, rarest first. They are counted in ``GRAM_SLOTS``
   hashed slots, which bounds the table that goes to the tasks whatever the alphabet; bigrams of one slot count as
   equal. The prefix of a word is its three first bigrams in that order and every further one equal to the third.
3. Pivots: two bigrams of the prefix that share no letter and are in the fewest words, by dynamic programming. Three
   places hold two that are at least two apart, so there always are two.
4. One edit leaves one pivot of a word whole. Of two near words take the one whose third bigram comes first: that pivot
   lies in the other's prefix too. An edit behind the first pivot leaves all letters up to the pivot's end in place,
   one in or before it leaves all letters from the second pivot on in place, counted from the end. These are the
   position limits; a pivot near the end of a word would still meet many words under them. So the letters on the edit's
   side are cut into windows of ``WINDOW`` letters; the edit is in one of them, the letters before it agree in place, those
   behind it moved by the difference of the lengths. A key is a window's place with all letters outside it: made by the
   pivots of a word for each difference, and by the prefix of every other word for its own length. Words under one key
   differ in these few letters only, so their number is bounded whatever the number of words.
5. Pairs under a key are verified by edit distance in the join.

Words of fewer than four letters are not indexed. Lengths and places are code points. Null texts hold no words; a null
id is written as an empty one; repeated rows count as often as they occur; an empty table gives no rows."""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.graph import saved
from barlake.llm.text import list_array

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DROP_EVERY = 31
GRAM_SLOTS = 1 << 16
WINDOW = 3


def misspelt(doc_id: Column, run: Column, every: int = DROP_EVERY) -> Column:
    """The run without one code point where ``every`` divides the CRC-32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
                  ).otherwise(run)


def occurrences(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, every: int = DROP_EVERY) -> DataFrame:
    """(word, n): the distinct words of all texts, long and frequent enough."""
    runs = df.select(F.col(f"`{doc_id}`").alias("id"), F.explode(F.regexp_extract_all(
        F.col(f"`{text}`").cast("string"), F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    words = runs.select(misspelt(F.col("id"), F.col("run"), every).alias("word"))
    # one condition on count and length, or Spark would test the length before the counting, on the spelling made twice
    enough = F.when(F.length("word") >= min_length, F.col("n")).otherwise(0) >= min_count
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(enough)


def pivots(places: list[int], counts: list[int], k: int = 2) -> list[int]:
    """``k`` of the bigram places (ascending) that share no letter and have the least sum of counts: best[j] is the
    cheapest choice of j among the places so far, the last of them ending before the next one begins."""
    best: list[list[tuple[int, tuple]]] = []    # by place: cheapest choice of 0..k among it and those before
    for x, (place, cost) in enumerate(zip(places, counts)):
        before = next((best[y] for y in range(x - 1, -1, -1) if places[y] <= place - 2), None)
        row: list = [(0, ())]
        for j in range(1, k + 1):
            skip = best[x - 1][j] if x else None
            base = (before[j - 1] if before else None) if j > 1 else (0, ())
            take = (base[0] + cost, (*base[1], place)) if base else None
            row.append(min((c for c in (skip, take) if c), default=None))
        best.append(row)
    return list(best[-1][k][1])


def _slot(gram: str) -> int:
    return (ord(gram[0]) * 0x9E37 ^ ord(gram[1]) * 0x85EB) % GRAM_SLOTS


class Ranks(dict):
    """bigram -> (words with a bigram of its slot, slot): its place in the order, rarest first."""

    def __init__(self, counts: dict[int, int]):
        super().__init__()
        self.counts = counts

    def __missing__(self, gram: str) -> tuple[int, int]:
        slot = _slot(gram)
        self[gram] = found = self.counts[slot], slot
        return found


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, n): words of this task with a bigram of the slot."""
    counts: Counter = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            counts.update({_slot(word[p:p + 2]) for p in range(len(word) - 1)})
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                                     names=["slot", "n"])


def _side(word: str, end: int, side: str, differences: tuple[int, ...]) -> list[str]:
    """Keys for an edit behind ``word[:end]``, by the length of the other word: its difference (0 for its own keys)."""
    return [f"{side}{m} {word[:cut]} {word[cut + WINDOW - d:]}"
            for d in differences for m in (len(word) + d,) for cut in range(end, m + 1, WINDOW)]


def word_keys(word: str, ranks: Ranks) -> tuple[list[str], list[str]]:
    """Keys of a word by its pivots and by its prefix."""
    places = [(ranks[word[p:p + 2]], p) for p in range(len(word) - 1)]
    third = sorted(places)[2][0]
    prefix = [(p, rank[0]) for rank, p in places if rank <= third]
    first, second = pivots([p for p, _ in prefix], [c for _, c in prefix])
    back, n = word[::-1], len(word)
    by_prefix: list[str] = []
    for p, _ in prefix:
        by_prefix += _side(word, p + 2, "a", (0,))
        by_prefix += _side(back, n - p, "z", (0,))
    return _side(word, first + 2, "a", (-1, 0, 1)) + _side(back, n - second, "z", (-1, 0, 1)), by_prefix


def _keys(batches: Iterator[pa.RecordBatch], counts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    import xxhash

    def hashed(keys: list[list[str]]) -> pa.Array:
        flat = np.fromiter((xxhash.xxh64_intdigest(k) for ks in keys for k in ks), np.uint64)
        return list_array(np.array([len(ks) for ks in keys], np.int64), pa.array(flat.view(np.int64)))

    ranks = Ranks(counts)
    for batch in batches:
        words = batch.column("word")
        keys = [word_keys(w, ranks) for w in words.to_pylist()]
        yield pa.RecordBatch.from_arrays([words.cast(pa.string()), *(hashed([k[side] for k in keys]) for side in (0, 1))],
                                         names=["word", "pivot_keys", "prefix_keys"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), both ways round: the words (column ``word``, distinct) that are exactly one edit apart."""
    words = words.select("word").where(F.length("word") >= 4)
    slots = words.mapInArrow(_gram_counts, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = {r.slot: r.n for r in slots.collect()}         # at most GRAM_SLOTS
    keyed = saved(words.mapInArrow(lambda it: _keys(it, counts),
                                   "word string, pivot_keys array<long>, prefix_keys array<long>"))
    x = keyed.select(F.col("word").alias("a"), F.explode("pivot_keys").alias("key"))
    y = keyed.select(F.col("word").alias("b"), F.explode("prefix_keys").alias("key"))
    near = x.join(y, (x.key == y.key) & (F.col("a") != F.col("b"))
                  & (F.abs(F.length("a") - F.length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1))
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("p")).select("p.a", "p.b")


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of counted words (word, n).

    ``form`` is the most frequent near word (ties: the smallest) if it is at least ``ratio`` times as frequent, else
    null; ``root`` is the last word reached over forms. Counts grow by ``ratio`` with each form, so chains are short and
    have no rings; each round doubles the steps followed."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = saved(words.select("word", "n"))
    pairs = saved(near_pairs(words))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = (pairs.join(other, "b").groupBy(F.col("a").alias("word"))
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "b")).alias("best")))
    frequent = -F.col("best.less") >= ratio * F.col("n")
    formed = saved(words.join(best, "word", "left").select(
        "word", F.when(frequent, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(frequent, -F.col("best.less")).alias("form_n")))
    reach = saved(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        jump = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = saved(reach.join(jump, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                             F.col("further").isNotNull().alias("moved")))
        reach = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            break
    return formed.join(reach, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                                                     "n_near", "form_n")
