"""Quality rules: plain counts, and how well public vocabularies fit a text (tokeniser fertility).

Counts look at words ``[^\\x20\\x09-\\x0D]+`` of the whole text (null: no words): characters in words, symbols,
repeated lines, words inside three-word windows that occur twice or more. The base rule fails a text with fewer than
50 words or with more than half of its words in repeated windows.

Fertility measures every distinct word of a slice once per vocabulary: characters per token under a byte-fallback and
a byte-level vocabulary, the share of byte-fallback tokens, and the entropy of a text's tokens. Bands are statistics
of the corpus itself: per language (``und`` where it is null) and doubling of length, as short texts vary more, the
quartiles of each measure over all texts that pass the base rule, widened by a number of interquartile ranges that
differs by measure and side (``BANDS``). A group with fewer than ``least`` texts borrows the band of the first of these
that has as many: its language in the doublings beside it as well, its language, all languages in the three doublings,
the whole corpus (of any size). Each text that passes the base rule is so judged. Quantiles are mergeable sketches, so a
language with a third of all rows is no larger a task than any other."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.graph import saved
from barlake.llm.text import bounds, coded_words, filled, per_worker, slices
from barlake.llm.vocab import BYTES, PIECES, vocab_path

MEASURES = ("n_words:bigint", "word_chars:bigint", "n_symbols:bigint", "n_dup_lines:bigint", "n_repeat_words:bigint",
            "n_tokens:bigint", "chars_per_token:double", "chars_per_byte_token:double", "byte_share:double",
            "entropy:double")
# Interquartile ranges that the band reaches below and above the quartiles (None: no fence), and the least range that
# counts, as a share of the upper quartile or absolute. Junk packs badly and repeats itself; a text that mixes languages
# has high entropy and is none, so entropy has no upper fence.
BANDS = {"chars_per_token": (4.0, 8.0, 0.02, 0.0), "chars_per_byte_token": (6.0, 8.0, 0.02, 0.0),
         "byte_share": (None, 5.0, 0.0, 0.02), "entropy": (2.0, None, 0.01, 0.0)}
LEAST = 50
KEPT_WORDS = 100_000  # measured words a worker keeps


class Fertility:
    """Tokens of words under two vocabularies; words seen before come from a table of bounded size."""

    def __init__(self, folder: str | None):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=vocab_path(PIECES, folder))
        size = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(size)])
        with open(vocab_path(BYTES, folder), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        self.width[list(ranks.values())] = [len(b) for b in ranks]
        self.size = size
        self.seen: dict[str, tuple[bytes, int]] = {}

    def _byte_tokens(self, words: list[str]) -> np.ndarray:
        """Byte-level tokens of each word behind a blank; the words are encoded together, as no token of this
        vocabulary holds a blank after another character."""
        widths = self.width[self.bytes.encode_ordinary(" " + " ".join(words))]
        ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words)))
        return np.diff(np.searchsorted(np.cumsum(widths), ends, side="right"), prepend=0)

    def measure(self, vocab: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words joined, start and number of ids per word, byte-level tokens per word)."""
        known = list(map(self.seen.get, vocab))
        new = np.array([i for i, k in enumerate(known) if k is None], np.int64)
        old = np.array([i for i, k in enumerate(known) if k is not None], np.int64)
        words = [vocab[i] for i in new]
        ids = self.pieces.encode(words, num_threads=1) if words else []
        lengths, second = np.zeros(len(vocab), np.int64), np.zeros(len(vocab), np.int64)
        lengths[old] = [len(known[i][0]) // 2 for i in old]
        second[old] = [known[i][1] for i in old]
        lengths[new] = list(map(len, ids))
        if words:
            second[new] = self._byte_tokens(words)
        flat = np.concatenate((np.frombuffer(b"".join([known[i][0] for i in old]), "<u2"),
                               np.fromiter(chain.from_iterable(ids), np.uint16, int(lengths[new].sum()))))
        order = np.concatenate((old, new))
        starts = np.zeros(len(vocab), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        if len(self.seen) > KEPT_WORDS:
            self.seen.clear()
        for i in new[counts[new] > 1].tolist():
            a = starts[i]
            self.seen[vocab[i]] = (flat[a:a + lengths[i]].tobytes(), int(second[i]))
        return flat, starts, lengths, second


def repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words of one text inside three-word windows found twice or more."""
    if len(codes) < 4:
        return 0
    if distinct > 2_000_000:  # three codes no longer fit 63 bits
        codes = np.unique(codes, return_inverse=True)[1]
        distinct = int(codes.max()) + 1
    c = codes.astype(np.int64)
    windows = (c[:-2] * distinct + c[1:-1]) * distinct + c[2:]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(windows, twice))
    hit = np.zeros(len(codes) + 2, bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def _measured(texts: pa.Array, model: Fertility) -> list[np.ndarray]:
    per_row, codes, vocab = coded_words(texts)
    n, words = len(texts), vocab.to_pylist()
    flat, starts, lengths, second = model.measure(words, np.bincount(codes, minlength=len(words)))
    chars = pc.utf8_length(vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    bytes_before = np.concatenate(([0], np.cumsum(model.is_byte[flat])))
    byte_per_word = bytes_before[starts + lengths] - bytes_before[starts]
    offsets = bounds(per_row)

    def total(per_word):
        sums = np.concatenate(([0], np.cumsum(per_word[codes])))
        return sums[offsets[1:]] - sums[offsets[:-1]]

    tokens = total(lengths)
    entropy, repeats = np.zeros(n), np.zeros(n, np.int64)
    for i in range(n):
        c = codes[offsets[i]:offsets[i + 1]]
        if not len(c):
            continue
        repeats[i] = repeated_words(c, len(words))
        width = lengths[c]
        inside = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        found = np.bincount(flat[np.repeat(starts[c], width) + inside], minlength=model.size)
        found = found[found > 0]
        if len(found):
            t = found.sum()
            entropy[i] = np.log2(t) - float((found * np.log2(found)).sum()) / t
    lines = np.fromiter((repeated_lines(t) for t in texts.to_pylist()), np.int64, n)
    symbols = pc.count_substring_regex(texts, r"[#*$%&|<>]").to_numpy(zero_copy_only=False)
    word_chars = total(chars)
    some = np.maximum(tokens, 1)
    return [per_row, word_chars, symbols.astype(np.int64), lines, repeats, tokens, word_chars / some,
            word_chars / np.maximum(total(second), 1), total(byte_per_word) / some, entropy]


def measure(df: DataFrame, text: str = "text", out: str = "measures", folder: str | None = None) -> DataFrame:
    """``df`` with a struct of the counts and the fertility of its text."""
    names = [m.split(":")[0] for m in MEASURES]
    ints = [m.endswith("bigint") for m in MEASURES]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = per_worker(("fertility", folder), lambda: Fertility(folder))
        for batch in batches:
            texts = filled(batch)
            done = [_measured(texts.slice(lo, hi - lo), model) for lo, hi in slices(texts)]
            cols = [np.concatenate([d[k] for d in done]) if done else np.zeros(0) for k in range(len(names))]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64() if i else pa.float64())
                                              for c, i in zip(cols, ints, strict=True)], names)
    return df.withColumn(out, F.arrow_udf(run, f"struct<{','.join(MEASURES)}>")(F.col(text)))


def base_failed(measures: str = "measures"):
    n, r = F.col(f"{measures}.n_words"), F.col(f"{measures}.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def _pools(lang, octave, reach: tuple[int, ...]):
    """Array of the pools (level, language, doubling) of a text, or with reach (0,) those that a group may borrow."""
    def pool(level, of, at):
        return F.struct(F.lit(level).alias("_level"), of.alias("_of"), at.cast("long").alias("_at"))
    every, none = F.lit(""), F.lit(-1)
    return F.array(pool(0, lang, octave), *[pool(1, lang, octave + k) for k in reach], pool(2, lang, none),
                   *[pool(3, every, octave + k) for k in reach], pool(4, every, none))


def _fences(rows: DataFrame, bands: dict, least: int) -> DataFrame:
    """A band per language and doubling of length that occurs, its own or the nearest that is large enough; the number
    of rows is that of the groups."""
    pools = rows.select(F.explode(_pools(F.col("_lang"), F.col("_octave"), (-1, 0, 1))).alias("_p"), *bands)
    q = saved(pools.groupBy("_p._level", "_p._of", "_p._at").agg(F.count(F.lit(1)).alias("_n"), *[
        F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.75)), F.lit(2000)).alias(c) for c in bands]))
    fences = []
    for c, (below, above, share, floor) in bands.items():
        low, high = F.col(c)[0], F.col(c)[1]
        spread = F.greatest(high - low, share * F.abs(high), F.lit(floor))
        fences.append(F.struct(
            (low - below * spread if below is not None else F.lit(float("-inf"))).alias("low"),
            (high + above * spread if above is not None else F.lit(float("inf"))).alias("high")).alias(f"_{c}"))
    large = q.where((F.col("_n") >= least) | (F.col("_level") == 4)).select("_level", "_of", "_at", *fences)
    groups = q.where("_level = 0").select(F.col("_of").alias("_lang"), F.col("_at").alias("_octave"))
    mine = groups.select("_lang", "_octave", F.explode(_pools(F.col("_lang"), F.col("_octave"), (0,))).alias("_p"))
    return mine.select("_lang", "_octave", "_p.*").join(large, ["_level", "_of", "_at"]).groupBy(
        "_lang", "_octave").agg(*[F.min_by(f"_{c}", "_level").alias(f"_{c}") for c in bands])


def judge(rows: DataFrame, bands: dict = BANDS, least: int = LEAST) -> DataFrame:
    """``rows`` (doc_id, lang, measures) with ``base_failed`` and ``kept``; read twice, so give a written table."""
    rows = rows.withColumn("base_failed", base_failed()).withColumn("_lang", F.coalesce("lang", F.lit("und")))
    rows = rows.withColumn("_octave", F.floor(F.log2(F.greatest(F.col("measures.n_tokens"), F.lit(1)))))
    good = rows.where(~F.col("base_failed")).select("_lang", "_octave", "measures.*")
    fences = _fences(good, bands, least)
    out = rows.join(fences, ["_lang", "_octave"], "left")
    inside = F.lit(True)
    for c in bands:
        x = F.col(f"measures.{c}")
        inside = inside & F.coalesce(x.between(F.col(f"_{c}.low"), F.col(f"_{c}.high")), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside)
