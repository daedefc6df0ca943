"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fit, on a bounded sample of labelled rows (the only use of labels; see ``fit`` for the two bounds):

* terms are lower-case words and their beginnings of 5 letters (stems). Every term of a sampled example is a coordinate;
  none is chosen or dropped. Terms that no example has cannot meet an example and are left out of the vectors
* document frequencies are counted over all documents, by a grouped aggregation over the terms of the sample
* a weight is (1 + ln tf) idf emphasis; the emphasis is ``floor`` plus the lower confidence bound, where positive, of the
  log ratio of a term's share among toxic examples to that among others. Vectors have length 1
* equal vectors are one posting with its counts of labels. A term's postings are cut into blocks of consecutive examples,
  each with its largest weight

Score: blocks are visited by upper bound, made of query weight times block maximum, and left when it falls below the
k-th best similarity, so the k nearest are exact, with all ties (to ``TIE``) at the k-th. Votes weigh similarity^``power``; the score is the
weighted share of toxic neighbours, drawn to the base rate by a prior of ``prior`` votes. Evidence is the neighbours that
voted: id, cosine, toxic texts and texts of each (the smallest id stands for equal vectors).

A null or empty text, or one without a known term, has no neighbour and scores the base rate. An id labelled more than
once is toxic if one label is; of texts that share an id the smallest is the example. Without labels every score is a
half. Labels, language, source and id are never inputs of a score."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.graph import saved
from barlake.llm.text import bounds, coded_words, filled, slices

MAX_EXAMPLES, MAX_CHARS, NEAREST, BLOCK = 5000, 50_000_000, 25, 64
STEM = 5
# Terms stored as arrays, blocks visited before the floor is known, queries looked up together, cosines taken as equal.
DENSE, LEAD, BATCH, TIE = 512, 8, 128, 1e-6
ONE_THREAD = 1 << 18
_EDGE = ".,;:!?\"'()[]{}|#$%&*<>-_=+/\\~`^0123456789"


def terms_of(word: str) -> list[str]:
    """Terms of a lower-case word: itself and its beginning."""
    w = word.strip(_EDGE)
    return [w, w[:STEM] + "~"] if len(w) >= STEM else [w] if w else []


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` by a few rows at a time, each product too small to be given to several threads: threads that wait for
    such short products cost as much CPU time again."""
    rows = max(1, ONE_THREAD // max(1, b.size))
    whole = len(a) // rows * rows
    out = np.empty((len(a), b.shape[1]), a.dtype)
    out[:whole] = np.matmul(a[:whole].reshape(whole // rows, rows, a.shape[1]), b).reshape(whole, b.shape[1])
    out[whole:] = a[whole:] @ b
    return out


def _occurrences(texts: pa.Array, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets of the texts, places in ``names``, tf) of the distinct terms of each text of a slice, as ``terms_of`` gives
    them, for terms that are in ``names``."""
    per_row, codes, vocab = coded_words(pc.utf8_lower(texts))
    words = pc.utf8_trim(vocab, characters=_EDGE)
    stems = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, STEM), *(pa.scalar(x, words.type) for x in ("~", "")))
    ids = np.stack([pc.fill_null(pc.index_in(x, value_set=names), -1).to_numpy() for x in (words, stems)], axis=1)
    ids[pc.less(pc.utf8_length(words), STEM).to_numpy(zero_copy_only=False), 1] = -1
    ids = ids[codes].ravel().astype(np.int64)
    rows, has, width = np.repeat(np.arange(len(per_row)), 2 * per_row), ids >= 0, max(len(names), 1)
    found, tf = np.unique(rows[has] * width + ids[has], return_counts=True)
    return np.searchsorted(found, np.arange(len(per_row) + 1) * width), found % width, tf


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (term, toxic, clean): texts of a batch that have the term."""
    for batch in batches:
        texts, labels = filled(batch.column("text")), batch.column("label").to_numpy(zero_copy_only=False)
        for lo, hi in slices(texts):
            per_row, codes, vocab = coded_words(pc.utf8_lower(texts.slice(lo, hi - lo)))
            lists = [terms_of(w) for w in vocab.to_pylist()]
            counts: dict[str, list[int]] = {}
            ends = np.cumsum(per_row)
            for n, end, y in zip(per_row.tolist(), ends.tolist(), labels[lo:hi].tolist(), strict=True):
                for t in {t for c in np.unique(codes[end - n:end]).tolist() for t in lists[c]}:
                    counts.setdefault(t, [0, 0])[1 - int(y)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(
                [c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
                names=["term", "toxic", "clean"])


def _frequencies(docs: DataFrame, names: pa.Array) -> np.ndarray:
    """Texts of ``docs`` (column ``text``) that have each known term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(names), np.int64)
        for batch in batches:
            texts = filled(batch.column("text"))
            for lo, hi in slices(texts):
                df += np.bincount(_occurrences(texts.slice(lo, hi - lo), names)[1], minlength=len(names))
        has = np.flatnonzero(df)
        for at in range(0, len(has), 100_000):
            part = has[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(df[part], pa.int64())],
                                             names=["term", "n"])
    found = docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(names))
    df[found["term"].to_numpy()] = found["n"].to_numpy()
    return df


class Index:
    """Distinct example vectors with their counts of labels, in blocks with maxima.

    ``vectors`` are (term ids ascending, weights) arrays; ``toxic`` and ``count`` are their numbers of texts. The
    ``DENSE`` most frequent terms keep their postings as one array a block, all others as lists; this changes no result."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], toxic, count, n_terms: int):
        # neighbours in the index share their strongest terms, so block maxima are tight
        self.order = np.array(sorted(range(len(vectors)), key=lambda e: (
            int(vectors[e][0][np.argmax(vectors[e][1])]) if len(vectors[e][0]) else -1, e)), np.int64)
        self.size, self.blocks = len(vectors), -(-len(vectors) // BLOCK)
        self.toxic, self.count = np.asarray(toxic, float)[self.order], np.asarray(count, float)[self.order]
        example = np.repeat(np.arange(self.size, dtype=np.int32), [len(vectors[e][0]) for e in self.order])
        empty = [np.zeros(0)]
        terms = np.concatenate([vectors[e][0] for e in self.order] or empty).astype(np.int64)
        weight = np.concatenate([vectors[e][1] for e in self.order] or empty).astype(np.float32)
        frequency = np.bincount(terms, minlength=n_terms)
        frequent = np.argsort(-frequency, kind="stable")[:DENSE]
        frequent = frequent[frequency[frequent] > 0]
        self.slot = np.full(n_terms, -1, np.int32)
        self.slot[frequent] = np.arange(len(frequent))
        slot = self.slot[terms]
        self.dense = np.zeros((self.blocks, len(frequent), BLOCK), np.float32)
        kept = slot >= 0
        self.dense[example[kept] // BLOCK, slot[kept], example[kept] % BLOCK] = weight[kept]
        self.tops = np.ascontiguousarray(self.dense.max(axis=2).T)
        by_term = np.argsort(terms[~kept], kind="stable")
        self.example, self.weight = example[~kept][by_term], weight[~kept][by_term]
        self.first = np.searchsorted(terms[~kept][by_term], np.arange(n_terms + 1))

    def similar(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (term ids, weights) the (places, cosines) of the k nearest by number of labelled texts, nearest
        first, with all ties at the last.

        Listed postings are added up first. A block's bound is the largest of these sums in it plus query weight times
        block maximum over the frequent terms; the ``LEAD`` blocks of largest bound give the floor, and of the others those
        that reach it are visited."""
        n, width = len(queries), self.blocks * BLOCK
        if not n or not self.blocks:
            return [(np.zeros(0, np.int64), np.zeros(0))] * n
        rows = np.repeat(np.arange(n), [len(t) for t, _ in queries])
        terms, weights = (np.concatenate(x) for x in zip(*queries, strict=True))
        slot = self.slot[terms]
        frequent, listed = slot >= 0, slot < 0
        q = np.zeros((n, len(self.tops)), np.float32)
        q[rows[frequent], slot[frequent]] = weights[frequent]
        sums, at = np.zeros((n, width)), 0
        for row, (t, w) in enumerate(queries):
            rare = listed[at:at + len(t)]
            at += len(t)
            starts = self.first[t[rare]]
            runs = self.first[t[rare] + 1] - starts
            posting = _spread(starts, runs)
            sums[row] = np.bincount(self.example[posting], np.repeat(w[rare], runs) * self.weight[posting], width)
        sums = sums.reshape(n, self.blocks, BLOCK)
        bound = sums.max(axis=2) + _product(q, self.tops)
        scores = np.zeros_like(sums)

        def visit(need: np.ndarray) -> None:
            for b in np.flatnonzero(need.any(axis=0)).tolist():
                who = np.flatnonzero(need[:, b])
                scores[who, b] = sums[who, b] + _product(q[who], self.dense[b])
        lead = np.argsort(-bound, axis=1, kind="stable")[:, :LEAD]
        need = np.zeros(bound.shape, bool)
        np.put_along_axis(need, lead, True, axis=1)
        visit(need)
        best = np.take_along_axis(scores, lead[:, :, None], axis=1).reshape(n, -1)
        # every example holds a text at least, so k examples reach no lower than k texts
        floor = -np.partition(-best, min(k, best.shape[1]) - 1, axis=1)[:, min(k, best.shape[1]) - 1]
        if best.shape[1] < k:
            floor[:] = 0
        visit(~need & (bound > 0) & (bound >= floor[:, None] - TIE))
        out = []
        for s, low in zip(scores.reshape(n, width), floor.tolist(), strict=True):
            near = np.flatnonzero((s > 0) & (s >= low - TIE))
            near = near[np.argsort(-s[near], kind="stable")]
            at = int(np.searchsorted(np.cumsum(self.count[near]), k))
            if at < len(near):
                near = near[:np.searchsorted(-s[near], TIE - s[near[at]], side="right")]
            out.append((near, s[near]))
        return out


class Model:
    """``names``: the terms; ``strength``: idf times emphasis of each term; ``ids``: an id for each example vector."""

    def __init__(self, names: pa.Array, strength: np.ndarray, rate: float, k: int, power: float, prior: float):
        self.names, self.strength, self.rate = names, strength, rate
        self.k, self.power, self.prior = k, power, prior
        self.index, self.ids = Index([], [], [], len(names)), pa.array([], pa.int64())

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Unit vectors (term ids ascending, weights) of the texts of a slice."""
        at, terms, tf = _occurrences(texts, self.names)
        weights, out = (1 + np.log(tf)) * self.strength[terms], []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            t, w = terms[lo:hi], weights[lo:hi]
            t, w = t[w > 0], w[w > 0]
            out.append((t, np.round(w / math.sqrt(float(w @ w)), 7) if len(w) else w))
        return out

    def add_examples(self, ids: pa.Array, vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> None:
        """Index the examples, given by ascending id; equal vectors become one, under its first id."""
        place: dict[tuple[bytes, bytes], int] = {}
        first, toxic, count = [], [], []
        for e, ((t, w), y) in enumerate(zip(vectors, labels, strict=True)):
            at = place.setdefault((t.tobytes(), w.tobytes()), len(first))
            if at == len(first):
                first.append(e)
                toxic.append(0)
                count.append(0)
            toxic[at] += y
            count[at] += 1
        self.index = Index([vectors[e] for e in first], toxic, count, len(self.names))
        self.ids = ids.take(pa.array(np.array(first, np.int64)[self.index.order], pa.int64()))

    def scores(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(score, places, cosines) of each query, with the neighbours that vote."""
        for lo in range(0, len(queries), BATCH):
            for e, s in self.index.similar(queries[lo:lo + BATCH], self.k):
                w = s ** self.power
                votes, toxic = float((w * self.index.count[e]).sum()), float((w * self.index.toxic[e]).sum())
                yield (toxic + self.prior * self.rate) / (votes + self.prior), e, s


def fit(labels: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "label",
        max_examples: int = MAX_EXAMPLES, max_chars: int = MAX_CHARS, k: int = NEAREST, power: float = 2.0,
        prior: float = 0.03, floor: float = 0.1) -> Model:
    """Model of at most ``max_examples`` ids of ``labels``, drawn by hash of the id before the texts of ``docs`` are joined
    (broadcast: ``max_examples`` rows). Of these as many, in order of hash, as hold ``max_chars`` characters together (one at
    least) are examples, with their whole texts. These two bound what reaches the driver: the distinct terms of the
    examples with three counts, and the vectors. Frequencies are counted over all of ``docs``."""
    sample = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
              .groupBy(F.col(doc_id).alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
              .withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(max_examples))
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = saved(named.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label", "place")
                 .agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))
    sizes = sorted((r.place, r.n) for r in rows.select("place", F.length("text").alias("n")).collect())
    if not sizes:
        return Model(pa.array([], pa.large_string()), np.zeros(0), 0.5, k, power, prior)
    fits = int(np.searchsorted(np.cumsum([n for _, n in sizes]), max_chars, side="right"))
    rows = rows.where(F.col("place") <= sizes[max(fits, 1) - 1][0])
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    counts = rows.mapInArrow(_example_terms, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).orderBy("term").toArrow()
    names = pa.array(counts["term"].to_pylist(), pa.large_string())
    a, b = counts["toxic"].to_numpy() + 0.5, counts["clean"].to_numpy() + 0.5
    sure = np.log(a / b) - math.log((toxic + 1) / (n - toxic + 1)) - 1.64 * np.sqrt(1 / a + 1 / b)
    idf = np.log((1 + docs.count()) / (1 + _frequencies(named, names))) if len(names) else np.zeros(0)
    model = Model(names, np.maximum(idf, 0) * (floor + np.maximum(sure, 0)), toxic / n, k, power, prior)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = filled(batch.column("text"))
            for lo, hi in slices(texts):
                part = batch.slice(lo, hi - lo)
                v = model.vectors(texts.slice(lo, hi - lo))
                at = pa.array(bounds(np.array([len(t) for t, _ in v])), pa.int32())
                flat = [np.concatenate(x) for x in zip(*v, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(at, pa.array(flat[0], pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(flat[1], pa.float64()))],
                    names=["doc_id", "label", "terms", "weights"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "label", "text").mapInArrow(
        vectors, f"doc_id {kind}, label int, terms array<int>, weights array<double>").orderBy("doc_id").toArrow()
    found = found.combine_chunks()
    lists = [[x.values.to_numpy(zero_copy_only=False) for x in found[c]] for c in ("terms", "weights")]
    model.add_examples(found["doc_id"].combine_chunks(), [(t.astype(np.int64), w) for t, w in zip(*lists, strict=True)],
                       found["label"].to_pylist())
    return model


def score(df: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``df`` with a struct of the score and the neighbours that voted, nearest first."""
    ids, index = model.ids, model.index
    kind = {"int64": "long", "int32": "int", "int16": "smallint", "int8": "tinyint"}.get(str(ids.type), "string")
    if kind == "string":
        ids = ids.cast(pa.string())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, scores, places, cosines = filled(batch), [], [], []
            for lo, hi in slices(texts):
                place: dict[tuple[bytes, bytes], int] = {}
                queries, which = [], []
                for t, w in model.vectors(texts.slice(lo, hi - lo)):
                    which.append(place.setdefault((t.tobytes(), w.tobytes()), len(queries)))
                    if which[-1] == len(queries):
                        queries.append((t, w))
                found = list(model.scores(queries))
                for s, e, c in (found[at] for at in which):
                    scores.append(s)
                    places.append(e)
                    cosines.append(c)
            at = bounds(np.array([len(e) for e in places], np.int64))
            e = np.concatenate(places or [np.zeros(0, np.int64)])
            voters = pa.StructArray.from_arrays(
                [ids.take(pa.array(e, pa.int64())), pa.array(np.concatenate(cosines or [np.zeros(0)])),
                 pa.array(index.toxic[e].astype(np.int32)), pa.array(index.count[e].astype(np.int32))],
                ["id", "cosine", "toxic", "texts"])
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.ListArray.from_arrays(
                pa.array(at, pa.int32()), voters)], ["score", "evidence"])
    voter = f"struct<id:{kind},cosine:double,toxic:int,texts:int>"
    return df.withColumn(out, F.arrow_udf(run, f"struct<score:double,evidence:array<{voter}>>")(F.col(text)))
