"""SentencePiece (merge type) encoding by a prefix table, and decoding.

Every prefix of a text has one last token in the encoding of that prefix. The table of these last tokens is filled
from left to right: an Aho-Corasick automaton over the vocabulary lists the tokens that end at a position, longest
first, and the one that is compatible with the last token of the prefix before it is stored. Two tokens are
compatible when merging the symbols of their joined text ends in just these two; the answers are remembered. Ids are
recovered from the end of the text backwards. No merge queue runs over the text.

A text starts with one added blank mark, blanks become marks, nothing else is normalised. No vocabulary entry has a
mark after another character, a line feed, or a stop or comma after a letter (checked when the file is loaded), so a
text falls into chunks at its marks, and these into units at the other places, that are encoded on their own; encoded
chunks and units are kept in tables of bounded size. Characters outside the vocabulary become byte tokens.

Null counts as the empty text: only the end id, decoded to ''."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.text import bounds, filled, per_worker, slices
from barlake.llm.vocab import PIECES, vocab_path

MARK = "▁"
KEPT_CHUNKS = 160_000  # encoded chunks (without their mark) a worker keeps at most, old and new together; about 200 bytes each
KEPT_UNITS = 200_000  # encoded units, likewise
KEPT_PAIRS = 240_000  # compatibility answers, likewise
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])


class TokenBytes(dict):
    """Token -> its id as a little-endian 16-bit number; of a character without one, the ids of its bytes."""

    def __init__(self, ids: dict[str, int], byte: list[int]):
        super().__init__((t, i.to_bytes(2, "little")) for t, i in ids.items())
        self.byte = [i.to_bytes(2, "little") for i in byte]

    def __missing__(self, token: str) -> bytes:
        return b"".join([self.byte[b] for b in token.encode()])


class Kept(dict):
    """Text -> its ids as little-endian 16-bit numbers, made on first use and kept while it is in use: at ``most`` texts
    in all, those not asked for since the table was last full are given up."""

    def __init__(self, make, most):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, text: str) -> bytes:
        if 2 * len(self) >= self.most():
            self.older = dict(self)
            self.clear()
        value = self.older.get(text)
        if value is None:
            value = self.make(text)
        if len(text) <= 64:
            self[text] = value
        return value


class PrefixTable:
    """Encoder and decoder of a vocabulary file, with the tables that a worker keeps."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.end = sp.eos_id()
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.out = [b""] * size
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.out[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.score[piece], self.id[piece] = sp.get_score(i), i
                self.out[i] = piece.replace(MARK, " ").encode()
            elif sp.is_unknown(i):
                self.out[i] = " ⁇ ".encode()
        if size > 65_536:
            raise ValueError("ids need more than 16 bits")
        long = [p for p in self.score if len(p) > 1]
        if any(re.search(f"[^{MARK}]{MARK}|\n|[{_LETTER}][.,]", p) for p in long):
            raise ValueError("an entry crosses a unit border")
        self.automaton = ahocorasick.Automaton()
        self.reached = {p for p in long if self.merged(p) == [p]}
        for p in self.reached:  # an entry that merging never reaches ends no prefix
            self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()
        self.bytes_of = TokenBytes(self.id, self.byte)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units = Kept(self.unit_ids, lambda: KEPT_UNITS)
        self.words = Kept(lambda word: self.chunk_ids(MARK + word), lambda: KEPT_CHUNKS)
        self.older_pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Symbols of a short text after all merges, best score first, leftmost among equals."""
        symbols, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Do the symbols of the joined text merge to just these two?"""
        if 2 * len(self.pairs) >= KEPT_PAIRS:   # what was asked since the last time stays
            self.older_pairs = dict(self.pairs)
            self.pairs.clear()
        known = self.older_pairs.get((left, right))
        if known is None:
            joined = left + right
            known = joined not in self.reached and self.merged(joined) == [left, right]
        self.pairs[left, right] = known
        return known

    def tokens(self, unit: str) -> list[str]:
        last = list(unit)  # a character that ends no longer compatible token is a token itself
        pairs, done = self.pairs, -1
        for end, (token, width) in self.automaton.iter(unit):
            if end == done:
                continue
            start = end - width
            if start >= 0:
                left = last[start]
                ok = pairs.get((left, token))
                if ok is None:
                    ok = self.compatible(left, token)
                if not ok:
                    continue
            last[end] = token
            done = end
        found, i = [], len(unit)
        while i:
            found.append(last[i - 1])
            i -= len(found[-1])
        return found[::-1]

    def unit_ids(self, unit: str) -> bytes:
        code = self.bytes_of
        return b"".join([code[t] for t in self.tokens(unit)])

    def chunk_ids(self, chunk: str) -> bytes:
        return b"".join([self.units[u] for u in _UNIT.findall(chunk)])

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        if not text:
            ids = b""
        elif text[0] == " " or "  " in text or MARK in text:    # chunks with several marks
            ids = b"".join(map(self.chunk_ids, _CHUNK.findall(MARK + text.replace(" ", MARK))))
        else:
            ids = b"".join(map(self.words.__getitem__, text.split(" ")))
        return np.frombuffer(ids + self.end.to_bytes(2, "little") if end else ids, "<u2")

    def decode(self, ids) -> str:
        """Text of ids; the blank added before the text goes."""
        data = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return data[1:] if data.startswith(" ") else data


# A chunk ends before a mark; a unit does, and in a chunk also around a line feed, and between a letter and a stop or comma.
_INNER = f"(?:[^{MARK}\n.,]|(?<![{_LETTER}])[.,])"
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_UNIT = re.compile(f"{MARK}*(?:[.,]{_INNER}*|{_INNER}+)|{MARK}+|\n")


def encode(df: DataFrame, text: str = "text", out: str = "encoded", folder: str | None = None,
           model: str = PIECES) -> DataFrame:
    """``df`` with a struct of the ids (the end id last) and the text decoded from them.

    Rows leave a task in slices of a few MB of text, so neither side holds the ids of a whole batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = vocab_path(model, folder)
        table = per_worker(("prefix table", path), lambda: PrefixTable(path))
        for batch in batches:
            texts = filled(batch.column(text))
            rest = batch.drop_columns([out]) if out in batch.schema.names else batch
            for lo, hi in slices(texts, 2_000_000):
                ids = [table.encode(t) for t in texts.slice(lo, hi - lo).to_pylist()]
                back = [table.decode(i.tolist()) for i in ids]
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds(np.array([len(i) for i in ids], np.int64)), pa.int32()),
                    pa.array(np.concatenate(ids).astype(np.int32)))
                yield rest.slice(lo, hi - lo).append_column(out, pa.StructArray.from_arrays(
                    [lists, pa.array(back, pa.string())], ["ids", "decoded"]))

    schema = T.StructType([f for f in df.schema.fields if f.name != out]
                          + [T.StructField(out, ENCODED)])
    return df.mapInArrow(run, schema)


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **where) -> DataFrame:
    """Per row: number of ids and the digests of the ids and of the decoded text."""
    e = encode(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), out="e", **where)
    ids = F.array_join(F.transform("e.ids", lambda i: i.cast("string")), " ")
    return e.select("doc_id", F.size("e.ids").cast("long").alias("n_tokens"),
                    F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                    F.sha2(F.col("e.decoded").cast("binary"), 256).alias("decoded_sha256"))
