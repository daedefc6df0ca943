"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, address schemes and identifier cues
("iban", "account no", ... in any case). A small deterministic parser starts at each anchor, expands to the exact
boundaries of the item and validates it. No pattern is searched over the text as a whole.

Base kinds, leftmost and non-overlapping per kind (ASCII letters and digits only):

* email: local part of ``A-Za-z0-9._%+-``, ``@``, two or more dot-separated labels of ``A-Za-z0-9-``
* ip: four dot-separated digit runs, each at most 255
* card: digits with single blanks or hyphens between, 12 to 19 of them, passing Luhn
* phone: ``+``, a digit, any of ``0-9 ( ) . - blank``, ending in a digit, 9 to 15 digits

A candidate that fails its check is dropped and not retried at a later start inside it. Added kinds: ``mailbox`` (the
full mailbox where letters beyond ASCII cut the base email short), ``address`` (scheme or ``www.`` up to the last
character that belongs to it, with a host of at most 253 characters) and ``account`` (the identifier after a cue: a valid
IBAN, or 6 to 34 characters with at least 6 digits). Positions are code points, ends exclusive. Null and empty texts have no spans; every other column
of the input passes through, so clashing names cannot occur except with the output column, which is replaced."""
from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.text import free_name

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "mailbox", "address", "account")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_SCHEMES = ("http://", "https://", "ftp://", "mailto:", "www.")
_CUES = ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "ssn", "passport", "user id",
         "customer id", "tax id")

_LABEL = re.compile(r"[A-Za-z0-9-]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"[ ().0-9-]*")
_CUE_LINK = re.compile(r"(?:[ \t]*(?:number|no|nr|num|id)\b\.?)?[ \t]*[:#=]?[ \t]*", re.I)
_IDENT = re.compile(r"[A-Za-z0-9](?:[ -]?[A-Za-z0-9]){5,41}")
_TOKEN = re.compile(r"[A-Za-z0-9](?:-?[A-Za-z0-9]){5,33}")
_ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]+")
_AFTER_HOST = re.compile(r"[/?#]")
_HOST = re.compile(r"[^/?#:]{1,254}")
_PLAIN_END = frozenset(".,;:!?*&$%#")
HOST_LENGTH = 253  # of a domain name, by its standard
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = frozenset("0123456789")
_PAIRS = {")": "(", "]": "["}
_LOWER = {c: c + 32 for c in range(65, 91)}


def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for word, kind in [("@", "@"), ("+", "+"), *((d, "0") for d in "0123456789"), *((s, "scheme") for s in _SCHEMES)]:
        a.add_word(word, (kind, len(word)))
    for cue in _CUES:
        a.add_word(cue, ("cue", len(cue)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(s: str) -> bool:
    s = s.replace(" ", "").replace("-", "").upper()
    if not (15 <= len(s) <= 34 and s[:2].isalpha() and s[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _domain(s: str, at: int) -> int:
    """End of two or more labels after the at-sign, or -1."""
    m = _LABEL.match(s, at + 1)
    if not m:
        return -1
    end, labels = m.end(), 1
    while end < len(s) and s[end] == "." and (m := _LABEL.match(s, end + 1)):
        end, labels = m.end(), labels + 1
    return end if labels > 1 else -1


def _email(s: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and s[start - 1] in _LOCAL:
        start -= 1
    if start == at or (end := _domain(s, at)) < 0:
        return None
    return start, end


def _mailbox(s: str, at: int, base: tuple[int, int]) -> tuple[int, int] | None:
    start = at
    while start > 0 and (s[start - 1] in _LOCAL or (s[start - 1] > "\x7f" and s[start - 1].isalpha())):
        start -= 1
    while start < at and s[start] in ".-%+":
        start += 1
    end = base[1]
    while end > at and s[end - 1] == "-":
        end -= 1
    return (start, end) if start < base[0] else None


def _ip(s: str, pos: int) -> tuple[int, list[str]]:
    """(end, parts) of four dotted digit runs from ``pos``; fewer parts if they are not there."""
    m = _DIGITS.match(s, pos)
    end, parts = m.end(), [m.group()]
    while len(parts) < 4 and end < len(s) and s[end] == "." and (m := _DIGITS.match(s, end + 1)):
        end = m.end()
        parts.append(m.group())
    return end, parts


def _phone(s: str, plus: int) -> int:
    """End of the phone candidate, or -1: the last digit of the run, with a character between it and the first."""
    if plus + 1 >= len(s) or s[plus + 1] not in _DIGIT:
        return -1
    end = _PHONE.match(s, plus + 2).end()
    while end > plus + 3 and s[end - 1] not in _DIGIT:
        end -= 1
    return end if end > plus + 3 and s[end - 1] in _DIGIT else -1


class _Run:
    """The characters around a scheme that may belong to an address, with what all schemes of the run share: each of its
    positions is looked at a bounded number of times, however many schemes it holds."""

    def __init__(self, s: str, start: int):
        self.s, self.start = s, start
        self.end = self.tail = _ADDRESS.match(s, start).end()
        while self.tail > start and (s[self.tail - 1] in _PLAIN_END or s[self.tail - 1] in _PAIRS):
            self.tail -= 1
        self.last_at = s.rfind("@", start, self.end)
        self.next_at = self.next_cut = -1
        # places of each closing bracket in the tail, and openers less closers before each position up to the tail
        closers = set(s[self.tail:self.end]) & set(_PAIRS)
        self.closers = {c: [i for i in range(self.tail, self.end) if s[i] == c] for c in closers}
        self.excess = {c: list(accumulate(((x == _PAIRS[c]) - (x == c) for x in s[start:self.tail]), initial=0))
                       for c in closers}

    def trimmed(self, start: int) -> int:
        """End of the run without closing punctuation and without closing brackets that nothing from ``start`` opens."""
        end = self.tail
        for c, places in self.closers.items():
            opened = self.excess[c][-1] - self.excess[c][start - self.start]
            if opened > 0:
                end = max(end, places[min(opened, len(places)) - 1] + 1)
        return end

    def host(self, start: int, end: int) -> str:
        """Host name from ``start``, behind user information; empty if it is longer than a name can be."""
        if self.next_at < start:
            self.next_at = at if (at := self.s.find("@", start, self.end)) >= 0 else self.end
        if self.next_cut < start:
            self.next_cut = m.start() if (m := _AFTER_HOST.search(self.s, start, self.end)) else self.end
        m = _HOST.match(self.s, self.next_at + 1 if self.next_at < min(self.next_cut, end) else start, end)
        return m.group() if m and len(m.group()) <= HOST_LENGTH else ""


def _address(s: str, start: int, scheme: int, run: _Run) -> int:
    """End of the address whose scheme ends at ``scheme``, or -1."""
    end = run.trimmed(start)
    if s[start:scheme].lower() == "mailto:":
        at = max(scheme, run.last_at + 1)
        host = s[at:end] if end - at <= HOST_LENGTH else ""
    else:
        host = run.host(scheme if s[scheme - 1] == "/" else start, end)
    labels = host.split(".")
    least = 3 if labels[0].lower() == "www" else 2
    return end if len(labels) >= least and all(labels) and len(labels[-1]) > 1 else -1


def _account(s: str, cue_start: int, cue_end: int) -> tuple[int, int] | None:
    if cue_start and s[cue_start - 1].isalnum() or cue_end < len(s) and s[cue_end].isalpha():
        return None
    start = _CUE_LINK.match(s, cue_end).end()
    if start == cue_end:
        return None
    if m := _IDENT.match(s, start):
        # the longest cut at a group boundary that is a valid IBAN
        cuts = [m.end(), *(start + i for i, c in reversed(list(enumerate(m.group()))) if c in " -")]
        for end in cuts:
            if iban(s[start:end]):
                return start, end
    m = _TOKEN.match(s, start)
    if m and sum(c in _DIGIT for c in m.group()) >= 6 and not s[m.end():m.end() + 1].isalnum():
        return start, m.end()
    return None


def _folded(s: str) -> str:
    """``s`` in lower case, position by position: one letter grows by the usual rule, so then only A-Z are changed."""
    low = s.lower()
    return low if len(low) == len(s) else s.translate(_LOWER)


def spans_of(s: str, automaton) -> list[tuple[str, int, int]]:
    """All spans of one text by (start, kind as listed)."""
    found: list[tuple[int, int, int]] = []
    run = None
    email_end = ip_end = card_end = phone_end = address_end = account_end = 0
    for last, (kind, width) in automaton.iter(_folded(s)):
        at = last - width + 1
        if kind == "0":
            if at >= ip_end and (at == ip_end or s[at - 1] not in _DIGIT):
                end, parts = _ip(s, at)
                if len(parts) == 4:
                    ip_end = end
                    if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in parts):
                        found.append((at, 1, end))
            if at >= card_end:
                end = _CARD.match(s, at).end()
                card_end = end
                digits = s[at:end].replace(" ", "").replace("-", "") if end - at >= 12 else ""
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append((at, 2, end))
        elif kind == "@":
            if at >= email_end and (m := _email(s, at, email_end)):
                email_end = m[1]
                found.append((m[0], 0, m[1]))
                if wide := _mailbox(s, at, m):
                    found.append((wide[0], 4, wide[1]))
        elif kind == "+":
            if at >= phone_end and (end := _phone(s, at)) > 0:
                phone_end = end
                if 9 <= sum(c in _DIGIT for c in s[at:end]) <= 15:
                    found.append((at, 3, end))
        elif kind == "scheme":
            if at >= address_end and not (at and s[at - 1].isalnum()):
                if run is None or at >= run.end:
                    run = _Run(s, at)
                if (end := _address(s, at, last + 1, run)) > 0:
                    address_end = end
                    found.append((at, 5, end))
        elif at >= account_end and (m := _account(s, at, last + 1)):
            account_end = m[1]
            found.append((m[0], 6, m[1]))
    found.sort()
    return [(KINDS[k], a, b) for a, k, b in found]


def _find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    automaton = _automaton()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for texts in batches:
        yield pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(s.as_py() or "", automaton)]
                        for s in texts], pa.list_(kind))


def find_spans(df: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """``df`` with the array of (kind, start, end) spans of its text."""
    return df.withColumn(out, F.arrow_udf(_find, SPANS)(F.col(text)))


def redact(df: DataFrame, text: str = "text", out: str = "text") -> DataFrame:
    """``df`` with each span of the text replaced by ``<kind>``; overlapping spans become one mark of the first kind."""
    spans_col = free_name(df, "_spans", out)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            done = []
            for s, spans in zip(b.column(text).to_pylist(), b.column(spans_col).to_pylist(), strict=True):
                if s is not None:
                    parts, pos = [], 0
                    for x in spans:
                        if x["start"] >= pos:
                            parts += [s[pos:x["start"]], f"<{x['kind']}>"]
                        pos = max(pos, x["end"])
                    s = "".join([*parts, s[pos:]])
                done.append(s)
            b = b.drop_columns([spans_col])
            names = b.schema.names
            cols = [pa.array(done, pa.string()) if n == out else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(cols + ([] if out in names else [pa.array(done, pa.string())]),
                                             names=names + ([] if out in names else [out]))
    src = find_spans(df, text, spans_col)
    schema = df.schema if out in df.columns else df.withColumn(out, F.lit(None).cast("string")).schema
    return src.mapInArrow(cut, schema)


def digest_columns(spans: Column) -> list[Column]:
    """Counts per base kind, digest of the base spans and the text of all spans."""
    def text(x):
        return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    def of(kind):
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda x: x["kind"].isin(*BASE_KINDS))
    return [*(of(k) for k in BASE_KINDS),
            F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
            F.array_join(F.transform(spans, text), ",").alias("spans")]
