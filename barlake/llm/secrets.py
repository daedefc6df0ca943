"""Secrets by a battery of randomness tests (DataFrame operations only).

Base kinds, leftmost and non-overlapping per kind: assign (a credential word, ``:`` or ``=``, a value of 6 or more
characters), access (``AKIA`` and capitals or digits, 20 or more characters), hex (24 or more lower-case hex digits).
A candidate that is too short is dropped, not retried. Positions are code points: the pieces of a text between the
matches, and the matches, add up to them.

Added kind ``random``: runs of 20 or more characters of the key alphabets whose encoding can be inferred (hex, base
32, 36, 64, url-safe 64 - each with digits and letters). ``=`` ends a run and belongs to it as trailing padding only, so
a name before it is no part of the value. A run that fits no encoding is tested by its parts: those between ``/`` and
``+`` that fit one, the parts of the others between ``-`` and ``_``, and the parts between ``-`` and ``_`` that hold ``/``
or ``+``; of nested spans the outermost stays. The symbols face three tests against a uniform draw:

* chi-squared uniformity over the alphabet (Wilson-Hilferty tail)
* runs of the lower and upper half of the alphabet
* lag-1 serial correlation

The smallest of the three p-values, times three, decides. Benjamini-Hochberg at level ``q`` runs within each encoding
and doubling of length, so short and long candidates are not mixed, and discoveries are candidates that are *not*
random (names, paths, repeated patterns): at most a share ``q`` of those set aside are keys. The others are spans, if
they carry at least ``bits`` bits. The procedure works on counts per (encoding, length, step of ln p), a table whose size is
fixed by the steps; its thresholds, one per encoding and doubling, are all that reaches the driver. Null and empty
texts have no spans."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.graph import saved

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of 24 or more: the same matches as all runs, less those that are too short
SHORTEST = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?"
# encoding: (form of the body, alphabet in order of value); the first that fits
ENCODINGS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": (r"^(?=.*[0-9])(?=.*[A-Za-z])([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base64": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$",
               "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$",
                  "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
FDR, BITS = 0.05, 80
STEP = 0.05  # of ln p; p below e^-40 counts as e^-40


def _matches(text: Column, pattern: str, kind: str, least: int = 0, group: int | None = None) -> Column:
    """Spans (start, kind number, end, item) of the matches, by position."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("item"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), size.alias("value"))
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,item:string>>)")

    def step(a, x):
        begin = a["pos"] + F.length(x["gap"])
        end = begin + F.length(x["item"])
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"),
                        x["item"].alias("item"))
        return F.struct(end.alias("pos"), F.when(F.length(x["value"]) >= least, F.concat(a["got"], F.array(span)))
                        .otherwise(a["got"]).alias("got"))
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("pos"), none.alias("got")), step, lambda a: a["got"])
    return F.when(F.size(found) > 0, walked).otherwise(none)


def _mixed(item: Column) -> Column:
    return (F.length(item) >= SHORTEST) & item.rlike("[0-9]") & item.rlike("[A-Za-z]")


def encoding_of(token: Column) -> Column:
    """Name of the first encoding that the token fits, or null."""
    body = F.regexp_replace(token, r"=+$", "")
    return F.coalesce(*[F.when(body.rlike(form), F.lit(name)) for name, (form, _) in ENCODINGS.items()])


def _parts(span: Column, separator: str) -> Column:
    """Spans of the parts of a span between separators of one character, those long and mixed enough."""
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,item:string>>)")

    def step(a, x):
        end = a["pos"] + F.length(x)
        part = F.struct(a["pos"].alias("start"), span["kind"].alias("kind"), end.alias("end"), x.alias("item"))
        return F.struct((end + 1).alias("pos"), F.when(_mixed(x), F.concat(a["got"], F.array(part)))
                        .otherwise(a["got"]).alias("got"))
    return F.aggregate(F.split(span["item"], separator, -1), F.struct(span["start"].alias("pos"), none.alias("got")), step,
                       lambda a: a["got"])


def candidates_of(run: Column) -> Column:
    """Array of the spans of a run to be tested: itself, or its parts where it fits no encoding."""
    fine = F.flatten(F.transform(_parts(run, "[/+]"), lambda x: F.when(
        encoding_of(x["item"]).isNotNull(), F.array(x)).otherwise(_parts(x, "[-_]"))))
    wide = F.filter(_parts(run, "[-_]"), lambda x: x["item"].rlike("[/+]"))
    return F.when(encoding_of(run["item"]).isNotNull(), F.array(run)).otherwise(F.array_distinct(F.concat(fine, wide)))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, Abramowitz and Stegun 26.2.17."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(tokens: DataFrame, token: str = "item") -> DataFrame:
    """``tokens`` with encoding, n, p_uniform, p_runs, p_serial and p; null where no encoding can be inferred."""
    body = F.regexp_replace(F.col(token), r"=+$", "")
    alphabet = F.coalesce(*[F.when(F.col("encoding") == name, F.lit(a)) for name, (_, a) in ENCODINGS.items()])
    t = tokens.withColumn("_body", body).withColumn("encoding", encoding_of(F.col(token))).withColumn(
        "_alphabet", alphabet)
    folded = F.when(F.col("encoding").isin("hex", "base36"), F.lower("_body")).otherwise(F.col("_body"))
    t = t.withColumn("_body", folded).withColumn("n", F.length("_body")).withColumn("_a", F.length("_alphabet"))
    t = t.withColumn("_v", F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.position(
        F.substr(F.col("_body"), i, F.lit(1)), F.col("_alphabet")).cast("double") - 1))
    n, a = F.col("n").cast("double"), F.col("_a").cast("double")
    squares = F.aggregate(F.sequence(F.lit(0), F.col("_a") - 1), F.lit(0.0), lambda s, k: s + F.pow(
        F.size(F.filter("_v", lambda v: v == k)).cast("double"), F.lit(2.0)))
    total = F.aggregate("_v", F.lit(0.0), lambda s, v: s + v)
    t = t.withColumn("_chi", squares * a / n - n).withColumn("_mean", total / n)
    upper = F.aggregate("_v", F.lit(0.0), lambda s, v: s + (v * 2 >= a).cast("double"))
    pairs = F.zip_with(F.slice("_v", F.lit(1), F.col("n") - 1), F.slice("_v", F.lit(2), F.col("n") - 1),
                       lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    t = t.withColumn("_up", upper).withColumn("_pairs", pairs)
    t = t.withColumn("_runs", 1 + F.aggregate("_pairs", F.lit(0.0), lambda s, p: s + (
        (p["x"] * 2 >= a) != (p["y"] * 2 >= a)).cast("double")))
    m = F.col("_mean")
    t = (t.withColumn("_var", F.aggregate("_v", F.lit(0.0), lambda s, v: s + (v - m) * (v - m)))
         .withColumn("_cov", F.aggregate("_pairs", F.lit(0.0), lambda s, p: s + (p["x"] - m) * (p["y"] - m))))
    df = a - 1
    z = (F.pow(F.greatest(F.col("_chi"), F.lit(1e-9)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    up, down = F.col("_up"), n - F.col("_up")
    mu = 2 * up * down / n + 1
    sd = F.sqrt(F.greatest((mu - 1) * (mu - 2) / (n - 1), F.lit(1e-9)))
    one_side = (up == 0) | (down == 0)
    t = (t.withColumn("p_uniform", _upper_tail(z))
         .withColumn("p_runs", F.when(one_side, F.pow(F.lit(2.0), 1 - n)).otherwise(
             2 * _upper_tail(F.abs((F.col("_runs") - mu) / sd))))
         .withColumn("p_serial", F.when(F.col("_var") > 0, 2 * _upper_tail(F.abs(
             (F.col("_cov") / F.col("_var") + 1 / n) * F.sqrt(n)))).otherwise(F.lit(0.0))))
    t = t.withColumn("p", F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial")))
    return t.drop(*[c for c in t.columns if c.startswith("_") and c not in tokens.columns])


def structured_below(tested: DataFrame, q: float = FDR) -> dict[tuple[str, int], float]:
    """Benjamini-Hochberg threshold of p per (encoding, doubling of length): at or below it a candidate is
    structured. Counts per step of ln p make a table of fixed size; a step counts with its upper end, so the level
    holds."""
    step = F.ceil(F.greatest(F.ln(F.greatest("p", F.lit(1e-300))), F.lit(-40.0)) / STEP)
    counts = tested.groupBy("encoding", "octave", step.alias("step")).agg(F.count(F.lit(1)).alias("k"))
    stratum = Window.partitionBy("encoding", "octave")
    up_to = stratum.orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = F.exp(F.col("step") * STEP)
    passed = (counts.withColumn("m", F.sum("k").over(stratum)).withColumn("r", F.sum("k").over(up_to))
              .where(edge * F.col("m") <= q * F.col("r")))
    return {(r.encoding, r.octave): r.edge for r in
            passed.groupBy("encoding", "octave").agg(F.max(edge).alias("edge")).collect()}


def find_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", q: float = FDR,
                 bits: int = BITS) -> DataFrame:
    """(doc_id, spans) per row; a span is (start, kind number, end, item), by start and kind."""
    body = F.coalesce(F.col(text), F.lit(""))
    low = F.lower(body)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    none = F.expr("CAST(array() AS array<struct<start:int,kind:int,end:int,item:string>>)")
    rows = saved(df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(doc_id).alias("doc_id"),
        F.concat(F.when(named, _matches(body, ASSIGN, "assign", 6, 1)).otherwise(none),
                 F.when(body.contains("AKIA"), _matches(body, ACCESS, "access", 20)).otherwise(none),
                 _matches(body, HEX, "hex")).alias("base"),
        F.filter(_matches(body, CANDIDATE, "random"), lambda x: _mixed(x["item"])).alias("candidates")))
    runs = rows.select("_row", F.explode("candidates").alias("run"))
    spans = runs.select("_row", F.col("run.start").alias("at"), F.explode(candidates_of(F.col("run"))).alias("c"))
    tested = battery(spans.select("_row", "at", "c", "c.item")).where(
        "encoding IS NOT NULL").withColumn("octave", F.floor(F.log2("n")).cast("int"))
    tested = saved(tested.select("_row", "at", "c", "encoding", "octave", "n", "p"))
    below = structured_below(tested, q)
    cut = F.coalesce(*[F.when((F.col("encoding") == e) & (F.col("octave") == o), F.lit(p))
                       for (e, o), p in sorted(below.items())], F.lit(0.0))
    info = F.coalesce(*[F.when(F.col("encoding") == e, F.col("n") * F.log2(F.lit(float(len(a)))))
                        for e, (_, a) in ENCODINGS.items()])
    outermost = F.filter("all", lambda x: ~F.exists("all", lambda y: (y["start"] <= x["start"]) & (y["end"] >= x["end"])
                                                    & (F.length(y["item"]) > F.length(x["item"]))))
    found = (tested.where((F.col("p") > cut) & (info >= bits)).groupBy("_row", "at").agg(F.collect_list("c").alias("all"))
             .select("_row", outermost.alias("c")).groupBy("_row").agg(F.flatten(F.collect_list("c")).alias("random")))
    return rows.join(found, "_row", "left").select("doc_id", F.array_sort(
        F.concat("base", F.coalesce("random", none))).alias("spans"))


def digest_columns(spans: Column) -> list[Column]:
    """Counts per base kind, digest of the base spans and the text of all spans."""
    def text(x):
        return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"].cast("string"),
                           x["end"].cast("string"))
    def count(kind):
        return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda x: x["kind"] < len(BASE_KINDS))
    return [*map(count, BASE_KINDS),
            F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
            F.array_join(F.transform(spans, text), ",").alias("spans")]
