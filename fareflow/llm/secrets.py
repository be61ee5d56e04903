"""Secret scan with a randomness test battery (operator 5, built-in functions only).

Three fixed kinds of span are found by pattern: assignments to a secret-like
name, access keys, and long lower-case hexadecimal strings.  Further
candidates are long runs of encoding characters that hold a digit or letters
of both cases.  For each
candidate the encoding is inferred from its characters, and three statistics
are computed under the hypothesis that it is random text of that encoding:
a chi-squared statistic of alphabet uniformity, the number of runs above and
below the middle of the alphabet, and the lag-one serial correlation.  The
smallest of the three p-values, times three, is the candidate's p-value.

Structured strings (identifiers, slugs, serial names) are cleared by the
Benjamini-Hochberg step-up rule at level ``FDR``, within strata of equal
length class (with and without digits apart), because short strings give weak evidence and must not be judged
by the threshold that long ones allow.  Candidates that are not cleared are
reported as ``random`` spans, unless they overlap a span found by pattern.

The rule needs only counts of p-values per length class.  They are binned on
a logarithmic grid (the upper end of the bin counts), so the counts of any
corpus fit a few thousand rows, and the thresholds are one number per class.

Everything per document happens in its own row: nothing but those counts is
shuffled, and a source or copy group of any size is split like any input.

Defined cases: a null text is an empty one and has no spans; repeated rows
are scanned each on its own; an empty table gives an empty table.  Very long
texts are scanned whole.  Other columns pass through; helper columns take
names that the table does not have.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, let

# Fixed patterns of the three kinds, and the shortest accepted lengths.
ASSIGN_NAME = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN_VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN_LENGTH = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

# Candidates of the test battery: whole runs of encoding characters.
RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE_LENGTH = 20
CANDIDATE = f"(?<!{RUN}){RUN}{{{CANDIDATE_LENGTH},}}+"

# Significance: share of structured strings among those cleared, at most.
FDR = 0.05
# Bins of -log10(p): 1/BINS each, up to MAX_LOG.
BINS, MAX_LOG = 50, 40
# Added to the stratum of candidates without a digit: compound words and
# identifiers are common among them, so they have thresholds of their own.
DIGIT_FREE = 1000

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the narrowest to the widest: pattern and alphabet.
ENCODINGS = (
    ("^[0-9]+$", _DIGITS),
    ("^[0-9a-f]+$", _DIGITS + _LOWER[:6]),
    ("^[0-9A-F]+$", _DIGITS + _UPPER[:6]),
    ("^[A-Z2-7]+$", _UPPER + "234567"),
    ("^[a-z0-9]+$", _DIGITS + _LOWER),
    ("^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", _LOWER + _UPPER),
    ("^[A-Za-z0-9]+$", _DIGITS + _LOWER + _UPPER),
    ("^[A-Za-z0-9+/]+$", _DIGITS + _LOWER + _UPPER + "+/"),
    ("^[A-Za-z0-9_-]+$", _DIGITS + _LOWER + _UPPER + "_-"),
    ("", _DIGITS + _LOWER + _UPPER + "+/_-="),
)

_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _located(text: Column, pattern: str, kind: int, keep) -> Column:
    """Accepted matches of a pattern with their offsets in code points.

    The matches and the gaps between them alternate, so offsets are running
    sums of their lengths.  Texts without a match take neither step.
    """
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(hits)).alias("gap"))
    none = F.struct(F.lit(0).alias("pos"), F.array().cast(_SPANS).alias("out"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["1"])
        end = start + F.length(x["0"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["0"].alias("value"))
        return F.struct(end.alias("pos"), F.when(keep(x["0"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    pairs = F.transform(pairs, lambda x: F.struct(x["hit"].alias("0"), x["gap"].alias("1")))
    return F.when(text.rlike(pattern), F.aggregate(pairs, none, step, lambda acc: acc["out"])).otherwise(
        F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start and then kind."""
    def long_value(hit):
        return F.length(F.regexp_extract(hit, f"^{ASSIGN_NAME}({ASSIGN_VALUE})", 1)) >= ASSIGN_LENGTH
    always = lambda hit: F.lit(True)
    return F.array_sort(F.concat(
        _located(text, ASSIGN_NAME + ASSIGN_VALUE, 0, long_value),
        _located(text, ACCESS, 1, always),
        _located(text, HEX, 2, always)))


def candidate_spans(text: Column) -> Column:
    """Runs of encoding characters that an encoder could have made, before any test.

    They hold a digit, or letters of both cases; runs of one case without a
    digit are words, and separators are no text of any encoding.
    """
    return _located(text, CANDIDATE, 3, lambda hit: hit.rlike("[0-9]") | (hit.rlike("[a-z]") & hit.rlike("[A-Z]")))


def normal_tail(z: Column) -> Column:
    """Upper tail of the standard normal (a rational approximation, error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(value: Column) -> Column:
    """Statistics and p-values of one candidate, as a struct.

    Trailing padding is not tested.  ``p`` is the combined p-value: small for
    strings that random text of the inferred encoding would rarely give.
    """
    def encoding(body):
        alphabet = F.lit(ENCODINGS[-1][1])
        for pattern, chars in reversed(ENCODINGS[:-1]):
            alphabet = F.when(body.rlike(pattern), F.lit(chars)).otherwise(alphabet)
        return F.struct(body.alias("body"), alphabet.alias("alphabet"))

    def coded(e):
        codes = F.transform(F.filter(F.split(e["body"], ""), lambda c: c != ""),
                            lambda c: (F.instr(e["alphabet"], c) - 1).cast("double"))
        return F.struct(codes.alias("codes"), F.length(e["alphabet"]).cast("double").alias("k"))

    def tests(s):
        codes, k = s["codes"], s["k"]
        n = F.size(codes).cast("double")
        zero = F.lit(0.0)
        start = F.struct(F.lit(-1.0).alias("last"), zero.alias("high"), zero.alias("runs"),
                         zero.alias("x"), zero.alias("xx"), zero.alias("xy"))

        def step(a, c):
            up = c >= k / 2
            new = (a["last"] < 0) | ((a["last"] >= k / 2) != up)
            return F.struct(c.alias("last"), (a["high"] + F.when(up, 1.0).otherwise(0.0)).alias("high"),
                            (a["runs"] + F.when(new, 1.0).otherwise(0.0)).alias("runs"),
                            (a["x"] + c).alias("x"), (a["xx"] + c * c).alias("xx"),
                            (a["xy"] + F.when(a["last"] >= 0, a["last"] * c).otherwise(0.0)).alias("xy"))
        sums = F.aggregate(codes, start, step)
        squares = F.aggregate(F.array_distinct(codes), zero, lambda acc, c: acc + F.pow(
            F.size(F.filter(codes, lambda x: x == c)).cast("double"), F.lit(2.0)))
        return F.struct(n.alias("n"), k.alias("k"), sums.alias("s"), squares.alias("sq"),
                        F.element_at(codes, 1).alias("head"))

    def values(t):
        n, k, s = t["n"], t["k"], t["s"]
        chi = k / n * t["sq"] - n
        chi_z = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        chi_p = normal_tail(chi_z)
        high, low = s["high"], n - s["high"]
        mean = 1 + 2 * high * low / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs_p = F.when(var > 0, 2 * normal_tail(F.abs(s["runs"] - mean) / F.sqrt(var))).otherwise(F.lit(1e-30))
        avg = s["x"] / n
        spread = s["xx"] - n * avg * avg
        cross = s["xy"] - avg * (s["x"] - t["head"]) - avg * (s["x"] - s["last"]) + (n - 1) * avg * avg
        serial = F.when(spread > 0, cross / spread)
        serial_p = F.coalesce(2 * normal_tail(F.abs(serial + 1 / n) * F.sqrt(n)), F.lit(1e-30))
        p = F.least(F.lit(1.0), 3 * F.least(chi_p, runs_p, serial_p))
        return F.struct(chi_z.alias("chi_z"), s["runs"].alias("runs"), serial.alias("serial"), p.alias("p"))

    return let(F.regexp_replace(value, "=+$", ""), lambda body: let(encoding(body), lambda e: let(
        coded(e), lambda c: let(tests(c), values))))


def length_class(value: Column) -> Column:
    """Stratum of a candidate: half octaves of its length, apart for those without a digit."""
    octaves = F.floor(2 * F.log2(F.length(value).cast("double"))).cast("int")
    return F.when(value.rlike("[0-9]"), octaves).otherwise(octaves + DIGIT_FREE)


def p_bin(p: Column) -> Column:
    """Number of the logarithmic bin; larger numbers are smaller p-values."""
    return F.floor(F.least(F.lit(float(MAX_LOG)), -F.log10(F.greatest(p, F.lit(10.0 ** -MAX_LOG)))) * BINS).cast("int")


def thresholds(docs: DataFrame, text: str = "text", fdr: float = FDR) -> dict[int, int]:
    """Per length class, the least bin that the step-up rule clears.

    Only the thresholds, one per class of lengths (at most about 120), reach
    the driver.
    """
    tested = docs.where(F.col(text).rlike(CANDIDATE)).select(
        F.explode(candidate_spans(F.col(text))).alias("c")).select(
        length_class(F.col("c.value")).alias("stratum"), p_bin(battery(F.col("c.value"))["p"]).alias("bin"))
    counts = tested.groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("stratum").agg(F.sum("n").alias("m"))
    # At most BINS * MAX_LOG rows in a class, whatever the corpus.
    ranked = counts.join(totals, "stratum").withColumn(
        "rank", F.sum("n").over(Window.partitionBy("stratum").orderBy(F.desc("bin"))))
    largest = F.pow(F.lit(10.0), -F.col("bin") / F.lit(float(BINS)))
    passed = ranked.where(largest <= F.lit(fdr) * F.col("rank") / F.col("m"))
    return {r["stratum"]: r["bin"] for r in passed.groupBy("stratum").agg(F.min("bin").alias("bin")).collect()}


def scan(docs: DataFrame, text: str = "text", fdr: float = FDR, spans: str = "secret_spans") -> DataFrame:
    """Add ``spans``: all spans (start, kind, end, value), by start and kind.

    ``kind`` is a position in ``KINDS``.  A column of that name is replaced,
    all others pass through.
    """
    source = docs.withColumn(text, F.coalesce(F.col(text).cast("string"), F.lit("")))
    cleared = thresholds(source, text, fdr)

    def keep(c, base):
        least = F.lit(1 << 30)
        for s, b in cleared.items():
            least = F.when(length_class(c["value"]) == s, F.lit(b)).otherwise(least)
        apart = ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        return apart & (p_bin(battery(c["value"])["p"]) < least)

    base, runs = free_name(source, "_base"), free_name(source, "_runs")
    found = source.withColumn(base, base_spans(F.col(text))).withColumn(runs, candidate_spans(F.col(text)))
    more = F.when(F.size(runs) > 0, F.filter(runs, lambda c: keep(c, F.col(base)))).otherwise(F.col(runs))
    return found.withColumn(spans, F.array_sort(F.concat(base, more))).drop(base, runs)


def described(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat(
        kind(s), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def report(scanned: DataFrame) -> DataFrame:
    spans = F.col("secret_spans")
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(described(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        described(spans).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans become one mark."""
    none = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"])
        apart = s["start"] >= acc["pos"]
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(apart, F.concat(acc["out"], F.array(F.concat(gap, F.lit(mark))))).otherwise(acc["out"]).alias("out"))

    def finish(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, none, step, finish)).otherwise(text)
