"""Secret scans: known shapes, and a battery of randomness tests.

Known shapes (``assign``, ``access``, ``hex``) are regular expressions.  The
battery judges every other run of 20 or more code characters that has a
letter.  The smallest alphabet that holds a run is its inferred
encoding.  If a run really is random in that encoding, these statistics have
known distributions: chi-squared of symbol counts against a uniform
alphabet (by symbol, and by digits, capitals, small letters and marks), the number of runs above and below the alphabet's middle, and the
correlation of neighbouring symbols.  Runs of small letters or of capitals
alone have one class of symbols; there the sum of the letters' weights, which
are higher for letters common in prose, takes the place of the classes.  Their p-values combine by Bonferroni.

A corpus has very many runs, so a fixed limit would either drop true secrets
or pass text.  Runs are put into families by encoding and length (powers of
two: short runs have little power, so they are ranked among each other), and in
each family the Benjamini-Hochberg rule rejects randomness with the false
discovery rate ``fdr``: of the runs called text, at most that share were
random.  Where text prevails that rule alone would reject nearly every p up to
``fdr``, so a second bound holds in every family: p above ``lost`` is never
rejected, and of the random runs no more than about that share is lost.  What
is not rejected is reported as ``random``.  Copies of a run count once.
p-values are rounded up to a tenth of a decade, so the corpus enters the rule
as a histogram of bounded size.

Everything is DataFrame expressions.  Positions are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, whole_text

ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+=*"  # may follow "=": NAME=<run>
KINDS = ("assign", "access", "hex", "random")

DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: name, alphabet; the smallest that holds a run is its encoding
ENCODINGS = (("hex", DIGITS + "abcdef"), ("HEX", DIGITS + "ABCDEF"), ("base32", UPPER + "234567"),
             ("base36", DIGITS + LOWER), ("BASE36", DIGITS + UPPER), ("base62", UPPER + LOWER + DIGITS),
             ("base64", UPPER + LOWER + DIGITS + "+/"), ("base64url", UPPER + LOWER + DIGITS + "-_"),
             ("mixed", UPPER + LOWER + DIGITS + "+/-_"))
CLASSES = (DIGITS, UPPER, LOWER, "+/-_")
#: encodings of runs of letters alone, numbered after ENCODINGS
LETTERS = (("lower", LOWER), ("UPPER", UPPER), ("letters", UPPER + LOWER))
# Percent of a to z in prose, the mean of English, German, French and Spanish.
PROSE = (8.5, 1.6, 3.2, 4.5, 14.0, 1.4, 1.9, 3.0, 6.8, 0.4, 0.6, 4.5, 2.8, 7.6, 6.2, 1.9, 0.6, 6.7, 7.4, 6.8, 4.1, 1.2, 1.1, 0.2, 0.8, 0.5)
LAST_BIN = 300
BODY = "whole_text_searched"
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, merge) -> Column:
    """values[0], merge(values[0], values[1]) and so on: sums or maxima up to every place (not negative numbers).

    Arrays grow by copying, so the places of a block of 256 are run through on
    their own, and each block's is merged with what the blocks before come to:
    the work grows with the length.
    """
    def inside(block: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct(
            merge(acc["at"], x).alias("at"), F.array_append(acc["out"], merge(acc["at"], x)).alias("out")), lambda acc: acc["out"])

    def joined(parts: Column) -> Column:
        before = inside(F.transform(parts, lambda part: F.coalesce(F.get(part, F.size(part) - 1), F.lit(0))))
        return let(before, lambda ends: F.flatten(F.transform(parts, lambda part, k: F.transform(
            part, lambda x: merge(F.coalesce(F.get(ends, k - 1), F.lit(0)), x)))))
    return let(values, lambda v: let(F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size(v) - 1, F.lit(0)) / 256).cast("int")),
        lambda k: inside(F.slice(v, k * 256 + 1, F.lit(256)))), joined))


def added(a: Column, b: Column) -> Column:
    return a + b


def count_below(n: Column, below) -> Column:
    """How many of 0..n-1 fulfil ``below``, which holds up to some place and not beyond it (binary search)."""
    first = F.struct(F.lit(0).alias("lo"), n.cast("int").alias("hi"))

    def narrow(acc: Column, _: Column) -> Column:
        return let(F.floor((acc["lo"] + acc["hi"]) / 2).cast("int"), lambda mid: F.when(acc["lo"] >= acc["hi"], acc).when(
            below(mid), F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), first, narrow, lambda acc: acc["lo"])


def located(pattern: str, kind: int, text: str, group: int = 0, least: int = 0) -> tuple[Column, Column]:
    """Matches, and (from the matches in a column ``found``) the spans of those whose group has ``least`` characters or more.

    Matches are leftmost and don't overlap.
    Texts without a match are read once; others are also split at the
    matches, and the lengths of pieces and matches add up to positions.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    whole = F.struct(F.col("found").alias("found"), F.split(text, pattern).alias("pieces"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("captured"))

    def spans(m: Column) -> Column:
        lengths = F.transform(m["found"], lambda f, i: F.char_length(F.get(m["pieces"], i)) + F.char_length(f))
        return let(running(lengths, added), lambda ends: F.filter(F.transform(m["found"], lambda f, i: F.struct(
            (F.get(ends, i) - F.char_length(f)).alias("start"), F.lit(kind).alias("kind"), F.get(ends, i).alias("end"),
            F.get(m["captured"], i).alias("value"))), lambda s: F.char_length(s["value"]) >= least))
    return matches, let(whole, spans)


def without_overlap(runs: Column, base: Column) -> Column:
    """The runs that no span of ``base`` (ordered by start) overlaps.

    Of the spans that start before a run's end, the largest end decides.
    """
    def kept(pair: Column) -> Column:
        return F.filter(pair["runs"], lambda r: let(
            count_below(F.size(pair["base"]), lambda k: F.get(pair["base"], k)["start"] < r["end"]),
            lambda n: (n == 0) | (F.get(pair["ends"], n - 1) <= r["start"])))
    ends = running(F.transform(base, lambda b: b["end"]), F.greatest)
    return F.when((F.size(runs) > 0) & (F.size(base) > 0), let(F.struct(runs.alias("runs"), base.alias("base"), ends.alias("ends")), kept)).otherwise(runs)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal (rational approximation, error below 1e-7)."""
    # Coefficients of the published approximation, from the first power on.
    coefficients = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * F.abs(z))
    poly = F.lit(0.0)
    for c in reversed(coefficients):
        poly = (poly + F.lit(c)) * t
    tail = poly * F.exp(-z * z / 2) * F.lit(0.3989422804014327)
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def battery(run: Column) -> Column:
    """struct(encoding, n, p): the inferred encoding's place, the length, and the combined p-value of one run."""
    body = F.regexp_replace(run, "=+$", "")
    known = ENCODINGS + LETTERS
    sizes = F.array(*[F.lit(len(a)) for _, a in known])
    alphabets = F.array(*[F.lit(a) for _, a in known])
    smallest = sorted(enumerate(known), key=lambda e: len(e[1][1]))
    encoding = F.coalesce(*[F.when(F.translate(body, a, "") == "", F.lit(k)) for k, (_, a) in smallest],
                          F.lit(len(ENCODINGS) - 1))
    roots = [math.sqrt(v) for v in PROSE]
    middle = sum(roots) / len(roots)
    spread = math.sqrt(sum((v - middle) ** 2 for v in roots) / len(roots))
    weights = F.array(*[F.lit((v - middle) / spread) for v in roots])

    def with_codes(x: Column) -> Column:
        codes = F.transform(F.split(x["body"], ""), lambda c: F.instr(x["alphabet"], c).cast("double"))
        return F.struct(x["encoding"].alias("encoding"), x["k"].alias("k"), x["body"].alias("body"),
                        x["alphabet"].alias("alphabet"), F.filter(codes, lambda c: c > 0).alias("codes"))

    def with_sums(x: Column) -> Column:
        codes, k = x["codes"], x["k"].cast("double")
        n = F.size(codes).cast("double")
        length = F.char_length(x["body"])
        squares = F.aggregate(F.split(x["alphabet"], ""), F.lit(0.0), lambda acc, c: acc + F.pow(
            (length - F.char_length(F.replace(x["body"], c, F.lit("")))).cast("double"), F.lit(2.0)))
        high = F.size(F.filter(codes, lambda c: c > k / 2)).cast("double")
        held = lambda word, marks: (F.char_length(word) - F.char_length(F.translate(word, marks, ""))).cast("double")
        classes = F.filter(F.array(*[F.struct(held(x["alphabet"], c).alias("size"), held(x["body"], c).alias("count"))
                                     for c in CLASSES]), lambda c: c["size"] > 0)
        total = F.aggregate(codes, F.lit(0.0), lambda acc, c: acc + c)
        pairs = F.zip_with(F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))), F.slice(codes, F.lit(2), F.size(codes)),
                           lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        return F.struct(x["encoding"].alias("encoding"), k.alias("k"), n.alias("n"), squares.alias("squares"),
                        high.alias("high"), (total / n).alias("mean"), codes.alias("codes"), pairs.alias("pairs"),
                        classes.alias("classes"))

    def upper_z(chi: Column, free: Column) -> Column:
        """Normal deviate of a chi-squared value (cube root)."""
        spread = F.lit(2.0) / (F.lit(9.0) * free)
        return (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1.0 / 3)) - (F.lit(1.0) - spread)) / F.sqrt(spread)

    def with_z(x: Column) -> Column:
        k, n = x["k"], x["n"]
        z_chi = upper_z(k / n * x["squares"] - n, k - 1)
        by_class = F.aggregate(x["classes"], F.lit(0.0), lambda acc, c: acc + c["count"] * c["count"] * k / (n * c["size"])) - n
        z_class = upper_z(by_class, F.greatest(F.size(x["classes"]).cast("double") - 1, F.lit(1.0)))
        z_prose = F.aggregate(x["codes"], F.lit(0.0), lambda acc, c: acc + F.coalesce(F.get(weights, c.cast("int") - 1), F.lit(0.0))) / F.sqrt(n)
        z_class = F.when(F.size(x["classes"]) > 1, z_class).otherwise(z_prose)
        runs = F.lit(1.0) + F.size(F.filter(x["pairs"], lambda p: (p["a"] > k / 2) != (p["b"] > k / 2)))
        mean = F.lit(2.0) * x["high"] * (n - x["high"]) / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        z_runs = F.when(variance > 0, (runs - mean) / F.sqrt(variance)).otherwise(F.lit(-40.0))
        around = F.aggregate(x["codes"], F.lit(0.0), lambda acc, c: acc + F.pow(c - x["mean"], F.lit(2.0)))
        lagged = F.aggregate(x["pairs"], F.lit(0.0), lambda acc, p: acc + (p["a"] - x["mean"]) * (p["b"] - x["mean"]))
        z_serial = F.when(around > 0, (lagged / around + F.lit(1.0) / n) * F.sqrt(n)).otherwise(F.lit(40.0))
        least = F.least(normal_tail(z_chi), normal_tail(z_class), normal_tail(F.abs(z_runs)) * 2, normal_tail(F.abs(z_serial)) * 2)
        return F.struct(x["encoding"].alias("encoding"), n.cast("int").alias("n"),
                        F.least(F.lit(1.0), least * 4).alias("p"))

    first = let(encoding, lambda e: F.struct(e.alias("encoding"), body.alias("body"), F.get(alphabets, e).alias("alphabet"),
                                             F.get(sizes, e).alias("k")))
    return let(let(let(first, with_codes), with_sums), with_z)


def family(encoding: Column, n: Column) -> Column:
    """Number of the family of an encoding and a length."""
    return encoding * 64 + F.floor(F.log2(n.cast("double"))).cast("int")


def p_bin(p: Column) -> Column:
    """Tenths of a decade below 1, at most ``LAST_BIN``; 10 ** (-bin / 10) is p or more."""
    return F.when(p > 0, F.least(F.floor(F.log10(p) * -10), F.lit(LAST_BIN))).otherwise(F.lit(LAST_BIN)).cast("int")


def rejected_from(histogram: dict[int, dict[int, int]], fdr: float, lost: float = 0.01) -> dict[int, int]:
    """For each family the least bin whose runs are rejected as not random (Benjamini-Hochberg, and p at most ``lost``)."""
    out, bound = {}, math.ceil(-10 * math.log10(lost) - 1e-9)
    for name, bins in histogram.items():
        total, below, least = sum(bins.values()), 0, LAST_BIN + 1
        for b in sorted(bins, reverse=True):
            below += bins[b]
            if 10 ** (-b / 10) <= fdr * below / total:
                least = b
        out[name] = max(least, bound)
    return out


def scan_spans(df: DataFrame, fdr: float = 0.05, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
               lost: float = 0.01) -> DataFrame:
    """``keep`` columns, ``base`` and ``spans`` of every row: arrays of (start, kind, end), ordered by start and kind.

    ``kind`` counts in ``KINDS``; ends are exclusive.  ``base`` has the known
    shapes, ``spans`` also the runs that the battery can't tell from random,
    unless a known shape overlaps them.  A null or empty text has none,
    repeated rows repeat (but their runs count once in the histogram), an empty
    table gives none.  Kept columns may have any names but the two of the
    result; ``scan_rows`` takes those too.
    """
    return scan_rows(df, fdr, text_col, keep, lost).select("row.*", "base", "spans")


def scan_rows(df: DataFrame, fdr: float = 0.05, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
              lost: float = 0.01) -> DataFrame:
    """``scan_spans`` with the kept columns in one struct ``row``, where no name can clash."""
    text = df.select(F.struct(*[df[c] for c in keep]).alias("row"), whole_text(df[text_col]).alias(BODY))
    gates = ((ASSIGN, 0, 1, 12, F.col(BODY).contains("=") | F.col(BODY).contains(":")),
             (ACCESS, 1, 0, 0, F.col(BODY).contains("AKIA")), (HEX, 2, 0, 0, F.lit(True)), (RUN, 3, 0, 0, F.lit(True)))
    none = F.expr(f"CAST(array() AS {SPAN})")
    for pattern, kind, group, least, gate in gates:
        matches, spans = located(pattern, kind, BODY, group, least)
        # only texts that can match are searched, only texts that do are taken apart
        text = text.withColumn("found", F.when(gate, matches))
        text = text.withColumn(f"k{kind}", F.when(F.size("found") > 0, spans).otherwise(none)).drop("found")
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.array_sort(F.transform(F.concat("k0", "k1", "k2"), plain))
    text = text.select("row", base.alias("base"), F.filter("k3", lambda s: s["value"].rlike("[A-Za-z]")).alias("runs"))
    tested = F.transform(without_overlap(F.col("runs"), F.col("base")), lambda r: let(battery(r["value"]), lambda t: F.struct(
        r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end"),
        family(t["encoding"], t["n"]).alias("family"), p_bin(t["p"]).alias("bin"),
        F.xxhash64(F.regexp_replace(r["value"], "=+$", "")).alias("key"))))
    rows = stored(text.select("row", "base", tested.alias("runs")), "secret-spans")

    histogram: dict[int, dict[int, int]] = {}
    for r in rows.select(F.inline("runs")).groupBy("family", "bin").agg(F.countDistinct("key").alias("n")).collect():
        histogram.setdefault(r.family, {})[r.bin] = r.n  # families x bins: bounded
    limits = rejected_from(histogram, fdr, lost)
    if limits:
        table = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        random = F.filter("runs", lambda r: r["bin"] < F.element_at(table, r["family"]))
    else:
        random = F.col("runs")
    return rows.select("row", "base", F.array_sort(F.concat("base", F.transform(random, plain))).alias("spans"))


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]", part: int = 4096) -> Column:
    """The text with every span (they may overlap) replaced by a mark; ``spans`` are ordered by start.

    Done in parts of the text, each with the spans that reach into it, so the
    work grows with the text.
    """
    def of_part(x: Column, piece: Column, number: Column) -> Column:
        left = number * part
        first = count_below(F.size(x["ends"]), lambda k: F.get(x["ends"], k) <= left)
        after = count_below(F.size(x["spans"]), lambda k: F.get(x["spans"], k)["start"] < left + F.char_length(piece))
        start = F.struct(left.cast("int").alias("at"), F.lit("").alias("out"))
        here = F.slice(x["spans"], (first + 1).cast("int"), F.greatest(after - first, F.lit(0)).cast("int"))
        return F.aggregate(here, start, lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(piece, acc["at"] - left + 1, s["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out")),
            lambda acc: F.concat(acc["out"], F.when(acc["at"] < left + F.char_length(piece), F.substr(piece, acc["at"] - left + 1)).otherwise("")))

    def done(x: Column) -> Column:
        return F.array_join(F.transform(x["pieces"], lambda piece, number: of_part(x, piece, number)), "")

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{part}}}"), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return F.when(F.size(spans) > 0, let(F.struct(pieces.alias("pieces"), spans.alias("spans"), ends.alias("ends")), done)).otherwise(text)
