"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` together with literal
tokens that each matching URL must contain: site rules, words, and patterns with
wildcards and anchors.  The tokens of all rules are
counted over all URLs, and each rule is filed under its rarest one.  A URL's
tokens fetch the rules filed under them, and only those run their
regular expression, once for each distinct URL.  Rules, tokens and index are
tables that are joined, so their number does not enter the plan; a list of rules
of known size is broadcast, so no common token gathers its URLs in one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .common import ascii_lower

SEPARATORS = "[^a-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is matched against host + path; ``tokens`` are in every URL that it matches.

    ``rank`` 1 goes before 0 (site rules before patterns), then the longer
    name wins, then block.  A rule without tokens is tried on every URL.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...] = field(default=())
    rank: int = 0


def site_rule(name: str, verdict: str) -> UrlRule:
    """A rule like ``example.net/en/``: that host and its subdomains, paths that start so."""
    host, slash, path = name.partition("/")
    path = slash + path
    whole = path if not path or re.search("[^a-zA-Z0-9]$", path) else re.sub("[a-zA-Z0-9]+$", "", path)
    tokens = tuple(sorted({t for t in re.split(SEPARATORS, f"{host}/{whole}".lower()) if t}))
    quote = lambda s: re.sub(r"([^A-Za-z0-9/_])", r"\\\1", s)
    return UrlRule(name, verdict, rf"^([^/]*\.)?{quote(host)}{quote(path)}", tokens, 1)


def word_rule(words: str, verdict: str = "block") -> UrlRule:
    """A rule for words that stand in the host or path as whole tokens in a row."""
    parts = words.split("-")
    return UrlRule(words, verdict, rf"(?i)(^|[^a-z0-9]){'-'.join(parts)}($|[^a-z0-9])", tuple(sorted(set(parts))))


def pattern_rule(glob: str, verdict: str = "block") -> UrlRule:
    """A rule with wildcards: ``*`` stands for any characters, ``|`` at either end for that end of host and path.

    Other characters stand for themselves, letters in either case.  Its tokens
    are the letter and digit runs that are whole tokens in every match: bounded
    by other characters or an anchor, not by a wildcard or a loose end.
    """
    body = glob.strip("|")
    start, end = "^" if glob.startswith("|") else "", r"\z" if glob.endswith("|") else ""
    quote = lambda x: re.sub(r"([^A-Za-z0-9/_])", r"\\\1", x)
    pattern = f"(?is){start}{'.*'.join(map(quote, body.split('*')))}{end}"
    bounded = ("." if start else "a") + body.replace("*", "a*a") + ("." if end else "a")
    parts = re.split(SEPARATORS, bounded.lower())
    whole = [t for k, t in enumerate(parts) if t and 0 < k < len(parts) - 1 and "*" not in t]
    loose = {t for piece in re.split(r"\*", bounded.lower()) for t in (re.split(SEPARATORS, piece)[0], re.split(SEPARATORS, piece)[-1])}
    return UrlRule(glob, verdict, pattern, tuple(sorted(set(whole) - loose)))


SITE_RULES = (site_rule("net/", "block"), site_rule("example.net/en/", "allow"),
              site_rule("example.com/de/", "block"), site_rule("org/fr/", "allow"))
WORD_RULES = tuple(word_rule(w) for w in (
    "adult", "bets", "betting", "casino", "cheap-pills", "escort", "free-bets", "jackpot", "payday-loans", "poker",
    "porn", "slots", "torrent", "viagra", "warez", "xxx"))

PATTERN_RULES = tuple(pattern_rule(g) for g in (
    "|ads.*/banner/", "|blog.*-x.example.org/*.html|", "/cgi-bin/*.pl|", "/feed/*/rss.xml|", "/print/*.html|", "/tag/*/feed/",
    "|www.*.example.*/es/*.html|"))
#: rules are broadcast up to this many bytes of names, patterns and tokens
BROADCAST_BYTES = 64 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_index(urls: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """(token, name, verdict, pattern, rank): every rule under the token of it that the fewest ``urls`` (tokens) have.

    Of equally rare tokens the first in the alphabet; a rule without tokens is under the empty one.
    """
    spark = urls.sparkSession
    shape = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "verdict", "pattern")]
                         + [T.StructField("rank", T.IntegerType()), T.StructField("literals", T.ArrayType(T.StringType()))])
    table = sized(spark.createDataFrame([(r.name, r.verdict, r.pattern, r.rank, list(r.tokens)) for r in rules], shape), rules)
    literals = table.select(F.explode("literals").alias("token")).distinct()
    counts = (urls.select(F.explode("tokens").alias("token")).join(sized(literals, rules), "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    filed = (table.select("name", "verdict", "pattern", "rank", F.explode_outer("literals").alias("token"))
             .join(counts, "token", "left")
             .groupBy("name", "verdict", "pattern", "rank")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token"))).alias("rarest")))
    return filed.select("rarest.token", "name", "verdict", "pattern", "rank")


def sized(table: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """A table of at most all rules and tokens: broadcast if that list is small enough, else left to Spark."""
    size = sum(len(r.name) + len(r.pattern) + sum(map(len, r.tokens)) + 64 for r in rules) * 4
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def judge_urls(df: DataFrame, rules: Sequence[UrlRule] = SITE_RULES + WORD_RULES + PATTERN_RULES, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, rank, verdict) of every row; rule and rank are null where none matches.

    A null URL, and one without ``://``, has an empty host and path and gets
    the default verdict.  Repeated rows repeat, an empty table gives none.
    """
    urls = (df.where(F.col(url_col).contains("://")).groupBy(F.col(url_col).alias("address")).agg(F.count(F.lit(1)).alias("n"))
            .select("address", F.concat(host_of(F.col("address")), path_of(F.col("address"))).alias("place"))
            # A-Z alone are folded, as the expressions fold
            .withColumn("tokens", F.array_distinct(F.split(ascii_lower(F.col("place")), SEPARATORS))))
    index = rule_index(urls, rules)
    # the empty token fetches the rules that have none
    keyed = urls.select("address", "place", F.explode(F.array_union("tokens", F.array(F.lit("")))).alias("token"))
    best = F.max(F.struct("rank", F.char_length("name").alias("size"), (F.col("verdict") == "block").alias("blocks"),
                          "name", "verdict")).alias("best")
    matched = (keyed.join(sized(index, rules), "token").where(F.expr("place RLIKE pattern"))
               .groupBy("address").agg(best))
    return (df.select(F.col(id_col), F.col(url_col).alias("url")).join(matched, F.col("url") == F.col("address"), "left")
            .select(id_col, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                    F.col("best.name").alias("rule"), F.col("best.rank").alias("rank"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
