"""Rule bitmask ledger: measure once, store failure bits, apply versioned policies.

Every rule is evaluated once for each document.  The ledger keeps the
measurements and one bit for each failed rule, so that a policy (a version
name and the set of rules it applies) is one bitwise AND, a new policy needs
no new pass over the texts, and ablations (how many documents only this
rule rejects, how many a policy without it would keep) are bitwise
aggregates over the ledger.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bpe import ROWS
from .common import ship_code

# What counts as a symbol.
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper_words",
            "n_marked_words")


def measure_text(text: str) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one whole text."""
    data = text.encode()
    words = data.split()  # ASCII white space, which is what separates words here
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    seen, repeated, lines = set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(" \t\x0b\x0c\r"):
            seen.add(line)
        else:
            continue
        lines += 1
    covered = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        counts = Counter(windows)
        if len(counts) < len(windows):
            end = 0  # words before this one are counted already
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    covered += i + 3 - max(i, end)
                    end = i + 3
    upper = sum(map(bytes.isupper, words))
    marked = sum(1 for w in words if w[-1] in MARKS and (len(w) == 1 or w[-2] in MARKS))
    return n, chars, sum(map(text.count, SYMBOLS)), repeated, covered, lines, upper, marked


#: a marked word ends with two of these, or is one of them
MARKS = frozenset(b"#*$%&|<>!")


@dataclass(frozen=True)
class Rule:
    """A named condition over the measures; its place in the rule list is its bit."""

    name: str
    fails: str


#: New rules go at the end: a bit never changes its meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("upper_case", "100 * n_upper_words > 30 * n_words"),
    Rule("marked_words", "100 * n_marked_words > 10 * n_words"),
)

#: version -> names of the rules it applies
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(r.name for r in RULES),
}


def mask(names, rules=RULES) -> int:
    """The bits of the named rules."""
    place = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << place[n] for n in set(names))


def ledger(df: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, the measures (long) and ``failed`` (long, a bit for each rule) of every row.

    A null or empty text has no words and fails ``few_words``; a repeated
    row gives a repeated row, an empty table gives none.  One pass, no
    shuffle.
    """
    ship_code(df.sparkSession)
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [measure_text(t) for t in part.column(1).to_pylist()]
                columns = zip(*found) if found else [()] * len(MEASURES)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=[id_col, *MEASURES])

    schema = ", ".join([f"`{id_col}` {df.schema[id_col].dataType.simpleString()}", *(f"{m} long" for m in MEASURES)])
    measured = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)
    bits = [F.when(F.expr(r.fails), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
            for k, r in enumerate(rules)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed)


def passes(policy: str, rules=RULES, policies=POLICIES) -> Column:
    """Whether a ledger row fails none of the policy's rules."""
    return F.col("failed").bitwiseAND(F.lit(mask(policies[policy], rules))) == 0


def ablations(rows: DataFrame, policy: str, rules=RULES, policies=POLICIES) -> DataFrame:
    """For each rule of the policy: rule, n_fail, n_only (documents that no other rule of it rejects), n_rows.

    One aggregation over the ledger; ``n_only`` is what the policy without
    the rule would keep in addition.
    """
    whole = mask(policies[policy], rules)
    own = F.col("failed").bitwiseAND(F.lit(whole))
    sums = [F.count(F.lit(1)).alias("n_rows")]
    for name in policies[policy]:
        bit = mask([name], rules)
        sums += [F.count_if(own.bitwiseAND(F.lit(bit)) != 0).alias(f"{name}|fail"), F.count_if(own == bit).alias(f"{name}|only")]
    one = rows.agg(*sums)
    entries = [F.struct(F.lit(n).alias("rule"), F.col(f"`{n}|fail`").alias("n_fail"), F.col(f"`{n}|only`").alias("n_only"),
                        F.col("n_rows")) for n in policies[policy]]
    return one.select(F.inline(F.array(*entries)))
