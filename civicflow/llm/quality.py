"""Quality rules as a bitmask ledger.

``ledger`` measures every text once and evaluates every rule once: the
measurements stay as columns and the failures as bits of one number.  Policies
are versioned sets of rules; ``apply_policy`` is a bitwise test on the ledger
and ``ablations`` aggregates the distinct bit patterns (at most two to the
number of rules), so neither reads a text again.

Everything is built-in column functions.  Repeated three-word windows are
found by hash (64 bits, compared within one text): the windows are sorted as
(hash, position) and neighbours compared, only in texts that have any.

Defined results: a null text has no words and measures 0 throughout; ties and
repeated rows are measured row by row; input columns with the name of a ledger
column are replaced, others kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import unused

#: Fixed values of the measurements.
SPACES = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _window_hashes(words: Column) -> Column:
    size = F.size(words)
    hashes = F.transform(
        F.sequence(F.lit(0), size - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(size >= 3, hashes).otherwise(F.array().cast("array<bigint>"))


def _repeated_positions(hashes: Column) -> Column:
    """Number of words in windows whose hash stands at two positions or more."""
    none = F.array().cast("array<int>")

    def count(entries: Column) -> Column:
        pairs = F.zip_with(
            entries, F.slice(entries, 2, F.size(entries)),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(none),
        )
        starts = F.array_distinct(F.flatten(pairs))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2)))))

    entries = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), _let(entries, count)).otherwise(0)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements of ``text`` (all long)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    of_words, of_lines = unused([*df.columns, *MEASURES], "_w", "_l")
    per_words = _let(_words(whole), lambda w: F.struct(
        F.size(w).alias("n_words"),
        F.length(F.array_join(w, "")).alias("word_chars"),
        _let(_window_hashes(w), _repeated_positions).alias("n_repeat_words"),
    ))
    per_lines = _let(_lines(whole), lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    found = df.withColumns({
        of_words: per_words, of_lines: per_lines,
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)),
        "n_upper": F.length(whole) - F.length(F.regexp_replace(whole, "[A-Z]+", "")),
        "n_exclaim": F.regexp_count(whole, F.lit("!")),
    })
    found = found.withColumns({f: F.col(f"{s}.{f}") for s, f in (
        (of_words, "n_words"), (of_words, "word_chars"), (of_words, "n_repeat_words"), (of_lines, "n_lines"), (of_lines, "n_dup_lines"))})
    return found.withColumns({m: F.col(m).cast("long") for m in MEASURES}).drop(of_words, of_lines)


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` is true; ``bit`` is its place in the ledger, for good."""

    bit: int
    name: str
    fails: str


#: SQL over the measurements, in integers.  Bits are never given anew.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "n_dup_lines >= 5 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "shouting", "2 * n_upper > word_chars"),
    Rule(5, "exclamations", "3 * n_exclaim > n_words"),
    Rule(6, "word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
)

#: Policies by version: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "shouting", "exclamations"),
}


def mask(policy: str, rules=RULES) -> int:
    bit_of = {r.name: r.bit for r in rules}
    return sum(1 << bit_of[name] for name in POLICIES[policy])


def ledger(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``df`` with the measurements and ``fail_bits`` (bit of each failed rule)."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0).cast("long") for r in rules]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measure(df, text).withColumn("fail_bits", total)


def passes(policy: str) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def apply_policy(entries: DataFrame, policy: str) -> DataFrame:
    """``entries`` with ``kept``: no rule of the policy failed."""
    return entries.withColumn("kept", passes(policy))


def ablations(entries: DataFrame, policy: str, rules=RULES) -> DataFrame:
    """For each rule of ``policy``: rows it rejects, rows that only it rejects,
    and rows kept without it."""
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count("*").alias("n"))
    named = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                      for r in rules if r.name in POLICIES[policy]])
    each = patterns.select("bits", "n", F.inline(named))
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    alone, kept = F.col("bits") == F.col("bit"), F.col("bits") == 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(kept | alone, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def verdicts(documents: DataFrame, policy: str = "v2") -> DataFrame:
    """Ledger row of each document with the base verdict and the policy's."""
    entries = apply_policy(ledger(documents.select("doc_id", "text")), policy)
    base_failed = ~passes("base")
    return entries.select(
        "doc_id", *MEASURES, "fail_bits", base_failed.alias("base_failed"), (~base_failed & F.col("kept")).alias("kept"))
