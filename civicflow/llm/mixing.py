"""Mixing sources to target weights by temperature.

The weight of a source is its share of tokens raised to an exponent and
normalised: 1 keeps the shares, 0 makes them equal.  The exponent is found by
bisection, so that the weights reach a target entropy or so that no source is
repeated more often than a limit.  A token budget turns weights into passes
over each source: whole passes and a part of one.

Passes are block permutations.  A source's documents are dealt into blocks of
about ``block_tokens`` by hash, every pass orders the blocks anew by hash, and
the part pass takes blocks in that order until the budget is met; the block in
which it is met is cut between documents in hash order.  Hence a document is
in the part pass exactly if its block's hash is below its source's limit (or
equal and its own hash within the cut).  Per source that is a few numbers, and
the documents themselves are never shuffled.

The plan, a row per source, is a table and joined as such, however many
sources there are.  The driver holds a row per distinct token count of a source
(with the number of such sources) to find the exponent: at most the square root
of twice the corpus's tokens, and no more than there are sources.  A very
frequent source adds blocks, not larger ones.

Defined results: a null source is a source; a text without words, or null,
counts one token; documents with equal id and equal text (repeated rows) go
together, so a budget may be passed by their tokens as by any last document;
a target out of reach is an error; an empty table gives an empty mixture; input
columns with the name of a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from civicflow.session import materialize

BLOCK_TOKENS = 1 << 20
STEPS = 60
#: Rounding of targets at an end of the range of exponents.
TOLERANCE = 1e-9


def token_count(text: Column) -> Column:
    """Words, 1 at least."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+")), F.lit(1)).cast("long")


def temperature_weights(tokens: list[int], exponent: float, counts: list[int] | None = None) -> list[float]:
    """Weight of one source of each size; ``counts``: how many sources have it (one if not given)."""
    top = max(tokens)
    raised = [(t / top) ** exponent for t in tokens]
    total = math.fsum(n * r for n, r in zip(counts or [1] * len(raised), raised))
    return [r / total for r in raised]


def entropy(weights: list[float], counts: list[int] | None = None) -> float:
    return -math.fsum(n * w * math.log(w) for n, w in zip(counts or [1] * len(weights), weights) if w > 0)


def passes_of(tokens: list[int], weights: list[float], budget: float | None) -> list[float]:
    """Passes over each source; without a budget the least that shows every source whole."""
    if budget is None:
        budget = max(t / w for t, w in zip(tokens, weights))
    return [w * budget / t for t, w in zip(tokens, weights)]


def bisect_exponent(tokens: list[int], budget: float | None = None, target_entropy: float | None = None, max_passes: float | None = None,
                    counts: list[int] | None = None) -> float:
    """The exponent in [0, 1] that meets the target: entropy falls as it grows,
    and so does the number of passes over the smallest source.

    Both ends are tested; a target that no exponent meets is an error: an
    entropy below that of the shares or above that of equal weights, or a limit
    of passes that the budget exceeds even in proportion to the shares."""
    if (target_entropy is None) == (max_passes is None):
        raise ValueError("give a target entropy or a limit of passes")

    def reached(exponent: float) -> float:
        weights = temperature_weights(tokens, exponent, counts)
        return entropy(weights, counts) if target_entropy is not None else max(passes_of(tokens, weights, budget))

    target = max_passes if target_entropy is None else target_entropy
    slack = TOLERANCE * max(1.0, abs(target))
    flat, proportional = reached(0.0), reached(1.0)
    if proportional > target + slack or target_entropy is not None and flat < target - slack:
        what = "passes" if target_entropy is None else "entropy"
        raise ValueError(f"{what} of {target:g} can't be met: {proportional:g} in proportion to the shares, {flat:g} with equal weights")
    low, high = 0.0, 1.0
    if flat <= target:
        return low
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) > target else (low, middle)
    return high


def _uniform(seed: int, *columns) -> Column:
    return F.xxhash64(F.lit(seed), *columns).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)


def mix(documents: DataFrame, budget_ratio: float | None = None, target_entropy: float | None = None, max_passes: float | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: int = 11, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``documents`` as the mixture shows them, with ``tokens``, ``epoch`` and
    ``mix_key`` (in [0, 1); sorting by it interleaves the sources).

    ``budget_ratio``: token budget as a multiple of the corpus; without it the
    least budget under which every document is shown.
    """
    names = [c for c in documents.columns if c.lower() not in ("tokens", "epoch", "mix_key")]
    # The caller's columns in one struct, so that none has the name of a working column.
    sized = documents.select(
        F.struct(*names).alias("row"), token_count(F.col(text)).alias("tokens"), F.col(source).cast("string").alias("own"),
        F.xxhash64(F.lit(seed + 1), F.col(doc_id), F.col(text)).alias("_doc"))
    narrow = materialize(sized.select("own", "_doc", "tokens"), "mix-sizes")  # what planning needs; the texts are read once more at the end
    totals = materialize(narrow.groupBy(F.col("own").alias("src")).agg(F.sum("tokens").alias("n")), "mix-totals")  # one row per source
    sizes = totals.groupBy("n").agg(F.count("*").alias("sources")).orderBy("n").collect()  # one row per token count
    if not sizes:
        return sized.select("row.*", "tokens", F.lit(0).alias("epoch"), F.lit(0.0).alias("mix_key"))
    tokens, counts = [r["n"] for r in sizes], [r["sources"] for r in sizes]
    budget = None if budget_ratio is None else budget_ratio * sum(n * t for n, t in zip(counts, tokens))
    exponent = bisect_exponent(tokens, budget, target_entropy, max_passes, counts)
    passes = passes_of(tokens, temperature_weights(tokens, exponent, counts), budget)
    plan = [(n, p, int(p + 1e-9), max(0.0, p - int(p + 1e-9)) * n, -(-n // block_tokens)) for n, p in zip(tokens, passes)]
    by_size = documents.sparkSession.createDataFrame(plan, "n long, passes double, whole int, part_tokens double, n_blocks long")
    sources = materialize(totals.join(by_size, "n").drop("n"), "mix-plan")

    def located(df: DataFrame) -> DataFrame:
        """``df`` with its source's plan, its block and the hashes of both."""
        joined = df.join(sources, F.col("own").eqNullSafe(F.col("src")))
        return joined.withColumn("_block", F.pmod(F.xxhash64(F.lit(seed), "_doc"), F.col("n_blocks"))).withColumn("_at", _uniform(seed, "src", "_block", F.col("whole")))

    # Blocks of the part pass: one row per block, then one per source.
    by_block = located(narrow).groupBy("src", "_block", "_at", "part_tokens").agg(F.sum("tokens").alias("n"))
    in_order = W.partitionBy("src").orderBy("_at", "_block")
    run = by_block.withColumn("end", F.sum("n").over(in_order)).withColumn("start", F.col("end") - F.col("n"))
    edge = materialize(run.where((F.col("start") < F.col("part_tokens")) & (F.col("end") >= F.col("part_tokens"))).select(
        F.col("src").alias("e_src"), F.col("_at").alias("e_at"), F.col("_block").alias("e_block"), (F.col("part_tokens") - F.col("start")).alias("room")), "mix-edge")  # one row per source
    # Documents of the block that is cut.
    same = F.col("src").eqNullSafe(F.col("e_src")) & (F.col("_block") == F.col("e_block"))
    inside = located(narrow).join(edge, same).groupBy("src", "_doc", "room", "e_at").agg(F.sum("tokens").alias("n"))
    by_hash = W.partitionBy("src").orderBy("_doc")
    cut = inside.withColumn("start", F.sum("n").over(by_hash) - F.col("n")).where(F.col("start") < F.col("room"))
    limits = cut.groupBy(F.col("src").alias("l_src"), F.col("e_at").alias("limit")).agg(F.max("_doc").alias("last"))
    sources = materialize(sources.join(limits, F.col("src").eqNullSafe(F.col("l_src")), "left").drop("l_src"), "mix-plan")

    in_part = (F.col("_at") < F.col("limit")) | ((F.col("_at") == F.col("limit")) & (F.col("_doc") <= F.col("last")))
    n_shown = F.col("whole") + F.when(F.coalesce(in_part, F.lit(False)), 1).otherwise(0)
    shown = located(sized).withColumn("_n", n_shown).where("_n > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    position = (F.col("epoch") + _uniform(seed, "src", "_block", F.col("epoch"))) / F.col("passes")
    return shown.select("row.*", "tokens", F.col("epoch").cast("int").alias("epoch"), F.least(position, F.lit(1.0 - 2.0**-52)).alias("mix_key"))
