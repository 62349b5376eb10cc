"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its token share to the power ``alpha``, normalised. The
exponent is bisected so that the mixture meets a target: an entropy (a fraction of
that of equal weights), or a limit on how often the most repeated source may be
passed. Every probe is one aggregate over the table of sources, for 31 exponents at
a time (five halvings).

The weights are realised as token budgets. A source's documents are permuted anew
in every pass; whole passes come first, then documents of one more pass as long as
they start within the budget. Without ``budget_tokens`` the budget is the least that
passes every source once, so no document is dropped. The sequence of a source is
laid over all blocks in proportion, so each block has the weights of the mixture, and
inside a block the order is one more permutation.

Prefix sums are taken in two steps: over hash buckets of a pass, then inside a bucket,
so a source that holds a third of all rows is spread over many tasks.

Defined cases: a null source is a source of its own; a null or empty text has no tokens
and is passed as often as its source; a source without tokens gets one pass; rows that
share an id or have none are told apart (and spread) by the hash of their text, or by
``row``; rows equal in that too each get a place of their own, any of them; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gridlake.llm import common as C

BLOCK_TOKENS = 32_768
#: Rows of one hash bucket of a pass, about.
BUCKET_ROWS = 4096
_PROBES, _ROUNDS = 31, 7


def source_tokens(docs: DataFrame, doc_id: str, text: str, source: str, row: Column | None = None) -> DataFrame:
    """doc_id, row (hash of the text, if not given), src, no_src (a null source), n_tokens:
    words of the whole text."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.xxhash64(F.col(text)) if row is None else row).alias("row"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
        F.col(source).isNull().alias("no_src"),
        F.size(C.words(F.col(text))).cast("long").alias("n_tokens"),
    )


def find_exponent(shares: DataFrame, target_entropy: float | None, max_repeats: float | None, budget_share: float | None) -> float:
    """The exponent at which the sources (column p, positive token shares) meet the target.

    Both measures fall or rise monotonically with the exponent: the entropy falls from
    that of equal weights at 0; the most repeated source's passes fall to those of plain
    proportion at 1 (the smallest exponent within the limit is taken)."""
    low, high = 0.0, 1.0 if target_entropy is None else 16.0
    if target_entropy is None and max_repeats is None:
        return 1.0
    for _ in range(_ROUNDS):
        step = (high - low) / (_PROBES + 1)
        grid = [low + step * (k + 1) for k in range(_PROBES)]
        # The probes are rows, not 62 aggregates with their numbers in the generated code, which
        # every round would compile anew: one small plan serves all rounds.
        w = F.exp(F.col("a") * F.log("p"))
        probes = shares.select("p", F.posexplode(F.array(*map(F.lit, grid))).alias("k", "a")).groupBy("k")
        sums = probes.agg(F.count("*"), F.min("p"), F.max("p"), F.sum(w), F.sum(w * F.log("p"))).collect()
        found = {k: rest for k, *rest in sums}  # at most _PROBES rows
        if not found or found[0][0] < 2:
            return 1.0

        def within(k: int) -> bool:
            a, (n, least, most, z, e) = grid[k], found[k]
            if target_entropy is not None:
                return math.log(z) - a * e / z <= target_entropy * math.log(n)
            if budget_share is None:
                return (most / least) ** (1.0 - a) <= max_repeats
            return budget_share * least ** (a - 1.0) / z <= max_repeats

        first = next((k for k in range(_PROBES) if within(k)), _PROBES)
        low, high = low + step * first, low + step * (first + 1)
    return round(high, 9)


def budgets(tokens: DataFrame, target_entropy=None, max_repeats=None, budget_tokens: int | None = None) -> DataFrame:
    """One row per source: src, no_src, tokens, weight, budget, passes (whole ones), rest."""
    per = C.cut(tokens.groupBy("src", "no_src").agg(F.sum("n_tokens").alias("tokens")), "sources")
    total = per.agg(F.sum("tokens")).first()[0] or 0
    shares = per.where("tokens > 0").select((F.col("tokens") / F.lit(float(max(1, total)))).alias("p"))
    budget_share = None if budget_tokens is None else budget_tokens / max(1, total)
    alpha = find_exponent(shares, target_entropy, max_repeats, budget_share)
    r = shares.agg(F.sum(F.pow("p", F.lit(alpha))), F.max("p"), F.min("p")).first()
    z, most, least = r[0] or 1.0, r[1] or 1.0, r[2] or 1.0
    p = F.col("tokens") / F.lit(float(max(1, total)))
    if budget_tokens is None:
        # The source that needs the largest budget for one pass sets it: weights times
        # the budget are then tokens of that source times a power of the ratio of shares.
        base = most if alpha <= 1 else least
        budget = F.lit(base * total) * F.pow(p / F.lit(base), F.lit(alpha))
    else:
        budget = F.pow(p, F.lit(alpha)) / F.lit(z) * F.lit(float(budget_tokens))
    some = F.col("tokens") > 0
    return (
        per.withColumn("weight", F.when(some, F.pow(p, F.lit(alpha)) / F.lit(z)).otherwise(0.0))
        .withColumn("budget", F.when(some, F.round(budget).cast("long")).otherwise(0))
        .withColumn("passes", F.when(some, F.expr("budget div tokens")).otherwise(1))
        .withColumn("rest", F.when(some, F.expr("budget % tokens")).otherwise(0))
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 0,
    row: Column | None = None,
) -> DataFrame:
    """The mixture in order: doc_id, source, n_tokens, pass (from 1), block and position in
    it (both from 0). A document has a row for every time it is passed. ``row`` is a long that
    tells rows of one id apart; if given, it comes back as the column row."""
    tokens = C.cut(source_tokens(docs, doc_id, text, source, row), "tokens")
    plan = C.cut(budgets(tokens, target_entropy, max_repeats, budget_tokens), "budgets")
    size = plan.agg(F.sum("budget"), F.count("*")).first()
    blocks = max(1, -(-int(size[0] or 0) // block_tokens))
    bits = max(0, math.ceil(math.log2(max(1, tokens.count()) / BUCKET_ROWS)))
    key = ["src", "no_src", "pass", "bucket"]
    dealt = (
        tokens.join(plan, ["src", "no_src"])
        .withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("passes + IF(rest > 0, 1, 0)"))))
        .withColumn("u", F.xxhash64(F.lit(seed), "pass", "doc_id", "row"))
        .withColumn("bucket", F.shiftrightunsigned("u", 64 - bits) if bits else F.lit(0).cast("long"))
    )
    sums = dealt.groupBy(*key).agg(F.sum("n_tokens").alias("in_bucket"))
    over = Window.partitionBy("src", "no_src", "pass").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*key, F.coalesce(F.sum("in_bucket").over(over), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*key).orderBy("u", "doc_id", "row", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        dealt.join(before, key)
        .withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .where("pass <= passes OR start < rest")
    )
    # Where in its source's sequence a document starts, 0 to 1; without tokens, by hash.
    by_hash = F.shiftrightunsigned("u", 11).cast("double") / F.lit(float(1 << 53))
    place = F.when(F.col("budget") > 0, ((F.col("pass") - 1) * F.col("tokens") + F.col("start")) / F.col("budget")).otherwise(by_hash)
    block = F.least(F.floor(place * F.lit(blocks)), F.lit(blocks - 1).cast("long"))
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "block", "pass", "doc_id", "row"), "doc_id", "pass", "row", "src", "no_src")
    return (
        laid.withColumn("block", block)
        .withColumn("position", (F.row_number().over(order) - 1).cast("long"))
        .select("doc_id", *([] if row is None else ["row"]), F.when(~F.col("no_src"), F.col("src")).alias("source"), "n_tokens", "pass", "block", "position")
    )
