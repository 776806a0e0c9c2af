"""Temperature mixing of sources.

Shares of the sources' tokens are raised to an exponent between 0 (equal) and 1 (as found). The exponent is
found by repeated section of its interval, against a target entropy or a limit on repetition. The
normalised weights times the budget are tokens per source, realised as whole epochs and one begun epoch,
each a permutation of blocks and of the documents in a block. A source of n documents has about sqrt(n)
blocks, so neither the blocks of a source nor the documents of a block are ever many.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded, materialize
from .common import WORD, whole_text, without

OUTPUTS = ("n_tokens", "epoch", "block", "start_token", "position")
# Points of a section, and sections: the exponent is exact to SECTION ** -ROUNDS.
SECTION = 64
ROUNDS = 5
MAX_REPEATS = 2.0


@dataclass(frozen=True)
class Mix:
    """Exponent, total budget in tokens, and the plan (key, rows, tokens, weight, budget) per source."""

    exponent: float
    budget: float
    sources: DataFrame


def source_key(name: str) -> Column:
    """A text that tells null from every name."""
    return F.to_json(F.struct(F.col(f"`{name}`").cast("string").alias("s")))


def _weigh(stats: DataFrame, low: float, high: float, top: float) -> list[dict]:
    """Entropy and repetition for the exponents of one section; one row each, in order."""
    points = F.explode(F.sequence(F.lit(0), F.lit(SECTION))).alias("i")
    at = F.lit(low) + F.col("i") * ((high - low) / SECTION)
    staged = stats.select(points, F.log(F.col("tokens") / F.lit(top)).alias("l"), "tokens").select(
        "i", at.alias("at"), F.exp(at * F.col("l")).alias("z"), (at * F.col("l")).alias("al"), "tokens"
    )
    per_token = F.col("z") / F.col("tokens")
    summed = staged.groupBy("i", "at").agg(
        F.sum("z").alias("z"),
        F.sum(F.col("z") * F.col("al")).alias("zl"),
        F.max(per_token).alias("most"),
        F.min(per_token).alias("least"),
    )
    rows = summed.select(
        "i", "at", "z", (F.log("z") - F.col("zl") / F.col("z")).alias("entropy"), "most", "least"
    ).collect()  # SECTION + 1 rows
    return [r.asDict() for r in sorted(rows, key=lambda r: r["i"])]


def find_exponent(
    stats: DataFrame, entropy: float | None, max_repeats: float | None, budget: float | None
) -> float:
    """The largest exponent that reaches ``entropy`` (nats), but none below the smallest that keeps to ``max_repeats``.

    Entropy falls and repetition falls as the exponent grows. A goal that no exponent reaches gives the nearest end.
    """
    top = float(stats.agg(F.max("tokens")).first()[0])

    def section(good, low: float = 0.0, high: float = 1.0, largest: bool = True) -> float:
        """The border of the exponents for which ``good`` holds."""
        for _ in range(ROUNDS):
            rows = _weigh(stats, low, high, top)
            fits = [good(r) for r in rows]
            if largest:
                i = max((n for n, ok in enumerate(fits) if ok), default=0)
                low, high = rows[i]["at"], rows[min(i + 1, SECTION)]["at"]
            else:
                i = min((n for n, ok in enumerate(fits) if ok), default=SECTION)
                low, high = rows[max(i - 1, 0)]["at"], rows[i]["at"]
            if low == high:
                break
        return low if largest else high

    def repeats(r: dict) -> float:
        if budget is None:
            return r["most"] / r["least"]
        return budget * r["most"] / r["z"]

    free = section(lambda r: r["entropy"] >= entropy) if entropy is not None else 0.0
    floor = section(lambda r: repeats(r) <= max_repeats, largest=False) if max_repeats is not None else 0.0
    return max(free, floor)


def plan_mix(
    counted: DataFrame,
    key: str,
    tokens: str,
    entropy: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    budget: float | None = None,
) -> Mix | None:
    """Weights and budgets from documents with a source ``key`` and their ``tokens``; None without any token.

    Without ``budget`` the total is the smallest for which every source is used in full at least once.
    """
    spark = counted.sparkSession
    stats = materialize(
        counted.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"), F.sum(tokens).alias("tokens")),
        "sources",
    )
    filled = stats.where("tokens > 0")
    if filled.isEmpty():
        return None
    exponent = find_exponent(filled, entropy, max_repeats, budget)
    top = filled.agg(F.max("tokens")).first()[0]
    raw = F.exp(F.lit(exponent) * F.log(F.col("tokens") / F.lit(float(top))))
    total, least = filled.agg(F.sum(raw), F.min(raw / F.col("tokens"))).first()
    whole = budget if budget is not None else total / least
    weight = raw / F.lit(total)
    share = F.round(weight * F.lit(float(whole))).cast("long")
    if budget is None:
        share = F.greatest(share, F.col("tokens"))
    empty = F.col("tokens") == 0
    sources = stats.select(
        "key",
        "rows",
        "tokens",
        F.when(empty, F.lit(0.0)).otherwise(weight).alias("weight"),
        F.when(empty, F.lit(0).cast("long")).otherwise(share).alias("budget"),
    )
    return Mix(exponent, float(whole), materialize(sources, "mix"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    entropy: float | None = None,
    max_repeats: float | None = MAX_REPEATS,
    budget: float | None = None,
    seed: int = 11,
) -> DataFrame:
    """Documents of the mixture, one row per use: the columns of ``docs``, n_tokens, epoch, block, start_token, position.

    ``start_token`` counts in the source's own sequence over all epochs; ``position`` in [0, 1) is the share of
    the source's budget before the document: ordered by it, the sources are spread evenly. The begun epoch
    ends with the last document that fits the budget. Tokens are words; null texts have none, and a source
    without tokens gives each document once. A null source is a source of its own. Repeated rows are used
    each for itself. An empty table gives an empty one. Input columns named like an output are replaced.
    """
    rows = without(docs, OUTPUTS)
    names = [f"`{c}`" for c in rows.columns]
    tokens = F.regexp_count(whole_text(text_col), F.lit(WORD)).cast("long")
    own = F.xxhash64(F.col(id_col), F.col(text_col))
    counted = rows.withColumns({"n_tokens": tokens, "__llm_key": source_key(source_col), "__llm_own": own})
    narrow = materialize(counted.select("__llm_key", "n_tokens", "__llm_own"), "token-counts")
    planned = plan_mix(narrow, "__llm_key", "n_tokens", entropy, max_repeats, budget)
    if planned is None:
        zero = F.lit(0)
        return rows.select(
            *names,
            tokens.alias("n_tokens"),
            zero.alias("epoch"),
            zero.alias("block"),
            zero.cast("long").alias("start_token"),
            F.lit(0.0).alias("position"),
        )

    def block(hashed: Column, n: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), hashed), F.ceil(F.sqrt(n)).cast("long")).cast("int")

    sources = bounded(planned.sources.withColumnRenamed("key", "__llm_key"))
    whole = F.when(F.col("tokens") == 0, F.lit(1)).otherwise(F.floor(F.col("budget") / F.col("tokens")))
    begun = F.when(F.col("tokens") == 0, F.lit(0)).otherwise(F.pmod(F.col("budget"), F.col("tokens")))
    in_blocks = (
        narrow.join(sources, "__llm_key")
        .groupBy("__llm_key", "rows", "tokens", "budget", block(F.col("__llm_own"), F.col("rows")).alias("block"))
        .agg(F.sum("n_tokens").alias("__llm_held"))
        .withColumns({"__llm_whole": whole.cast("int"), "__llm_begun": begun.cast("long")})
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__llm_whole"))))
    )
    shuffled = F.xxhash64(F.lit(seed), "epoch", "__llm_key", "block")
    before = (
        Window.partitionBy("__llm_key", "epoch")
        .orderBy(shuffled, "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    limit = F.when(F.col("epoch") < F.col("__llm_whole"), F.col("tokens")).otherwise(F.col("__llm_begun"))
    blocks = materialize(
        in_blocks.withColumns({"__llm_before": F.coalesce(F.sum("__llm_held").over(before), F.lit(0)), "__llm_limit": limit})
        .where((F.col("epoch") < F.col("__llm_whole")) | (F.col("__llm_before") < F.col("__llm_limit")))
        .select(
            "__llm_key",
            "block",
            "epoch",
            F.col("tokens").alias("__llm_all"),
            F.col("budget").alias("__llm_budget"),
            "__llm_before",
            "__llm_limit",
        ),
        "blocks",
    )
    # Which block a document is in depends on its source's row count alone.
    sized = counted.join(sources.select("__llm_key", "rows"), "__llm_key")
    placed = sized.withColumn("block", block(F.col("__llm_own"), F.col("rows"))).drop("rows")
    used = placed.join(bounded(blocks), ["__llm_key", "block"])
    inside = (
        Window.partitionBy("__llm_key", "block", "epoch")
        .orderBy(F.xxhash64(F.lit(seed + 1), "epoch", "__llm_own"), "__llm_own")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("__llm_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    cut = used.withColumn("__llm_start", start).where(F.col("__llm_start") + F.col("n_tokens") <= F.col("__llm_limit"))
    at = F.col("epoch") * F.col("__llm_all") + F.col("__llm_start")
    share = F.when(F.col("__llm_budget") > 0, at / F.col("__llm_budget")).otherwise(F.lit(0.0))
    return cut.select(
        *names, "n_tokens", "epoch", "block", at.cast("long").alias("start_token"), share.alias("position")
    )


def op1_temperature_mix(docs: DataFrame) -> DataFrame:
    """Every use of a document in the mixture; nulls, ties and empty tables as in ``mix``."""
    return mix(docs).select("doc_id", "source", *OUTPUTS)
