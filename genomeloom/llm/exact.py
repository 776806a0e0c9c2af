"""Exact dedup with a heavy-hitter split.

Frequent digests are found with a mergeable frequent-items summary (a Misra-Gries counter set kept
per task and merged in two steps), then counted exactly. Their winners are a list of bounded length
that goes to every task, so the copies of a frequent text are decided where they are read. All other
digests take one ordinary exchange; by the bound of the summary none of them is frequent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import whole_text, without

OUTPUTS = ("text_sha256", "keep_id", "group_size", "kept")
ROW = "__llm_row"
# Counters of a summary. A digest above 3.5 / TRACKED of all rows is always reported.
TRACKED = 8192
# Most digests that are taken as frequent: the length of the broadcast list.
HEAVY = 2048
FAN_IN = 256


def frequent_digests(digests: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """Candidates (text_sha256): at most ``heavy`` rows. Misses nothing above the bound of the summary."""
    parts = digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("counters")
    )
    # Grouped under one key: a task without rows then adds no (unreadable) empty summary.
    merged = parts.groupBy(F.floor(F.col("part") / FAN_IN)).agg(F.expr(f"approx_top_k_combine(counters, {tracked})").alias("counters"))
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(counters, {heavy})")).alias("hit"))
    return found.select(F.col("hit.item").alias("text_sha256")).where(F.col("text_sha256").isNotNull())


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    tracked: int = TRACKED,
    heavy: int = HEAVY,
) -> DataFrame:
    """Mark, for every row, the row of its group of equal texts that stays.

    Adds ``text_sha256`` (of the text in UTF-8), ``keep_id`` (id of the row that stays), ``group_size``
    and ``kept`` to the ``carry`` columns (default: all). Of equal texts the largest id stays; null
    ids rank below all others, and of rows that tie exactly one stays. A null text counts as empty.
    An empty table gives an empty table. Input columns named like an output are replaced by it.
    """
    docs_in = docs.withColumn("__llm_sha", F.sha2(whole_text(text_col), 256))
    names = [c for c in (docs.columns if carry is None else [id_col, *carry]) if c.lower() not in OUTPUTS]
    stored = materialize(
        without(docs_in, OUTPUTS).select(
            *[f"`{c}`" for c in dict.fromkeys(names)],
            F.col("__llm_sha").alias("text_sha256"),
            F.monotonically_increasing_id().alias(ROW),
        ),
        "digests",
    )
    place = F.struct(F.col(id_col).alias("id"), F.col(ROW).alias("row"))
    # The list has at most ``heavy`` rows, so both joins below may broadcast it.
    candidates = materialize(frequent_digests(stored.select("text_sha256"), tracked, heavy), "frequent")
    winners = materialize(
        stored.join(F.broadcast(candidates), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max(place).alias("__llm_best"), F.count("*").alias("group_size")),
        "winners",
    )
    marked = stored.join(F.broadcast(winners), "text_sha256", "left")
    often = marked.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("text_sha256")
    rest = (
        stored.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
        .withColumn("__llm_best", F.max(place).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    both = often.unionByName(rest)
    return both.select(
        *[f"`{c}`" for c in dict.fromkeys(names)],
        F.col("__llm_best.id").alias("keep_id"),
        "group_size",
        (F.col("__llm_best.row") == F.col(ROW)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    # Clashing names are replaced by the marks, so the marks are taken off a renamed copy.
    safe = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = docs.columns.index
    kept = exact_dedup(safe, f"c{at(id_col)}", f"c{at(text_col)}").where("kept")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op9_heavy_hitter_dedup(docs: DataFrame) -> DataFrame:
    """One row per document with the row that stays; nulls, ties and empty tables as in ``exact_dedup``."""
    return exact_dedup(docs, carry=[])


SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
