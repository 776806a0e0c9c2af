"""Ordered computations that stay distributed when one key holds most of the rows.

A window partitioned by a hot key runs in one task. These helpers take an extra
``bucket``: a deterministic column that never decreases along the ordering (a day,
a file block, an ordinal divided by a chunk size). Rows meet only inside
``(keys, bucket)``; what crosses buckets is one summary row per bucket. Keys and
bucket must not be null: a row without them has no place in the order, and its
totals come out null rather than wrong.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded, materialize

BUCKET = "__bucket"


def _names(prefix: str, n: int) -> list[str]:
    return [f"__{prefix}{i}" for i in range(n)]


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    values: dict[str, Column],
    inclusive: bool = True,
) -> DataFrame:
    """Add one running total per entry of ``values`` (exclusive totals stop before the row)."""
    names = list(values)
    staged = df.withColumn(BUCKET, bucket)
    for name, value in values.items():
        staged = staged.withColumn(f"__v_{name}", value)
    cells = staged.groupBy(*keys, BUCKET).agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        *keys, BUCKET, *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in names]
    )
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*_as_cols(order))
    end = Window.currentRow if inclusive else -1
    inside = inside.rowsBetween(Window.unboundedPreceding, end)
    summed = staged.withColumns(
        {f"__r_{n}": F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)) for n in names}
    )
    out = summed.join(offsets, [*keys, BUCKET], "left")
    out = out.withColumns({n: F.col(f"__r_{n}") + F.col(f"__o_{n}") for n in names})
    return out.select(*[c for c in df.columns if c not in names], *names)


def ordinal(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], bucket: Column, out: str = "rec"
) -> DataFrame:
    """Dense 0-based position inside each key."""
    return running_sums(df, keys, order, bucket, {out: F.lit(1).cast("long")}, inclusive=False)


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    values: dict[str, Column],
) -> DataFrame:
    """Add the previous row's value of each entry, looking across bucket borders."""
    names = list(values)
    packed = F.struct(*[v.alias(n) for n, v in values.items()])
    staged = df.withColumn(BUCKET, bucket).withColumn("__p", packed)
    last = staged.groupBy(*keys, BUCKET).agg(
        F.max_by("__p", F.struct(*_as_cols(order))).alias("__last")
    )
    across = Window.partitionBy(*keys).orderBy(BUCKET)
    borders = last.select(*keys, BUCKET, F.lag("__last").over(across).alias("__border"))
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*_as_cols(order))
    out = (
        staged.withColumn("__lag", F.lag("__p").over(inside))
        .join(borders, [*keys, BUCKET], "left")
        .withColumn("__prev", F.coalesce("__lag", "__border"))
    )
    return out.select(*df.columns, *[F.col("__prev")[n].alias(n) for n in names])


def top_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the largest by ``order``. A partial aggregate, so a hot key shrinks map-side."""
    kept = [c for c in (keep or df.columns) if c not in keys]
    best = F.max_by(F.struct(*kept), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col("__best")[c].alias(c) for c in kept])


# Distinct values of a key that one task may hold to find their median.
MEDIAN_VALUES = 200_000
MEDIAN_BINS = 1024


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median of numbers over value frequencies: repeated values are merged before they meet.

    A key with more than ``MEDIAN_VALUES`` distinct values is never gathered: its median is found by
    narrowing ranges, see ``ranked_values``.
    """
    freq = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    freq = materialize(freq, "frequencies")
    wide = freq.groupBy(*keys).agg(F.count("*").alias("__d"), F.sum("__n").alias("__all")).where(F.col("__d") > MEDIAN_VALUES)
    wide = materialize(wide, "wide-keys")
    gather = F.expr(f"percentile({value}, 0.5D, __n)").alias(out)
    if wide.isEmpty():
        return freq.groupBy(*keys).agg(gather)
    some = bounded(wide.select(*keys))
    narrow = freq.join(some, list(keys), "left_anti").groupBy(*keys).agg(gather)
    ranks = wide.select(*keys, F.explode(F.array(F.expr("(__all - 1) div 2"), F.expr("__all div 2"))).alias("rank")).distinct()
    found = ranked_values(freq.join(some, list(keys), "left_semi"), ranks, keys, value, "__n")
    return narrow.unionByName(found.groupBy(*keys).agg(F.avg(F.col(value).cast("double")).alias(out)))


def ranked_values(freq: DataFrame, ranks: DataFrame, keys: Sequence[str], value: str, n: str) -> DataFrame:
    """``keys, rank, value`` for 0-based ``ranks`` (``keys, rank``) of the values of a key, each ``n`` times there.

    Each round counts the values of the range that holds the rank in ``MEDIAN_BINS`` bins and goes on in one of
    them, until the range is one value. No task holds more than the bins of a key and rank; a round narrows the
    range a thousandfold.
    """
    v = F.col(value)
    ends = freq.groupBy(*keys).agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    ranges = materialize(ranks.join(ends, list(keys)).withColumn("below", F.lit(0).cast("long")), "ranges")
    while not ranges.where("lo < hi").isEmpty():
        inside = freq.join(bounded(ranges), list(keys)).where(v.between(F.col("lo"), F.col("hi")))
        share = (v.cast("double") - F.col("lo")) / (F.col("hi").cast("double") - F.col("lo"))
        bin_ = F.when(F.col("lo") < F.col("hi"), F.least(F.floor(share * MEDIAN_BINS), F.lit(MEDIAN_BINS - 1))).otherwise(0)
        bins = inside.groupBy(*keys, "rank", "below", bin_.alias("bin")).agg(
            F.sum(n).alias("held"), F.min(v).alias("lo"), F.max(v).alias("hi")
        )
        before = Window.partitionBy(*keys, "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("below", F.col("below") + F.coalesce(F.sum("held").over(before), F.lit(0)))
        chosen = (F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("held"))
        ranges = materialize(bins.where(chosen).select(*keys, "rank", "lo", "hi", "below"), "ranges")
    return ranges.select(*keys, "rank", F.col("lo").alias(value))


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    value: Column,
    out: str,
) -> DataFrame:
    """Last non-null ``value`` at or before each row of a key."""
    staged = df.withColumn(BUCKET, bucket).withColumn("__c", value)
    last = staged.groupBy(*keys, BUCKET).agg(
        F.max_by("__c", F.when(F.col("__c").isNotNull(), F.struct(*_as_cols(order)))).alias("__last")
    )
    across = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    borders = last.select(*keys, BUCKET, F.last("__last", ignorenulls=True).over(across).alias("__border"))
    inside = (
        Window.partitionBy(*keys, BUCKET).orderBy(*_as_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = staged.withColumn("__in", F.last("__c", ignorenulls=True).over(inside)).join(
        borders, [*keys, BUCKET], "left"
    )
    return joined.select(*[c for c in df.columns if c != out], F.coalesce("__in", "__border").alias(out))


def preview(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows per key. The rank filter also runs before the shuffle, so a hot key sends ``n`` rows per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_as_cols(order)))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def quarantine(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows without a reason, and the others with theirs."""
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


# Positions of the smallest stretch in which neighbours meet, and how many stretches meet in the next larger one.
STRETCH, FAN = 1 << 20, 1 << 10


def stitched(spans: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Join spans of a key that touch: ``keys, start, end``, 1-based closed.

    A tree over positions. Spans meet inside a stretch; what they become is final, but for the first and the last
    one of the stretch. These go up to a stretch ``FAN`` times as long, until one stretch holds the
    longest key. No window sees more than two rows per stretch below it. ``spans`` is to be stored: it is read twice.
    """
    longest = spans.agg(F.max(start)).first()[0] or 0
    size, level, done = STRETCH, spans.select(*keys, start, end), []
    while True:
        joined = _joined_within(level, keys, start, end, size)
        if longest < size:
            done.append(joined.drop("__edge"))
            break
        joined = materialize(joined, "stretches")
        done.append(joined.where(~F.col("__edge")).drop("__edge"))
        level, size = joined.where("__edge").drop("__edge"), size * FAN
    return functools.reduce(DataFrame.unionByName, done)


def _joined_within(spans: DataFrame, keys: Sequence[str], start: str, end: str, size: int) -> DataFrame:
    """Touching spans of a stretch as one, and whether it is the first or the last of the stretch."""
    staged = spans.withColumn(BUCKET, F.floor(F.col(start) / size))
    order = Window.partitionBy(*keys, BUCKET).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col(start) > before + 1), 1).otherwise(0)
    islands = staged.withColumn("__opens", opens).withColumn("__island", F.sum("__opens").over(order))
    merged = islands.groupBy(*keys, BUCKET, "__island").agg(F.min(start).alias(start), F.max(end).alias(end))
    whole = Window.partitionBy(*keys, BUCKET)
    edge = (F.col("__island") == 1) | (F.col("__island") == F.max("__island").over(whole))
    return merged.withColumn("__edge", edge).drop(BUCKET, "__island")
