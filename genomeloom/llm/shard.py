"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Count the rows of each input partition (no column is read).
2. Draw how many rows of each partition go to each shard: the exact law of a uniform permutation,
   drawn down a tree of partitions. A node splits its shard counts among its children, one
   hypergeometric draw per child and shard, from numbers that depend on seed and node only.
3. Permute inside each partition: a local sort by a random number. The local rank against the
   cumulated matrix row gives the shard. Nothing has moved so far.
4. Exchange once, to (shard, cell). Cells are random parts of a shard, as many as it needs.
5. Permute again inside each cell. Cell offsets make the slots of a shard gapless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import bounded, materialize
from .common import bind, unit_interval, whole_text, without

FAN_OUT = 64
# Rows that one task permutes at the end.
CELL_ROWS = 20_000
# Standard deviations around the mean that a draw looks at: the rest has a chance below 1e-18.
REACH = 9.0
# Largest table of matrix rows or cell offsets that is sent to every task.
MAX_BROADCAST_ROWS = 200_000


def hypergeometric(u: Column, total: Column, marked: Column, drawn: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` without replacement, by inverting the law at ``u``."""
    as_double = lambda c: c.cast("double")
    n, k, m = as_double(total), as_double(marked), as_double(drawn)
    mean = m * k / F.greatest(n, F.lit(1.0))
    spread = F.sqrt(mean * F.greatest((n - k) / F.greatest(n, F.lit(1.0)), F.lit(0.0)) + 1.0)
    lowest = F.greatest(F.lit(0).cast("long"), drawn + marked - total)
    highest = F.least(marked, drawn)
    lo = F.greatest(lowest, F.floor(mean - REACH * spread).cast("long"))
    hi = F.least(highest, F.ceil(mean + REACH * spread).cast("long") + 1)

    def ratio(x: Column) -> Column:
        """Chance of x + 1 over the chance of x."""
        x = as_double(x)
        return (k - x) * (m - x) / ((x + 1.0) * F.greatest(n - k - m + x + 1.0, F.lit(1.0)))

    def mass(values: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
            lambda s, x: F.struct((s["w"] * ratio(x)).alias("w"), (s["sum"] + s["w"]).alias("sum")),
            lambda s: s["sum"],
        )

    def invert(values: Column, goal: Column) -> Column:
        start = F.struct(
            F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below")
        )

        def step(s: Column, x: Column) -> Column:
            up = s["sum"] + s["w"]
            passed = F.when(up <= goal, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
            return F.struct((s["w"] * ratio(x)).alias("w"), up.alias("sum"), (s["below"] + passed).alias("below"))

        return F.aggregate(values, start, step, lambda s: s["below"])

    searched = bind(
        F.sequence(lo, hi), lambda values: bind(mass(values), lambda all_: F.least(hi, lo + invert(values, u * all_)))
    )
    return F.when(hi <= lo, lo).otherwise(searched)


def _split(children: Column, room: Column, seed: int, depth: int, node: Column, shards: int) -> Column:
    """Give each child (its row count) a part of the parent's shard counts ``room``; one array per child."""
    zero = F.lit(0).cast("long")
    total_of = lambda a: F.aggregate(a, zero, lambda x, y: x + y)

    def draw_child(room_left: Column, child: Column) -> Column:
        """Counts per shard: the child's rows are drawn shard after shard."""
        start = F.struct(
            child["n"].alias("need"),
            total_of(room_left).alias("pool"),
            F.array().cast("array<bigint>").alias("out"),
        )

        def one(s: Column, j: Column) -> Column:
            room_j = F.get(room_left, j)
            u = unit_interval(F.lit(seed), F.lit(depth), node, child["id"], j)
            return bind(
                hypergeometric(u, s["pool"], room_j, s["need"]),
                lambda got: F.struct(
                    (s["need"] - got).alias("need"),
                    (s["pool"] - room_j).alias("pool"),
                    F.concat(s["out"], F.array(got)).alias("out"),
                ),
            )

        return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, one, lambda s: s["out"])

    def next_child(s: Column, child: Column) -> Column:
        return bind(
            draw_child(s["room"], child),
            lambda got: F.struct(
                F.zip_with(s["room"], got, lambda a, b: a - b).alias("room"),
                F.concat(s["rows"], F.array(F.struct(child["id"].alias("id"), got.alias("room")))).alias("rows"),
            ),
        )

    empty = F.struct(
        room.alias("room"), F.array().cast("array<struct<id:bigint,room:array<bigint>>>").alias("rows")
    )
    return F.aggregate(children, empty, next_child, lambda s: s["rows"])


def communication_matrix(counts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, room): rows of partition ``part`` that go to each shard.

    ``counts`` has part (0 up) and n. Shard totals differ by one at most; row sums are the partition sizes.
    """
    levels = [counts.select(F.col("part").cast("long").alias("id"), F.col("n").cast("long"))]
    top = counts.agg(F.max("part")).first()[0]
    if top is None:
        return counts.select("part", F.array().cast("array<bigint>").alias("room"))
    width = int(top) + 1
    while width > 1 or len(levels) == 1:
        up = levels[-1].groupBy(F.floor(F.col("id") / FAN_OUT).alias("id")).agg(F.sum("n").alias("n"))
        levels.append(up)
        width = -(-width // FAN_OUT)
    goal = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")),
        lambda j: F.floor(F.col("n") / shards).cast("long")
        + F.when(j < F.pmod(F.col("n"), F.lit(shards)), F.lit(1)).otherwise(F.lit(0)).cast("long"),
    )
    rooms = levels[-1].select("id", goal.alias("room"))
    for depth in range(len(levels) - 2, -1, -1):
        families = levels[depth].groupBy(F.floor(F.col("id") / FAN_OUT).alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("id", "n"))).alias("children")
        )
        drawn = families.join(rooms, families["parent"] == rooms["id"]).select(
            F.explode(_split(F.col("children"), F.col("room"), seed, depth, F.col("parent"), shards)).alias("c")
        )
        rooms = drawn.select(F.col("c.id").alias("id"), F.col("c.room").alias("room"))
    return rooms.select(F.col("id").alias("part"), "room")


OUTPUTS = ("shard", "slot")


def shuffle_shards(
    docs: DataFrame, shards: int = 16, seed: int = 20, stored: bool = False, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (0 up) and ``slot`` (0 up, gapless in its shard), in uniform random order.

    The counts of the first pass must hold for the second, so ``docs`` is written to the shared folder
    first unless it is the plain scan of a stored table (``stored``). Rows are told apart by place, not by
    content: repeated rows, null ids and null texts are rows like any other. An empty table gives an
    empty table; a shard may be empty when there are fewer rows than shards. Input columns named
    ``shard`` or ``slot`` are replaced.
    """
    rows = without(docs, OUTPUTS)
    if not stored:
        rows = materialize(rows, "to-shard")
    names = [f"`{c}`" for c in rows.columns]

    def placed(df: DataFrame, keep: list[str]) -> DataFrame:
        """Local permutation: part, rank in it, and the numbers for cell and second permutation."""
        tagged = df.select(
            *keep,
            F.spark_partition_id().alias("__llm_part"),
            F.rand(seed).alias("__llm_first"),
            F.rand(seed + 1).alias("__llm_cell"),
            F.rand(seed + 2).alias("__llm_second"),
        ).sortWithinPartitions("__llm_first")
        local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        return tagged.withColumn("__llm_rank", local)

    counts = materialize(
        rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")), "part-counts"
    )
    n = counts.agg(F.sum("n")).first()[0] or 0
    cells = max(1, -(-n // (shards * cell_rows)))
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda j: F.aggregate(F.slice("room", 1, j), F.lit(0).cast("long"), lambda a, b: a + b),
    )
    matrix = materialize(communication_matrix(counts, shards, seed), "matrix")
    cuts = bounded(matrix.select(F.col("part").cast("int").alias("__llm_part"), ends.alias("ends")), MAX_BROADCAST_ROWS)

    def dealt(df: DataFrame, keep: list[str]) -> DataFrame:
        shard = F.size(F.filter("ends", lambda e: e <= F.col("__llm_rank")))
        return (
            placed(df, keep)
            .join(cuts, "__llm_part")
            .select(
                *keep,
                shard.alias("shard"),
                F.floor(F.col("__llm_cell") * cells).cast("int").alias("__llm_cell"),
                "__llm_second",
            )
        )

    sizes = materialize(
        dealt(rows, []).groupBy("shard", "__llm_cell").agg(F.count("*").alias("m")), "cell-sizes"
    )
    before = Window.partitionBy("shard").orderBy("__llm_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "__llm_cell", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("__llm_offset"))
    order = Window.partitionBy("shard", "__llm_cell").orderBy("__llm_second")
    ranked = dealt(rows, names).withColumn("__llm_rank", F.row_number().over(order))
    slot = (F.col("__llm_offset") + F.col("__llm_rank") - 1).cast("long")
    return ranked.join(bounded(offsets, MAX_BROADCAST_ROWS), ["shard", "__llm_cell"]).select(
        *names, "shard", slot.alias("slot")
    )


def op2_hypergeometric_shards(docs: DataFrame) -> DataFrame:
    """All ``documents`` in shards 0 to 15 by law ``rows``; a null text counts as empty, with size 1 and checksum 0."""
    text = whole_text()
    size = F.octet_length(text).cast("long") + 1
    placed = shuffle_shards(docs.select("doc_id", "text"), shards=16, stored=True)
    return placed.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
