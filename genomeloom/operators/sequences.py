"""Sequence profiles, masking checks, protein-set summaries, intervals and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import residues as R
from ..functions.runs import lowercase_runs
from ..session import materialize
from .spread import exact_median, running_sums, stitched

PIECE = 65_536


def base_profile(df: DataFrame, seq: str = "seq", lower: str = "acgt") -> DataFrame:
    """Add ``length, lower_n, gap_n, masked_n`` and their percentages per sequence."""
    out = df.withColumns(
        {
            "length": F.length(seq).cast("long"),
            "lower_n": R.lowercase_count(seq, lower),
            "gap_n": R.gap_count(seq),
            "masked_n": R.masked_sites(seq, lower),
        }
    )
    return out.withColumns(
        {
            "lower_pct": R.percent(F.col("lower_n"), F.col("length"), 6),
            "gap_pct": R.percent(F.col("gap_n"), F.col("length"), 6),
            "masked_pct": R.percent(F.col("masked_n"), F.col("length"), 6),
        }
    )


def profile_totals(df: DataFrame, keys: Sequence[str], seq: str = "seq", lower: str = "acgt") -> DataFrame:
    """Residue totals per delivery. Works on whole records and on pieces alike."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.length(seq).cast("long")), F.lit(0)).alias("total"),
        F.coalesce(F.sum(R.lowercase_count(seq, lower)), F.lit(0)).alias("lower_n"),
        F.coalesce(F.sum(R.gap_count(seq)), F.lit(0)).alias("gap_n"),
    )


def softmask_outcome(total: Column, lower_n: Column, gap_n: Column) -> Column:
    """Ordered rule: nothing to count, too little soft mask, too many gaps, fine."""
    return (
        F.when(total == 0, F.lit("manual"))
        .when(F.try_divide(lower_n, total) < 0.005, F.lit("gap_not_softmasked"))
        .when(F.try_divide(gap_n, total) > 0.2, F.lit("gap_hardmasked"))
        .otherwise(F.lit("ok"))
    )


def softmask_rule(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    totals = profile_totals(df, keys, seq)
    return totals.withColumn("outcome", softmask_outcome(F.col("total"), F.col("lower_n"), F.col("gap_n")))


def mask_gate(ids: Column, lengths: Column, same: Column, lower_pct: Column) -> Column:
    return F.when(ids & lengths & same & (lower_pct >= 0.5), F.lit("PASS")).otherwise(F.lit("FAIL"))


def mask_facts(df: DataFrame, keep: Sequence[str], id_col: str = "id", seq: str = "seq") -> DataFrame:
    """What a masking check needs of each record, without its residues.

    Taken before records are numbered or joined, so no sequence is ever shuffled.
    """
    return df.select(
        *keep,
        F.col(id_col).alias("id"),
        F.length(seq).cast("long").alias("len"),
        F.sha2(F.upper(F.col(seq)), 256).alias("sha"),
        R.lowercase_count(seq, "any").alias("lower_n"),
        R.gap_count(seq).alias("gap_n"),
        R.lowercase_count(seq, "acgt").alias("soft_n"),
    )


def mask_qc(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Masked delivery against its input. Both sides: ``mask_facts`` with a dense ``rec`` per key."""
    a = before.select(*keys, "rec", F.col("id").alias("id_a"), F.col("len").alias("len_a"), F.col("sha").alias("sha_a"))
    b = after.select(
        *keys, "rec", F.col("id").alias("id_b"), F.col("len").alias("len_b"), F.col("sha").alias("sha_b"), "lower_n", "gap_n"
    )
    both = a.join(b, [*keys, "rec"], "full_outer")
    flags = both.groupBy(*keys).agg(
        F.bool_and(F.col("id_a").eqNullSafe(F.col("id_b"))).alias("ids_equal"),
        F.bool_and(F.col("len_a").eqNullSafe(F.col("len_b"))).alias("len_ok"),
        F.bool_and(F.col("sha_a").eqNullSafe(F.col("sha_b"))).alias("seq_ok"),
        F.coalesce(F.sum("len_b"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("lower_n"), F.lit(0)).alias("lower_n"),
        F.coalesce(F.sum("gap_n"), F.lit(0)).alias("gap_n"),
    )
    out = flags.withColumns(
        {
            "lengths_equal": F.col("ids_equal") & F.col("len_ok"),
            "sequence_equal_ignorecase": F.col("ids_equal") & F.col("seq_ok"),
            "lowercase_pct": F.coalesce(R.percent(F.col("lower_n"), F.col("total"), 3), F.lit(0.0)),
            "n_pct": F.coalesce(R.percent(F.col("gap_n"), F.col("total"), 3), F.lit(0.0)),
        }
    )
    return out.withColumn(
        "status",
        mask_gate(
            F.col("ids_equal"), F.col("lengths_equal"), F.col("sequence_equal_ignorecase"), F.col("lowercase_pct")
        ),
    ).drop("len_ok", "seq_ok")


def protein_flags(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Both definitions of internal stops and of ambiguous residues, side by side."""
    return df.withColumns(
        {
            "internal_ambiguity": R.internal_ambiguity(seq),
            "internal_stops_one": R.internal_stops(seq, "one"),
            "internal_stops_all": R.internal_stops(seq, "all"),
            "ambiguous_listed": R.ambiguous_residues(seq, "listed"),
            "ambiguous_alphabet": R.ambiguous_residues(seq, "alphabet"),
        }
    )


def protein_summary(df: DataFrame, keys: Sequence[str], id_col: str = "id", seq: str = "seq") -> DataFrame:
    """Records, truncated median length, repeated ids, ambiguous residues and internal stops per set.

    Sequences are read once; the three answers come from what is stored of each record.
    """
    rows = df.select(
        *keys,
        F.col(id_col).alias("id"),
        F.length(seq).cast("long").alias("len"),
        R.ambiguous_residues(seq).alias("amb"),
        R.internal_stops(seq).alias("stops"),
    )
    rows = materialize(rows, "records")
    sums = rows.groupBy(*keys).agg(
        F.count_if(F.col("len") > 0).alias("proteins"),
        F.sum("amb").alias("ambiguous_residues"),
        F.sum("stops").alias("internal_stops"),
    )
    ids = (
        rows.groupBy(*keys, "id")
        .agg((F.count("*") - 1).alias("extra"))
        .groupBy(*keys)
        .agg(F.sum("extra").alias("duplicate_ids"))
    )
    median = exact_median(rows.where("len > 0"), keys, "len", "m").select(
        *keys, F.col("m").cast("long").alias("protein_median_len")
    )
    return sums.join(ids, keys, "left").join(median, keys, "left")


def protein_lengths(df: DataFrame, seq: str = "seq") -> DataFrame:
    """Record lengths as rows (ordered by the caller's ordinal), never as one list per set."""
    return df.withColumn("aa", F.length(seq).cast("long")).drop(seq)


def pieces_of(df: DataFrame, keys: Sequence[str], seq: str = "seq", size: int = PIECE) -> DataFrame:
    """Cut whole records into ``keys, start, bases`` rows of at most ``size`` residues."""
    last = F.greatest(F.floor((F.length(seq) - 1) / size), F.lit(0))
    rows = df.where(F.length(seq) > 0).select(*keys, seq, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i"))
    return rows.select(
        *keys,
        (F.col("i") * size + 1).alias("start"),
        F.substring(F.col(seq), (F.col("i") * size + 1).cast("int"), F.lit(size)).alias("bases"),
    )


def mask_intervals(pieces: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Maximal lowercase runs, 1-based closed: ``keys, start, end``.

    Runs are found where the bases are read; only positions go on from there. Runs inside a piece are
    final. At most two per piece touch its ends; those alone meet their neighbours, see ``stitched``. A
    record of any length is many independent rows.
    """
    width = F.length("bases").cast("long")
    found = pieces.select(*keys, F.col("start").alias("piece"), width.alias("width"), lowercase_runs("bases").alias("runs"))
    first, last = F.col("piece"), F.col("piece") + F.col("width") - 1
    spans = found.select(*keys, "piece", "width", F.inline("runs")).select(
        *keys,
        (first + F.col("start") - 1).alias("start"),
        (first + F.col("end") - 1).alias("end"),
        ((F.col("start") == 1) | (F.col("end") == F.col("width"))).alias("border"),
    )
    spans = materialize(spans, "runs")
    return spans.where(~F.col("border")).drop("border").unionByName(stitched(spans.where("border").drop("border"), keys))


def sequence_window(df: DataFrame, regions: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Bases of ``start..end`` (1-based closed) from whole records.

    The regions of a record meet it together, so its residues move once and not once per region.
    """
    others = [c for c in regions.columns if c != key]
    packed = regions.groupBy(key).agg(F.collect_list(F.struct(*others)).alias("__regions"))
    met = df.join(packed, key).select(*df.columns, F.inline("__regions"))
    return met.withColumn(
        "bases", F.substring(F.col(seq), F.col("start").cast("int"), (F.col("end") - F.col("start") + 1).cast("int"))
    ).drop(seq)


BIN_SIZE = 4096


def piece_window(pieces: DataFrame, regions: DataFrame, keys: Sequence[str], bin_size: int = BIN_SIZE) -> DataFrame:
    """Parts of each region cut from pieces: ``keys, start, end, part_start, bases``.

    Parts stay rows; a region may be longer than any one value should be. Pieces and regions meet by record
    and stretch of ``bin_size`` bases, so a chromosome's pieces do not all meet all of its regions.
    """
    r = regions.withColumnRenamed("start", "r_start").withColumnRenamed("end", "r_end")
    width = F.length("bases").cast("long")

    def bins(first: Column, last: Column) -> Column:
        return F.sequence(F.floor((first - 1) / bin_size), F.floor((last - 1) / bin_size))

    p = pieces.where(width > 0).withColumn("__first", F.floor((F.col("start") - 1) / bin_size))
    p = p.withColumn("__bin", F.explode(bins(F.col("start"), F.col("start") + width - 1)))
    r = r.where("r_start <= r_end").withColumn("__r_first", F.floor((F.col("r_start") - 1) / bin_size))
    r = r.withColumn("__bin", F.explode(bins(F.col("r_start"), F.col("r_end"))))
    # A pair that shares several bins is taken in the first of them.
    hit = p.join(r, [*keys, "__bin"]).where(
        (F.col("start") <= F.col("r_end"))
        & (F.col("start") + width - 1 >= F.col("r_start"))
        & (F.col("__bin") == F.greatest("__first", "__r_first"))
    )
    first = F.greatest("start", "r_start")
    final = F.least(F.col("start") + width - 1, F.col("r_end"))
    return hit.select(
        *keys,
        F.col("r_start").alias("start"),
        F.col("r_end").alias("end"),
        first.alias("part_start"),
        F.substring(F.col("bases"), (first - F.col("start") + 1).cast("int"), (final - first + 1).cast("int")).alias("bases"),
    )


def check_regions(df: DataFrame, regions: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """Declared regions must be all soft-masked bases or all N, as ``expected`` says (soft / hard)."""
    lengths = df.groupBy(key).agg(F.max(F.length(seq).cast("long")).alias("seq_length"))
    return check_piece_regions(pieces_of(df, [key], seq), regions, [key], lengths)


def check_piece_regions(
    pieces: DataFrame, regions: DataFrame, keys: Sequence[str], lengths: DataFrame | None = None
) -> DataFrame:
    """``check_regions`` of records that come in pieces: regions meet the pieces of their stretch, and of what they
    find only two answers per part go on. Records are those of ``lengths`` (``keys, seq_length``), else those with a piece.
    """
    parts = piece_window(pieces, regions.select(*keys, "start", "end").distinct(), keys)
    found = parts.groupBy(*keys, "start", "end").agg(
        F.bool_and(F.col("bases").rlike("^[acgt]+$")).alias("__soft"), F.bool_and(F.col("bases").rlike("^N+$")).alias("__hard")
    )
    if lengths is None:
        last = F.max(F.col("start") + F.length("bases") - 1)
        lengths = pieces.groupBy(*keys).agg(last.cast("long").alias("seq_length"))
    met = regions.join(lengths, list(keys)).join(found, [*keys, "start", "end"], "left")
    inside = (F.col("start") >= 1) & (F.col("start") <= F.col("end")) & (F.col("end") <= F.col("seq_length"))
    as_declared = F.when(F.col("expected") == "soft", F.col("__soft")).otherwise(F.col("__hard"))
    outcome = F.when(~inside, F.lit("outside")).when(as_declared, F.lit("as_declared")).otherwise(F.lit("differs"))
    return met.withColumn("outcome", outcome).drop("__soft", "__hard")


def take_prefix(
    df: DataFrame, keys: Sequence[str], order: str, bucket: Column, max_bases: int, max_records: int, seq: str = "seq"
) -> DataFrame:
    """Which first records of each source fit a base budget, and how much of the last one.

    Works on lengths; join the chosen few back to their residues by id.
    """
    lengths = df.withColumn("len", F.length(seq).cast("long")).drop(seq)
    rows = running_sums(
        lengths, keys, [order], bucket, {"rec": F.lit(1).cast("long"), "before": F.col("len")}, inclusive=False
    )
    kept = rows.where((F.col("before") < max_bases) & (F.col("rec") < max_records))
    return kept.withColumn("taken", F.least(F.col("len"), F.lit(max_bases) - F.col("before")))


def id_only(df: DataFrame, header: str = "header") -> DataFrame:
    return df.withColumn("id", R.first_token(header))


def verify_same(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order, uniqueness and case-insensitive equality of a rewritten file, from numbered ``mask_facts``."""
    qc = mask_qc(before, after, keys).select(
        *keys, F.col("ids_equal").alias("order_equal"), "lengths_equal", "sequence_equal_ignorecase"
    )
    unique = (
        after.groupBy(*keys, "id").agg(F.count("*").alias("n")).groupBy(*keys).agg((F.max("n") == 1).alias("ids_unique"))
    )
    return qc.join(unique, list(keys), "left")
