"""Hit tables to functional annotation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spread import top_row

# Annotation sources in report order.
SOURCES = ("Nr", "Swissprot", "KEGG", "KOG", "TrEMBL", "Interpro", "GO")
HIT_SOURCES = SOURCES[:5]


def filter_hits(hits: DataFrame, qcov: float = 50.0) -> DataFrame:
    return hits.where(F.col("qcovhsp") >= qcov)


def best_hit(hits: DataFrame, keys: Sequence[str] = ("qseqid",), keep: Sequence[str] | None = None) -> DataFrame:
    """Best hit per query: bit score, then smaller e-value, coverage, largest subject id."""
    order = [F.col("bitscore"), -F.col("evalue"), F.col("qcovhsp"), F.col("sseqid")]
    return top_row(hits, keys, order, keep)


def near_top(
    hits: DataFrame, keys: Sequence[str] = ("qseqid",), fraction: float = 0.05, unit: str = "hits"
) -> DataFrame:
    """``keys, top, close, ambiguous``: more than one hit within ``fraction`` of the best score.

    ``unit="subjects"`` counts different subjects instead of hits. The top score
    per query is a partial aggregate; the hits then meet one row per query, and
    only those near the top go into the second aggregate.
    """
    top = hits.groupBy(*keys).agg(F.max("bitscore").alias("top"))
    close = hits.join(top, list(keys)).where(F.col("bitscore") >= F.col("top") * (1 - fraction))
    counted = F.count("*") if unit == "hits" else F.count_distinct("sseqid")
    return close.groupBy(*keys).agg(F.max("top").alias("top"), counted.alias("close")).withColumn(
        "ambiguous", F.col("close") > 1
    )


def annotate_best(best: DataFrame, annot: DataFrame) -> DataFrame:
    """Best hits with the annotation of their subject; ``annotated`` tells a missing row from an empty text.

    The annotation table may be far larger than its files let the optimizer expect (ids made by ``explode``), so it is
    merged and never sent whole to the driver and every executor.
    """
    table = annot.select(F.col("id").alias("sseqid"), "annot", F.lit(True).alias("__found"))
    return best.join(table.hint("merge"), "sseqid", "left").withColumns(
        {"annotated": F.coalesce("__found", F.lit(False)), "annot": F.coalesce("annot", F.lit(""))}
    ).drop("__found")


def missing_annotations(annotated: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct best subjects without an annotation row."""
    subjects = annotated.groupBy(*keys, "sseqid").agg(F.bool_or("annotated").alias("annotated"))
    return subjects.groupBy(*keys).agg(F.count_if(~F.col("annotated")).alias("annot_missing_ids"))


def protein_terms(domains: DataFrame, column: str = "terms") -> DataFrame:
    """Distinct ``protein, term`` pairs."""
    return domains.select("protein", F.explode(column).alias("term")).distinct()


def domain_sets(domains: DataFrame) -> DataFrame:
    """Sorted domain and term lists of each protein.

    Sets grow where the rows are read and meet once: a set is bounded by the vocabulary, however many rows a protein has.
    """
    rows = domains.select(
        "protein",
        F.explode_outer(
            F.concat(
                F.transform("domains", lambda d: F.struct(F.lit("D").alias("k"), d.alias("v"))),
                F.transform("terms", lambda g: F.struct(F.lit("T").alias("k"), g.alias("v"))),
            )
        ).alias("p"),
    )
    return rows.groupBy("protein").agg(
        F.array_sort(F.collect_set(F.when(F.col("p.k") == "D", F.col("p.v")))).alias("domains"),
        F.array_sort(F.collect_set(F.when(F.col("p.k") == "T", F.col("p.v")))).alias("terms"),
    )


def flag_matrix(queries: DataFrame, hits: DataFrame, domains: DataFrame) -> DataFrame:
    """One row per query with seven 0/1 flags and the joined domain and term lists.

    ``hits`` carries ``source`` and ``qseqid`` after filtering. All sources fold
    into flags in one aggregate instead of one join per source.
    """
    seen = hits.groupBy(F.col("qseqid").alias("query")).agg(
        *[F.max(F.when(F.col("source") == s, 1).otherwise(0)).alias(s) for s in HIT_SOURCES]
    )
    sets = domain_sets(domains).select(
        F.col("protein").alias("query"),
        (F.size("domains") > 0).cast("int").alias("Interpro"),
        (F.size("terms") > 0).cast("int").alias("GO"),
        F.array_join("domains", ";").alias("ipr_list"),
        F.array_join("terms", ";").alias("go_list"),
    )
    rows = queries.select("query").join(seen, "query", "left").join(sets, "query", "left")
    return rows.fillna(0, list(SOURCES)).fillna("", ["ipr_list", "go_list"])


def annotation_stats(flags: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] = SOURCES) -> DataFrame:
    """Per-flag n and percent over all queries, plus Any and None (0 for an empty query set)."""
    any_flag = F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])
    counts = flags.groupBy(*keys).agg(
        F.count("*").alias("total_queries"),
        *[F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(f"{c}_n") for c in columns],
        F.coalesce(F.sum(any_flag.cast("long")), F.lit(0)).alias("any_n"),
    )
    pct = {f"{c}_pct": _pct(F.col(f"{c}_n"), F.col("total_queries")) for c in columns}
    return counts.withColumns(
        {**pct, "any_pct": _pct(F.col("any_n"), F.col("total_queries")), "none_n": F.col("total_queries") - F.col("any_n")}
    )


def _pct(n, total):
    return F.round(F.coalesce(F.try_divide(F.lit(100.0) * n, total.cast("double")), F.lit(0.0)), 2)


def annotation_overlap(flags: DataFrame, columns: Sequence[str] = SOURCES) -> DataFrame:
    """Number of queries per flag combination."""
    return flags.groupBy(*columns).agg(F.count("*").alias("count"))


def validate_integration(flags: DataFrame, queries: DataFrame, expected: int | None = None) -> DataFrame:
    """Self-checks of the integrated table; a technical PASS says nothing about the biology."""
    rows = flags.groupBy("query").agg(F.count("*").alias("n")).join(
        queries.groupBy("query").agg(F.count("*").alias("q")), "query", "full_outer"
    )
    complete = F.lit(True)
    for c in SOURCES:
        complete = complete & F.col(c).isin(0, 1)
    checks = rows.agg(
        F.bool_and(F.col("n").eqNullSafe(F.col("q"))).alias("all_queries_one_row"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("q"), F.lit(0)).alias("queries"),
    ).join(flags.agg(F.coalesce(F.bool_and(complete), F.lit(True)).alias("seven_flags_complete")), F.lit(True))
    goal = F.lit(expected) if expected is not None else F.col("queries")
    out = checks.withColumn("denominator_is_total", F.col("rows") == goal)
    passed = F.col("all_queries_one_row") & F.col("denominator_is_total") & F.col("seven_flags_complete")
    return out.withColumn("status", F.when(passed, "PASS").otherwise("FAIL"))


def coverage(queries: DataFrame, table: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Exact-id coverage: queries with any flag set over all queries; ids must match to the letter."""
    any_flag = F.lit(False)
    for c in flags:
        any_flag = any_flag | (F.col(c) == 1)
    by_id = table.groupBy(*keys, "query").agg(
        F.coalesce(F.bool_or(any_flag), F.lit(False)).alias("annotated"), F.count("*").alias("rows")
    )
    totals = by_id.groupBy(*keys).agg(
        F.sum("rows").alias("annotation_rows"), F.count_if(F.col("rows") > 1).alias("repeated_ids")
    )
    joined = queries.select(*keys, "query").join(by_id, [*keys, "query"], "left")
    out = (
        joined.groupBy(*keys)
        .agg(
            F.count("*").alias("query_proteins"),
            F.count_if(F.col("annotated")).alias("annotated_query_proteins"),
        )
        .join(totals, list(keys), "left")
        .fillna(0, ["annotation_rows", "repeated_ids"])
    )
    return out.withColumn(
        "annotation_coverage_pct",
        F.round(F.try_divide(F.lit(100.0) * F.col("annotated_query_proteins"), F.col("query_proteins")), 6),
    )
