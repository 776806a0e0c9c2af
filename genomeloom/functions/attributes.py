"""Ninth-column attribute parsing for GFF3 and GTF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(col: Column) -> Column:
    """Percent-decoding that leaves ``+`` and stray ``%`` alone."""
    decoded = F.coalesce(F.try_url_decode(F.regexp_replace(col, r"\+", "%2B")), col)
    return F.when(F.contains(col, F.lit("%")), decoded).otherwise(col)


def _items(col: Column) -> Column:
    """Parts with a ``=``."""
    return F.filter(F.split(col, ";"), lambda x: F.contains(x, F.lit("=")))


def attribute_map(col: Column | str) -> Column:
    """``k=v;k=v`` as a map. Items without ``=`` are skipped; of a repeated key the last value stays.

    Rows without a repeated key, nearly all, take the plain built-in.
    """
    value = F.col(col) if isinstance(col, str) else col
    text = F.array_join(_items(value), ";")
    plain = F.map_filter(F.str_to_map(text, F.lit(";"), F.lit("=")), lambda k, v: v.isNotNull())
    return F.when(_repeated(value), _last_of_each(value)).otherwise(plain)


def _repeated(value: Column) -> Column:
    keys = F.transform(_items(value), lambda x: F.substring_index(x, "=", 1))
    return F.size(F.array_distinct(keys)) < F.size(keys)


def _last_of_each(value: Column) -> Column:
    pairs = F.transform(_items(value), lambda x: F.split(x, "=", 2))
    kept = F.filter(
        F.transform(pairs, lambda p, i: F.struct(p[0].alias("k"), p[1].alias("v"), i.alias("i"))),
        lambda e: ~F.exists(F.slice(pairs, e["i"] + 2, F.size(pairs)), lambda later: later[0] == e["k"]),
    )
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["k"], e["v"])))


def bad_attributes(col: Column | str) -> Column:
    """True where an item has no ``=`` or a key is repeated (the strict scan rejects both)."""
    value = F.col(col) if isinstance(col, str) else col
    bare = F.exists(F.split(value, ";"), lambda x: (x != "") & (x != ".") & ~F.contains(x, F.lit("=")))
    return bare | _repeated(value)


def parent_list(attrs: Column) -> Column:
    """Parents: split on commas first, decode each afterwards."""
    raw = attrs["Parent"]
    names = F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda p: p != "")
    return F.when(F.contains(raw, F.lit("%")), F.transform(names, decode)).otherwise(names)


# The three ways a gene identifier is written in a GTF-like row.
GENE_ID_PATTERN = r'(?:^|;)\s*gene_id(?:\s*=\s*|\s+)(?:"([^"]+)"|([^;\s"]+))'
FEATURE_ID_PATTERN = r"(?:^|;)\s*ID=([^;\s]+)"
BARE_ID_PATTERN = r'^[^;\s="]+;?$'


def gtf_gene_id(kind: Column, attributes: Column) -> Column:
    """``struct<gene_id, format, problem>`` of a GTF row."""
    text = F.trim(attributes)
    explicit = F.coalesce(
        F.nullif(F.regexp_extract(text, GENE_ID_PATTERN, 1), F.lit("")),
        F.nullif(F.regexp_extract(text, GENE_ID_PATTERN, 2), F.lit("")),
    )
    n_explicit = F.regexp_count(text, F.lit(GENE_ID_PATTERN))
    feature = F.nullif(F.regexp_extract(text, FEATURE_ID_PATTERN, 1), F.lit(""))
    n_feature = F.regexp_count(text, F.lit(FEATURE_ID_PATTERN))
    bare = F.when(
        (text != ".") & text.rlike(BARE_ID_PATTERN), F.regexp_replace(text, ";+$", "")
    )
    is_gene = kind == "gene"
    return F.struct(
        F.when(n_explicit == 1, explicit)
        .when(n_explicit > 1, None)
        .when(is_gene & (n_feature <= 1), F.coalesce(feature, bare))
        .alias("gene_id"),
        F.when(n_explicit == 1, F.lit("gene_id_attribute"))
        .when(n_explicit > 1, None)
        .when(is_gene & (n_feature == 1), F.lit("gene_feature_ID"))
        .when(is_gene & (n_feature == 0) & bare.isNotNull(), F.lit("bare_gene_feature_ID"))
        .alias("format"),
        F.when(n_explicit > 1, F.lit("repeated_gene_id"))
        .when(is_gene & (n_explicit == 0) & (n_feature > 1), F.lit("repeated_feature_id"))
        .when(is_gene & (n_explicit == 0) & (n_feature == 0) & bare.isNull(), F.lit("no_identifier"))
        .alias("problem"),
    )
