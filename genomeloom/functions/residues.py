"""Character-class counts and transforms over sequence columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Residue classes the checks are defined on.
SOFT_ACGT = "[acgt]"
SOFT_ANY = r"\p{Ll}"
GAP = "[Nn]"
PROTEIN_AMBIGUOUS = "[XBZJUO]"
PROTEIN_OUTSIDE = "[^ACDEFGHIKLMNPQRSTVWY*]"


def clean(col: Column | str) -> Column:
    """Residues only: whitespace and record markers removed."""
    return F.regexp_replace(col, r"[\s>]", "")


def count_of(col: Column | str, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern)).cast("long")


def lowercase_count(col: Column | str, lower: str = "acgt") -> Column:
    """Soft-masked residues: ``acgt`` counts the four bases, ``any`` every lowercase letter."""
    return count_of(col, _soft(lower))


def gap_count(col: Column | str) -> Column:
    return count_of(col, GAP)


def masked_sites(col: Column | str, lower: str = "acgt") -> Column:
    """Lowercase or N/n; a lowercase n is one site, not two."""
    return count_of(col, f"{_soft(lower)}|{GAP}")


def _soft(lower: str) -> str:
    if lower not in ("acgt", "any"):
        raise ValueError("lower is 'acgt' or 'any'")
    return SOFT_ACGT if lower == "acgt" else SOFT_ANY


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """100 * part / whole, null for an empty denominator."""
    value = F.try_divide(F.lit(100.0) * part, whole.cast("double"))
    return value if digits is None else F.round(value, digits)


def hard_mask(col: Column | str) -> Column:
    return F.regexp_replace(col, SOFT_ACGT, "N")


def unmask(col: Column | str) -> Column:
    return F.upper(col)


def without_terminal_stop(col: Column | str) -> Column:
    return F.regexp_replace(col, r"\*$", "")


def internal_ambiguity(col: Column | str) -> Column:
    """``.`` and ``*`` left after dropping one terminal stop."""
    return count_of(without_terminal_stop(col), "[.*]")


def internal_stops(col: Column | str, strip: str = "one") -> Column:
    """Stops that are not terminal; ``one`` forgives a single trailing stop, ``all`` every one."""
    if strip == "one":
        seq = F.col(col) if isinstance(col, str) else col
        return F.greatest(
            count_of(seq, r"\*") - F.when(seq.endswith("*"), 1).otherwise(0), F.lit(0)
        ).cast("long")
    if strip == "all":
        return count_of(F.regexp_replace(col, r"\*+$", ""), r"\*")
    raise ValueError("strip is 'one' or 'all'")


def ambiguous_residues(col: Column | str, mode: str = "listed") -> Column:
    """``listed``: one of XBZJUO. ``alphabet``: outside the twenty letters and the stop."""
    if mode == "listed":
        return count_of(col, PROTEIN_AMBIGUOUS)
    if mode == "alphabet":
        return count_of(col, PROTEIN_OUTSIDE)
    raise ValueError("mode is 'listed' or 'alphabet'")


def first_token(col: Column | str) -> Column:
    """Record id: the header up to its first whitespace."""
    return F.regexp_extract(col, r"^\s*(\S*)", 1)


def wrap(col: Column | str, width: int) -> Column:
    """Break a sequence every ``width`` characters, with no trailing newline."""
    lines = F.regexp_replace(col, f"(.{{{width}}})", "$1\n")
    return F.regexp_replace(lines, r"\n$", "")
