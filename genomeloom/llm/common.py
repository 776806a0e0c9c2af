"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

# Characters that separate words, as a Java class and as plain text.
SPACES = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = f"[^{SPACES}]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators count on: texts differ in length, so a batch for Python is bounded in bytes."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, outputs: Sequence[str]) -> DataFrame:
    """Drop input columns that an operator is about to produce itself, whatever their letter case."""
    taken = {c.lower() for c in outputs}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def whole_text(name: str = "text") -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable.

    A column that several branches of a higher-order expression mention would otherwise be
    computed again at each mention, inside loops once per element.
    """
    return F.transform(F.array(value), body)[0]


def unit_interval(*parts: Column | str | int) -> Column:
    """A number in [0, 1) that depends on nothing but ``parts``: the same on every retry."""
    cols = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)
