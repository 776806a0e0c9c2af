"""Registration of the runnable queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import tune


# Rows of these tables are texts that are costly to scan; one row group must not mean one task.
TEXT_TABLES = ("documents", "pages")


def balanced(df: DataFrame) -> DataFrame:
    """Spread rows over the cores when the scan itself yields fewer splits than that; otherwise no shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Tables:
    """Lazy access to the tables of one scale directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = tune(spark)
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return balanced(df) if name in TEXT_TABLES else df


@dataclass(frozen=True)
class Entry:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``covers`` lists inventory ids."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        REGISTRY[name] = Entry(name, tuple(covers.split()), run, sql, (fn.__doc__ or "").strip())
        return fn

    return register
