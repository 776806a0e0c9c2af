"""Corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, mixing, packing.

A stage takes (spark, docs, sf_dir); all but the last return the columns of ``documents``. The result of a stage is
to be written before the next one is called, which deletes the working tables of the one before.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genomeloom.llm import lines, mixing, near, packing, quality
from genomeloom.llm.common import prepare, table
from genomeloom.session import give_back, materialize, written

# Tables that the stage before wrote for itself.
_left: list[str] = []


def tidy(stage):
    """Delete what the stage before wrote for itself: its result is stored by the time the next stage reads it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        give_back(spark, _left)
        _left.clear()
        before = set(written())
        out = stage(spark, docs, sf_dir)
        _left.extend(p for p in written() if p not in before)
        return out

    return run_stage


@tidy
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs of their language let pass."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@tidy
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later repeats of a run of lines taken out; n_chars follows the text."""
    prepare(spark)
    cleaned = lines.dedup_lines(docs)
    length = F.length("text").cast("long")
    return cleaned.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


@tidy
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    prepare(spark)
    return near.near_classes(docs).where("kept").select(*[f"`{c}`" for c in docs.columns])


@tidy
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture uses them: each at least once, none of a source more than MAX_REPEATS times over."""
    prepare(spark)
    return mixing.mix(docs).select(*[f"`{c}`" for c in docs.columns])


@tidy
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and their place in training sequences."""
    prepare(spark)
    return packing.pack(docs, packing.word_tokenizer())


STAGES = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]
# Sketches, token ids and permutations cannot be written in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before it kept, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
