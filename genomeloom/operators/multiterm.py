"""Many terms against many texts in one pass: an Aho-Corasick automaton over Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A term may stand anywhere, only beside other characters than letters and digits, or also not beside "_".
INSIDE, WORD, TOKEN = "inside", "word", "token"
RULES = (INSIDE, WORD, TOKEN)

# Bytes of terms that one automaton holds; a larger table is scanned for in slices of this size.
MAX_TERM_BYTES = 8 << 20

HITS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("token", T.StringType())]))


@functools.lru_cache(maxsize=4)
def _automaton(terms: tuple[tuple[str, str, str], ...]) -> ahocorasick.Automaton:
    """Built once per worker and slice; a term with several kinds is one entry."""
    entries: dict[str, list[tuple[str, str]]] = {}
    for term, kind, rule in terms:
        entries.setdefault(term.lower(), []).append((kind, rule))
    made = ahocorasick.Automaton()
    for term, uses in entries.items():
        made.add_word(term, (term, uses))
    made.make_automaton()
    return made


def _letter(char: str) -> bool:
    return "a" <= char <= "z" or "0" <= char <= "9"


def hits_of(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, str]]:
    """Distinct (kind, term) found in the text, in lower case, with the neighbours that the rule of the term allows."""
    low, found = text.lower(), set()
    for end, (term, uses) in automaton.iter(low):
        start = end - len(term) + 1
        near = (low[start - 1] if start else " ", low[end + 1] if end + 1 < len(low) else " ")
        letters = any(map(_letter, near))
        for kind, rule in uses:
            if rule == INSIDE or not (letters or (rule == TOKEN and "_" in near)):
                found.add((kind, term))
    return sorted(found)


def _scan(slice_: tuple):
    def scan(texts: pa.Array) -> pa.Array:
        automaton = _automaton(slice_.value)
        rows = [[{"kind": k, "token": t} for k, t in hits_of(x, automaton)] if x else [] for x in texts.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("token", pa.string())])))

    # Written out, as the annotations of a closure are strings that cannot be looked up.
    scan.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(scan, HITS)


def find_terms(df: DataFrame, keys: Sequence[str], text: Column | str, terms: DataFrame) -> DataFrame:
    """``keys, kind, token``: the terms (``term, kind, rule``) that each text holds, each once.

    The term table is read slice by slice and each slice sent to the workers; texts are read once per slice and
    never move. Empty terms and null ones say nothing.
    """
    spark = df.sparkSession
    known = terms.where((F.col("term") != "") & F.col("kind").isNotNull() & F.col("rule").isin(*RULES)).distinct()
    out, slice_, size = [], [], 0

    def flush():
        hits = _scan(spark.sparkContext.broadcast(tuple(slice_)))(text)
        out.append(df.select(*keys, F.inline(hits)))

    for row in known.select("term", "kind", "rule").toLocalIterator():
        slice_.append(tuple(row))
        size += len(row["term"].encode())
        if size >= MAX_TERM_BYTES:
            flush()
            slice_, size = [], 0
    if slice_ or not out:
        flush()
    return functools.reduce(DataFrame.unionByName, out)
