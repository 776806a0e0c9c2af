"""What an evidence pointer can name in a file: read once per file, in Arrow batches."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Attributes of a feature file that a pointer may name.
GFF_ATTRIBUTES = ("protein_id", "Parent", "ID")

CONTENTS = T.StructType(
    [T.StructField("lines", T.LongType()), T.StructField("names", T.ArrayType(T.StringType()))]
)
_FASTA_ID = re.compile(r"^>\s*(\S+)", re.M)


def json_paths(text: str) -> list[str]:
    """Every dotted path of a document. List items count from both ends; a key with a dot cannot be named."""
    try:
        todo = [("", json.loads(text))]
    except ValueError:
        return []
    out = []
    while todo:
        prefix, value = todo.pop()
        if isinstance(value, dict):
            items = [(k, v) for k, v in value.items() if "." not in k]
        elif isinstance(value, list):
            items = [(str(i), v) for i, v in enumerate(value)]
            out += [f"{prefix}{i - len(value)}" for i in range(len(value))]
        else:
            continue
        out += [prefix + k for k, _ in items]
        todo += [(f"{prefix}{k}.", v) for k, v in items]
    return out


def names_in(file: str, text: str) -> list[str]:
    if file.endswith(".json"):
        return json_paths(text)
    if file.endswith((".fa", ".faa", ".fasta")):
        return _FASTA_ID.findall(text)
    if file.endswith((".gff", ".gff3")):
        return [a for a in GFF_ATTRIBUTES if f"{a}=" in text]
    return text.split("\n", 1)[0].split("\t") if text else []


@F.arrow_udf(CONTENTS)
def contents(file: pa.Array, text: pa.Array) -> pa.Array:
    """Number of lines and distinct names of each file; null where there is no text."""
    rows = []
    for name, body in zip(file.to_pylist(), text.to_pylist()):
        if body is None:
            rows.append(None)
            continue
        lines = body.count("\n") + (body != "" and not body.endswith("\n"))
        rows.append({"lines": lines, "names": sorted(set(names_in(name or "", body)))})
    return pa.array(rows, pa.struct([("lines", pa.int64()), ("names", pa.list_(pa.string()))]))
