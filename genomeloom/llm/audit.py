"""How five filters interact: what each removes in any order, and what it would remove alone.

One pass over the texts marks each document with the filters it fails (a mask of five bits). Whether a text is a copy
of one with a smaller id is found by radix tries: each batch sends its distinct texts once, with the smallest id of
the batch, to a partition that holds a range of text prefixes. Prefixes are as long as they need to be: a prefix
that is too heavy for a partition is replaced by prefixes four times as long. A partition inserts its whole texts into
a compressed trie whose terminals hold the smallest id, and walks it to tell which batches held later copies.
Masks are then counted, and the counts of 32 masks give every figure of every order.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import prepare

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = b"#$%&*|"
COPY = 1 << FILTERS.index("E")

# Bytes of the shortest prefix, and how much longer the next one is.
SHORTEST, LONGER = 4, 4
# Bytes of text that a trie is to hold.
TRIE_BYTES = 48 << 20

_CONTINUED = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_MARKED = "key long, doc_id long, part string, mask int, first boolean, text binary, marks array<long>"


def mask_of(text: bytes) -> int:
    """The bits of filters A to D that a text fails."""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > MAX_UPPER_PERCENT * points) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def marks_of(text: bytes) -> list[int]:
    """Hashes of the prefixes of growing length, at last of the whole text."""
    out, size = [], SHORTEST
    while size < len(text):
        out.append(_signed(text[:size]))
        size *= LONGER
    return [*out, _signed(text)]


def _signed(data: bytes) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(data), "big", signed=True)


def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with its mask; of equal texts in a batch one row with the smallest id carries text and prefixes."""
    schema = pa.schema(
        [
            ("key", pa.int64()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()),
            ("first", pa.bool_()), ("text", pa.binary()), ("marks", pa.list_(pa.int64())),
        ]
    )
    key = TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        found: dict[bytes, list] = {}  # text -> key, mask, smallest id
        for doc_id, text in zip(ids, texts):
            seen = found.get(text)
            if seen is None:
                found[text] = [key, mask_of(text), doc_id]
                key += 1
            elif doc_id is not None and (seen[2] is None or doc_id < seen[2]):
                seen[2] = doc_id
        keys, masks, firsts, carried, marks = [], [], [], [], []
        for doc_id, text in zip(ids, texts):
            seen = found[text]
            lowest = doc_id is not None and doc_id == seen[2]
            bring = lowest and len(seen) == 3
            if bring:
                seen.append(True)
            keys.append(seen[0])
            masks.append(seen[1])
            firsts.append(lowest or doc_id is None)
            carried.append(text if bring else None)
            marks.append(marks_of(text) if bring else None)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()), batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()),
                pa.array(firsts, pa.bool_()), pa.array(carried, pa.binary()), pa.array(marks, schema.field("marks").type),
            ],
            schema=schema,
        )


class Node:
    """A place in the trie: edges by first byte, and what ends here."""

    __slots__ = ("edges", "lowest", "ends")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.lowest: int | None = None
        self.ends: list[tuple[int, int]] = []


class RadixTrie:
    def __init__(self):
        self.root = Node()

    def insert(self, text: bytes, key: int, doc_id: int) -> None:
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node()
                node.edges[text[at]] = (text[at:], leaf)
                node = leaf
                break
            label, below = edge
            if text.startswith(label, at):
                node, at = below, at + len(label)
                continue
            same = shared(label, text, at)
            middle = Node()
            middle.edges[label[same]] = (label[same:], below)
            node.edges[text[at]] = (label[:same], middle)
            node, at = middle, at + same
        node.ends.append((key, doc_id))
        node.lowest = doc_id if node.lowest is None else min(node.lowest, doc_id)

    def later(self) -> Iterator[int]:
        """Keys whose text ends at a terminal with a smaller id."""
        todo = [self.root]
        while todo:
            node = todo.pop()
            yield from (key for key, doc_id in node.ends if doc_id > node.lowest)
            todo.extend(below for _, below in node.edges.values())


def shared(label: bytes, text: bytes, at: int) -> int:
    """Length of what ``label`` and ``text`` from ``at`` on have in common; they differ somewhere in the label."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def later_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = RadixTrie()
    for batch in batches:
        for key, text, doc_id in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "doc_id"))):
            trie.insert(text, key, doc_id)
    keys = trie.later()
    while chunk := list(itertools.islice(keys, 1 << 16)):
        yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64())], ["key"])


def with_leaves(texts: DataFrame, partitions: int, limit: int) -> DataFrame:
    """Add ``leaf``: the shortest prefix that at most ``limit`` bytes of text begin with, or the whole text.

    At most total / limit prefixes of a length are heavier, so the tables of heavy ones are small.
    """
    depth, heavy = 0, None
    out = texts.withColumn("leaf", F.lit(None).cast("long"))
    inside = texts.select("marks", "size")
    while True:
        at = F.get("marks", F.lit(depth))
        sums = (
            inside.where(F.size("marks") > depth + 1)
            .groupBy(at.alias(f"heavy_{depth}"))
            .agg(F.sum("size").alias("bytes"))
            .where(F.col("bytes") > limit)
            .drop("bytes")
        )
        heavy = materialize(sums, "heavy-prefixes")
        few = F.broadcast(heavy)  # at most total / limit rows
        out = out.join(few, at == F.col(f"heavy_{depth}"), "left")
        light = F.col(f"heavy_{depth}").isNull() | (F.size("marks") <= depth + 1)
        out = out.withColumn("leaf", F.when(F.col("leaf").isNull() & light, at).otherwise(F.col("leaf"))).drop(
            f"heavy_{depth}"
        )
        if heavy.isEmpty():
            return out
        inside = inside.join(few, at == F.col(f"heavy_{depth}"), "left_semi")
        depth += 1


def failed_filters(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(doc_id, part, mask) for every row."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    )
    marked = materialize(rows.mapInArrow(mark, _MARKED), "marked")
    texts = marked.where("text IS NOT NULL").select(
        "key", "doc_id", "text", "marks", F.octet_length("text").cast("long").alias("size")
    )
    total = texts.agg(F.sum("size")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // trie_bytes))
    leaves = with_leaves(texts, partitions, max(1, total // (2 * partitions)))
    dealt = leaves.select("key", "doc_id", "text", "leaf", F.substring("text", 1, 16 * SHORTEST).alias("head"))
    dealt = dealt.repartitionByRange(partitions, "head", "leaf").select("key", "doc_id", "text")
    later = materialize(dealt.mapInArrow(later_keys, "key long"), "later")
    narrow = marked.select("key", "doc_id", "part", "mask", "first")
    known = narrow.where(~F.col("first")).select("doc_id", "part", F.col("mask").bitwiseOR(COPY).alias("mask"))
    open_rows = narrow.where("first").join(later.withColumn("late", F.lit(COPY)), "key", "left")
    late = F.when(F.col("doc_id").isNotNull(), F.coalesce("late", F.lit(0))).otherwise(0)
    return known.unionByName(open_rows.select("doc_id", "part", F.col("mask").bitwiseOR(late).alias("mask")))


def orders() -> list[dict]:
    """Every step of every order: the filter's bit, and the bits that went before."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return out


def interactions(masks: DataFrame) -> DataFrame:
    """The figures of all orders from (part, mask, n, good, toxic)."""
    cells = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    schema = "array<struct<filter_order:string,step:int,bit:int,before:int>>"
    wide = cells.withColumn("o", F.explode(F.from_json(F.lit(json.dumps(orders())), schema)))
    bit, before = F.col("o.bit"), F.col("o.before")

    def total(value: str, holds):
        return F.aggregate(
            "cells", F.lit(0).cast("long"), lambda s, c: s + F.when(holds(c["mask"]), c[value]).otherwise(0)
        )

    def here(mask):
        return (mask.bitwiseAND(bit) != 0) & (mask.bitwiseAND(before) == 0)

    figures = wide.select(
        "part",
        "o.filter_order",
        "o.step",
        bit.alias("bit"),
        total("n", lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("toxic", here).alias("toxic_lost"),
    )
    every_order = Window.partitionBy("part", "bit")
    return figures.withColumn("shapley", F.sum("removed").over(every_order)).drop("bit")


def audit(docs: DataFrame, labels: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per part, order and step; see ``interactions``.

    Null texts are empty. A null source is the part with the empty name. Rows without id are no copies and make no
    other row one; rows that repeat a (doc_id, text) are copies of neither. A document counts as good (toxic) if
    one of its labels says so; labels without document are left aside. Other columns are not looked at. An empty
    table gives an empty table.
    """
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    masks = (
        failed_filters(docs, trie_bytes)
        .join(said, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"),
        )
    )
    return interactions(masks)


def op12_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All 120 orders of the five filters for each source; see ``audit``."""
    return audit(docs, labels)


SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS x, coalesce(source, '') AS part,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda e: e <> '') AS w
  FROM documents
), masked AS (
  SELECT doc_id, part,
         (len(w) < {MIN_WORDS})::INT
         + 2 * (100 * len(list_distinct(w)) < {MIN_DISTINCT_PERCENT} * len(w))::INT
         + 4 * (100 * (length(x) - length(regexp_replace(x, '[A-Z]', '', 'g'))) > {MAX_UPPER_PERCENT} * length(x))::INT
         + 8 * regexp_matches(x, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false)::INT AS mask
  FROM d
), said AS (
  SELECT doc_id, max((coalesce(quality, 0) = 1)::INT) AS good, max((coalesce(toxic, 0) = 1)::INT) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), counted AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM masked LEFT JOIN said USING (doc_id) GROUP BY part, mask
), letters AS (SELECT unnest(range(5)) AS i, unnest(string_split('A,B,C,D,E', ',')) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), steps AS (
  SELECT filter_order, s AS step, (1 << (ascii(filter_order[s]) - 65))::INT AS bit,
         coalesce(list_sum(list_transform(range(1, s), lambda j: (1 << (ascii(filter_order[j]) - 65))::INT)), 0)::INT AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS s)
), figures AS (
  SELECT part, filter_order, step::INT AS step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM figures
"""
