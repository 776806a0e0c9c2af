"""Prediction by partial matching over bytes.

Training counts every symbol after every context of up to ``ORDER`` bytes in all training texts: the
nodes of a context trie, gathered by Spark as packed numbers. A symbol that its context has not seen is
reached by escapes: an escape from a context has its number of distinct symbols as weight (against the
total of their counts), and symbols that the longer context has seen are excluded below it. Since
the symbols of a context are among those of its suffix, what is excluded at an order depends on the
longer context alone, so all denominators are aggregates of the trie and are computed once. The end
of a text is a symbol. Below the empty context every symbol left is as likely as any other.

What a place of a text adds to its score depends on the place's gram alone, the last ``ORDER`` + 1 symbols. So Spark
computes one value for every distinct gram of all texts, by joins with the trie. The grams that are used most, as many as
a worker holds, are read by each scoring task once; places with any other gram leave the task and meet its value by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch
from .common import whole_text

ORDER = 5
BITS = 9  # of a symbol: 256 bytes, the end, and the place before a text
END, BEFORE = 256, 257
SYMBOLS = 257
# Symbols that are handled at once, grams that a worker holds, and tokens of a chunk: these bound a task's memory.
CHUNK_SYMBOLS = 1 << 19
TRAIN_SYMBOLS = 1 << 20
SHARD_NODES = 4_000_000
CHUNK_TOKENS = 1_000_000
CHUNK_TEXTS = 1 << 16
ODD = np.uint64(0x9E3779B97F4A7C15)


def low_bits(symbols: int) -> int:
    return (1 << (BITS * symbols)) - 1


# --- texts as numbers ---------------------------------------------------------------------------


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The last order + 1 symbols at every place of the texts, packed; and where each text begins."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths + order)])[:-1]
    symbols = np.full(int((lengths + order).sum()), BEFORE, np.int64)
    ends = starts + order + lengths - 1
    filled = np.ones(len(symbols), bool)
    for i in range(order):
        filled[starts + i] = False
    filled[ends] = False
    symbols[filled] = np.frombuffer(b"".join(texts), np.uint8)
    symbols[ends] = END
    packed = symbols[: len(symbols) - order].copy()
    for i in range(1, order + 1):
        packed = (packed << BITS) | symbols[i : len(symbols) - order + i]
    # Places that only hold the context of the next text are left out.
    first = starts  # of each text, in places shifted by ``order``
    real = np.ones(len(packed), bool)
    for i in range(1, order + 1):
        at = first[1:] - i
        real[at] = False
    return packed[real], np.concatenate([[0], np.cumsum(lengths)])[:-1]


def _bundles(texts: Iterator[tuple[list, list[bytes]]], symbols: int) -> Iterator[tuple[list, list[bytes]]]:
    """Join batches of (tags, texts) until there are enough symbols. A-Z are lowered, all other bytes stay."""
    tags, held, size = [], [], 0
    for more_tags, more in texts:
        for tag, text in zip(more_tags, more, strict=True):
            tags.append(tag)
            held.append(text.lower())
            size += len(text) + 1
            if size >= symbols:
                yield tags, held
                tags, held, size = [], [], 0
    if held:
        yield tags, held


# --- training -----------------------------------------------------------------------------------


def summed(gram: np.ndarray, n: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted grams, each once, with the sums of their counts."""
    order = np.argsort(gram)
    gram = gram[order]
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    return gram[first], np.add.reduceat(n[order], first), np.add.reduceat(uses[order], first)


def count_grams(texts: DataFrame, order: int) -> DataFrame:
    """(gram, n, uses) over the texts (text binary, learn boolean): ``uses`` in all of them, ``n`` in those to learn from."""

    def bundle(learn: list[bool], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        packed, starts = grams(texts, order)
        own = np.repeat(np.array(learn, np.uint64), np.diff(starts, append=len(packed)))
        marked, uses = np.unique(packed.view(np.uint64) << np.uint64(1) | own, return_counts=True)
        n = np.where(marked & np.uint64(1), uses, 0)
        return (marked >> np.uint64(1)).view(np.int64), n, uses

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = ((b.column(1).to_pylist(), b.column(0).to_pylist()) for b in batches)
        held, size = [], 0
        for learn, texts in _bundles(whole, TRAIN_SYMBOLS):
            held.append(bundle(learn, texts))
            size += len(held[-1][0])
            if size >= TRAIN_SYMBOLS:
                held = [summed(*map(np.concatenate, zip(*held, strict=True)))]
                size = len(held[0][0])
                if size >= TRAIN_SYMBOLS // 2:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["gram", "n", "uses"])
                    held, size = [], 0
        if held:
            held = summed(*map(np.concatenate, zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, held)), ["gram", "n", "uses"])

    counted = texts.mapInArrow(count, "gram long, n long, uses long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))


class Model:
    """Values of all grams: the path of those that a worker holds, and the others (None if there are none)."""

    def __init__(self, path: str, others: DataFrame | None, order: int):
        self.path, self.others, self.order = path, others, order


def suffix(gram: str, symbols: Column | int) -> Column:
    """The last symbols of a packed number."""
    masks = F.array(*[F.lit(low_bits(i)).cast("bigint") for i in range(64 // BITS + 1)])
    return F.col(gram).bitwiseAND(F.get(masks, symbols if isinstance(symbols, Column) else F.lit(symbols)))


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Count, compute the denominators, and write the value of every gram of the texts (text, learn) to the shared folder."""
    spark = texts.sparkSession
    used = materialize(count_grams(texts, order), "grams")
    level = used.where("n > 0").select("gram", "n")
    parts = [level.select(F.lit(order).alias("k"), "gram", "n")]
    for k in range(order - 1, -1, -1):
        level = level.groupBy(suffix("gram", k + 1).alias("gram")).agg(F.sum("n").alias("n"))
        parts.append(level.select(F.lit(k).alias("k"), "gram", "n"))
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)
    nodes = materialize(nodes.withColumn("context", F.shiftright("gram", BITS)), "nodes")
    contexts = nodes.groupBy("k", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    contexts = materialize(contexts, "contexts")
    # What a context has seen, counted at its suffix.
    longer = nodes.where("k > 0").select(
        (F.col("k") - 1).alias("k"), suffix("gram", F.col("k")).alias("gram"), F.col("context").alias("child")
    )
    seen = (
        longer.join(nodes.select("k", "gram", "n"), ["k", "gram"])
        .groupBy((F.col("k") + 1).alias("k"), F.col("child").alias("context"))
        .agg(F.sum("n").alias("seen_below"))
    )
    below = contexts.select(
        (F.col("k") + 1).alias("k"),
        F.col("context").alias("suffix"),
        F.col("total").alias("total_below"),
        F.col("kinds").alias("kinds_below"),
    )
    left = F.col("kinds_below") - F.col("kinds")
    weight = F.col("total_below") - F.col("seen_below") + left
    links = (
        contexts.join(seen, ["k", "context"], "left")
        .withColumn("suffix", suffix("context", F.col("k") - 1))
        .join(below, ["k", "suffix"], "left")
        .select(
            "k",
            "context",
            F.log10(F.col("kinds") / (F.col("total") + F.col("kinds"))).alias("leave"),
            F.when(left > 0, F.log10(weight.cast("double"))).otherwise(F.lit(0.0)).alias("weight"),
            F.when(left > 0, F.log10(left / weight)).otherwise(F.lit(0.0)).alias("pass"),
            F.log10((F.col("total") + F.col("kinds")).cast("double")).alias("whole"),
        )
    )
    links = materialize(links, "links")
    root = contexts.where("k = 0").select("kinds").first()
    known = (
        used.where("n > 0")
        .withColumn("context", F.shiftright("gram", BITS))
        .join(links.where(F.col("k") == order).select("context", "whole"), "context")
        .select("gram", "uses", (F.log10(F.col("n").cast("double")) - F.col("whole")).alias("value"))
    )
    missed = used.where("n = 0").select("gram", "uses")
    values = known.unionByName(missed_values(missed, nodes, links, order, SYMBOLS - (root[0] if root else 0)))
    return held_apart(values.withColumn("often", often("uses")).drop("uses"), order)


# Orders whose nodes and contexts are few whatever the corpus: 257 symbols after 258 contexts.
LOW = 2


def missed_values(missed: DataFrame, nodes: DataFrame, links: DataFrame, order: int, left: int) -> DataFrame:
    """(gram, uses, value) of grams (gram, uses) that training has not seen; below the empty context ``left`` symbols are left.

    From the highest order down: the first context that is known is left, contexts below it pass a symbol on that they
    have not seen either, and the first node ends it.
    """

    def met(low: bool) -> DataFrame:
        orders = F.col("k") < LOW if low else F.col("k") >= LOW
        few = F.broadcast if low else lambda df: df
        ks = [F.lit(k) for k in range(order + 1) if (k < LOW) == low]
        at = missed.withColumn("k", F.explode(F.array(*ks) if ks else F.array().cast("array<int>")))
        at = at.withColumn("part", suffix("gram", F.col("k") + 1)).withColumn("context", F.shiftright("part", BITS))
        node = nodes.where(orders).select("k", F.col("gram").alias("part"), F.log10(F.col("n").cast("double")).alias("a"))
        return at.join(few(node), ["k", "part"], "left").join(few(links.where(orders)), ["k", "context"], "left")

    step = F.struct("k", "a", "leave", "weight", "pass", "whole").alias("step")
    steps = met(True).unionByName(met(False)).select("gram", "uses", step)
    start = F.struct(
        F.lit(0.0).alias("out"),
        F.lit(None).cast("double").alias("weight"),
        F.lit(0.0).alias("pass"),
        F.lit(False).alias("ended"),
    )

    def down(state: Column, step: Column) -> Column:
        node = step["a"] - F.coalesce(state["weight"], step["whole"])
        leave = F.when(state["weight"].isNull(), F.coalesce(step["leave"], F.lit(0.0))).otherwise(F.lit(0.0))
        added = F.when(state["ended"], F.lit(0.0)).otherwise(F.coalesce(node, state["pass"] + leave))
        return F.struct(
            (state["out"] + added).alias("out"),
            F.coalesce(step["weight"], state["weight"]).alias("weight"),
            F.coalesce(step["pass"], state["pass"]).alias("pass"),
            (state["ended"] | step["a"].isNotNull()).alias("ended"),
        )

    def end(state: Column) -> Column:
        return state["out"] - F.when(state["ended"], F.lit(0.0)).otherwise(F.lit(math.log10(max(1, left))))

    walked = steps.groupBy("gram").agg(F.first("uses").alias("uses"), F.collect_list("step").alias("steps"))
    return walked.select("gram", "uses", F.aggregate(F.sort_array("steps", asc=False), start, down, end).alias("value"))


def often(uses: str) -> Column:
    """Classes that grow with the number of uses: each number up to 1023 is one, then 128 to an octave."""
    return F.when(F.col(uses) < 1024, F.col(uses)).otherwise(F.floor(F.log2(F.col(uses).cast("double")) * 128)).cast("int")


def held_apart(values: DataFrame, order: int) -> Model:
    """Store the values (gram, value, often) and choose the classes of use that a worker holds."""
    spark = values.sparkSession
    path = scratch(spark, "values")
    values.write.parquet(path)
    values = spark.read.schema(values.schema).parquet(path)
    sizes = values.groupBy("often").count().orderBy(F.desc("often")).collect()
    held, least = 0, None
    for often_, n in sizes:
        if held + n > SHARD_NODES:
            least = often_ + 1
            break
        held += n
    if least is None:
        return Model(path, None, order)
    path = scratch(spark, "held-values")
    values.where(F.col("often") >= least).select("gram", "value").write.parquet(path)
    return Model(path, values.where(F.col("often") < least).select("gram", "value"), order)


# --- scoring ------------------------------------------------------------------------------------


class Values:
    """Open addressing over whole arrays: gram -> value."""

    FREE = np.int64(-1)

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, math.ceil(math.log2(1.5 * len(keys) + 1)))
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, self.FREE)
        self.values = np.zeros(1 << bits)
        for first in range(0, len(keys), 1 << 17):  # in slices: the work space stays small
            part, own = keys[first : first + (1 << 17)], values[first : first + (1 << 17)]
            at, open_ = self._home(part), np.arange(len(part))
            while len(open_):
                place = at[open_]
                empty = self.keys[place] == self.FREE
                self.keys[place[empty]] = part[open_[empty]]
                won = self.keys[place] == part[open_]
                self.values[place[won]] = own[open_[won]]
                open_ = open_[~won]
                at[open_] = (at[open_] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * ODD) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, 0 where there is none; and the places of those without."""
        at = self._home(keys)
        got, out = self.keys[at], self.values[at]
        open_ = np.flatnonzero(got != keys)
        at, got, keys = at[open_], got[open_], keys[open_]
        none = [open_[:0]]
        while len(open_):
            free = got == self.FREE
            none.append(open_[free])
            more = np.flatnonzero(~free)
            open_, keys, at = open_[more], keys[more], (at[more] + 1) & self.mask
            got = self.keys[at]
            out[open_] = self.values[at]
            more = np.flatnonzero(got != keys)
            open_, keys, at, got = open_[more], keys[more], at[more], got[more]
        none = np.concatenate(none)
        out[none] = 0.0
        return out, none


def read_values(path: str) -> Values:
    import pyarrow.fs
    import pyarrow.parquet

    files, place = pyarrow.fs.FileSystem.from_uri(path)
    data = pyarrow.parquet.read_table(place, filesystem=files, partitioning=None, columns=["gram", "value"])
    keys, values = data["gram"].to_numpy(), data["value"].to_numpy()
    del data
    table = Values(keys, values)
    del keys, values
    pa.default_memory_pool().release_unused()
    return table


def score_texts(rows: DataFrame, model: Model) -> DataFrame:
    """(row, score, gram) of texts (row long, text binary): a text's log10 probability, with its end, as far as the worker
    holds the values; and a row for each place with another gram, without score."""
    path, order = model.path, model.order

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = None
        source = ((b.column(0).to_pylist(), b.column(1).to_pylist()) for b in batches)
        for tags, texts in _bundles(source, CHUNK_SYMBOLS):
            values = values or read_values(path)
            packed, starts = grams(texts, order)
            found, other = values.find(packed)
            tags = np.array(tags, np.int64)
            nothing = pa.nulls(len(tags), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(tags), pa.array(np.add.reduceat(found, starts)), nothing], ["row", "score", "gram"]
            )
            if len(other):
                text = np.searchsorted(starts, other, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tags[text]), pa.nulls(len(other), pa.float64()), pa.array(packed[other])],
                    ["row", "score", "gram"],
                )

    return rows.mapInArrow(score, "row long, score double, gram long")


def whole_scores(rows: DataFrame, model: Model) -> DataFrame:
    """(row, score) of texts (row long, text binary)."""
    scored = score_texts(rows, model)
    if model.others is None:
        return scored.select("row", "score")
    scored = materialize(scored, "scored")
    met = scored.where("gram is not null").select("row", "gram").join(model.others, "gram")
    met = met.select("row", F.col("value").alias("score"))
    return scored.where("gram is null").select("row", "score").unionByName(met).groupBy("row").agg(F.sum("score").alias("score"))


# --- word base ----------------------------------------------------------------------------------


class Vocabulary(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def word_uses(rows: DataFrame) -> DataFrame:
    """(word, base, train, uses) of rows (row, text, learn): a word's uses in a chunk of neighbouring rows.

    ``uses`` packs pairs (row - base, count) of 16 bits each; ``train`` is its count in rows to learn from.
    """

    def flush(vocabulary, numbers, sizes, learn, base) -> pa.RecordBatch:
        text = np.repeat(np.arange(len(sizes)), sizes)
        pairs, n = np.unique(np.concatenate(numbers) << 16 | text, return_counts=True)
        over = (n - 1) // 65535  # a count beyond 16 bits is written as several pairs
        pairs, parts = np.repeat(pairs, over + 1), np.full(len(n) + int(over.sum()), 65535, np.int64)
        parts[np.cumsum(over + 1) - 1] = n - 65535 * over
        word, at = pairs >> 16, pairs & 0xFFFF
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        packed = np.stack([at, parts], 1).astype("<u2").tobytes()
        offsets = np.concatenate([4 * first, [len(packed)]]).astype(np.int32)
        train = np.add.reduceat(np.where(np.array(learn, bool)[at], parts, 0), first)
        words = pa.array(list(vocabulary), pa.binary())  # in order of their numbers
        uses = pa.Array.from_buffers(
            pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
        )
        return pa.RecordBatch.from_arrays(
            [words, pa.array(np.full(len(first), base)), pa.array(train.astype(np.int64)), uses],
            ["word", "base", "train", "uses"],
        )

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def empty():
            return Vocabulary(), [], [], [], None

        vocabulary, numbers, sizes, learn, base = empty()
        tokens = 0
        for batch in batches:
            for row, text, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if base is not None and row - base >= CHUNK_TEXTS or tokens >= CHUNK_TOKENS:
                    if tokens:
                        yield flush(vocabulary, numbers, sizes, learn, base)
                    vocabulary, numbers, sizes, learn, base = empty()
                    tokens = 0
                base = row if base is None else base
                words = text.lower().split()
                while len(sizes) < row - base:
                    sizes.append(0)
                    learn.append(False)
                numbers.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
                sizes.append(len(words))
                learn.append(own)
                tokens += len(words)
        if tokens:
            yield flush(vocabulary, numbers, sizes, learn, base)

    return rows.mapInArrow(collect, "word binary, base long, train long, uses binary")


def word_gains(uses: DataFrame) -> DataFrame:
    """(row, gain, known, words) of every row with words; and rows without ``row`` that hold kinds and tokens of the training.

    A word's rows, one per chunk, meet to learn its count c; a chunk's words, bounded like the chunk, meet to be summed:
    gain is the sum of log10(c + 1), known the words with c > 0.
    """
    pair = np.dtype([("at", "<u2"), ("n", "<u2")])
    word = Window.partitionBy("word")
    counted = uses.select(
        "base",
        "uses",
        "train",
        F.sum("train").over(word).alias("c"),
        (F.min("base").over(word) == F.col("base")).alias("first"),
    )

    def total(chunk: pa.Table) -> pa.Table:
        c, train = chunk["c"].to_numpy(), chunk["train"].to_numpy()
        blobs = chunk["uses"].to_pylist()
        pairs = np.frombuffer(b"".join(blobs), pair)
        per_word = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        n, at = pairs["n"].astype(np.float64), pairs["at"]
        width = int(at.max()) + 1
        words = np.bincount(at, n, width)
        gain = np.bincount(at, n * np.repeat(np.log10(c + 1.0), per_word), width)
        known = np.bincount(at, n * np.repeat(c > 0, per_word), width)
        there = np.flatnonzero(words)
        rows = [*(there + chunk["base"][0].as_py()).tolist(), None]
        kinds = int((chunk["first"].to_numpy(zero_copy_only=False) & (c > 0)).sum())
        nothing = [0] * len(there)
        return pa.table(
            {
                "row": pa.array(rows, pa.int64()),
                "gain": [*gain[there].tolist(), 0.0],
                "known": pa.array([*known[there].astype(np.int64).tolist(), 0], pa.int64()),
                "words": pa.array([*words[there].astype(np.int64).tolist(), 0], pa.int64()),
                "kinds": pa.array([*nothing, kinds], pa.int64()),
                "tokens": pa.array([*nothing, int(train.sum())], pa.int64()),
            }
        )

    schema = "row long, gain double, known long, words long, kinds long, tokens long"
    return counted.groupBy("base").applyInArrow(total, schema)


# --- operator -----------------------------------------------------------------------------------


def score_documents(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    stored: bool = False,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``score`` is the log10 probability of the text with A-Z lowered, and its end, under the model trained on the
    rows where ``held_out`` is false; ``base_score`` is that of its words under add-one word counts. A null text is
    empty: its end alone is scored. Repeated rows are counted and scored each for itself. With nothing to learn
    from every symbol is as likely as any other. Other columns do not enter. An empty table gives an empty one.
    Rows are told apart by their place in the input, which is written to the shared folder first unless it is
    the plain scan of a stored table (``stored``).
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        whole_text(text_col).cast("binary").alias("text"),
    )
    if not stored:
        base = materialize(base, "to-score")
    placed = base.withColumn("row", F.monotonically_increasing_id())
    model = train(base.select("text", (~F.col("held_out")).alias("learn")), order)
    uses = word_uses(placed.select("row", "text", (~F.col("held_out")).alias("learn")))
    gains = materialize(word_gains(uses), "word-gains")
    totals = gains.agg(F.sum("kinds").alias("kinds"), F.sum("tokens").alias("tokens")).first()
    learned = base.where("not held_out").count()
    tokens = (totals["tokens"] or 0) + learned
    kinds = (totals["kinds"] or 0) + (learned > 0)
    scored = whole_scores(placed.select("row", "text"), model)
    known = gains.where("row is not null").select("row", "gain", "known", "words")
    narrow = placed.select("row", "doc_id", "held_out")
    n = F.coalesce("words", F.lit(0)) + 1
    return (
        narrow.join(scored, "row")
        .join(known, "row", "left")
        .select(
            "doc_id",
            "held_out",
            n.alias("n_tokens"),
            (F.coalesce("known", F.lit(0)) + (1 if learned else 0)).cast("long").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (
                F.coalesce("gain", F.lit(0.0)) + math.log10(learned + 1) - n * math.log10(tokens + kinds + 1)
            ).alias("base_score"),
            "score",
        )
    )


def op6_partial_matching(docs: DataFrame) -> DataFrame:
    """Scores of all ``documents``; a null text counts as empty, a null doc_id as the empty name in the held-out rule."""
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2
    return score_documents(docs.select("doc_id", "text"), held, stored=True)
