"""Near-duplicates by order MinHash.

A text is its sequence of two-word shingles, each labelled with how often it occurred before. For each
of many hash orders the few smallest labelled shingles are kept in text order; their sequence is a
bucket. A short text is its labelled words instead, in any order: one edit leaves most of them as they were.
Texts that differ by few edits share buckets, texts that merely share a passage or hold
the same parts in another order hardly do. Members of a bucket are compared with one centre, and
what is not settled by that with all members of other classes in the bucket, first by the counts of their words, which
tell most of them apart. A comparison is a banded alignment of the words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import whole_text, without

# An edit takes two shingles at most: of texts at SIMILARITY at least 3 shingles in 7 are common to both.
SHINGLE = 2
SIMILARITY = 0.8
# Hash orders, and shingles kept of each.
ORDERS = 96
KEPT = 3
# Texts of so many words or fewer are met by their words.
SHORT = 40
SEED = 8
ODD = np.uint64(0x9E3779B97F4A7C15)
# Numbers of one step of the hash orders; bounds the memory for a very long text.
CELLS = 1 << 18
MEMO_WORDS = 100_000
# Classes of labelled words whose counts bound the edits between two texts from below.
BAGS = 1024
_PAIRS = np.uint64(0x00FF00FF00FF00FF)
# Members of a bucket that are compared at a time.
CHUNK = 1024


class WordHashes(dict):
    """Hash of each word; computed when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * ODD
    return x ^ (x >> np.uint64(32))


def labelled_shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """One number per shingle and occurrence. Fewer words than a shingle are one shingle."""
    width = min(size, len(hashes))
    rolled = np.zeros(len(hashes) - width + 1, np.uint64)
    for step in range(width):
        rolled = rolled * ODD + hashes[step : len(hashes) - width + 1 + step]
    rolled = mixed(rolled)
    order = np.argsort(rolled, kind="stable")
    ordered = rolled[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if not fresh.all():
        at = np.arange(len(ordered))
        seen = np.empty(len(ordered), np.uint64)
        seen[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
        rolled = np.where(seen > 0, mixed(rolled + seen * np.uint64(0xC2B2AE3D27D4EB4F)), rolled)
    return rolled


def smallest(values: np.ndarray, kept: int) -> np.ndarray:
    """Places of the ``kept`` smallest values of each row, in order of place. Values are evenly spread hashes: of many, only
    those below a bound that more than ``kept`` are expected under are looked at, unless a row has too few of them."""
    rows, n = values.shape
    if n >= 16 * kept:
        row, place = np.divmod(np.flatnonzero(values < np.uint64((1 << 64) // n * 5 * kept)), n)
        found = np.bincount(row, minlength=rows)
        if found.min() >= kept:
            order = np.lexsort((values[row, place], row))
            places = place[order[(np.cumsum(found) - found)[:, None] + np.arange(kept)]]
            places.sort(axis=1)
            return places
    places = np.argpartition(values, kept - 1, axis=1)[:, :kept]
    places.sort(axis=1)
    return places


def order_sketch(shingles: np.ndarray, factors: np.ndarray, kept: int = KEPT) -> np.ndarray:
    """One bucket per hash order: its ``kept`` smallest shingles, in text order."""
    n = len(shingles)
    out = []
    step = max(1, CELLS // n)
    for at in range(0, len(factors), step):
        part = factors[at : at + step, None]
        if n > kept:
            chosen = shingles[smallest(shingles[None, :] * part, kept)]
        else:
            chosen = np.broadcast_to(shingles, (len(part), n))
        bucket = part[:, 0].copy()
        for i in range(chosen.shape[1]):
            bucket = mixed(bucket * ODD + chosen[:, i])
        out.append(bucket)
    return np.concatenate(out)


def text_sketch(
    hashes: np.ndarray, factors: np.ndarray, kept: int = KEPT, size: int = SHINGLE, similarity: float = SIMILARITY
) -> np.ndarray:
    """Buckets of a text by the hashes of its words: by shingles, by words in any order if it is short.

    Texts whose lengths allow ``similarity`` always have one of the two in common: a text is met both ways from
    ``similarity * SHORT`` to SHORT words.
    """
    out = []
    if len(hashes) <= SHORT:
        out.append(order_sketch(np.sort(labelled_shingles(hashes, 1)), factors, kept))
    if len(hashes) >= similarity * SHORT - 1e-9:
        out.append(order_sketch(labelled_shingles(hashes, size), factors, kept))
    return np.concatenate(out)


def sketches(
    keyed: DataFrame, orders: int = ORDERS, kept: int = KEPT, size: int = SHINGLE, similarity: float = SIMILARITY
) -> DataFrame:
    """(bucket, key, words) of every text with a word; ``keyed`` has key and text (binary)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = np.random.default_rng(SEED).integers(0, 1 << 63, orders, np.uint64) * np.uint64(2) + np.uint64(1)
        memo, done = WordHashes(), set()
        for batch in batches:
            keys, counts, found = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key in done:  # the same text again
                    continue
                done.add(key)
                words = text.split()
                if not words:
                    continue
                hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
                found.append(text_sketch(hashes, factors, kept, size, similarity))
                keys.append(key)
                counts.append(len(words))
            if len(memo) > MEMO_WORDS:
                memo.clear()
            if keys:
                times = [len(x) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found).view(np.int64)),
                        pa.array(np.repeat(np.array(keys, np.int64), times)),
                        pa.array(np.repeat(np.array(counts, np.int32), times)),
                    ],
                    ["bucket", "key", "words"],
                )

    return keyed.select("key", "text").mapInArrow(build, "bucket long, key long, words int")


def banded_distance(a: list, b: list, limit: int) -> int | None:
    """Word edits between ``a`` and ``b`` if there are at most ``limit``.

    Bit i of the vectors is a row of the band around the main diagonal; a column of the band takes a few
    operations on whole numbers (bit-vector alignment). Cells outside the band count as one step further.
    """
    if len(a) < len(b):
        a, b = b, a
    low = 0
    while low < len(b) and a[low] == b[low]:
        low += 1
    high = 0
    while high < len(b) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    longer = len(a) - len(b)
    if longer > limit:
        return None
    if not b:
        return len(a)
    if len(a) - sum((Counter(a) & Counter(b)).values()) > limit:
        return None
    equal: dict = {}
    for row, word in enumerate(a):
        equal[word] = equal.get(word, 0) | 1 << row
    width = 2 * limit + 1
    mask, top, middle = (1 << width) - 1, 1 << (width - 1), 1 << limit
    up = mask ^ ((1 << (limit + 1)) - 1)  # column 0: one step per row below row 0
    down = score = 0
    for column, word in enumerate(b):
        up, down = (up >> 1) | top, down >> 1
        rows = equal.get(word, 0)
        shift = column - limit
        rows = (rows >> shift if shift >= 0 else rows << -shift) & mask
        same = (((rows & up) + up) ^ up | rows | down) & mask
        right = down | (mask ^ ((same | up) & mask))
        left = up & same
        if not same & middle:
            score += 1
            if score > limit + longer:
                return None
        right, left = (right << 1 | 1) & mask, (left << 1) & mask
        up, down = left | (mask ^ (same | right)), right & same
    below = ((1 << longer) - 1) << (limit + 1)
    score += (up & below).bit_count() - (down & below).bit_count()
    return score if score <= limit else None


def edit_limit(a: int, b: int, similarity: float) -> int:
    """Edits that texts of ``a`` and ``b`` words may differ by; similarity is 1 - edits / words of the longer."""
    return int((1 - similarity) * max(a, b) + 1e-9)


def judged(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, b, la, lb, same) of pairs (a, b) of keys, which have the labels (la, lb)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for batch in batches:
            same = []
            for a, left, right in zip(*(batch.column(i).to_pylist() for i in (0, 4, 5)), strict=True):
                if a != last:
                    last, words = a, left.split()
                other = right.split()
                limit = edit_limit(len(words), len(other), similarity)
                same.append(banded_distance(words, other, limit) is not None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(same, pa.bool_())], ["a", "b", "la", "lb", "same"]
            )

    left = texts.select(F.col("key").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "la", "lb", "left", "right")
    return both.mapInArrow(compare, "a long, b long, la long, lb long, same boolean")


def components(edges: DataFrame) -> DataFrame:
    """(key, label) of all keys in ``edges`` (a, b): the smallest key that edges lead to.

    Edges turn into stars around ever smaller keys until there are stars only: neighbours above a key are hung on
    its smallest neighbour, then those below. No vertex is looked at as a whole: its neighbours meet in sums only.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now = materialize(now, "edges")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join below meets two plain exchanges and a hot key can be split.
        least = both.groupBy("u").agg(
            F.least(F.col("u"), F.min("v")).alias("m"),
            F.count_if(F.col("v") < F.col("u")).alias("below"),
            F.count_if(F.col("v") > F.col("u")).alias("above"),
        )
        least = materialize(least, "least")
        # A key of a star is its centre or hangs on nothing but the centre.
        if least.where("below > 1 or below = 1 and above > 0").isEmpty():
            return least.select(F.col("u").alias("key"), F.col("m").alias("label"))
        # One row per edge, so equal ones can wait.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large, "edges")
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        hung = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        now = materialize(small, "edges")


def united(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (key, label) after ``links`` (la, lb) between labels; a key without a label so far is its own."""
    moved = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    moved = moved.select(F.col("key").alias("old"), F.col("label").alias("new"))
    known = labels.join(moved, F.col("label") == F.col("old"), "left").select("key", F.coalesce("new", "label").alias("label"))
    alone = moved.join(labels, F.col("old") == F.col("key"), "left_anti").select(F.col("old").alias("key"), F.col("new").alias("label"))
    return materialize(known.unionByName(alone), "labels")


def _stars(members: DataFrame, similarity: float) -> DataFrame:
    """Pairs of every member with the smallest key of its bucket."""
    fits = F.least("words", "head_words") >= similarity * F.greatest("words", "head_words") - 1e-9
    return members.where((F.col("key") != F.col("head")) & fits).select(
        F.col("head").alias("a"), F.col("key").alias("b")
    ).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, la, lb): pairs whose texts are not in one class so far, with the labels of both."""
    left = labels.select(F.col("key").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("key").alias("b"), F.col("label").alias("lb"))
    both = pairs.join(left, "a", "left").join(right, "b", "left")
    both = both.select("a", "b", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
    return both.where("la <> lb")


def word_bags(texts: DataFrame) -> DataFrame:
    """(key, bags): how many labelled words of each text fall into each of BAGS classes, a byte per class; null if that is too small."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = text.split()
                labelled = labelled_shingles(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)), 1)
                bags = np.bincount((labelled % np.uint64(BAGS)).astype(np.int64), minlength=BAGS)
                rows.append(bags.astype(np.uint8).tobytes() if bags.max() < 256 else None)
            if len(memo) > MEMO_WORDS:
                memo.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["key", "bags"])

    return texts.select("key", "text").mapInArrow(count, "key long, bags binary")


def least_edits(one: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """Edits that a text needs at least to become each of others, by their bags: an edit changes one word for at
    most one other, so words of the longer text without a partner are a bound that loses no link."""
    met = np.minimum(one, others).view(np.uint64)
    # Bytes are added eight at a time: sums of 2 x 128 of them fit into 16 bits.
    met = ((met & _PAIRS) + ((met >> np.uint64(8)) & _PAIRS)).sum(axis=1)
    return np.maximum(n, sizes) - met.view(np.uint16).reshape(-1, 4).sum(axis=1, dtype=np.int64)


def near_pairs(
    keys: np.ndarray, labels: np.ndarray, words: np.ndarray, bags: list, half: np.ndarray | None, similarity: float
) -> Iterator[tuple[int, list[int], list[int]]]:
    """(a, first, rest): texts that may be linked to ``a`` and are of another class. Of two classes the pair
    that needs the fewest edits is in ``first``. ``half``: pairs lie across the two halves only."""
    known = np.array([x is not None for x in bags], bool)
    table = np.stack([np.frombuffer(x if x is not None else bytes(BAGS), np.uint8) for x in bags])
    words = words.astype(np.int64)
    limits = np.floor((1 - similarity) * words + 1e-9).astype(np.int64)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    found = []
    for i in range(len(keys) - 1):
        fits = np.minimum(words[i], words[i + 1 :]) >= similarity * np.maximum(words[i], words[i + 1 :]) - 1e-9
        fits &= labels[i + 1 :] != labels[i]
        if half is not None:
            fits &= half[i + 1 :] != half[i]
        at = np.flatnonzero(fits) + i + 1
        if not len(at):
            continue
        edits = least_edits(table[i], table[at], words[i], words[at])
        edits[~(known[at] & known[i])] = 0
        near = edits <= np.maximum(limits[i], limits[at])
        for j, e in zip(at[near].tolist(), edits[near].tolist()):
            pair = (min(labels[i], labels[j]), max(labels[i], labels[j]))
            a, b = (i, j) if keys[i] < keys[j] else (j, i)
            found.append((pair, a, b))
            best[pair] = min(best.get(pair, (e, a, b)), (e, a, b))
    first: dict[int, list[int]] = {}
    rest: dict[int, list[int]] = {}
    for pair, a, b in found:
        (first if best[pair][1:] == (a, b) else rest).setdefault(a, []).append(int(keys[b]))
    for a in first.keys() | rest.keys():
        yield int(keys[a]), first.get(a, []), rest.get(a, [])


def _open_pairs(members: DataFrame, labels: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(a, first, rest) of all members of unlike classes that meet in a bucket, as in ``near_pairs``.

    The members of a bucket are compared as arrays, at most two chunks of CHUNK of them at a time, so what leaves is not
    every pair of a bucket but those that may be linked, and of these each text's partners in one row.
    """
    classed = members.select("bucket", "key", "words").join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    unlike = (
        classed.groupBy("bucket")
        .agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"))
        .where("x <> y")
        .select("bucket", F.when(F.col("n") <= 2 * CHUNK, 1).otherwise(F.ceil(F.col("n") / CHUNK)).cast("int").alias("chunks"))
    )
    stands = materialize(classed.join(materialize(unlike, "unlike"), "bucket"), "stands")
    counts = materialize(word_bags(texts.join(stands.select("key").distinct(), "key", "left_semi")), "bags")
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    # A bucket of one chunk is one group; of more, every two chunks are one, and each chunk alone.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.struct(F.least("chunk", other).alias("i"), F.greatest("chunk", other).alias("j")),
    )
    dealt = stands.withColumn("chunk", chunk).select("bucket", "key", "label", "words", "chunk", F.explode(meets).alias("meet"))
    grouped = (
        dealt.join(counts, "key")
        .groupBy("bucket", "meet")
        .agg(F.collect_list(F.struct("key", "label", "words", "chunk", "bags")).alias("texts"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ends = batch.column(1).offsets.to_numpy()
            key, label, words, chunk, bags = batch.column(1).values.flatten()
            key, label, words, chunk = (x.to_numpy() for x in (key, label, words, chunk))
            for (low, high), meet in zip(zip(ends[:-1].tolist(), ends[1:].tolist()), batch.column(0).to_pylist()):
                half = chunk[low:high] if meet["i"] != meet["j"] else None
                rows += near_pairs(
                    key[low:high], label[low:high], words[low:high], bags[low:high].to_pylist(), half, similarity
                )
            columns = list(zip(*rows)) if rows else [[], [], []]
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["a", "first", "rest"])

    near = grouped.select("meet", "texts").mapInArrow(compare, "a long, first array<long>, rest array<long>")
    return near.groupBy("a").agg(
        F.array_distinct(F.flatten(F.collect_list("first"))).alias("first"),
        F.array_distinct(F.flatten(F.collect_list("rest"))).alias("rest"),
    )


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    orders: int = ORDERS,
    kept: int = KEPT,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every row with ``class_id``, ``class_size`` and ``kept``, beside the ``carry`` columns (default: all).

    Two texts are linked when an alignment of their words needs at most 1 - ``similarity`` edits per word of the
    longer. Classes are what links connect; equal texts are one class at once. ``class_id`` is the
    smallest id of the class, null if it has none; the row that stays is the one with that id (null
    ids last; of ties exactly one). Null texts count as empty; a text without words is linked to equal texts only.
    An empty table gives an empty table. Input columns named like an output are replaced. Texts are told apart
    by a 64-bit hash.
    """
    outputs = ("class_id", "class_size", "kept")
    names = [c for c in (docs.columns if carry is None else [id_col, *carry]) if c.lower() not in outputs]
    text = whole_text(text_col)
    tagged = docs.withColumns({"__llm_key": F.xxhash64(text), "__llm_id": F.col(id_col)})
    rows = materialize(
        without(tagged, outputs).select(
            *[f"`{c}`" for c in dict.fromkeys(names)], "__llm_id", "__llm_key", F.monotonically_increasing_id().alias("__llm_row")
        ),
        "near-rows",
    )
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))
    buckets = materialize(sketches(keyed, orders, kept, similarity=similarity), "buckets")
    heads = (
        buckets.groupBy("bucket")
        .agg(F.min(F.struct("key", "words")).alias("h"), F.max("key").alias("last"))
        .where(F.col("h.key") != F.col("last"))
        .select("bucket", F.col("h.key").alias("head"), F.col("h.words").alias("head_words"))
    )
    heads = materialize(heads, "heads")
    members = materialize(buckets.join(heads, "bucket").dropDuplicates(["bucket", "key"]), "members")
    # One row stands for each text that met another one; its copies do not travel.
    first = rows.groupBy(F.col("__llm_key").alias("key")).agg(F.min(F.struct("__llm_id")).alias("f"))
    wanted = members.select("key").distinct().join(first, "key").select("key", F.col("f.__llm_id").alias("wanted_id"))
    met = keyed.withColumnRenamed("key", "own")
    texts = materialize(
        met.join(wanted, (F.col("own") == F.col("key")) & F.col("id").eqNullSafe(F.col("wanted_id")))
        .select("key", "text")
        .dropDuplicates(["key"]),
        "texts",
    )
    # First each text with the smallest of its centres; then only centres of another class.
    stars = materialize(_stars(members, similarity), "stars")
    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b", F.col("a").alias("la"), F.col("b").alias("lb"))
    found = materialize(judged(first, texts, similarity), "judged")
    labels = components(found.where("same"))
    # Links of later rounds are between classes, so only classes that they unite are labelled anew.
    for name in ("stars", "first", "rest"):
        if name == "first":
            # What is open between classes that meet in a bucket: the nearest pair of two classes first, the others if it is unlike.
            wanted = materialize(_open_pairs(members, labels, texts, similarity), "open")
        # A text has one row in ``wanted``, and no partner twice in it.
        pairs = stars if name == "stars" else wanted.select("a", F.explode(name).alias("b"))
        pairs = _apart(pairs.join(found.select("a", "b"), ["a", "b"], "left_anti"), labels)
        more = materialize(judged(pairs, texts, similarity), "judged")
        found = found.unionByName(more)
        if not more.where("same").isEmpty():
            labels = united(labels, more.where("same"))
    classed = rows.join(labels.withColumnRenamed("key", "__llm_key"), "__llm_key", "left").withColumn(
        "__llm_label", F.coalesce("label", "__llm_key")
    )
    place = F.struct(F.col("__llm_id").isNull().alias("none"), F.col("__llm_id").alias("id"), F.col("__llm_row").alias("row"))
    classed = materialize(classed.drop("label", "__llm_key"), "classed")
    # Stored, so that the rows of a large class can be split.
    best = materialize(
        classed.groupBy("__llm_label").agg(F.min(place).alias("__llm_best"), F.count("*").alias("class_size")), "best"
    )
    return classed.join(best, "__llm_label").select(
        *[f"`{c}`" for c in dict.fromkeys(names)],
        F.col("__llm_best.id").alias("class_id"),
        "class_size",
        (F.col("__llm_best.row") == F.col("__llm_row")).alias("kept"),
    )


def op8_order_minhash(docs: DataFrame) -> DataFrame:
    """One row per document with its class; nulls, ties and empty tables as in ``near_classes``."""
    return near_classes(docs, carry=[])
