"""Phrases of two to five words that keep company more often than chance, per language.

Texts are counted level by level, each level in one pass over the texts:

1. words; only those with at least ``MIN_COUNT`` occurrences can be part of a candidate,
2. pairs of such words,
3. phrases of three to five words all of whose pairs are frequent.

A task counts its windows in a trie over word ids with hash containers at its leaves. A container that
grows too large bursts into a node with one container per next word. When the trie holds too many
entries, whole subtrees leave it, largest first, as runs sorted by their words and packed by the bucket of
their prefix (the words before the last one, two at least). The runs of a bucket are merged in one place. A phrase
comes once per run, however often it occurs, so a frequent prefix brings its distinct continuations only.

What the level before found is passed to the tasks as a bit map of fixed size. Two phrases may share a bit:
the map can let an infrequent phrase through, which is then counted and dropped, but never loses one.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import materialize
from .common import prepare

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
NO_LANG = "und"
CUTS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

# Bits of the map of frequent phrases: 8 MB, whatever the input.
MAP_BITS = 26
# Windows that are put into the trie at once, entries of a container before it bursts, entries of a trie
# before subtrees leave it.
BUFFER = 1 << 20
BURST = 1 << 14
MAX_ENTRIES = 1 << 20

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(CUTS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Word places whose phrases meet in one bucket, on average; a task merges one bucket after the other.
BUCKET_PLACES, MIN_BUCKETS, MAX_BUCKETS = 1 << 21, 64, 1 << 16

COUNTS = "lang string, size int, phrase string, n long"
RUN = "bucket int, lang string, size int, phrases binary, counts binary"
RUN_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("lang", pa.string()), ("size", pa.int32()), ("phrases", pa.binary()), ("counts", pa.binary())]
)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and whether each begins a piece."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    begin, end = int(offsets[0]), int(offsets[-1])
    if begin == end:
        return pa.array([], pa.binary()), np.zeros(0, bool)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end]
    kind = _KIND[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    doc_starts = np.unique(offsets[:-1] - begin)
    doc_starts = doc_starts[doc_starts < len(data)]
    first[doc_starts] = inside[doc_starts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return pa.array([], pa.binary()), np.zeros(0, bool)
    place = np.cumsum(inside, dtype=np.int64)
    edges = np.append(place[starts] - 1, place[-1])
    chars = _LOWER[data[inside]]
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(chars)]
    )
    cuts = np.cumsum(kind == 2, dtype=np.int64)[starts]
    breaks = np.ones(len(starts), bool)
    breaks[1:] = cuts[1:] != cuts[:-1]
    owner = np.searchsorted(doc_starts, starts, side="right")
    breaks[1:] |= owner[1:] != owner[:-1]
    return words, breaks


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """The texts of a batch by language; null texts are left out."""
    langs = batch.column("lang")
    for lang in pc.unique(langs).to_pylist():
        yield lang, pc.drop_null(batch.column("text").filter(pc.equal(langs, lang)))


def word_hash(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right >> np.uint64(1))
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def in_map(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - MAP_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) != 0


class Node(dict):
    """Word id -> Node or Counter of the words that follow."""


class PhraseTrie:
    """Counts windows of word ids; id 0 stands behind the last word of a window."""

    def __init__(self, width: int, burst: int):
        self.width, self.burst = width, burst
        self.root, self.entries = Node(), Counter()

    def add(self, windows: np.ndarray) -> None:
        for word, rest in self._groups(windows):
            self.entries[word] += self._put(self.root, word, rest)

    @staticmethod
    def _groups(windows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        ordered = windows[np.argsort(windows[:, 0], kind="stable")]
        edges = np.flatnonzero(np.diff(ordered[:, 0], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield int(ordered[a, 0]), ordered[a:b, 1:]

    def _put(self, node: Node, word: int, rest: np.ndarray) -> int:
        """Count ``rest`` below ``word``; returns how many entries came to be."""
        child = node.get(word)
        if child is None:
            child = node[word] = Counter()
        if isinstance(child, Node):
            return sum(self._put(child, w, r) for w, r in self._groups(rest))
        before = len(child)
        child.update(self._keys(rest))
        grown = len(child) - before
        if len(child) > self.burst and rest.shape[1] > 1:
            node[word] = self._burst(child, rest.shape[1])
        return grown

    @staticmethod
    def _keys(rest: np.ndarray) -> list[bytes]:
        return np.ascontiguousarray(rest).view(f"V{4 * rest.shape[1]}").ravel().tolist()

    @staticmethod
    def _rows(container: Counter, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(container), np.int32).reshape(-1, width)

    def _burst(self, container: Counter, width: int) -> Node:
        """One container per next word, with the counts that the container held."""
        made = Node()
        for (key, n), word in zip(container.items(), self._rows(container, width)[:, 0].tolist()):
            made.setdefault(word, Counter())[key[4:]] = n
        return made

    def leave(self, keep: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out subtrees, largest first, until at most ``keep`` entries stay."""
        stay = self.entries.total()
        for word, n in self.entries.most_common():
            if stay <= keep:
                return
            stay -= n
            del self.entries[word]
            yield from self._flat(self.root.pop(word), np.array([word], np.int32))

    def _flat(self, top: Node | Counter, path: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        todo = [(top, path)]
        while todo:
            child, path = todo.pop()
            if isinstance(child, Node):
                todo.extend((below, np.append(path, np.int32(word))) for word, below in child.items())
            elif child:
                rest = self._rows(child, self.width - len(path))
                head = np.broadcast_to(path, (len(rest), len(path)))
                yield np.hstack([head, rest]), np.fromiter(child.values(), np.int64, len(child))


class Counting:
    """The tries of a task, one per language, with the words that their ids stand for."""

    def __init__(self, shortest: int, longest: int, buckets: int, burst: int, max_entries: int):
        self.shortest, self.longest, self.buckets = shortest, longest, buckets
        self.burst, self.max_entries = burst, max_entries
        self.ids: dict[str, dict[bytes, int]] = {}
        self.tries: dict[str, PhraseTrie] = {}
        self.waiting: dict[str, list[np.ndarray]] = {}

    def ids_of(self, lang: str, words: list[bytes]) -> np.ndarray:
        known = self.ids.setdefault(lang, {})
        return np.fromiter((known.setdefault(w, len(known) + 1) for w in words), np.int32, len(words))

    def add(self, lang: str, windows: np.ndarray) -> Iterator[pa.RecordBatch]:
        waiting = self.waiting.setdefault(lang, [])
        waiting.append(windows)
        if sum(map(len, waiting)) >= BUFFER:
            self._insert(lang)
        if sum(t.entries.total() for t in self.tries.values()) > self.max_entries:
            for each in list(self.tries):
                yield from self._run(each, self.tries[each].entries.total() // 2)
        if sum(map(len, self.ids.values())) > self.max_entries:
            yield from self.finish()

    def _insert(self, lang: str) -> None:
        waiting = self.waiting.pop(lang, [])
        if waiting:
            trie = self.tries.setdefault(lang, PhraseTrie(self.longest, self.burst))
            trie.add(np.concatenate(waiting))

    def finish(self) -> Iterator[pa.RecordBatch]:
        for lang in list(self.waiting):
            self._insert(lang)
        for lang in list(self.tries):
            yield from self._run(lang, 0)
        self.tries, self.ids = {}, {}

    def _run(self, lang: str, keep: int) -> Iterator[pa.RecordBatch]:
        """Subtrees as a run sorted by words, with the counts of all their phrases."""
        taken = list(self.tries[lang].leave(keep))
        if not taken:
            return
        names = [b"", *self.ids[lang]]
        order = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), np.int32)
        rank[order] = np.arange(len(names), dtype=np.int32)
        ordered = [names[i] for i in order]
        words, hashes = pa.array(ordered, pa.large_binary()), word_hash(lang, ordered)
        rows = rank[np.concatenate([r for r, _ in taken])]
        counts = np.concatenate([c for _, c in taken])
        sorted_by_words = np.lexsort(rows.T[::-1])
        rows, counts = rows[sorted_by_words], counts[sorted_by_words]
        for size in range(self.shortest, self.longest + 1):
            whole = rows[:, size - 1] > 0
            part, n = rows[whole, :size], counts[whole]
            if not len(part):
                continue
            new = np.ones(len(part), bool)
            new[1:] = (part[1:] != part[:-1]).any(axis=1)
            edges = np.flatnonzero(new)
            yield from self._blocks(lang, words, hashes, part[edges], np.add.reduceat(n, edges))

    def _blocks(self, lang: str, words: pa.Array, hashes: np.ndarray, rows: np.ndarray, counts: np.ndarray):
        """The sorted phrases of one size, cut by the bucket of their prefix: the words before the last one, two at least."""
        size = rows.shape[1]
        prefix = hashes[rows[:, 0]]
        for i in range(1, max(2, size - 1)):
            prefix = pair_hash(prefix, hashes[rows[:, i]])
        bucket = (prefix % np.uint64(self.buckets)).astype(np.int32)
        dealt = np.argsort(bucket, kind="stable")
        rows, counts, bucket = rows[dealt], counts[dealt], bucket[dealt]
        large = pa.large_binary()
        joined = pc.binary_join_element_wise(
            *[words.take(pa.array(rows[:, i])) for i in range(size)], pa.scalar(b" ", large)
        )
        lines = pc.binary_join_element_wise(joined, pa.scalar(b"", large), pa.scalar(b"\n", large))
        offsets, data = np.frombuffer(lines.buffers()[1], np.int64), lines.buffers()[2]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
        columns = [[], [], []]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            columns[0].append(int(bucket[a]))
            columns[1].append(packed(data.slice(int(offsets[a]), int(offsets[b] - offsets[a]))))
            columns[2].append(packed(counts[a:b]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int32()),
                pa.array([lang] * len(columns[0]), pa.string()),
                pa.array([size] * len(columns[0]), pa.int32()),
                pa.array(columns[1], pa.binary()),
                pa.array(columns[2], pa.binary()),
            ],
            schema=RUN_SCHEMA,
        )


def packed(data) -> bytes:
    """Compressed, behind its length."""
    raw = memoryview(data).cast("B")
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> pa.Buffer:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd")


def merged_bucket(table: pa.Table, min_count: int) -> pa.Table:
    """The runs of a bucket, summed by phrase; phrases below ``min_count`` go."""
    sums = None
    for row in table.to_batches(max_chunksize=64):
        parts = [] if sums is None else [sums]
        for lang, size, phrases, counts in zip(*(row.column(c).to_pylist() for c in ("lang", "size", "phrases", "counts"))):
            text, n = unpacked(phrases), np.frombuffer(unpacked(counts), np.int64)
            ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
            # Every line but the first begins behind the newline of the one before; it is cut off below.
            lines = pa.Array.from_buffers(
                pa.large_binary(), len(n), [None, pa.py_buffer(np.append(0, ends + 1).astype(np.int64)), text]
            )
            same = np.zeros(len(n), np.int32)
            parts.append(
                pa.table(
                    {
                        "lang": pa.DictionaryArray.from_arrays(pa.array(same), [lang]).cast(pa.string()),
                        "size": pa.array(same + size),
                        "line": lines,
                        "n": pa.array(n),
                    }
                )
            )
        summed = pa.concat_tables(parts).group_by(["lang", "size", "line"], use_threads=False).aggregate([("n", "sum")])
        sums = summed.rename_columns({"n_sum": "n"}).select(["lang", "size", "line", "n"])
    kept = sums.filter(pc.greater_equal(sums["n"], min_count))
    phrase = pc.binary_slice(kept["line"].cast(pa.binary()), 0, -1).cast(pa.string())
    return pa.table({"lang": kept["lang"], "size": kept["size"], "phrase": phrase, "n": kept["n"]})


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, 1, word, n), and per language the number of all words under the empty word."""
    found: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = sorted(found)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array(np.ones(len(keys), np.int32)),
                pa.array([k[1] for k in keys], pa.binary()).cast(pa.string()),
                pa.array([found[k] for k in keys], pa.int64()),
            ],
            ["lang", "size", "phrase", "n"],
        )

    for batch in batches:
        for lang, texts in by_lang(batch):
            words, _ = words_of(texts)
            if not len(words):
                continue
            coded = words.dictionary_encode()
            counts = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            found[lang, b""] += len(words)
            for word, n in zip(coded.dictionary.to_pylist(), counts.tolist()):
                found[lang, word] += n
        if len(found) > MAX_ENTRIES:
            yield out()
            found.clear()
    if found:
        yield out()


def count_pairs(
    batches: Iterator[pa.RecordBatch], bits, buckets: int, burst: int, max_entries: int
) -> Iterator[pa.RecordBatch]:
    counting = Counting(2, 2, buckets, burst, max_entries)
    for batch in batches:
        for lang, texts in by_lang(batch):
            words, breaks = words_of(texts)
            if len(words) < 2:
                continue
            coded = words.dictionary_encode()
            names = coded.dictionary.to_pylist()
            often = np.flatnonzero(in_map(bits.value, word_hash(lang, names)))
            ids = np.zeros(len(names), np.int32)
            ids[often] = counting.ids_of(lang, [names[i] for i in often.tolist()])
            at = ids[coded.indices.to_numpy()]
            joined = (at[:-1] > 0) & (at[1:] > 0) & ~breaks[1:]
            yield from counting.add(lang, np.column_stack([at[:-1][joined], at[1:][joined]]))
    yield from counting.finish()


def count_longer(
    batches: Iterator[pa.RecordBatch], bits, buckets: int, burst: int, max_entries: int
) -> Iterator[pa.RecordBatch]:
    counting = Counting(3, MAX_WORDS, buckets, burst, max_entries)
    for batch in batches:
        for lang, texts in by_lang(batch):
            words, breaks = words_of(texts)
            if len(words) < 3:
                continue
            coded = words.dictionary_encode()
            names = coded.dictionary.to_pylist()
            hashes, at = word_hash(lang, names), coded.indices.to_numpy()
            # linked[i]: word i and word i + 1 stand in one piece and are a frequent pair.
            linked = np.zeros(len(at) + MAX_WORDS, bool)
            linked[: len(at) - 1] = in_map(bits.value, pair_hash(hashes[at[:-1]], hashes[at[1:]])) & ~breaks[1:]
            starts = np.flatnonzero(linked[: len(at)] & linked[1 : len(at) + 1])
            if not len(starts):
                continue
            used = np.unique(at[linked[: len(at)] | np.append(False, linked[: len(at) - 1])])
            ids = np.zeros(len(names), np.int32)
            ids[used] = counting.ids_of(lang, [names[i] for i in used.tolist()])
            coded_ids = ids[at]
            windows = np.zeros((len(starts), MAX_WORDS), np.int32)
            alive = np.ones(len(starts), bool)
            for i in range(MAX_WORDS):
                windows[alive, i] = coded_ids[starts[alive] + i]
                alive &= linked[starts + i]
            yield from counting.add(lang, windows)
    yield from counting.finish()


def _bit_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where a frequent word or pair stands in the map."""
    for batch in batches:
        langs = batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            split = [p.encode().split(b" ") for p in batch.column("phrase").filter(pc.equal(langs, lang)).to_pylist()]
            hashes = word_hash(lang, [s[0] for s in split])
            if len(split[0]) == 2:
                hashes = pair_hash(hashes, word_hash(lang, [s[1] for s in split]))
            places = (hashes >> np.uint64(64 - MAP_BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])


def _bit_map(frequent: DataFrame):
    """The map as a broadcast of 2 ** MAP_BITS bits; it comes to the driver in blocks of 4 KB."""
    place = F.col("place") + 1
    blocks = (
        frequent.select("lang", "phrase")
        .mapInArrow(_bit_places, "place long")
        .groupBy(F.bitmap_bucket_number(place).alias("block"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    )
    bits = np.zeros((1 << (MAP_BITS - 15), 1 << 12), np.uint8)
    for row in blocks.collect():
        bits[row["block"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(bits.ravel())


def merged(runs: DataFrame, min_count: int) -> DataFrame:
    """Runs summed where their bucket meets; phrases below ``min_count`` go."""
    return runs.groupBy("bucket").applyInArrow(lambda table: merged_bucket(table, min_count), COUNTS)


def frequent_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, burst: int = BURST, max_entries: int = MAX_ENTRIES
) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): (lang, size, phrase, n) of one to five words with n >= ``min_count``; (lang, total) of all words."""
    prepare(docs.sparkSession)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("binary").alias("text")
    )
    words = materialize(
        texts.mapInArrow(count_words, COUNTS)
        .groupBy("lang", "size", "phrase")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= min_count) | (F.col("phrase") == "")),
        "words",
    )
    totals = words.where("phrase = ''").select("lang", F.col("n").alias("total"))
    words = words.where("phrase <> ''")
    places = totals.agg(F.sum("total")).first()[0] or 0
    settings = {
        "buckets": min(max(MIN_BUCKETS, places // BUCKET_PLACES), MAX_BUCKETS),
        "burst": burst,
        "max_entries": max_entries,
    }
    runs = texts.mapInArrow(functools.partial(count_pairs, bits=_bit_map(words), **settings), RUN)
    pairs = materialize(merged(runs, min_count), "pairs")
    runs = texts.mapInArrow(functools.partial(count_longer, bits=_bit_map(pairs), **settings), RUN)
    longer = materialize(merged(runs, min_count), "longer")
    return words.unionByName(pairs).unionByName(longer), totals


def part(first: Column | int, last: Column | int, words: str = "w") -> Column:
    """Words ``first`` to ``last`` (from 1) of the array, joined."""
    first = F.lit(first) if isinstance(first, int) else first
    return F.array_join(F.slice(F.col(words), first, last - first + 1), " ")


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Every candidate with its lowest-scoring cut. Parts of a candidate are as frequent, so they are all among ``phrases``."""
    counts = phrases.select("lang", "phrase", "n")
    cuts = (
        phrases.where("size >= 2")
        .withColumn("w", F.split("phrase", " "))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .select(
            "lang",
            "size",
            "phrase",
            F.col("n").alias("a"),
            "k",
            part(1, F.col("k")).alias("left"),
            part(F.col("k") + 1, F.col("size")).alias("right"),
        )
    )
    wide = cuts.join(counts.withColumnsRenamed({"phrase": "left", "n": "l"}), ["lang", "left"]).join(
        counts.withColumnsRenamed({"phrase": "right", "n": "r"}), ["lang", "right"]
    )
    wide = wide.join(totals, "lang")
    big = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "total")}
    over = (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)")) * big["total"]
    wide = wide.withColumns({"over": over, "under": big["l"] * big["r"]})
    score = F.expr("over div under")
    best = F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("best")
    return wide.groupBy("lang", "size", "phrase", "a", F.col("total").alias("n")).agg(best)


def covered(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the count of the most frequent longer candidate that holds the phrase."""
    inner = (
        phrases.where("size >= 3")
        .withColumn("w", F.split("phrase", " "))
        .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    )
    return inner.groupBy("lang", part(F.col("at"), F.col("at") + F.col("m") - 1).alias("phrase")).agg(
        F.max("n").alias("longest")
    )


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    cover_percent: int = 100,
    burst: int = BURST,
    max_entries: int = MAX_ENTRIES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Null texts are empty, null languages are ``und``; empty tables and texts give no rows. Rows that repeat count as
    often as they stand there. Ties go by count, then by the bytes of the phrase. Other columns are not looked at.
    """
    phrases, totals = frequent_phrases(docs, min_count, burst, max_entries)
    kept = (
        scored(phrases, totals)
        .join(covered(phrases), ["lang", "phrase"], "left")
        .where(F.col("longest").isNull() | (100 * F.col("longest") < cover_percent * F.col("a")))
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(docs: DataFrame) -> DataFrame:
    """The first 2000 collocations of each language with at least 100 occurrences; see ``collocations``."""
    return collocations(docs)


def _sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = "\n  UNION ALL ".join(
        f"SELECT lang, {m} AS size, unnest(list_transform(range(1, len(w) - {m} + 2), lambda i: "
        f"array_to_string(list_slice(w, i, i + {m - 1}), ' '))) AS phrase FROM pieces WHERE len(w) >= {m}"
        for m in range(1, MAX_WORDS + 1)
    )
    return f"""
WITH cut AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\n-\\r]')) AS piece
  FROM documents
), pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM cut
), totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  {grams}
), f AS (
  SELECT lang, size, phrase, count(*)::BIGINT AS n FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}
), cuts AS (
  SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size >= 2
), valued AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, x.n AS l, y.n AS r, t.n AS n,
         ((1000::HUGEINT * c.a * t.n) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(list_slice(c.w, 1, c.k), ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(list_slice(c.w, c.k + 1, c.size), ' ')
  JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), free AS (
  SELECT b.* FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f g WHERE g.lang = b.lang AND g.size > b.size AND 100 * g.n >= 100 * b.a
      AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' '))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
"""


SQL = _sql()
