"""Best-fit packing planned on the histogram of lengths.

Texts become pieces of at most ``capacity`` tokens. How many pieces there are of each length is all
the planner sees: best-fit decreasing over counts, whose work and output depend on ``capacity``
only. Pieces are then numbered within their length and take the planned slot with their number.
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE_CHARS, whole_text

CAPACITY = 2048
END_ID = 0
# Bytes that the units a task remembers may take, about 150 beside their letters, before it starts anew.
MEMO_BYTES = 160 << 20
# Pieces that one task numbers within a length.
BLOCK_ROWS = 500_000


# Marks that these vocabularies never join to a letter before them; one run of them is a token group of its own.
TAIL = b".,;:!?*#$%&|<>()-"


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_CHARS.encode())] = True


def cut_at_spaces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All parts between white space, and how many each text has; a null text is empty."""
    texts = texts.fill_null(b"").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    begin, end = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    if begin == end:
        return pa.array([], pa.binary()), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end]
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    text_starts = (offsets[:-1] - begin)[np.diff(offsets) > 0]
    first[text_starts] = inside[text_starts]
    starts = np.flatnonzero(first)
    place = np.cumsum(inside, dtype=np.int64)
    edges = np.append(place[starts] - 1, place[-1]).astype(np.int32)
    parts = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(data[inside])]
    )
    return parts, np.diff(np.searchsorted(starts, offsets - begin))


def sliced(values: pa.Array, begin: np.ndarray, length: np.ndarray) -> pa.Array:
    """``length`` bytes of each value from its byte ``begin`` on."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values)]
    ends = np.cumsum(length)
    place = np.arange(int(ends[-1])) + np.repeat(offsets + begin - (ends - length), length)
    data = np.frombuffer(values.buffers()[2], np.uint8)[place]
    edges = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(edges), pa.py_buffer(data)])


class WordCodec:
    """Ids, as little-endian 32-bit numbers, of texts cut at ASCII white space.

    White space always separates tokens of these vocabularies, and so does the border between letters and a run of
    marks: the ids of a text are those of its units, one after another. A batch is cut into units at once and only
    its distinct ones are looked up; the ids of all units stand in one array, from which those of the texts are
    gathered. Letters, which give one token with a word end each, are encoded many at a time and told apart by
    their word ends.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """Start anew; the empty unit has number 0 and no ids."""
        self.known: dict[bytes, int] = {b"": 0}
        self.ids, self.lengths = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.known_bytes = 0

    def _encode(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _letters(self, words: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of the words and how many each has, for two thousand words at a time."""
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            ids = self._encode(b" ".join(some).decode())
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                yield ids, np.diff(stops, prepend=0)
            else:  # a word that the vocabulary takes apart
                each = [self._encode(w.decode()) for w in some]
                yield np.concatenate(each), np.array([len(x) for x in each])

    def _learn(self, letters: list[bytes], others: list[bytes]) -> None:
        found = list(self._letters(letters))
        each = [self._encode(u.decode("utf-8", "replace")) for u in others]
        self.ids = np.concatenate([self.ids, *[ids for ids, _ in found], *each])
        counts = [n for _, n in found] + [np.array([len(x) for x in each], np.int64)]
        self.lengths = np.concatenate([self.lengths, *counts])
        fresh = letters + others
        self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
        self.known_bytes += sum(map(len, fresh)) + 150 * len(fresh)

    def _numbers(self, units: pa.Array, letters: bool) -> np.ndarray:
        """The number of each unit, new ones learned."""
        names = units.to_pylist()
        numbers = list(map(self.known.get, names))
        new = list({u for u, n in zip(names, numbers, strict=True) if n is None})
        if new:
            self._learn(*((new, []) if letters else ([], new)))
            numbers = list(map(self.known.__getitem__, names))
        return np.array(numbers, np.int64)

    def _units(self, parts: pa.Array) -> np.ndarray:
        """Two unit numbers for each part: its letters and the marks behind them, or the part as a whole and nothing."""
        text = parts.cast(pa.string())
        core = pc.ascii_rtrim(text, characters=TAIL.decode())
        alpha = pc.ascii_is_alpha(core).to_numpy(zero_copy_only=False).copy()
        beyond = np.flatnonzero(~pc.string_is_ascii(core).to_numpy(zero_copy_only=False))
        alpha[beyond] = [w.isalpha() for w in core.take(pa.array(beyond)).to_pylist()]
        words, whole = pa.array(np.flatnonzero(alpha)), pa.array(np.flatnonzero(~alpha))
        out = np.zeros((len(parts), 2), np.int64)
        if len(words):
            cores = core.take(words)
            lowered = pc.ascii_lower(cores).cast(pa.binary()).dictionary_encode()
            out[alpha, 0] = self._numbers(lowered.dictionary, True)[lowered.indices.to_numpy()]
            parts_of = text.take(words).cast(pa.binary())
            after = pc.binary_length(cores.cast(pa.binary())).to_numpy()
            marks = sliced(parts_of, after, pc.binary_length(parts_of).to_numpy() - after).dictionary_encode()
            out[alpha, 1] = self._numbers(marks.dictionary, False)[marks.indices.to_numpy()]
        if len(whole):
            out[~alpha, 0] = self._numbers(parts.take(whole), False)
        return out

    def bytes_of(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text."""
        if self.known_bytes > MEMO_BYTES:
            self._forget()
        parts, counts = cut_at_spaces(texts)
        coded = parts.dictionary_encode()
        units = self._units(coded.dictionary)[coded.indices.to_numpy()].ravel()
        lengths = self.lengths[units]
        starts = (np.cumsum(self.lengths) - self.lengths)[units]
        # Place of every id: the start of its unit, and how far it is into it.
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
        body = self.ids[place].tobytes()
        stops = np.append(0, ends)[2 * np.append(0, np.cumsum(counts))] * 4
        for a, b in itertools.pairwise(stops.tolist()):
            yield body[a:b]


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """doc_id, piece (0 up), start, length, ids (binary) of every document; null texts are empty.

    A document is its ids and then ``end_id``; only one longer than ``capacity`` is cut.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).cast("binary").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = WordCodec(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        step = 4 * capacity
        for batch in batches:
            rows, numbers, blobs = [], [], []
            for row, body in enumerate(codec.bytes_of(batch.column(1))):
                body += end
                for number, at in enumerate(range(0, len(body), step)):
                    rows.append(row)
                    numbers.append(number)
                    blobs.append(body[at : at + step])
            number = pa.array(numbers, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    number,
                    pa.array([n * capacity for n in numbers], pa.int64()),
                    pa.array([len(b) // 4 for b in blobs], pa.int64()),
                    pa.array(blobs, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return source.mapInArrow(cut, f"doc_id {id_type}, piece int, start long, length long, ids binary")


PLAN_SCHEMA = "length long, first_rank long, n long, first_bin long, per_bin long, base long"


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` (length -> pieces).

    Bins that hold the same lengths are one run of numbers. A row (length, first_rank, n, first_bin,
    per_bin, base) says: pieces first_rank .. first_rank + n - 1 of that length fill bins from
    first_bin on, per_bin to a bin, from token ``base`` on.
    """
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # free tokens -> (first bin, bins)
    plan, bins = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        for free in range(length, capacity):
            while left and runs[free]:
                left, rank = _fill(runs, plan, free, runs[free].pop(), length, left, rank, capacity)
        if left:
            fresh = -(-left // (capacity // length))
            _fill(runs, plan, capacity, (bins, fresh), length, left, rank, capacity)
            bins += fresh
    return plan


def _fill(runs, plan, free, run, length, left, rank, capacity) -> tuple[int, int]:
    """Put pieces into the bins of one run; what is filled, half filled and untouched become runs of their own."""
    first, size = run
    per_bin = free // length
    n = min(left, per_bin * size)
    plan.append((length, rank, n, first, per_bin, capacity - free))
    full, rest = divmod(n, per_bin)
    if full:
        runs[free - per_bin * length].append((first, full))
    if rest:
        runs[free - rest * length].append((first + full, 1))
    used = full + (rest > 0)
    if used < size:
        runs[free].append((first + used, size - used))
    return left - n, rank + n


def numbered(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``__llm_rank``: 0 up within each length, counted block by block so that no length is one task."""
    total = rows.count()
    blocks = max(1, -(-total // block_rows)) * 4
    placed = rows.withColumn("__llm_block", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(blocks)))
    sizes = placed.groupBy("length", "__llm_block").agg(F.count("*").alias("m"))
    before = Window.partitionBy("length").orderBy("__llm_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "length", "__llm_block", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("__llm_offset")
    )
    inside = Window.partitionBy("length", "__llm_block").orderBy("doc_id", "piece")
    ranked = placed.withColumn("__llm_rank", F.row_number().over(inside))
    return ranked.join(offsets, ["length", "__llm_block"]).withColumn(
        "__llm_rank", F.col("__llm_offset") + F.col("__llm_rank") - 1
    )


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Every piece with ``sequence_id`` and ``offset`` (gapless from 0 in its sequence).

    Columns: doc_id, piece, start, length, ids (if ``with_ids``), ids_crc32, sequence_id, offset. Other
    columns of ``docs`` do not enter, so none can clash. Null and empty texts are one end token. Rows that
    share a doc_id, or are repeated as a whole, are packed each for itself. An empty table packs into nothing.
    """
    spark = docs.sparkSession
    made = pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    stored = materialize(made if with_ids else made.drop("ids"), "pieces")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["count"] for r in stored.groupBy("length").count().collect()}
    plan = best_fit(counts, capacity)
    columns = list(zip(*plan, strict=True)) or [[]] * 6
    names = [c.split()[0] for c in PLAN_SCHEMA.split(", ")]
    slots = spark.createDataFrame(
        pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, columns, strict=True)}), PLAN_SCHEMA
    )
    ranked = numbered(stored).withColumnRenamed("length", "__llm_length")
    rank, x = F.col("__llm_rank"), F.col("__llm_rank") - F.col("first_rank")
    # The plan's size depends on the capacity alone.
    fits = (F.col("__llm_length") == F.col("length")) & (rank >= F.col("first_rank")) & (x < F.col("n"))
    placed = ranked.join(F.broadcast(slots), fits)
    number = (F.col("first_bin") + F.floor(x / F.col("per_bin"))).cast("long")
    offset = (F.col("base") + F.pmod(x, F.col("per_bin")) * F.col("length")).cast("long")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        *(["ids"] if with_ids else []),
        "ids_crc32",
        number.alias("sequence_id"),
        offset.alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary) of whole sequences, from pieces with ids; a sequence holds ``capacity`` tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda s, p: F.concat(s, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))


def word_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op4_planned_best_fit(docs: DataFrame) -> DataFrame:
    """Pieces of all ``documents`` in sequences of 2048 tokens; nulls, repeats and empty tables as in ``pack``."""
    return pack(docs, word_tokenizer(), with_ids=False)
