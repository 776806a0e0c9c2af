"""Line dedup by winnowing over rolling lines.

A rolling line is ``min_words`` words in a row, beginning at any word: a passage need not begin or end
where a line of the text does. Of every ``min_words`` rolling lines in a row the one with the smallest
hash is elected as fingerprint (the last of equal ones), so two texts that share ``2 * min_words - 1``
words in a row are certain to elect the same one in it, and elected ones leave no word between them.

Positions are joined on the fingerprint: every later place meets the first one. Places that follow each
other on the same diagonal are one chain. Both ends of a chain are extended word by word, by less than a
rolling line: where the common run goes on for longer, another fingerprint lies there. What chains cover
at later places is deleted.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import give_back, materialize, written
from .common import SPACE_CHARS, whole_text

# Words of a rolling line.
MIN_WORDS = 20
# A run that ends inside a line leaves the line whole if it holds fewer words of it.
EDGE = 8
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
# Bits of an election key that hold the place.
PLACE_BITS = 28

_BLANK = np.zeros(256, bool)
_BLANK[list(SPACE_CHARS.encode())] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


class Words:
    """The words of all texts of a batch: byte ranges, and each text's range of words."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary())
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        low, high = (int(offsets[0]), int(offsets[-1])) if n else (0, 0)
        self.offsets = offsets - low
        self.data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
        inside = ~_BLANK[self.data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        filled = self.offsets[1:] > self.offsets[:-1]
        head, tail = self.offsets[:-1][filled], self.offsets[1:][filled] - 1
        begins[head], ends[tail] = inside[head], inside[tail]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        # Text i has the words edges[i] to edges[i + 1].
        self.edges = np.searchsorted(self.starts, self.offsets)
        self.inside = inside

    def array(self) -> pa.Array:
        at = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        chars = self.data[self.inside]
        return pa.Array.from_buffers(pa.large_binary(), len(self.starts), [None, pa.py_buffer(at), pa.py_buffer(chars)])

    def hashes(self) -> np.ndarray:
        """Two numbers per word."""
        coded = self.array().dictionary_encode()
        digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
        return np.frombuffer(digests, np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]

    def line_starts(self, sentences: bool) -> np.ndarray:
        """Whether a word begins a line: the text, after a newline, after a sentence end."""
        found = np.zeros(len(self.starts), bool)
        found[self.edges[:-1][self.edges[:-1] < self.edges[1:]]] = True
        newlines = np.cumsum(self.data == 10)
        if len(found) > 1:
            gap = newlines[self.starts[1:] - 1] > newlines[self.ends[:-1] - 1]
            found[1:] |= gap
            if sentences:
                found[1:] |= _STOP[self.data[self.ends[:-1] - 1]]
        return found

    def slice(self, a: int, b: int) -> list[bytes]:
        return [self.data[s:e].tobytes() for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


@functools.lru_cache(maxsize=4)
def _powers(odd: int, size: int) -> np.ndarray:
    out = np.full(size, odd, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def rolling(values: np.ndarray, at: np.ndarray, width: int, odd: int) -> np.ndarray:
    """Hash of ``width`` values from each place of ``at`` on: a polynomial, moved to power 0."""
    size = 1 << max(10, int(len(values)).bit_length())
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * _powers(odd, size)[: len(values)], dtype=np.uint64)])
    found = (sums[at + width] - sums[at]) * _powers(pow(odd, -1, 1 << 64), size)[at]
    return (found ^ (found >> np.uint64(31))) * np.uint64(ODD[0])


def elected(hashes: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Places of window minima; ``counts``: how many of the hashes each text has. The last of equal ones wins."""
    n = len(hashes)
    low = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~low) | (low - (np.arange(n, dtype=np.uint64) & low))
    base = np.concatenate([[0], np.cumsum(counts)])
    least, width = keys, 1
    while width * 2 <= window and len(least) > width:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    chosen = []
    if n >= window:
        rest = window - width
        least = np.minimum(least[: n - window + 1], least[rest : rest + n - window + 1])
        owner_end = np.repeat(base[1:], counts)
        chosen.append(least[np.arange(n - window + 1) + window <= owner_end[: n - window + 1]])
    short = (counts > 0) & (counts < window)
    if short.any():
        bounds = np.stack([base[:-1][short], base[1:][short]], 1).ravel()
        padded = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))
        chosen.append(np.minimum.reduceat(padded, bounds)[::2])
    if not chosen:
        return np.zeros(0, np.int64)
    picked = np.unique((low - (np.concatenate(chosen) & low)).astype(np.int64))
    return picked


def thinned(place: np.ndarray, hashes: np.ndarray, row: np.ndarray, step: int) -> np.ndarray:
    """Of neighbouring places with one hash (a word over and over) every ``step``-th and the last."""
    if not len(place):
        return place
    fresh = np.ones(len(place), bool)
    fresh[1:] = (np.diff(place) > 1) | (hashes[place[1:]] != hashes[place[:-1]]) | (row[place[1:]] != row[place[:-1]])
    at = np.arange(len(place))
    since = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return place[(since % step == 0) | np.append(fresh[1:], True)]


def fingerprints(keyed: DataFrame, least: int) -> DataFrame:
    """h1, h2 (the hash), id, digest, pos (first word) of the elected rolling lines of each text."""
    id_type = keyed.schema["id"].dataType.simpleString()

    def elect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(2))
            counts = np.maximum(np.diff(words.edges) - least + 1, 0)
            if not counts.sum():
                continue
            row = np.repeat(np.arange(len(counts)), counts)
            base = np.concatenate([[0], np.cumsum(counts)])
            at = np.arange(base[-1]) - base[row] + words.edges[row]
            values = words.hashes()
            first = rolling(values[:, 0], at, least, ODD[0])
            place = elected(first, counts, least)
            place = thinned(place, first, row, least)
            at, row = at[place], row[place]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first[place].view(np.int64)),
                    pa.array(rolling(values[:, 1], at, least, ODD[1]).view(np.int64)),
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array((at - words.edges[row]).astype(np.int32)),
                ],
                ["h1", "h2", "id", "digest", "pos"],
            )

    return keyed.mapInArrow(elect, f"h1 long, h2 long, id {id_type}, digest long, pos int")


def chains(later: DataFrame, least: int) -> DataFrame:
    """Runs of places without a gap: (id, digest, start, end), in words, and where the first and last of a run's
    places stood before: (fid, fdigest, fstart, fend)."""
    id_type = later.schema["id"].dataType.simpleString()
    grouped = later.groupBy("id", "digest").agg(F.collect_set(F.struct("pos", "fid", "fdigest", "fpos")).alias("places"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            pos, fid, fdigest, fpos = lists.flatten().flatten()
            order = np.lexsort((pos.to_numpy(), row))
            sort = pa.array(order)
            row, pos, fpos = row[order], pos.to_numpy()[order], fpos.to_numpy()[order]
            fid, fdigest = fid.take(sort), fdigest.take(sort)
            code = fid.dictionary_encode(null_encoding="encode").indices.to_numpy()
            kind = np.stack([row, code, fdigest.to_numpy()])
            step, fstep = np.diff(pos), np.diff(fpos)
            cut = (kind[:, 1:] != kind[:, :-1]).any(axis=0) | (step > least) | ((step != fstep) & (fstep != 0))
            a = np.concatenate([[0], np.flatnonzero(cut) + 1]) if len(pos) else np.zeros(0, np.int64)
            b = np.append(a[1:], len(pos)) - 1 if len(pos) else a
            take, owner = pa.array(a), pa.array(row[a])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(pos[a].astype(np.int32)),
                    pa.array((pos[b] + least).astype(np.int32)),
                    fid.take(take),
                    fdigest.take(take),
                    pa.array(fpos[a].astype(np.int32)),
                    pa.array((fpos[b] + least).astype(np.int32)),
                ],
                ["id", "digest", "start", "end", "fid", "fdigest", "fstart", "fend"],
            )

    ints = "{0}id {1}, {0}digest long, {0}start int, {0}end int"
    return grouped.mapInArrow(join_up, ints.format("", id_type) + ", " + ints.format("f", id_type))


def marks(runs: DataFrame) -> DataFrame:
    """(id, digest, asked, cut) of the texts that ``runs`` name: the questions for ``surroundings``, whether a run is cut out."""
    question = F.explode(F.array(
        F.struct(F.col("fstart").alias("at"), F.lit(0).alias("side")), F.struct(F.col("fend").alias("at"), F.lit(1).alias("side"))
    )).alias("q")
    asked = runs.select(F.col("fid").alias("id"), F.col("fdigest").alias("digest"), question, F.lit(False).alias("cut"))
    cut = runs.select("id", "digest", F.lit(None).cast(asked.schema["q"].dataType).alias("q"), F.lit(True).alias("cut"))
    return asked.unionByName(cut).groupBy("id", "digest").agg(F.collect_set("q").alias("asked"), F.max("cut").alias("cut"))


def surroundings(met: DataFrame, least: int) -> DataFrame:
    """(fid, fdigest, at, side, near) of ``met`` (id, digest, text, asked): less than a rolling line of words before
    (side 0) or behind (side 1) ``at``."""
    id_type = met.schema["id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(2))
            rows, ats, sides, nears = [], [], [], []
            for row, questions in enumerate(batch.column(3).to_pylist()):
                low, high = words.edges[row], words.edges[row + 1]
                for q in questions:
                    at = low + q["at"]
                    a, b = (max(low, at - least + 1), at) if q["side"] == 0 else (at, min(high, at + least - 1))
                    rows.append(row)
                    ats.append(q["at"])
                    sides.append(q["side"])
                    nears.append(b" ".join(words.slice(a, b)))
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take), batch.column(1).take(take),
                    pa.array(ats, pa.int32()), pa.array(sides, pa.int32()), pa.array(nears, pa.binary()),
                ],
                ["fid", "fdigest", "at", "side", "near"],
            )

    out = met.select("id", "digest", "text", "asked").mapInArrow(
        look, f"fid {id_type}, fdigest long, at int, side int, near binary"
    )
    # A row that is repeated as a whole answers more than once.
    return out.dropDuplicates(["fid", "fdigest", "at", "side"])


def repeated_runs(keyed: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Chains of ``keyed`` (id, digest, text) that stand at an earlier place, as in ``chains``.

    Places are ordered by id (null last), then digest, then word.
    """
    # Tables that are joined are stored first: the joins then meet two plain exchanges, and a hot key can be split.
    prints = materialize(fingerprints(keyed, least), "prints")
    spent = written()[-1:]
    # Half a hash is enough to leave out what stands once; only the others' places are ordered.
    often = materialize(prints.groupBy("h1").agg(F.count("*").alias("n")).where("n > 1").select("h1"), "often")
    found = materialize(prints.join(often, "h1"), "again")
    # The largest table but the texts; nothing reads it any more.
    give_back(keyed.sparkSession, spent)
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("digest").alias("digest"), F.col("pos").alias("pos"))
    firsts = (
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last")
        .select("h1", "h2", "first")
    )
    firsts = materialize(firsts, "firsts")
    overlaps = (
        F.col("id").eqNullSafe(F.col("first.id"))
        & (F.col("digest") == F.col("first.digest"))
        & (F.col("pos") < F.col("first.pos") + least)
    )
    later = (
        found.join(firsts, ["h1", "h2"])
        .where((place != F.col("first")) & ~overlaps)
        .select("id", "digest", "pos", F.col("first.id").alias("fid"), F.col("first.digest").alias("fdigest"), F.col("first.pos").alias("fpos"))
    )
    return materialize(chains(later, least), "chains")


def with_surroundings(runs: DataFrame, around: DataFrame) -> DataFrame:
    """(id, digest, start, end, before, behind): ``runs`` with the words around the place where they stood before."""
    for side, at, name in ((0, "fstart", "before"), (1, "fend", "behind")):
        part = around.where(F.col("side") == side).select(
            F.col("fid").alias("__fid"), F.col("fdigest").alias("__fdigest"), F.col("at").alias("__at"), F.col("near").alias(name)
        )
        here = F.col("fid").eqNullSafe(F.col("__fid")) & (F.col("fdigest") == F.col("__fdigest")) & (F.col(at) == F.col("__at"))
        runs = materialize(runs.join(part, here).drop("__fid", "__fdigest", "__at"), "runs")
    return runs.select("id", "digest", "start", "end", "before", "behind")


def common_head(a: list[bytes], b: list[bytes]) -> int:
    """How many words agree from the start on."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def deleted(words: Words, row: int, runs: list[dict], begins: np.ndarray, edge: int) -> list[tuple[int, int]]:
    """Ranges of words (of the batch) that go: runs, extended, united, drawn back to the edge of a line hardly met."""
    low, high = int(words.edges[row]), int(words.edges[row + 1])
    ranges = []
    for run in runs:
        a, b = low + run["start"], low + run["end"]
        before, behind = run["before"].split(), run["behind"].split()
        a -= common_head(words.slice(max(low, a - len(before)), a)[::-1], before[::-1])
        b += common_head(words.slice(b, min(high, b + len(behind))), behind)
        ranges.append((a, b))
    united: list[list[int]] = []
    for a, b in sorted(ranges):
        if united and a <= united[-1][1]:
            united[-1][1] = max(b, united[-1][1])
        else:
            united.append([a, b])
    out = []
    for a, b in united:
        ahead = np.flatnonzero(begins[a : min(a + edge, high)])
        if len(ahead):
            a += int(ahead[0])
        if b < high and not begins[b]:
            back = np.flatnonzero(begins[max(low, b - edge + 1) : b])
            if len(back):
                b = max(low, b - edge + 1) + int(back[-1])
        if a < b:
            out.append((a, b))
    return out


def without_words(words: Words, row: int, gone: list[tuple[int, int]]) -> bytes:
    """The text without those words and the white space behind them."""
    low, high = int(words.edges[row]), int(words.edges[row + 1])
    at, end = int(words.offsets[row]), int(words.offsets[row + 1])
    parts = []
    for a, b in gone:
        parts.append(words.data[at : int(words.starts[a])].tobytes() if a > low else b"")
        at = int(words.starts[b]) if b < high else end
    parts.append(words.data[at:end].tobytes())
    return b"".join(parts)


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    sentences: bool = True,
    edge: int = EDGE,
) -> DataFrame:
    """All rows and columns of ``docs``, later repeated runs taken out of the text; adds n_removed (words).

    A run of words goes when it stands, word for word, at an earlier place: in a row with a smaller id, or
    further up in the same text, not overlapping. Runs of ``2 * min_words - 1`` words are always met, runs of ``min_words``
    may be, shorter ones never. A run that ends inside a line (``sentences``: or sentence) of which it holds fewer than
    ``edge`` words leaves that line whole. White space between words does not count. Null ids come last; of rows with one id the
    text's hash decides; a row that is repeated as a whole counts as one and loses the same words. Null texts
    stay null and empty ones empty; shorter texts than ``min_words`` stay as they are. An empty table gives an empty
    table. An input column named n_removed is replaced.
    """
    names = [c for c in docs.columns if c.lower() != "n_removed"]
    digest = F.xxhash64(whole_text(text_col))
    keyed = docs.select(
        F.col(id_col).alias("id"), digest.alias("digest"), whole_text(text_col).cast("binary").alias("text")
    )
    runs = repeated_runs(keyed, min_words)
    named = materialize(
        marks(runs).select(*[F.col(c).alias(f"__llm_{c}") for c in ("id", "digest", "asked", "cut")]), "marks"
    )
    # The texts travel once, to what names them; of those only the ones that lose words travel again.
    stored = [c for c in names if docs.schema[c].dataType != T.NullType()]
    rows = docs.select(*[f"`{c}`" for c in stored]).withColumn("__llm_own", digest)
    here = F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.col("__llm_own") == F.col("__llm_digest"))
    met = materialize(rows.join(named, here, "left").drop("__llm_id", "__llm_digest"), "met")
    text = whole_text(text_col).cast("binary").alias("text")
    asked = met.where(F.size("__llm_asked") > 0).select(
        F.col(id_col).alias("id"), F.col("__llm_own").alias("digest"), text, F.col("__llm_asked").alias("asked")
    )
    around = materialize(surroundings(asked, min_words), "around")
    cuts = (
        with_surroundings(runs, around)
        .groupBy("id", "digest")
        .agg(F.collect_set(F.struct("start", "end", "before", "behind")).alias("runs"))
        .select(F.col("id").alias("__llm_id"), F.col("digest").alias("__llm_digest"), F.col("runs").alias("__llm_runs"))
    )
    cuts = materialize(cuts, "cuts")
    met = met.select("*", *[F.lit(None).alias(c) for c in names if c not in stored])
    joined = met.where("__llm_cut").join(cuts, here, "left")
    whole = met.where("not coalesce(__llm_cut, false)").select(*[f"`{c}`" for c in names], F.lit(0).alias("n_removed"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("__llm_text"))
            runs_of = batch.column(batch.schema.get_field_index("__llm_runs"))
            touched = runs_of.is_valid()
            removed = np.zeros(len(texts), np.int32)
            at = np.flatnonzero(touched.to_numpy(zero_copy_only=False))
            if len(at):
                words = Words(texts.filter(touched))
                begins = words.line_starts(sentences)
                left = []
                for row, cuts in enumerate(runs_of.filter(touched).to_pylist()):
                    gone = deleted(words, row, cuts, begins, edge)
                    left.append(without_words(words, row, gone))
                    removed[at[row]] = sum(b - a for a, b in gone)
                texts = pc.replace_with_mask(texts, touched, pa.array(left, texts.type))
            columns = [batch.column(i) for i in range(len(names))]
            columns[names.index(text_col)] = texts.cast(pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed)], schema_names)

    out = docs.select(*[f"`{c}`" for c in names]).schema
    schema_names = [*names, "n_removed"]
    staged = joined.select(
        *[F.lit(None).cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in names],
        "__llm_runs",
        F.col(text_col).cast("binary").alias("__llm_text"),
    )
    return staged.mapInArrow(clean, out.add("n_removed", T.IntegerType())).unionByName(whole)


def op3_winnowed_lines(docs: DataFrame) -> DataFrame:
    """Whole ``documents``: doc_id, text without later repeats, n_removed (words); nulls and ties as in ``dedup_lines``."""
    return dedup_lines(docs.select("doc_id", "text"))
