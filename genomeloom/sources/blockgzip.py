"""Block gzip as lines: a Python data source whose partitions are ranges of compressed bytes.

A block-gzip file is a chain of gzip members of at most 64 KB, each of which tells its own size, so a reader can begin
at any member. Files are cut at equal compressed offsets without a pass over them: a task looks for the first
member in its range, and reads on past the end of the range to finish its last line. Plain gzip has no such places
and stays one partition, as does a small file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, block bigint, pos bigint, value string"
RANGE_BYTES = 32 << 20
# Fixed values of the format: gzip with an extra field, and in it the subfield that holds the size of the member.
MAGIC = b"\x1f\x8b\x08\x04"
SIZE_FIELD = b"BC\x02\x00"
MAX_MEMBER = 1 << 16
BATCH_LINES = 1 << 14


def member_size(data: bytes, at: int = 0) -> int | None:
    """Compressed size of the block-gzip member that begins at ``at``; None if there is none."""
    if data[at : at + 4] != MAGIC or len(data) < at + 12:
        return None
    extra = data[at + 12 : at + 12 + int.from_bytes(data[at + 10 : at + 12], "little")]
    while len(extra) >= 6:
        if extra[:4] == SIZE_FIELD:
            return int.from_bytes(extra[4:6], "little") + 1
        extra = extra[4 + int.from_bytes(extra[2:4], "little") :]
    return None


def first_member(data: bytes, at_end: bool) -> int | None:
    """Offset of the first member in ``data``: bytes that look like one count only if another one (or the end) follows."""
    at = data.find(MAGIC)
    while at >= 0:
        size = member_size(data, at)
        if size and (member_size(data, at + size) or (at_end and at + size == len(data))):
            return at
        at = data.find(MAGIC, at + 1)
    return None


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LineRange(InputPartition):
    def __init__(self, path: str, begin: int, end: int, size: int, blocked: bool):
        self.path, self.begin, self.end, self.size, self.blocked = path, begin, end, size, blocked


class BlockGzipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["path"].split("\n")
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))

    def partitions(self) -> list[LineRange]:
        """Ranges of every file; of each the first header is read, nothing else."""
        out = []
        for path in self.paths:
            system, name = _opened(path)
            size = system.get_file_info(name).size
            with system.open_input_file(name) as file:
                blocked = member_size(file.read(MAX_MEMBER)) is not None
            step = self.range_bytes if blocked else max(size, 1)
            out += [LineRange(path, a, min(a + step, size), size, blocked) for a in range(0, max(size, 1), step)]
        return out

    def read(self, part: LineRange) -> Iterator[pa.RecordBatch]:
        system, name = _opened(part.path)
        with system.open_input_file(name) as file:
            lines = _block_lines(file, part) if part.blocked else _plain_lines(file)
            at, rows = 0, []
            for line in lines:
                rows.append(line)
                if len(rows) == BATCH_LINES:
                    yield _batch(part, at, rows)
                    at, rows = at + len(rows), []
            if rows:
                yield _batch(part, at, rows)


def _batch(part: LineRange, at: int, rows: list[bytes]) -> pa.RecordBatch:
    n = len(rows)
    text = [r.replace(b"\r", b"").decode("utf-8", "replace") for r in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([part.path] * n), pa.array([part.begin] * n, pa.int64()), pa.array(range(at, at + n), pa.int64()), pa.array(text, pa.string())],
        ["file", "block", "pos", "value"],
    )


def _plain_lines(file) -> Iterator[bytes]:
    """Lines of gzip members one after the other, whatever their size."""
    rest, unpack = b"", zlib.decompressobj(31)
    while chunk := file.read(1 << 20):
        while chunk:
            text = rest + unpack.decompress(chunk)
            *whole, rest = text.split(b"\n")
            yield from whole
            chunk = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)
    if rest:
        yield rest


def _members(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Members from offset ``at`` on, each with its offset."""
    while at < size:
        file.seek(at)
        data = file.read(MAX_MEMBER * 16)
        inside = 0
        while (length := member_size(data, inside)) and inside + length <= len(data):
            yield at + inside, zlib.decompress(data[inside : inside + length], 31)
            inside += length
        if not inside:
            raise ValueError(f"no gzip member at offset {at}")
        at += inside


def _block_lines(file, part: LineRange) -> Iterator[bytes]:
    """Lines that begin in the members of the range. The line at its first byte belongs to the range before."""
    file.seek(part.begin)
    found, base, data = None, part.begin, b""
    while part.begin and found is None and base < part.end:
        data = file.read(3 * MAX_MEMBER)
        found = first_member(data, base + len(data) >= part.size)
        if found is None:
            base += 2 * MAX_MEMBER
            file.seek(base)
    if part.begin and (found is None or base + found >= part.end):
        return
    rest, skipping = b"", bool(part.begin)
    for at, text in _members(file, base + (found or 0), part.size):
        beyond = at >= part.end
        pieces = (rest + text).split(b"\n")
        rest = pieces.pop()
        if beyond and pieces:
            # The line that the range's end cuts, or that begins right there.
            if not skipping:
                yield pieces[0]
            return
        if skipping and pieces:
            skipping = False
            pieces = pieces[1:]
        yield from pieces
    if rest and not skipping:
        yield rest


class BlockGzipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "block_gzip_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(self.options)


def read_block_gzip_lines(spark: SparkSession, path, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, block, pos, value`` of gzip files, block gzip in ranges of ``range_bytes`` compressed bytes.

    ``path`` is a file, a glob, or a list of them; Spark's file index finds the files, tasks open them with Arrow's
    file systems.
    """
    index = spark.read.format("binaryFile").load(path).select(F.col("path"))
    files = sorted(index.inputFiles())
    spark.dataSource.register(BlockGzipSource)
    reader = spark.read.format("block_gzip_lines").option("range_bytes", str(range_bytes))
    return reader.option("path", "\n".join(files)).load()


def write_block_gzip(lines: DataFrame, path: str, member_bytes: int = 65_280) -> list[str]:
    """Write ``value`` as block gzip, one file per partition in its order; returns the files.

    A file is named after the attempt that wrote it, and only attempts that succeed return their name: files
    that a lost executor left behind are not read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        file = f"{path.rstrip('/')}/part-{task.partitionId():05d}-{task.taskAttemptId()}.gz"
        system, name = _opened(file)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(name, compression=None) as out:
            rest = bytearray()
            for batch in batches:
                for line in batch.column("value").to_pylist():
                    rest += line.encode() + b"\n"
                    while len(rest) >= member_bytes:
                        out.write(member(bytes(rest[:member_bytes])))
                        del rest[:member_bytes]
            out.write((member(bytes(rest)) if rest else b"") + member(b""))
        yield pa.RecordBatch.from_pydict({"file": [file]})

    return sorted(r["file"] for r in lines.select("value").mapInArrow(write, "file string").collect())


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = pack.compress(data) + pack.flush()
    size = len(body) + 26
    head = MAGIC + bytes(4) + b"\x00\xff" + (6).to_bytes(2, "little") + SIZE_FIELD + (size - 1).to_bytes(2, "little")
    return head + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")
