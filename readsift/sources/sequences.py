"""FASTA and FASTQ files as one row per record, read in byte ranges."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

from readsift.functions import first_word
from readsift.sources.text import line_place, path_part, sample_of

RANGE_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
# Ranges the driver lists; beyond that, ranges become longer.
MAX_RANGES = 100_000

_SEQUENCE = re.compile(rb"[A-Za-z.*-]*")

FASTQ_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("line_no", LongType()),
        StructField("description", StringType()),
        StructField("seq", StringType()),
        StructField("qual", StringType()),
    ]
)
_ARROW_FASTQ = pa.schema(
    [
        ("path", pa.string()),
        ("line_no", pa.int64()),
        ("description", pa.string()),
        ("seq", pa.string()),
        ("qual", pa.string()),
    ]
)


def list_files(path: str) -> list[fs.FileInfo]:
    """Data files at a path: the file itself, or all files below the folder."""
    filesystem, base = fs.FileSystem.from_uri(path)
    info = filesystem.get_file_info(base)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [info]
    found = filesystem.get_file_info(fs.FileSelector(base, recursive=True))
    hidden = ("_", ".")
    return sorted(
        (f for f in found if f.type == fs.FileType.File and not f.base_name.startswith(hidden)),
        key=lambda f: f.path,
    )


@dataclass
class FileRange(InputPartition):
    root: str
    path: str
    start: int
    end: int


def _open(root: str, path: str):
    filesystem, _ = fs.FileSystem.from_uri(root)
    if path.endswith(".gz"):
        return filesystem.open_input_stream(path, compression="gzip")
    return filesystem.open_input_file(path)


def _line_blocks(part: FileRange) -> Iterator[tuple[int, bytes]]:
    """Whole lines from the first line start in the range on, block by block, with their offset.

    Goes on past the end of the range; the caller stops where it has enough.
    """
    zipped = part.path.endswith(".gz")
    with _open(part.root, part.path) as stream:
        offset, tail = 0, b""
        if part.start and not zipped:
            stream.seek(part.start - 1)
            offset = part.start - 1
            while True:
                block = stream.read(CHUNK_BYTES)
                if not block:
                    return
                cut = block.find(b"\n")
                if cut >= 0:
                    tail, offset = block[cut + 1 :], offset + cut + 1
                    break
                offset += len(block)
        while True:
            block = stream.read(CHUNK_BYTES)
            data = tail + block
            if not block:
                if data:
                    yield offset, data if data.endswith(b"\n") else data + b"\n"
                return
            cut = data.rfind(b"\n") + 1
            if cut:
                yield offset, data[:cut]
            offset, tail = offset + cut, data[cut:]


class _Lines:
    """Lines of a block without copies: where each starts and ends, a carriage return left out."""

    def __init__(self, data: bytes):
        self.data = data
        self.letters = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero(self.letters == 10)
        self.start = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64)[: len(ends)]
        back = (ends > self.start) & (self.letters[np.maximum(ends, 1) - 1] == 13)
        self.end = ends - back
        self.next = ends + 1

    def __len__(self) -> int:
        return len(self.start)

    def __getitem__(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]

    def first(self, lines: slice) -> np.ndarray:
        """The first byte of lines; a line break where a line is empty."""
        return self.letters[self.start[lines]]

    def length(self, lines: slice) -> np.ndarray:
        return self.end[lines] - self.start[lines]

    def text(self, lines: np.ndarray, skip: int = 0) -> pa.Array:
        """These lines as strings, without their first ``skip`` bytes."""
        size = self.end[lines] - self.start[lines] - skip
        ends = np.concatenate([[0], np.cumsum(size)])
        places = np.arange(ends[-1]) + np.repeat(self.start[lines] + skip - ends[:-1], size)
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.letters[places])]
        return pa.LargeStringArray.from_buffers(len(lines), *buffers[1:]).cast(pa.string())


@dataclass
class _Record:
    """A record over any number of lines; ``after`` is the line that follows it."""

    line: int
    seq: bytes
    qual: bytes
    after: int


def _record(lines: _Lines, i: int, strict: bool = False) -> _Record | str | None:
    """The record that line ``i`` opens, None if the lines end within it, else what is wrong.

    Sequence lines last until a line that starts with ``+``, and quality lines until they are as
    long as the sequence, so a quality line may start with any mark. ``strict`` allows
    letters, dots, stars and dashes only in the sequence.
    """
    if not lines[i].startswith(b"@"):
        return "a record starts with @"
    seq, j = [], i + 1
    while j < len(lines) and not lines[j].startswith(b"+"):
        if strict and not _SEQUENCE.fullmatch(lines[j]):
            return "not a sequence"
        seq.append(lines[j])
        j += 1
    if strict and not seq:
        return "not a sequence"
    total = sum(map(len, seq))
    qual, held, j = [], 0, j + 1
    while j < len(lines) and (held < total or not qual):
        if not total and lines[j]:
            break  # an empty record may do without a quality line
        qual.append(lines[j])
        held += len(lines[j])
        j += 1
    if held > total:
        return "sequence and quality differ in length"
    if j > len(lines) or held < total or not qual and j == len(lines):
        return None
    return _Record(i, b"".join(seq), b"".join(qual), j)


def _first_record(lines: _Lines, ended: bool) -> int | None:
    """First line that opens a record which another follows; None if more lines are needed.

    A quality line may start with ``@`` too, but then no sequence and quality of one length follow
    it up to the next ``@``, unless qualities imitate a whole record.
    """
    for i in range(len(lines)):
        found = _record(lines, i, strict=True)
        if isinstance(found, str):
            continue
        if found is None or found.after >= len(lines):
            return i if ended and found is not None else (None if not ended else -1)
        after = _record(lines, found.after, strict=True)
        if after is None and not ended:
            return None
        if not isinstance(after, str):
            return i
    return -1 if ended else None


def _batch(part: FileRange, start, heads, seq, qual) -> pa.RecordBatch:
    path = pa.array([part.path]).take(pa.array(np.zeros(len(start), np.int32)))
    columns = [path, pa.array(start, pa.int64()), heads, seq, qual]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_FASTQ)


def _parse(part: FileRange, lines: _Lines, offset: int, ended: bool):
    """Batches of the records in the lines, lines used, and whether the range's end was reached.

    Records of four lines are found and checked all at once; from the first other one on they
    are read one by one.
    """
    n = len(lines) // 4
    four = slice(0, 4 * n, 4), slice(1, 4 * n, 4), slice(2, 4 * n, 4), slice(3, 4 * n, 4)
    fit = (lines.first(four[0]) == 64) & (lines.first(four[2]) == 43)
    fit &= lines.length(four[1]) == lines.length(four[3])
    whole = n if fit.all() else int(np.argmin(fit))
    starts = offset + lines.start[: 4 * whole : 4]
    zipped = part.path.endswith(".gz")
    inside = whole if zipped else int(np.searchsorted(starts, part.end))
    batches, at = [], 4 * np.arange(inside)
    if inside:
        parts = lines.text(at, 1), lines.text(at + 1), lines.text(at + 3)
        batches.append(_batch(part, starts[:inside], *parts))
    if inside < whole:
        return batches, 4 * inside, True
    i, rows, done = 4 * whole, [], False
    while i < len(lines):
        place = offset + int(lines.start[i])
        if not zipped and place >= part.end:
            done = True
            break
        if whole == n and not ended and len(lines) - i < 4:
            break  # the rest of a four-line record comes with the next block
        if not lines[i] and (ended and not any(lines[k] for k in range(i, len(lines)))):
            i = len(lines)
            break
        found = _record(lines, i)
        if isinstance(found, str):
            raise ValueError(f"{part.path}: {found} ({lines[i][:40]!r})")
        if found is None or found.after == len(lines) and not ended and not found.qual:
            if ended:
                raise ValueError(f"{part.path}: last record is cut short")
            break
        rows.append((place, lines[i][1:].decode(), found.seq.decode(), found.qual.decode()))
        i = found.after
    if rows:
        start, *texts = zip(*rows, strict=True)
        batches.append(_batch(part, start, *[pa.array(x, pa.string()) for x in texts]))
    return batches, i, done


def read_range(part: FileRange) -> Iterator[pa.RecordBatch]:
    """Records whose header starts inside the range, as Arrow batches."""
    blocks = _line_blocks(part)
    held, offset, synced, ended = b"", None, part.start == 0, False
    while not ended:
        at, data = next(blocks, (None, b""))
        ended = at is None
        if offset is None:
            if ended:
                return
            offset = at
            if part.start == 0 and not data.startswith(b"@"):
                raise ValueError(f"{part.path}: not a FASTQ file")
        held += data
        lines = _Lines(held)
        if not synced:
            first = _first_record(lines, ended)
            if first is None:
                continue
            if first < 0:
                if part.start and len(held) > 2 * CHUNK_BYTES:
                    raise ValueError(f"{part.path}: no FASTQ record near byte {offset}")
                return
            skip = int(lines.start[first])
            held, offset, synced = held[skip:], offset + skip, True
            lines = _Lines(held)
        batches, used, done = _parse(part, lines, offset, ended)
        yield from batches
        if done:
            return
        skip = int(lines.next[used - 1]) if used else 0
        held, offset = held[skip:], offset + skip


class FastqReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self):
        parts, files = [], list_files(self.path)
        length = max(self.range_bytes, sum(f.size for f in files) // MAX_RANGES)
        for f in files:
            step = max(f.size, 1) if f.path.endswith(".gz") else length
            for start in range(0, f.size, step):
                parts.append(FileRange(self.path, f.path, start, min(start + step, f.size)))
        return parts or [FileRange(self.path, "", 0, 0)]

    def read(self, partition):
        if partition.path:
            yield from read_range(partition)


class FastqSource(DataSource):
    """FASTQ records, wrapped or not; plain files are split, gzipped ones read whole."""

    @classmethod
    def name(cls):
        return "fastq"

    def schema(self):
        return FASTQ_SCHEMA

    def reader(self, schema):
        return FastqReader(self.options)


def located(path: str) -> str:
    """The path as given, or made absolute where it is a relative local one."""
    return path if re.match(r"[a-z][a-z0-9+.-]*:", path) else os.path.abspath(path)


def sniff_format(spark: SparkSession, path: str) -> str:
    """FASTA or FASTQ, by the first character of every file.

    Only file names pass the driver; the first bytes are read by tasks. An empty file, a
    file that starts otherwise, or a mix of formats is an error. Below a folder, empty
    files beside others are passed over: Spark writes them for empty partitions.
    """
    names = [(f.path,) for f in list_files(path)]
    if not names:
        raise ValueError(f"{path}: no sequence file")

    def look(batches):
        for batch in batches:
            marks = []
            for name in batch.column(0).to_pylist():
                with _open(path, name) as stream:
                    marks.append(stream.read(1).decode("latin-1"))
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.string())], names=["mark"])

    files = spark.createDataFrame(names, "path string")
    marks = {r.mark for r in files.mapInArrow(look, "mark string").distinct().collect()}
    formats = {">": "fasta", "@": "fastq"}
    if marks == {""}:
        raise ValueError(f"{path}: first line is blank")
    marks.discard("")
    if marks - formats.keys():
        raise ValueError(f"{path}: neither FASTA nor FASTQ")
    if len(marks) > 1:
        raise ValueError(f"{path}: FASTA and FASTQ files mixed")
    return formats[marks.pop()]


def read_fasta(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """FASTA records of a file or of all files below a folder.

    Records are split by Spark's text reader at a line break before ``>``; a ``>`` inside a
    header is kept.
    """
    reader = spark.read.option("lineSep", "\n>").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    parts = F.split(F.regexp_replace("value", "^>", ""), "\r?\n", 2)
    rows = reader.text(path).select(*line_place(), parts.alias("p"))
    header = F.regexp_replace(F.col("p")[0], "\r$", "")
    body = F.coalesce(F.get("p", F.lit(1)), F.lit(""))
    return rows.select(
        "path",
        "line_no",
        header.alias("description"),
        F.regexp_replace(body, r"\s", "").alias("seq"),
        F.lit(None).cast("string").alias("qual"),
    )


def read_fastq(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    spark.dataSource.register(FastqSource)
    return spark.read.format("fastq").option("rangebytes", range_bytes).load(path)


def read_sequences(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    mate: int = 1,
    path_pattern: str | None = None,
) -> DataFrame:
    """Reads of FASTA or FASTQ files, gzipped or not, with sample and mate.

    Without ``fmt`` the format is found from the first character of the files. The first group
    of ``path_pattern`` finds the sample in a file's path and the second, if there is one,
    the mate: ``r"([^/]+)_([12])\\.fastq"`` makes the mate files of a sample its own.
    """
    path = located(path)
    fmt = fmt or sniff_format(spark, path)
    rows = read_fasta(spark, path) if fmt == "fasta" else read_fastq(spark, path)
    sample, number = sample_of(F.col("path")), F.lit(mate)
    if path_pattern:
        sample = path_part(path_pattern)
        if re.compile(path_pattern).groups > 1:
            number = path_part(path_pattern, 2).cast("int")
    return rows.select(
        sample.alias("sample"),
        number.alias("mate"),
        first_word(F.col("description")).alias("id"),
        "description",
        "seq",
        "qual",
        "path",
        "line_no",
    )


def read_genomes(spark: SparkSession, path: str, glob: str = "*.fna{,.gz}") -> DataFrame:
    """All contigs of ``*.fna`` and ``*.fna.gz`` below a folder as one table."""
    rows = read_fasta(spark, path, glob)
    name = first_word(F.col("description"))
    return rows.select("path", "line_no", name.alias("id"), "description", "seq")
