"""Canonical k-mers of sequences as 64-bit numbers, computed over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

MAX_K = 31
SLICE_BASES = 1 << 20
# Letters that are numbered at a time, and mean letters of a run of rows that is sorted by itself.
BLOCK_BASES = 1 << 15
RUN_BASES = 1 << 12

# Base codes, either case; every other letter is 4.
_CODES = np.full(256, 4, dtype=np.uint8)
for _code, _base in enumerate("ACGT"):
    _CODES[ord(_base)] = _CODES[ord(_base.lower())] = _code


def _canonical(codes: np.ndarray, k: int) -> np.ndarray:
    """Canonical k-mer at each position, in blocks that stay in a core's cache."""
    out = np.empty(max(len(codes) - k + 1, 0), np.int64)
    for start in range(0, len(out), BLOCK_BASES):
        fwd, rev = _rolling(codes[start : start + BLOCK_BASES + k - 1] & 3, k)
        np.minimum(fwd, rev, out=out[start : start + BLOCK_BASES])
    return out


def _rolling(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the k-mer at each position, forward and reverse-complemented.

    Words of doubling length are joined, in numbers as narrow as they fit in, and at last two words
    that overlap, so the work grows with log k.
    """
    fwd, rev, done = codes, 3 - codes, 1
    while 2 * done <= k:
        kind = np.uint8 if done <= 2 else np.uint16 if done <= 4 else np.uint32
        fwd, rev, n = fwd.astype(kind, copy=False), rev.astype(kind, copy=False), len(fwd) - done
        fwd = (fwd[:n] << (2 * done)) | fwd[done:]
        rev = (rev[done:] << (2 * done)) | rev[:n]
        done *= 2
    fwd, rev, rest = fwd.astype(np.int64), rev.astype(np.int64), k - done
    if rest:
        n, low = len(fwd) - rest, (1 << (2 * rest)) - 1
        fwd = (fwd[:n] << (2 * rest)) | (fwd[rest:] & low)
        rev = (rev[rest:] << (2 * rest)) | (rev[:n] & low)
    return fwd, rev


def _slices(data: np.ndarray, ends: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Start, base codes and, for each position a k-mer can begin at, whether it has one, slice by slice."""
    for start in range(0, len(data), SLICE_BASES):
        codes = _CODES[data[start : start + SLICE_BASES + k - 1]]
        n = len(codes) - k + 1
        if n < 1:
            return
        good = np.ones(n, bool)
        border = ends[np.searchsorted(ends, start, "right") : np.searchsorted(ends, start + n + k - 1)] - start
        for back in range(1, k):
            across = border - back
            good[across[(across >= 0) & (across < n)]] = False
        foreign = codes > 3
        if foreign.any():
            seen = np.concatenate(([0], np.cumsum(foreign, dtype=np.int32)))
            good &= seen[k:] == seen[:n]
        yield start, codes, good


def _rows_at(ends: np.ndarray, start: int, n: int) -> np.ndarray:
    """Row of each of ``n`` positions."""
    first = np.searchsorted(ends, start, "right")
    last = np.searchsorted(ends, start + n - 1, "right")
    size = np.diff(np.minimum(ends[first : last + 1] - start, n), prepend=0)
    return np.repeat(np.arange(first, first + len(size)), size)


def _kmer_rows(data: np.ndarray, ends: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row number, k-mer) of all k-mers without a foreign letter, slice by slice."""
    for start, codes, good in _slices(data, ends, k):
        yield _rows_at(ends, start, len(good))[good], _canonical(codes, k)[good]


def _distinct(values: np.ndarray) -> np.ndarray:
    """Values in order, each once; ``values`` is sorted in place."""
    values.sort()
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def _numbered(
    data: np.ndarray, ends: np.ndarray, numbers: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-mers of each slice with the numbers of their rows, each pair once where runs are long.

    Rows that follow each other with one number are one run, as the chunks of a contig are, so its
    k-mers need no number each until only the distinct ones are left.
    """
    last = np.flatnonzero(np.append(numbers[1:] != numbers[:-1], len(numbers) > 0))
    run_ends, run_numbers = ends[last], numbers[last]
    for start, codes, good in _slices(data, ends, k):
        values, n = _canonical(codes, k), len(good)
        first = np.searchsorted(run_ends, start, "right")
        stops = np.minimum(run_ends[first : np.searchsorted(run_ends, start + n - 1, "right") + 1] - start, n)
        if len(stops) * RUN_BASES > n + RUN_BASES:
            rows = _rows_at(ends, start, n)[good]
            yield values[good], numbers[rows]
            continue
        begins = np.concatenate(([0], stops[:-1]))
        parts = [_distinct(values[a:b][good[a:b]]) for a, b in zip(begins, stops, strict=True)]
        of = np.repeat(run_numbers[first : first + len(parts)], [len(x) for x in parts])
        yield np.concatenate(parts), of


def kmers(
    df: DataFrame, k: int, keep: Sequence[str], seq: str = "seq", keep_empty: bool = False
) -> DataFrame:
    """One row per k-mer of ``seq`` with the columns ``keep`` and the LONG ``kmer``.

    A k-mer and its reverse complement get the same number, the lower of the two. k-mers
    with a letter outside ACGT are skipped. With ``keep_empty`` a sequence without k-mers
    gives one row with a negative ``kmer``; its values differ, lest such rows gather
    under one key in a later shuffle.
    """
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k must be from 1 to {MAX_K}")
    keep = list(keep)
    source = df.select(*keep, F.col(seq).alias("_seq"))
    fields = [f for f in source.schema.fields if f.name != "_seq"]
    schema = StructType([*fields, StructField("kmer", LongType())])

    def explode(batches):
        for batch in batches:
            data, ends = _batch_letters(batch.column(len(keep)))
            kept = [batch.column(i) for i in range(len(keep))]
            filled = np.zeros(len(ends), dtype=bool)
            names = [*keep, "kmer"]
            for rows, values in _kmer_rows(data, ends, k):
                filled[rows] = True
                taken = pa.array(rows)
                cols = [c.take(taken) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(values)], names=names)
            empty = np.flatnonzero(~filled)
            if keep_empty and len(empty):
                taken = pa.array(empty)
                cols = [c.take(taken) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(-1 - empty)], names=names)

    return source.mapInArrow(explode, schema)


def kmer_spans(df: DataFrame, k: int, number: str, seq: str = "seq") -> DataFrame:
    """``kmer``, ``lo`` and ``hi``: least and largest ``number`` of the rows that hold a k-mer.

    One row per distinct k-mer of each slice of an Arrow batch. A task holds one slice at a
    time, however many k-mers its rows have. Rows without a number are left out.
    """
    source = df.select(F.col(number).cast("long"), seq)

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(0)))
            numbers = batch.column(0).to_numpy()
            for values, of in _numbered(*_batch_letters(batch.column(1)), numbers, k):
                if not len(values):
                    continue
                if (of != of[0]).any() or (values[1:] <= values[:-1]).any():
                    order = np.argsort(values)
                    values, of = values[order], of[order]
                first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values[first]),
                        pa.array(np.minimum.reduceat(of, first)),
                        pa.array(np.maximum.reduceat(of, first)),
                    ],
                    names=["kmer", "lo", "hi"],
                )

    return source.mapInArrow(run, "kmer long, lo long, hi long")


def _batch_letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all rows of a batch, and the end of each row."""
    text = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0]


def count_kmers(df: DataFrame, k: int, seq: str = "seq", out: str = "n_kmers") -> DataFrame:
    """Adds the number of k-mers of each row without a foreign letter."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        column = pa.array(texts, pa.large_string(), from_pandas=True)
        data, ends = _batch_letters(column)
        found = np.zeros(len(ends), np.int64)
        for start, _, good in _slices(data, ends, k):
            rows = _rows_at(ends, start, len(good))[good]
            found += np.bincount(rows, minlength=len(found))
        return pd.Series(found)

    return df.withColumn(out, count(F.col(seq)))


def kmer_lists(df: DataFrame, k: int, number: str, by: str, seq: str = "seq") -> DataFrame:
    """Inverted lists: ``by``, ``kmer``, ``row`` and ``more``, the numbers of the rows that hold it.

    One row per distinct k-mer and value of the whole number ``by`` in each slice of an Arrow
    batch, in place of one per occurrence; a row that holds a k-mer twice is listed twice.
    ``more`` is NULL where there is one row only, as for most k-mers, so that these take up four
    numbers and nothing of variable length.
    """
    source = df.select(F.col(by).cast("long").alias(by), F.col(number).cast("long"), seq)

    def run(batches):
        for batch in batches:
            group, numbers = (batch.column(i).to_numpy() for i in (0, 1))
            alone = not len(group) or group.min() == group.max()
            for rows, values in _kmer_rows(*_batch_letters(batch.column(2)), k):
                if not len(rows):
                    continue
                of = group[rows]
                order = np.argsort(values) if alone else np.lexsort((values, of))
                values, of = values[order], of[order]
                new = np.ones(len(order), bool)
                new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
                first = np.flatnonzero(new)
                listed = numbers[rows[order]]
                size = np.diff(np.append(first, len(order))) - 1
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                more = pa.ListArray.from_arrays(
                    pa.array(ends), pa.array(listed[~new]), mask=pa.array(size == 0)
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[first]), pa.array(values[first]), pa.array(listed[first]), more],
                    names=[by, "kmer", "row", "more"],
                )

    return source.mapInArrow(run, f"`{by}` long, kmer long, row long, more array<long>")


def listed_rows() -> Column:
    """All numbers of an inverted list."""
    return F.concat(F.array("row"), F.coalesce("more", F.expr("cast(array() as array<long>)")))


def kmer_text(kmer: Column, k: int) -> Column:
    """Letters of a k-mer number."""
    digits = F.lpad(F.conv(kmer.cast("string"), 10, 4), k, "0")
    return F.translate(digits, "0123", "ACGT")
