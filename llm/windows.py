"""Repeated windows of a fixed length over all texts of a corpus.

A window is ``length`` consecutive symbols (bytes or words) of one text. The question for
each window is whether the same symbols start earlier. Four steps answer it exactly, with
work that grows with the corpus and not with the square of any group:

1. The smallest rolling hash of ``gram`` symbols inside a window is its trigger. Neighbouring
   windows mostly share it, so windows fall into runs. A run's whole stretch of symbols is a
   *phrase*. Equal windows have equal triggers at equal places, whatever surrounds them.
2. Triggers that occur once in the corpus are dropped: their windows are unique. A bit
   filter made from the counted triggers does this in the scan.
3. Phrases are compared as wholes by 128 bits of hash: an occurrence after the first is
   repeated in full. Each task keeps one occurrence per phrase before it shuffles, so a phrase of a
   third of all texts is one row per task.
4. Where one trigger has several distinct phrases (the path branches), the windows of
   the first occurrence of each are compared with one another: trigger by trigger within
   a task while a trigger has few phrases, else window by window through Spark.

Rows with the same id and text count as one document; rows with the same id and other
text are different documents. A null id counts as the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import arrays
from llm.common import BitFilter, rows_of, stage

_LAST = np.iinfo(np.int64).max
#: Phrases whose windows are made at once. A trigger with more is settled alone, its windows made in parts.
_PIECE = 2_048
#: Bytes of text whose listed phrases are copied at once: each byte lies in several of them.
_COPIED = arrays.BLOCK_BYTES // 4
_PHRASE = "k long, c long, doc long, th long, a int, b int, kind int"


@dataclass(frozen=True)
class Kind:
    """What a window is made of, and which occurrences count as earlier.

    ``words`` takes words ended by white space in place of bytes. ``within`` lets
    earlier places of the same document count, else only smaller ids do.
    """

    length: int
    gram: int
    words: bool
    within: bool
    flush: int = 400_000
    local: int = 16_384

    @property
    def order(self) -> list[str]:
        return ["doc", "th", "a"] if self.within else ["doc"]


def _sequence(kind: Kind, data, offsets):
    """Hasher over the symbols of a block, and the place of each text's first symbol."""
    if kind.words:
        start, end, first = arrays.words(data, offsets, arrays.NOT_SPACE)
        return arrays.Hasher(arrays.word_hashes(data, start, end)), first
    return arrays.Hasher(data), offsets


def _phrases(kind: Kind, data, offsets):
    """Triggers of one block: hash, phrase hash, text number, first and last window start."""
    hasher, first = _sequence(kind, data, offsets)
    grams = hasher.grams(kind.gram)
    least = arrays.window_argmin(grams, kind.length - kind.gram + 1)
    limit = np.repeat(first[1:], np.diff(first))[: len(least)]
    place = np.flatnonzero(np.arange(len(least)) + kind.length <= limit)
    chosen = least[place]
    run = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])) if len(chosen) else []
    if not len(run):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    start = place[run]
    last = place[np.append(run[1:], len(place)) - 1]
    at = chosen[run]
    text = np.searchsorted(first, at, "right") - 1
    shift = first[text]
    phrase = hasher.spans(start, last + kind.length)
    return grams[at], phrase, text, start - shift, last - shift


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    return arrays.blocks(batch.column("text"))


def _count_triggers(kind: Kind):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, _, data, offsets in _texts(batch):
                held.append(_phrases(kind, data, offsets)[0])
                size += len(held[-1])
                if size >= kind.flush:
                    yield _counted(held)
                    held, size = [], 0
        if held:
            yield _counted(held)

    return run


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    key, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["k", "n"]
    )


def _find_phrases(kind: Kind, wanted: BitFilter):
    def run(batches):
        held, size = [], 0
        for batch in batches:
            doc = batch.column("doc").fill_null(_LAST).to_numpy(zero_copy_only=False)
            th = batch.column("th").to_numpy(zero_copy_only=False)
            for lo, _, data, offsets in _texts(batch):
                k, c, text, a, b = _phrases(kind, data, offsets)
                on = wanted.contains(k)
                text = text[on] + lo
                held.append(
                    (k[on].view(np.int64), c[on].view(np.int64), doc[text], th[text], a[on], b[on])
                )
                size += int(on.sum())
                if size >= kind.flush:
                    yield _first_of_each(kind, held)
                    held, size = [], 0
        if held:
            yield _first_of_each(kind, held)

    return run


def _first_of_each(kind: Kind, held: list[tuple]) -> pa.RecordBatch:
    """Phrases with their earliest occurrence (kind 0); later ones as covered ranges (kind 1)."""
    k, c, doc, th, a, b = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((a, th, doc, c, k))
    k, c, doc, th, a, b = (x[order] for x in (k, c, doc, th, a, b))
    later = _after_first([k, c], [doc, th, a] if kind.within else [doc])
    first = ~later
    span = _joined(doc[later], th[later], a[later], b[later] + kind.length)
    zeros = np.zeros(len(span[0]), np.int64)
    columns = [
        np.concatenate([x, y])
        for x, y in zip(
            (k[first], c[first], doc[first], th[first], a[first], b[first]),
            (zeros, zeros, *span),
            strict=True,
        )
    ]
    which = np.concatenate([np.zeros(int(first.sum()), np.int32), np.ones(len(zeros), np.int32)])
    columns[4:] = [columns[4].astype(np.int32), columns[5].astype(np.int32), which]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(_PHRASE))


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _after_first(group: list[np.ndarray], order: list[np.ndarray]) -> np.ndarray:
    """Of rows sorted by ``group`` and ``order``: which come after the least of their group."""
    n = len(group[0])
    if not n:
        return np.zeros(0, bool)
    new = np.ones(n, bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in group])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return np.logical_or.reduce([x != x[first] for x in order])


def _joined(doc, th, start, end):
    """Ranges [start, end) of each document with overlapping and touching ones made one."""
    if not len(doc):
        return doc, th, start, end
    order = np.lexsort((start, th, doc))
    doc, th, start, end = doc[order], th[order], start[order], end[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
    # lengths are below 2^31, so a shift per document keeps its ranges apart
    shift = (np.cumsum(new) - 1) << 32
    reach = np.maximum.accumulate(end + shift)
    new[1:] |= start[1:] + shift[1:] > reach[:-1]
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1
    return doc[head], th[head], start[head], reach[tail] - shift[head]


def _cut_phrases(kind: Kind):
    """Payload of each listed phrase: its bytes, or the hashes of its windows of words."""

    def run(batches):
        for batch in batches:
            listed = batch.column("listed")
            size = listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(size)])
            flat = [
                listed.flatten().field(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in "kab"
            ]
            doc = batch.column("doc").fill_null(_LAST).to_numpy(zero_copy_only=False)
            th = batch.column("th").to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in arrays.blocks(batch.column("text"), _COPIED):
                k, a, b = (x[ends[lo] : ends[hi]] for x in flat)
                if not len(k):
                    continue
                hasher, first = _sequence(kind, data, offsets)
                text = np.repeat(np.arange(hi - lo), size[lo:hi])
                start = a + first[text]
                if kind.words:
                    at, _ = arrays.expand(start, b - a + 1)
                    body = hasher.spans(at, at + kind.length)
                    taken = (b - a + 1) * 8
                else:
                    at, _ = arrays.expand(start, b - a + kind.length)
                    body = data[at]
                    taken = b - a + kind.length
                cuts = np.concatenate([[0], np.cumsum(taken)]).astype(np.int64)
                payload = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(k),
                    [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(body))],
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k), pa.array(doc[lo + text]), pa.array(th[lo + text])]
                    + [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), payload],
                    ["k", "doc", "th", "a", "b", "payload"],
                )

    return run


def _windows(kind: Kind, table: pa.RecordBatch | pa.Table):
    """Every window of phrases with a payload: (phrase number, window start, hash)."""
    a = table.column("a").to_numpy().astype(np.int64)
    n = table.column("b").to_numpy().astype(np.int64) - a + 1
    payload = table.column("payload").cast(pa.large_binary())
    if isinstance(payload, pa.ChunkedArray):
        payload = payload.combine_chunks()
    raw = payload.buffers()
    offsets = np.frombuffer(raw[1], np.int64, len(payload) + 1, payload.offset * 8)
    body = np.frombuffer(raw[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    if kind.words:
        hashed = np.frombuffer(body.tobytes(), np.uint64)
        owner = np.repeat(np.arange(len(n)), n)
        start = arrays.expand(a, n)[0]
    else:
        at, owner = arrays.expand(offsets[:-1] - offsets[0], n)
        hashed = arrays.Hasher(body).spans(at, at + kind.length)
        start = arrays.expand(a, n)[0]
    return owner, start, hashed


def _all_windows(kind: Kind, table: pa.Table):
    """The same, made for ``_PIECE`` phrases at a time, with small numbers."""
    parts = []
    for lo in range(0, table.num_rows, _PIECE):
        owner, start, hashed = _windows(kind, table.slice(lo, _PIECE))
        parts.append(((owner + lo).astype(np.int32), start.astype(np.int32), hashed))
    return (np.concatenate(x) for x in zip(*parts, strict=True))


def _resolve(kind: Kind):
    """Rows sorted by trigger in; ranges of windows that start earlier out."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        k = table.column("k").to_numpy()
        doc, th = table.column("doc").to_numpy(), table.column("th").to_numpy()
        owner, start, hashed = _all_windows(kind, table)
        order = np.lexsort((start, th[owner], doc[owner], hashed, k[owner]))
        owner, start, hashed = owner[order], start[order], hashed[order]
        by = [doc[owner], th[owner], start] if kind.within else [doc[owner]]
        later = _after_first([k[owner], hashed], by)
        owner, start = owner[later], start[later].astype(np.int64)
        return _span_batch(_joined(doc[owner], th[owner], start, start + kind.length))

    def pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
        k = table.column("k").to_numpy()
        border = np.append(np.flatnonzero(k[1:] != k[:-1]) + 1, len(k))
        lo = 0
        while lo < len(k):
            full = int(np.searchsorted(border, lo + _PIECE, "right")) - 1
            whole = int(np.searchsorted(border, lo, "right"))  # the end of the first trigger
            hi = int(border[max(full, whole)])
            yield settle(table.slice(lo, hi - lo))
            lo = hi

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < kind.local:
                continue
            table = pa.Table.from_batches(held)
            k = table.column("k").to_numpy()
            cut = int(np.searchsorted(k, k[-1]))  # the last trigger may go on in the next batch
            if cut:
                yield from pieces(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            size = table.num_rows - cut
        if held:
            yield from pieces(pa.Table.from_batches(held))

    return run


def _span_batch(span) -> pa.RecordBatch:
    doc, th, start, end = span
    columns = [doc, th, start.astype(np.int32), end.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "th", "s", "e"])


def _explode_windows(kind: Kind):
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, _PIECE):
                part = batch.slice(lo, _PIECE)
                owner, start, hashed = _windows(kind, part)
                columns = [part.column(x).to_numpy()[owner] for x in ("k", "doc", "th")]
                columns += [start.astype(np.int32), hashed.view(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], ["k", "doc", "th", "a", "h"]
                )

    return run


def _earlier_of_crowded(kind: Kind, phrases: DataFrame) -> DataFrame:
    """The same for triggers with very many phrases: one row per window, reduced before it moves."""
    each = phrases.mapInArrow(arrays.release_after(_explode_windows(kind)), "k long, doc long, th long, a int, h long")
    least = each.groupBy("k", "h").agg(F.min(F.struct(*kind.order)).alias("least"))
    return (
        each.join(least, ["k", "h"])
        .where(F.struct(*kind.order) > F.col("least"))
        .select("doc", "th", F.col("a").alias("s"), (F.col("a") + kind.length).alias("e"))
    )


def earlier_ranges(docs: DataFrame, kind: Kind) -> DataFrame:
    """Ranges (doc, th, s, e) of symbols that lie in a window which also starts earlier.

    ``doc`` is the id with the largest number for null, ``th`` the hash of the text.
    Ranges of a document may overlap.
    """
    rows = docs.select("doc", F.xxhash64("text").alias("th"), "text")
    counted = rows.select("text").mapInArrow(arrays.release_after(_count_triggers(kind)), "k long, n long")
    repeated = counted.groupBy("k").agg(F.sum("n").alias("n")).where("n > 1").select("k")
    wanted = BitFilter(stage(repeated, "triggers"), "k")
    found = stage(rows.mapInArrow(arrays.release_after(_find_phrases(kind, wanted)), _PHRASE), "phrases")

    at = Window.partitionBy("k", "c").orderBy(*kind.order)
    ranked = stage(
        found.where("kind = 0").select("*", F.rank().over(at).alias("nth")).drop("kind"), "ranked"
    )
    covered = found.where("kind = 1").select("doc", "th", F.col("a").alias("s"), F.col("b").alias("e"))
    again = ranked.where("nth > 1").select(
        "doc", "th", F.col("a").alias("s"), (F.col("b") + kind.length).alias("e")
    )

    first = ranked.where("nth = 1")
    branching = stage(
        first.groupBy("k")
        .agg(F.count("*").alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1"))
        .where("c0 != c1")
        .select("k", "n"),
        "branching",
    )
    part = first.where(BitFilter(branching, "k").column(F.col("k")))
    listed = stage(
        part.groupBy("doc", "th").agg(F.collect_list(F.struct("k", "a", "b")).alias("listed")),
        "listed",
    )
    phrases = stage(
        _holders(rows, listed).mapInArrow(
            arrays.release_after(_cut_phrases(kind)), "k long, doc long, th long, a int, b int, payload binary"
        ),
        "payloads",
    )
    # few, since each has more than ``local`` phrases: at most one in ``local`` rows
    crowded = stage(branching.where(F.col("n") > kind.local).select("k"), "crowded")
    kept_apart = phrases.join(crowded, "k", "left_anti")
    local = (
        kept_apart.repartition("k")
        .sortWithinPartitions("k")
        .mapInArrow(arrays.release_after(_resolve(kind)), "doc long, th long, s int, e int")
    )
    many = _earlier_of_crowded(kind, phrases.join(crowded, "k", "left_semi"))
    return covered.unionByName(again).unionByName(local).unionByName(many)


def _holders(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Texts joined with what ``listed`` has for them; other texts stay out of the shuffle."""
    keyed = rows.withColumn("doc", F.coalesce("doc", F.lit(_LAST)))
    key = F.xxhash64("doc", "th")
    wanted = BitFilter(listed.select(key.alias("key")), "key")
    return keyed.where(wanted.column(key)).join(listed, ["doc", "th"])


def with_ranges(docs: DataFrame, kind: Kind, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``text`` and the ranges ``spans`` (array of (s, e)) of every row of ``docs``.

    Rows without a range pass straight through; only rows that may have one are joined.
    """
    plain = rows_of(docs, id_col, text_col)
    found = earlier_ranges(plain, kind)
    spans = stage(
        found.groupBy("doc", "th").agg(F.collect_list(F.struct("s", "e")).alias("spans")), "spans"
    ).withColumnRenamed("doc", "at")
    keyed = plain.withColumn("th", F.xxhash64("text")).withColumn(
        "at", F.coalesce("doc", F.lit(_LAST))
    )
    key = F.xxhash64("at", "th")
    maybe = BitFilter(spans.select(key.alias("key")), "key").column(key)
    flagged = keyed.withColumn("_maybe", maybe)
    none = F.lit(None).cast(spans.schema["spans"].dataType)
    rest = flagged.where(~F.col("_maybe")).select("doc", "text", none.alias("spans"))
    joined = flagged.where("_maybe").join(spans, ["at", "th"], "left")
    return rest.unionByName(joined.select("doc", "text", "spans"))


def range_arrays(spans: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an array column of (s, e): offsets per row, all starts, all ends."""
    if isinstance(spans, pa.ChunkedArray):
        spans = spans.combine_chunks()
    size = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = spans.flatten()
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return (
        offsets,
        flat.field("s").to_numpy(zero_copy_only=False).astype(np.int64),
        flat.field("e").to_numpy(zero_copy_only=False).astype(np.int64),
    )
