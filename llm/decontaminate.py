"""Benchmark decontamination by a prefix-filtered containment join (operator 1).

Items are cut into windows of ten consecutive words. A window must be contained as a whole, so
of its words, ordered by rarity in the corpus, one suffices as prefix: the rarest. The
join of document words with prefix words gives candidates; the place of the prefix word in the
window fixes where the window would start, and the text must be long enough from there.
What remains is compared word by word.

Windows go to the tasks in blocks of at most ``BLOCK_WINDOWS``, one pass over the documents
per block, so what is broadcast is bounded however large the benchmark is. Documents
are never shuffled.

Words are the maximal runs of letters, digits and characters beyond ASCII after folding A-Z.
Defined cases: a null text has no words; an item of fewer than ten words is one window, an
item without words none; an item without an id is left out; items that repeat an id count
as one; repeated document rows each give a row; empty tables give no hits. ``annotate`` keeps
other columns in ``row``, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import arrays
from llm.common import stage, text_column

WINDOW = 10
#: A block of windows takes about 25 MB in a task.
BLOCK_WINDOWS = 200_000


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    folded = arrays.fold_ascii(data)
    start, end, first = arrays.words(folded, offsets, arrays.ALNUM)
    return arrays.word_hashes(folded, start, end), first


def _item_windows(window: int):
    def run(batches):
        for batch in batches:
            items = batch.column("item").to_pylist()
            out_items, out_words = [], []
            for lo, hi, data, offsets in arrays.blocks(batch.column("text")):
                hashes, first = _word_hashes(data, offsets)
                for i in range(lo, hi):
                    own = hashes[first[i - lo] : first[i - lo + 1]].view(np.int64)
                    size = min(window, len(own))
                    for at in range(len(own) - size + 1 if size else 0):
                        out_items.append(items[i])
                        out_words.append(own[at : at + size].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_items, pa.string()), pa.array(out_words, pa.list_(pa.int64()))],
                ["item", "words"],
            )

    return run


def _count_words(shared):
    """Occurrences of the given words in one task's documents."""

    def run(batches):
        wanted = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for _, _, data, offsets in arrays.blocks(batch.column("text")):
                hashes, _ = _word_hashes(data, offsets)
                at = _lookup(wanted, hashes)
                total += np.bincount(at[at >= 0], minlength=len(wanted))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(wanted[some].view(np.int64)), pa.array(total[some])], ["word", "n"]
        )

    return run


def _lookup(wanted: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted array, -1 where it is not there."""
    out = np.full(len(hashes), -1, np.int64)
    if not len(wanted):
        return out
    sieve = np.zeros(1 << 20, bool)  # most words end here
    sieve[(wanted >> np.uint64(44)).astype(np.int64)] = True
    some = np.flatnonzero(sieve[(hashes >> np.uint64(44)).astype(np.int64)])
    at = np.minimum(np.searchsorted(wanted, hashes[some]), len(wanted) - 1)
    same = wanted[at] == hashes[some]
    out[some[same]] = at[same]
    return out


class _Block:
    """Windows of one block, ready for the join: by prefix word, with its place."""

    def __init__(self, rows: pa.Table, counts: dict[int, int]):
        lists = rows.column("words").to_pylist()
        self.items = rows.column("items").to_pylist()
        self.size = np.array([len(x) for x in lists], np.int64)
        self.words = np.zeros((len(lists), max([1, *self.size.tolist()])), np.int64)
        prefix, place = [], []
        for i, x in enumerate(lists):
            self.words[i, : len(x)] = x
            at = min(range(len(x)), key=lambda j: (counts.get(x[j], 0), x[j], j))
            prefix.append(x[at])
            place.append(at)
        self.words = self.words.view(np.uint64)
        token = np.array(prefix, np.int64).view(np.uint64)
        order = np.argsort(token, kind="stable")
        self.token, first = np.unique(token[order], return_index=True)
        self.first = np.append(first, len(order))
        self.window = order
        self.place = np.array(place, np.int64)[order]


def _match(shared, text_col: str):
    def run(batches):
        block = shared.value
        for batch in batches:
            row = batch.column("row")
            before = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            n_words, spans, items = [], [], []
            for lo, hi, data, offsets in arrays.blocks(row.field(text_col)):
                hashes, first = _word_hashes(data, offsets)
                found = _hits(block, hashes, first)
                n_words += np.diff(first).tolist()
                for i in range(lo, hi):
                    own = found.get(i - lo, ())
                    spans.append(before[0][i] + [{"s": s, "e": e} for s, e, _ in own])
                    new = {x for _, _, w in own for x in block.items[w]}
                    items.append(sorted(new.union(before[1][i])))
            pairs = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(n_words, pa.int64()), pa.array(spans, pairs)]
                + [pa.array(items, pa.list_(pa.string()))],
                ["row", "n_words", "spans", "items"],
            )

    return run


def _hits(block: _Block, hashes: np.ndarray, first: np.ndarray) -> dict[int, list]:
    """Verified windows per text: (first word, end, window), counted within the text."""
    at = _lookup(block.token, hashes)
    pos = np.flatnonzero(at >= 0)
    if not len(pos):
        return {}
    at = at[pos]
    entry, owner = arrays.expand(block.first[at], block.first[at + 1] - block.first[at])
    pos = pos[owner]
    text = np.searchsorted(first, pos, "right") - 1
    window = block.window[entry]
    size = block.size[window]
    start = pos - block.place[entry]
    ok = (start >= first[text]) & (start + size <= first[text + 1])
    start, window, size, text = start[ok], window[ok], size[ok], text[ok]
    for j in range(block.words.shape[1]):
        same = (j >= size) | (
            hashes[np.minimum(start + j, len(hashes) - 1)] == block.words[window, j]
        )
        start, window, size, text = start[same], window[same], size[same], text[same]
    out: dict[int, list] = {}
    begin = start - first[text]
    for t, s, e, w in zip(
        text.tolist(), begin.tolist(), (begin + size).tolist(), window.tolist(), strict=True
    ):
        out.setdefault(t, []).append((s, e, w))
    return out


def _blocks(windows: DataFrame, docs: DataFrame, text_col: str, limit: int):
    """One broadcast block of windows after another, with prefix words chosen by rarity."""
    spark = docs.sparkSession
    distinct = stage(
        windows.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items")), "windows"
    )
    parts = max(1, -(-distinct.count() // limit))
    for part in range(parts):
        key = F.pmod(F.xxhash64("words"), F.lit(parts))
        rows = distinct.where(key == part).orderBy("words").toArrow()
        flat = rows.column("words").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vocabulary = np.unique(flat.view(np.uint64))
        shared = spark.sparkContext.broadcast(vocabulary)
        counted = (
            docs.select(text_column(text_col).alias("text"))
            .mapInArrow(_count_words(shared), "word long, n long")
            .groupBy("word")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        counts = dict(
            zip(counted.column("word").to_pylist(), counted.column("n").to_pylist(), strict=True)
        )
        yield spark.sparkContext.broadcast(_Block(rows, counts))


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns), ``n_words``, ``spans``, ``items``.

    ``spans`` are the word ranges [s, e) that hold a window, which may overlap, and ``items``
    the sorted ids of the items that own them.
    """
    items = benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), text_column(item_text).alias("text")
    )
    windows = items.mapInArrow(_item_windows(window), "item string, words array<long>")
    out = docs.select(F.struct("*").alias("row")).select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("spans"),
        F.expr("cast(array() as array<string>)").alias("items"),
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    for n, shared in enumerate(_blocks(windows, docs, text_col, block_windows)):
        if n:
            out = stage(out, "matched")
        out = out.mapInArrow(_match(shared, text_col), schema)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, all their columns."""
    return annotate(docs, benchmark, **options).where(F.size("spans") == 0).select("row.*")


def hit_words(spans: Column) -> Column:
    """How many words lie in at least one of the ranges."""
    start = F.expr("cast(0 as int)")
    step = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("n"), start.alias("reach")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], x["e"]).alias("reach"),
        ),
    )
    return step["n"]


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = annotate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hit_words(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bwin AS (
  SELECT DISTINCT item, least(10, len(ws)) AS k, array_to_string(ws[p : p + 9], ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS p
        FROM bw WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT k FROM bwin
), dwin AS (
  SELECT doc_id, p, k, array_to_string(ws[p : p + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p
        FROM dw, sizes WHERE len(ws) >= k)
), hit AS (
  SELECT doc_id, p, d.k, item FROM dwin d JOIN bwin b ON d.win = b.win AND d.k = b.k
), w AS (
  SELECT doc_id, count(DISTINCT i) AS n
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS i FROM hit) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(DISTINCT item) AS n,
         string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(w.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(w.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN w USING (doc_id) LEFT JOIN it USING (doc_id)
"""
