"""BPE encoding and decoding through a table of distinct words (operator 6).

1. Every task splits its texts into the pieces that the byte-level splitting rule gives and keeps one row
   per distinct piece. Spark adds these up to the table of distinct pieces.
2. Each distinct piece is encoded once.
3. Ids join back by position. The most frequent pieces (at most ``COMMON``, a few dozen MB) are sent to the
   tasks; pieces beyond these are rare, so no key is hot, and join through a shuffle as
   (text, position) rows.
4. Decoding joins ids with their pieces of bytes, a table of the vocabulary's size.

Splitting works on code points: runs of letters, of digits, of other marks, each with one blank
before it, the contractions, and white space that leaves its last blank to the next run. Control
strings of the vocabulary are cut out first, as the tokenizer does.

Defined cases: null is empty and has no ids; repeated rows each give a row; an empty table
gives an empty result; other columns are ignored. Two pieces with one 64-bit hash raise an error.
"""

from __future__ import annotations

import json
import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import arrays
from llm.common import rows_of, stage

TOKENIZER = "byte_bpe_50k.json"
COMMON = 1 << 20
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_FLUSH = 1 << 18


@cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    table = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_DIGIT, r"\p{N}")):
        found = "".join(regex.findall(pattern + "+", every))
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def split_pieces(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start in the code points of a block of texts, in order."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    text_start = np.zeros(n + 1, bool)
    text_start[offsets] = True
    head = np.ones(n, bool)
    head[1:] = (kind[1:] != kind[:-1]) | text_start[1:n]
    # a run of white space before something else in its text leaves its last character over
    before = np.flatnonzero(head & (kind != _SPACE) & ~text_start[:n])
    before = before[kind[before - 1] == _SPACE] if len(before) else before
    blank = points[before - 1] == 32
    head[before - 1] = True  # the last white space starts a piece ...
    head[before[blank]] = False  # ... which the run after it joins if it is a blank
    # contractions: a lone apostrophe that starts a piece, with the letters after it
    mark = np.flatnonzero((points[:-1] == 39) & head[:-1] & head[1:])
    mark = mark[(kind[mark + 1] == _LETTER) & ~text_start[mark + 1]]
    if len(mark):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[mark + 1], padded[mark + 2]
        inside = ~text_start[np.minimum(mark + 2, n)]
        single = np.isin(one, [ord(x) for x in "stmd"])
        double = np.zeros(len(mark), bool)
        for a, b in ("re", "ve", "ll"):
            double |= (one == ord(a)) & (two == ord(b)) & inside
        size = np.where(single, 2, np.where(double, 3, 0))
        some = size > 0
        mark, size = mark[some], size[some]
        head[mark + 1] = False
        after = mark + size
        after = after[after < n]
        head[after] = True
    return np.flatnonzero(head)


def _special(path: str) -> list[tuple[str, int]]:
    with open(path, encoding="utf-8") as f:
        return [(x["content"], x["id"]) for x in json.load(f)["added_tokens"]]


class _Cut:
    """Pieces of a block: hashes, bounds in the block's code points, number per text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, special: list[tuple[str, int]]):
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.points, self.offsets = points, chars[offsets]
        bounds, places, size = self.offsets, [], []
        for content, _ in special:
            raw = np.frombuffer(content.encode("utf-32-le"), np.uint32)
            for at in _find(points, raw):
                if np.searchsorted(self.offsets, at, "right") == np.searchsorted(
                    self.offsets, at + len(raw) - 1, "right"
                ):
                    places.append(at)
                    size.append(len(raw))
        self.start = split_pieces(points, bounds)
        if places:
            edge = np.unique(np.concatenate([bounds, places, np.add(places, size)]))
            start = split_pieces(points, edge)
            whole = np.repeat(places, size), np.concatenate([np.arange(x) for x in size])
            inner = (whole[0] + whole[1])[whole[1] > 0]
            self.start = np.setdiff1d(start, inner)
        self.end = np.append(self.start[1:], len(points))
        if len(self.start):
            text_end = self.offsets[np.searchsorted(self.offsets, self.start, "right")]
            self.end = np.minimum(self.end, text_end)
        self.hash = arrays.word_hashes(points, self.start, self.end)
        self.first = np.searchsorted(self.start, self.offsets)

    def words(self, which: np.ndarray) -> list[str]:
        raw = self.points.tobytes()
        return [
            raw[4 * a : 4 * b].decode("utf-32-le")
            for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)
        ]


def _find(points: np.ndarray, wanted: np.ndarray) -> list[int]:
    """Places of a string, from left to right without overlap."""
    at = np.flatnonzero(points[: max(0, len(points) - len(wanted) + 1)] == wanted[0])
    for j in range(1, len(wanted)):
        at = at[points[at + j] == wanted[j]]
    out: list[int] = []
    for x in at.tolist():
        if not out or x >= out[-1] + len(wanted):
            out.append(x)
    return out


def _distinct(path: str):
    """One row per distinct piece and part of a task, with its number."""

    def run(batches):
        special = _special(path)
        keys, counts, words = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, object)
        for batch in batches:
            for _, _, data, offsets in arrays.blocks(batch.column("text")):
                cut = _Cut(data, offsets, special)
                key, at, n = np.unique(cut.hash, return_index=True, return_counts=True)
                place = np.searchsorted(keys, key)
                known = place < len(keys)
                known[known] = keys[place[known]] == key[known]
                counts[place[known]] += n[known]
                fresh = ~known
                found = np.array([*cut.words(at[fresh]), None], object)[:-1]
                order = np.argsort(np.concatenate([keys, key[fresh]]), kind="stable")
                keys = np.concatenate([keys, key[fresh]])[order]
                counts = np.concatenate([counts, n[fresh]])[order]
                words = np.concatenate([words, found])[order]
                if len(keys) > _FLUSH:
                    yield _word_rows(keys, counts, words)
                    keys, counts, words = keys[:0], counts[:0], words[:0]
        yield _word_rows(keys, counts, words)

    return run


def _word_rows(key: np.ndarray, n: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(n), pa.array(words, pa.string())],
        ["hash", "n", "word"],
    )


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


def _encode_words(path: str):
    def run(batches):
        tokenizer = _tokenizer(path)
        for batch in batches:
            words = batch.column("word").to_pylist()
            ids = []
            for lo in range(0, len(words), 10_000):
                part = tokenizer.encode_batch_fast(words[lo : lo + 10_000], add_special_tokens=False)
                ids += [np.array(x.ids, "<u4").tobytes() for x in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("hash"), batch.column("n"), pa.array(ids, pa.binary())],
                ["hash", "n", "ids"],
            )

    return run


def word_table(docs: DataFrame, path: str) -> DataFrame:
    """``hash, n, ids`` of every distinct piece of all texts (a column ``text``)."""
    rows = docs.select("text").mapInArrow(arrays.release_after(_distinct(path)), "hash long, n long, word string")
    whole = rows.groupBy("hash", "word").agg(F.sum("n").alias("n"))
    return whole.mapInArrow(arrays.release_after(_encode_words(path)), "hash long, n long, ids binary")


def _one_piece_a_hash(words: DataFrame) -> None:
    twice = words.groupBy("hash").agg(F.count("*").alias("pieces")).where("pieces > 1")
    if not twice.isEmpty():
        raise ValueError("two pieces share one hash")


class _Common:
    """The most frequent pieces: sorted hashes, and their ids one after another.

    Each worker holds the table, so ids and places take no wider numbers than they need.
    """

    def __init__(self, rows: pa.Table):
        order = np.argsort(rows.column("hash").to_numpy().view(np.uint64))
        rows = rows.take(pa.array(order))
        self.hash = rows.column("hash").to_numpy().view(np.uint64).copy()
        raw = [x or b"" for x in rows.column("ids").to_pylist()]
        ends = np.cumsum([len(x) // 4 for x in raw or [b""]])
        self.first = np.concatenate([[0], ends]).astype(np.int64 if ends[-1] >> 31 else np.int32)
        ids = np.frombuffer(b"".join(raw) or bytes(4), "<u4")
        self.ids = ids.astype("<u4" if int(ids.max()) > 0xFFFF else "<u2")


def _fill(path: str, shared, only_holes: bool = False):
    """Ids of common pieces in place; a rare piece is one zero and its hash with its place.

    With ``only_holes`` just the rare pieces and their places, without any ids.
    """

    def run(batches):
        special, table = _special(path), shared.value
        for batch in batches:
            for lo, hi, data, offsets in arrays.blocks(batch.column("text")):
                cut = _Cut(data, offsets, special)
                at = np.minimum(np.searchsorted(table.hash, cut.hash), max(0, len(table.hash) - 1))
                known = table.hash[at] == cut.hash if len(table.hash) else np.zeros(len(at), bool)
                size = np.where(known, table.first[at + 1] - table.first[at], 1)
                end = np.concatenate([[0], np.cumsum(size)])
                text_end = end[cut.first]
                columns = [batch.column("doc").slice(lo, hi - lo), batch.column("th").slice(lo, hi - lo)]
                if not only_holes:
                    place, owner = arrays.expand(np.where(known, table.first[at], 0), size)
                    ids = np.where(known[owner], table.ids[place], 0).astype("<u4")
                    edges = zip(text_end[:-1], text_end[1:], strict=True)
                    rows = [_squeeze(ids[a:b].tobytes()) for a, b in edges]
                    columns.append(pa.array(rows, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, ["doc", "th", "ids"])
                    continue
                hole = np.flatnonzero(~known)
                text = np.searchsorted(cut.first, hole, "right") - 1
                row = pa.array(text)
                columns = [c.take(row) for c in columns]
                columns.append(pa.array(cut.hash[hole].view(np.int64)))
                columns.append(pa.array((end[hole] - text_end[text]).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["doc", "th", "hash", "at"])

    return run


def _squeeze(raw: bytes) -> bytes:
    """Ids on their way through a shuffle: two bytes each where that is enough, compressed.

    All low bytes come first, then all high bytes, which are alike and compress well.
    """
    ids = np.frombuffer(raw, "<u4")
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    narrow = ids if wide else ids.astype("<u2")
    body = narrow.view(np.uint8).reshape(len(ids), narrow.itemsize).T.tobytes()
    return bytes([wide]) + pa.compress(body, "zstd", asbytes=True) + len(body).to_bytes(8, "little")


def _unsqueeze(raw: bytes) -> np.ndarray:
    body = pa.decompress(raw[1:-8], int.from_bytes(raw[-8:], "little"), "zstd", asbytes=True)
    kind = np.dtype("<u4" if raw[0] else "<u2")
    planes = np.frombuffer(body, np.uint8).reshape(kind.itemsize, len(body) // kind.itemsize)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind).astype("<u4")


def _finish(batches):
    """Ids of rare pieces put into their places."""
    for batch in batches:
        raws, rare = batch.column("ids"), batch.column("rare")
        found = rare.flatten()
        place = found.field("at").to_numpy()
        piece = found.field("ids").cast(pa.large_binary())
        raw = piece.buffers()
        edge = np.frombuffer(raw[1], np.int64, len(piece) + 1, piece.offset * 8) // 4
        letters = np.frombuffer(raw[2] or b"", "<u4", int(edge[-1]))
        first = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(rare), 0).to_numpy()))
        out = []
        for k in range(batch.num_rows):
            ids = _unsqueeze(raws[k].as_py())
            if first[k] < first[k + 1]:
                at = place[first[k] : first[k + 1]]
                order = np.argsort(at)
                at, here = at[order], first[k] + order
                size = edge[here + 1] - edge[here]
                width = np.ones(len(ids), np.int64)
                width[at] = size
                start = (np.cumsum(width) - width)[at]
                ids = np.repeat(ids, width)
                ids[arrays.expand(start, size)[0]] = letters[arrays.expand(edge[here], size)[0]]
            out.append(ids.astype("<u4", copy=False).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(out, pa.binary())], ["doc_id", "ids"]
        )


def _threshold(words: DataFrame, limit: int) -> int:
    """The least number of occurrences that at most ``limit`` pieces reach."""
    by_count = words.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(
        F.count("*").alias("pieces")
    )
    total, least = 0, 100_001  # at most 100,000 rows come here
    for row in sorted(by_count.collect(), reverse=True):
        total += row["pieces"]
        if total > limit:
            break
        least = row["n"]
    return least


def encode(
    docs: DataFrame,
    path: str | None = None,
    common: int = COMMON,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, ids`` (binary: little-endian unsigned 32-bit ids of the whole text)."""
    path = path or public_tokenizers.path(TOKENIZER)
    joined = _joined(docs, path, common, id_col, text_col)
    return joined.mapInArrow(arrays.release_after(_finish), "doc_id long, ids binary")


def _joined(docs: DataFrame, path: str, common: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: ids with holes, and the rare pieces that fill them."""
    rows = rows_of(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    words = stage(word_table(rows, path), "words")
    _one_piece_a_hash(words)
    least = _threshold(words, common)
    table = _Common(words.where(F.col("n") >= least).select("hash", "ids").toArrow())
    shared = docs.sparkSession.sparkContext.broadcast(table)
    filled = rows.mapInArrow(arrays.release_after(_fill(path, shared)), "doc long, th long, ids binary")
    holes = rows.mapInArrow(arrays.release_after(_fill(path, shared, True)), "doc long, th long, hash long, at int")
    rare = words.where(F.col("n") < least).select("hash", "ids")
    found = (
        holes.join(rare, "hash")
        .groupBy("doc", "th")
        .agg(F.collect_set(F.struct("at", "ids")).alias("rare"))
    )
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    found = stage(found, "rare").withColumnsRenamed({"doc": "d", "th": "t"})
    return filled.select("doc", "th", "ids").join(found, same, "left").select("doc", "ids", "rare")


@cache
def _pieces(path: str) -> list[bytes]:
    """The bytes of every id."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    to_byte |= {chr(256 + k): b for k, b in enumerate(hidden)}
    with open(path, encoding="utf-8") as f:
        loaded = json.load(f)
    out = [b""] * (1 + max([*loaded["model"]["vocab"].values(), *(x["id"] for x in loaded["added_tokens"])]))
    for piece, at in loaded["model"]["vocab"].items():
        out[at] = bytes(to_byte[c] for c in piece) if all(c in to_byte for c in piece) else piece.encode()
    for x in loaded["added_tokens"]:
        out[x["id"]] = x["content"].encode()
    return out


def _decode(path: str):
    def run(batches):
        pieces = _pieces(path)
        for batch in batches:
            text = [
                b"".join([pieces[i] for i in np.frombuffer(x, "<u4").tolist()]).decode(errors="replace")
                for x in batch.column("ids").to_pylist()
            ]
            columns = [batch.column("doc_id"), batch.column("ids"), pa.array(text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])

    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, text`` from ``doc_id, ids``."""
    path = path or public_tokenizers.path(TOKENIZER)
    return encoded.mapInArrow(arrays.release_after(_decode(path)), "doc_id long, ids binary, text string")


def encode_and_decode(
    docs: DataFrame,
    path: str | None = None,
    common: int = COMMON,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, ids, text``: what ``decode`` makes of ``encode``, with one Python worker a task."""
    path = path or public_tokenizers.path(TOKENIZER)
    decoded = _decode(path)

    def run(batches):
        return decoded(_finish(batches))

    joined = _joined(docs, path, common, id_col, text_col)
    return joined.mapInArrow(arrays.release_after(run), "doc_id long, ids binary, text string")


def digests(docs: DataFrame) -> DataFrame:
    """The ids and the decoded text of every row, as digests."""
    return encode_and_decode(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
