"""Token counts per section by offset mapping (operator 10).

Each whole document is encoded once, so the count is that of the document and not of pieces cut
before encoding. Token spans (from the lengths of the tokens) are joined with section spans by
place. A token inside one section counts there. A token across a boundary goes, by
``rule``, to the section that holds most of its bytes (``"most"``; of equal shares the earlier) or
to the one where it begins (``"start"``).

A section is a line with its line feed; ``SECTIONS`` may be replaced by any function from a
block's bytes and text offsets to section starts.

Defined cases: a null text counts as empty; an empty text is one empty section without tokens;
repeated rows each give their sections; an empty table gives an empty result; other columns
are ignored. Control strings of the vocabulary are ordinary text here.
"""

from __future__ import annotations

import base64
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from llm import arrays
from llm.common import rows_of

VOCABULARY = "byte_bpe_50k.tiktoken"


@cache
def _encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder of a rank file and the number of bytes of each token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        size[rank] = len(piece)
    encoding = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding, size


def line_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where sections begin: at each text, and after each line feed within one."""
    after = np.flatnonzero(data == 10) + 1
    after = after[~np.isin(after, offsets)]
    return np.sort(np.concatenate([offsets[:-1], after]))


SECTIONS = line_starts


def _attribute(path: str, rule: str, sections):
    def run(batches):
        encoding, size = _encoding(path)
        for batch in batches:
            for lo, hi, data, offsets in arrays.blocks(batch.column("text")):
                raw = data.tobytes()
                tokens = [
                    encoding.encode_ordinary(raw[x:y].decode())
                    for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                yield _counts(batch.column("doc").slice(lo, hi - lo), data, offsets, tokens, size, rule, sections)

    return run


def _counts(doc, data, offsets, tokens, size, rule, sections) -> pa.RecordBatch:
    """Sections of one block with the tokens attributed to them."""
    number = np.array([len(x) for x in tokens], np.int64)
    length = size[np.fromiter((i for x in tokens for i in x), np.int64, int(number.sum()))]
    end = np.cumsum(length)  # tokens cover every byte, so this is the place in the block too
    begin = end - length
    section = sections(data, offsets)
    text = np.searchsorted(offsets, section, "right") - 1
    if (np.diff(offsets) == 0).any():  # empty texts share their offset with the next one
        text = np.repeat(np.arange(len(offsets) - 1), _sections_per_text(section, offsets))
    finish = np.append(section[1:], len(data))
    first = np.searchsorted(section, begin, "right") - 1
    last = np.searchsorted(section, end - 1, "right") - 1
    owner, crossing = first.copy(), first != last
    if rule == "most":
        for i in np.flatnonzero(crossing):
            span = np.arange(first[i], last[i] + 1)
            held = np.minimum(finish[span], end[i]) - np.maximum(section[span], begin[i])
            owner[i] = span[int(np.argmax(held))]
    starts_char = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(starts_char)])
    head = np.searchsorted(text, np.arange(len(offsets) - 1))
    columns = [
        np.arange(len(section)) - head[text],
        chars[section] - chars[offsets[text]],
        chars[finish] - chars[section],
        np.bincount(owner, minlength=len(section)),
        np.bincount(owner, weights=crossing, minlength=len(section)).astype(np.int64),
    ]
    return pa.RecordBatch.from_arrays(
        [doc.take(pa.array(text)), *(pa.array(x.astype(np.int64)) for x in columns)],
        ["doc_id", "section", "start_char", "n_chars", "n_tokens", "n_crossing"],
    )


def _sections_per_text(section: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """An empty text has one section; any other those that begin within it."""
    size = np.diff(offsets)
    inside = np.searchsorted(section, offsets[1:]) - np.searchsorted(section, offsets[:-1], "right")
    return np.where(size == 0, 1, inside + 1)


def section_tokens(
    docs: DataFrame,
    path: str | None = None,
    rule: str = "most",
    sections=SECTIONS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per section: ``doc_id, section, start_char, n_chars, n_tokens, n_crossing``.

    The sum of ``n_tokens`` over a document is its token count. ``n_crossing`` counts those
    of a section's tokens that reach into another section. ``path`` is a rank file that every
    executor has.
    """
    if rule not in ("most", "start"):
        raise ValueError(f"unknown rule {rule!r}")
    path = path or public_tokenizers.path(VOCABULARY)
    schema = (
        "doc_id long, section long, start_char long, n_chars long, n_tokens long, n_crossing long"
    )
    return rows_of(docs, id_col, text_col).mapInArrow(_attribute(path, rule, sections), schema)


def query(spark, sf_dir: str) -> DataFrame:
    return section_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
