"""Substring dedup over words by a compacted de Bruijn graph (operator 2).

Nodes are word k-mers, here the ones that are the least of the windows around them, so every
window of ``WINDOW`` words has one. An edge is a node together with the unbroken path of words
around it. A node with one distinct edge does not branch: all its occurrences are the
same path and compact into one row. Nodes with several edges branch; their paths are
fetched from the source by coordinates and compared window by window. Covered paths that follow
one another in a document join into long spans.

Defined cases: null text has no words; repeated rows (same id and text) are one document and
each row is returned; rows with one id and different texts are documents that do not cover one
another; a null id counts as the largest; texts shorter than a window lose nothing;
other columns are ignored by ``repeated_words`` and kept by ``remove_repeated_words``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import arrays
from llm.windows import Kind, range_arrays, with_ranges

WINDOW = 50
NODE = 8


def _cut(batches):
    for batch in batches:
        first_span, span_start, span_end = range_arrays(batch.column("spans"))
        for lo, hi, data, offsets in arrays.blocks(batch.column("text")):
            start, end, first = arrays.words(data, offsets, arrays.NOT_SPACE)
            raw = data.tobytes()
            n_words, n_removed, kept = np.diff(first), [], []
            for i in range(lo, hi):
                f, t = first[i - lo], first[i - lo + 1]
                p, q = first_span[i], first_span[i + 1]
                gone = arrays.covered(t - f, span_start[p:q], span_end[p:q])
                keep = np.flatnonzero(~gone) + f
                text = b" ".join(
                    [raw[x:y] for x, y in zip(start[keep].tolist(), end[keep].tolist(), strict=True)]
                )
                n_removed.append(int(gone.sum()))
                kept.append(text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(lo, hi - lo), pa.array(n_words.astype(np.int64))]
                + [pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )


def remove_repeated_words(
    docs: DataFrame,
    window: int = WINDOW,
    node: int = NODE,
    id_col: str = "doc_id",
    text_col: str = "text",
    **tuning: int,
) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_text`` (kept words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts in a document
    with a smaller id. Windows are judged on the input.
    """
    kind = Kind(window, node, words=True, within=False, **tuning)
    return with_ranges(docs, kind, id_col, text_col).mapInArrow(
        arrays.release_after(_cut), "doc_id long, n_words long, n_removed long, kept_text string"
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_words(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'),
                             lambda x: x <> '') AS ws
  FROM documents
), starts AS (
  SELECT doc_id, p, array_to_string(ws[p : p + 49], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w WHERE len(ws) >= 50)
), hashed AS (
  SELECT doc_id, p, md5_number(win) AS h FROM starts
), hit AS (
  SELECT doc_id, p FROM
    (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS d0 FROM hashed) WHERE d0 < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM hit
), removed AS (
  SELECT doc_id, list(i) AS idx, count(*) AS n FROM gone GROUP BY doc_id
), each AS (
  SELECT w.doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS text
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i
  WHERE g.i IS NULL GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
