"""Exact removal of repeated byte strings by prefix-free parsing (operator 7).

Rolling-hash triggers cut every text into overlapping phrases. The distinct phrases are the
dictionary, their occurrences in (document, place) order the parse. A plain trigger (hash
divisible by p) may be missing from 100 bytes; here the trigger is the least rolling
hash of the 69 in a window, so none is missed. Phrases that the parse repeats are settled as wholes.
Only suffixes of dictionary phrases that share a trigger are sorted, each with the first place
that the parse has for its phrase; of equal suffixes the earliest in corpus order stays. They are
sorted by trigger and hash rather than by letter, since only equality decides.

Defined cases: null text is empty; repeated rows (same id and text) are one document and
each row is returned; rows with one id and different texts are different documents in
the order of a hash of their text; a null id counts as the largest; texts
below 100 bytes lose nothing; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm import arrays
from llm.windows import Kind, range_arrays, with_ranges

WINDOW = 100
TRIGGER = 32


def _cut(batches):
    for batch in batches:
        first_span, span_start, span_end = range_arrays(batch.column("spans"))
        for lo, hi, data, offsets in arrays.blocks(batch.column("text")):
            n_removed, n_spans, kept = [], [], []
            for i in range(lo, hi):
                body = data[offsets[i - lo] : offsets[i - lo + 1]]
                p, q = first_span[i], first_span[i + 1]
                gone = arrays.covered(len(body), span_start[p:q], span_end[p:q])
                n_removed.append(int(gone.sum()))
                n_spans.append(int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum()))
                kept.append(body[~gone].tobytes())
            numbers = (np.diff(offsets), n_removed, n_spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in numbers)]
                + [pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def remove_repeated_bytes(
    docs: DataFrame,
    window: int = WINDOW,
    trigger: int = TRIGGER,
    id_col: str = "doc_id",
    text_col: str = "text",
    **tuning: int,
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary: the remaining bytes).

    A byte goes if a string of ``window`` bytes that covers it also starts earlier, in a
    smaller id or before in the same document. The rest may cut a character, so it is binary.
    """
    kind = Kind(window, trigger, words=False, within=True, **tuning)
    return with_ranges(docs, kind, id_col, text_col).mapInArrow(
        arrays.release_after(_cut), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_bytes(docs).selectExpr(
        "doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) AS kept_sha256"
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), starts AS (
  SELECT doc_id, x, unnest(range(0, CAST(len(x) / 2 AS BIGINT) - 99)) AS p FROM d
  WHERE len(x) >= 200
), hashed AS (
  SELECT doc_id, p, md5_number(substr(x, 2 * p + 1, 200)) AS h FROM starts
), hit AS (
  SELECT doc_id, p FROM
    (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS nth FROM hashed)
  WHERE nth > 1
), edge AS (
  SELECT doc_id, p, max(p) OVER (PARTITION BY doc_id ORDER BY p
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM hit
), run AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 100 THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY p) AS r FROM edge
), span AS (
  SELECT doc_id, r, min(p) AS s, max(p) + 100 AS e FROM run GROUP BY doc_id, r
), piece AS (
  SELECT d.doc_id, d.x, s.s, s.e,
         lag(s.e, 1, 0) OVER (PARTITION BY d.doc_id ORDER BY s.s) AS f,
         row_number() OVER (PARTITION BY d.doc_id ORDER BY s.s DESC) = 1 AS last
  FROM d JOIN span s USING (doc_id)
), kept AS (
  SELECT doc_id, sum(e - s) AS removed, count(*) AS spans,
         string_agg(substr(x, 2 * f + 1, 2 * (s - f)) ||
           CASE WHEN last THEN substr(x, 2 * e + 1) ELSE '' END, '' ORDER BY s) AS x
  FROM piece GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.x) / 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id)
"""
