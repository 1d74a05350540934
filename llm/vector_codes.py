"""Vector code compression by exact integer distances (operator 13).

Vectors become integers, are cut into parts, and each part is replaced by the number of its nearest
codebook entry. Squared distances are ``|x|^2 - 2 x.c + |c|^2``. Dot products of a batch with a
codebook are products of float64 matrices: integers are broken into signed limbs so short that a
product of two limbs, summed over a part, stays below 2^53 and is exact; the limb products are
recombined in int64. The first smallest distance wins, so ties go to the lower entry.

Every task adds up its parts per entry before anything is shuffled, so a round moves at most
one row per task, part and entry. Only codebooks reach the driver and the tasks: ``entries`` x width
numbers, whatever the table's size. Each round reads the table again; nothing grows with it.

Defined cases: vectors that are null or hold a null, NaN or infinite component are left
out; fewer kept vectors than ``entries`` give a smaller codebook; of rows with one id the smaller
vector comes first where the codebook starts, and a null id comes last; an empty table gives no
rows. All kept vectors need one width, a multiple of ``parts``, and components whose
distances fit 63 bits; others stop the job with an error that names the id. Further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import bound_batches, stage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Distances of so many vectors at once.
_SLICE = 2048


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def limb_bits(width: int) -> int:
    """Bits of a limb, so that ``width`` products of two limbs sum up to less than 2^53."""
    return (53 - max(1, width).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Signed digits of int64 numbers to the base 2^bits, lowest first, as float64."""
    out, half = [], np.int64(1 << (bits - 1))
    while True:
        high = (x + half) >> np.int64(bits)
        out.append((x - (high << np.int64(bits))).astype(np.float64))
        if not high.any():
            return out
        x = high


def exact_dot(a: np.ndarray, b: np.ndarray, bits: int | None = None) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, exact where the result fits 63 bits."""
    bits = bits or limb_bits(a.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    left, right = limbs(a, bits), [y.T.copy() for y in limbs(b, bits)]
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            if bits * (i + j) < 64:
                out += (x @ y).astype(np.int64) << np.int64(bits * (i + j))
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first nearest entry of ``book`` for each row, and its squared distance."""
    distance = exact_dot(x, book)
    distance *= -2
    distance += (book * book).sum(1)
    at = distance.argmin(1)
    return at, distance[np.arange(len(x)), at] + (x * x).sum(1)


def _integers(batch: pa.RecordBatch, scale: int, parts: int, width: int | None) -> np.ndarray:
    """Vectors of a batch as a matrix of whole numbers; the vector is the second column."""
    vectors = batch.column(1)
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(sizes) == 0:
        return np.zeros((0, width or 0), np.int64)
    width = width or int(sizes[0])
    odd = np.flatnonzero((sizes != width) | (width % parts != 0))
    if len(odd):
        raise ValueError(f"vector {batch.column(0)[int(odd[0])]} has {sizes[odd[0]]} components")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), width)
    scaled = np.floor(flat * scale)
    # twice this, squared, summed over the vector, fits 63 bits
    largest = 1 << ((62 - width.bit_length()) // 2 - 1)
    large = np.flatnonzero((np.abs(scaled) >= largest).any(1))
    if len(large):
        raise ValueError(f"vector {batch.column(0)[int(large[0])]} has too large a component")
    return scaled.astype(np.int64)


@dataclass
class Codebooks:
    """``entries`` (part, entry, position) of whole numbers, at most ``ENTRIES`` x width in all."""

    entries: np.ndarray
    scale: int

    @property
    def parts(self) -> int:
        return self.entries.shape[0]

    @property
    def width(self) -> int:
        return self.parts * self.entries.shape[2]

    def digest(self) -> str:
        """SHA-256 of all numbers, by part, entry and position, joined with commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every part (vectors x parts), and the summed squared distance."""
        size = self.entries.shape[2]
        code, error = np.zeros((len(x), self.parts), np.int64), np.zeros(len(x), np.int64)
        for lo in range(0, len(x), _SLICE):
            part_of = x[lo : lo + _SLICE]
            for p, book in enumerate(self.entries):
                at, off = nearest(part_of[:, p * size : (p + 1) * size], book)
                code[lo : lo + _SLICE, p] = at
                error[lo : lo + _SLICE] += off
        return code, error


def kept_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    bound_batches(table.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    return table.where(usable(vector)).select(F.col(id_col).cast("long").alias("id"), vector.alias("v"))


def _start(vectors: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """The vectors of the smallest ids, cut into parts; at most ``entries`` rows are collected."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()
    if not first.num_rows:
        return None
    x = _integers(first.combine_chunks().to_batches()[0], scale, parts, None)
    return Codebooks(x.reshape(len(x), parts, x.shape[1] // parts).transpose(1, 0, 2).copy(), scale)


def _sums(books: Codebooks):
    """Per task: sums and counts of the parts nearest to each entry."""

    def run(batches):
        count = np.zeros(books.entries.shape[:2], np.int64)
        total = np.zeros(books.entries.shape, np.int64)
        size = books.entries.shape[2]
        for batch in batches:
            x = _integers(batch, books.scale, books.parts, books.width)
            code, _ = books.assign(x)
            for p in range(books.parts):
                count[p] += np.bincount(code[:, p], minlength=count.shape[1])
                np.add.at(total[p], code[:, p], x[:, p * size : (p + 1) * size])
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(entry), pa.array(count[part, entry])]
                + [pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))],
                ["part", "entry", "n", "total"],
            )

    return run


def _round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry that parts are nearest to becomes their mean, rounded down."""
    size = books.entries.shape[2]
    each = vectors.mapInArrow(_sums(books), "part long, entry long, n long, total array<long>")
    rows = (
        each.groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(size)])
        .toArrow()
    )
    new = books.entries.copy()
    if rows.num_rows:
        columns = [rows[f"s{i}"].to_numpy() for i in range(size)]
        mean = np.stack(columns, 1) // rows["n"].to_numpy()[:, None]
        new[rows["part"].to_numpy(), rows["entry"].to_numpy()] = mean
    return Codebooks(new, books.scale)


def fit(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks from all usable vectors of the table; None where it has none."""
    vectors = kept_vectors(table, id_col, vector_col)
    books = _start(vectors, parts, entries, scale)
    for _ in range(rounds if books and books.width else 0):
        books = _round(vectors, books)
    return books


def encode(
    table: DataFrame,
    books: Codebooks,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    keep: dict[str, str] | None = None,
) -> DataFrame:
    """Per usable vector: ``id, code`` (one byte a part) and ``error``, with the columns ``keep``
    (input name to output name).

    A code of ``parts`` bytes and the codebooks stand for the vector.
    """
    if books.entries.shape[1] > 256:
        raise ValueError("a code has one byte a part")
    bound_batches(table.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    named = [F.col(a).alias(b) for a, b in (keep or {}).items()]
    rows = table.where(usable(vector)).select(
        F.col(id_col).cast("long").alias("id"), vector.alias("v"), *named
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:]]

    def run(batches):
        for batch in batches:
            code, error = books.assign(_integers(batch, books.scale, books.parts, books.width))
            packed = [row.tobytes() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), pa.array(error)]
                + [batch.column(i) for i in range(2, batch.num_columns)],
                ["id", "code", "error", *batch.schema.names[2:]],
            )

    return rows.mapInArrow(run, ", ".join(["id long, code binary, error long", *fields]))


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``id, vector``: the scaled-back entries that a code names."""
    book = books.entries.astype(np.float64) / books.scale

    def run(batches):
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
            at = raw.reshape(batch.num_rows, books.parts)
            found = book[np.arange(books.parts), at].reshape(batch.num_rows, books.width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.tolist(), pa.list_(pa.float64()))], ["id", "vector"]
            )

    return codes.select("id", "code").mapInArrow(run, "id long, vector array<double>")


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``: the summed error of the rows of a label, nulls together.

    Errors are added up per label before they are shuffled, and the join with these sums is a plain
    equality that Spark may broadcast or split, so a label of most rows is not one task's.
    """
    sums = coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")


def compress(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id, code`` (hexadecimal), ``error, label_error, codebooks_sha256`` per usable vector."""
    books = fit(table, id_col, vector_col)
    if books is None:
        schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return table.sparkSession.createDataFrame([], schema)
    coded = stage(encode(table, books, id_col, vector_col, {label_col: "label"}), "codes")
    return label_errors(coded).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in SQL: entries by (p, e), parts as lists, one pair of tables a round."""
    text = [
        f"""WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding,
        lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), x AS (
  SELECT r, CAST(p AS BIGINT) AS p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v
  FROM k, range({parts}) t(p)
), b0 AS (SELECT p, r - 1 AS e, v FROM x WHERE r <= {entries})"""
    ]
    near = """SELECT r, p, min_by(e, (d, e)) AS e, min(d) AS d FROM (
    SELECT x.r, x.p, b.e, CAST(list_sum(list_transform(list_zip(x.v, b.v),
           lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM x JOIN b{} b ON x.p = b.p) GROUP BY r, p"""
    for k in range(1, rounds + 1):
        text.append(f"""a{k} AS MATERIALIZED ({near.format(k - 1)}
), m{k} AS (
  SELECT p, e, list(floor_mean ORDER BY i) AS v FROM (
    SELECT a.p, a.e, i, CAST(sum(x.v[i]) // count(*) - CASE WHEN sum(x.v[i]) % count(*) < 0
           THEN 1 ELSE 0 END AS BIGINT) AS floor_mean
    FROM a{k} a JOIN x ON x.r = a.r AND x.p = a.p, range(1, len(x.v) + 1) t(i)
    GROUP BY a.p, a.e, i) GROUP BY p, e
), b{k} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.v, b.v) AS v
  FROM b{k - 1} b LEFT JOIN m{k} m ON m.p = b.p AND m.e = b.e)""")
    text.append(f"""f AS MATERIALIZED ({near.format(rounds)}
), g AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM f GROUP BY r
), h AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS s FROM b{rounds})
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM k JOIN g USING (r), h""")
    return ",\n".join(text)


ORACLE_SQL = _oracle()
