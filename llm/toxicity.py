"""Toxicity grades by cumulative-link ordinal regression (operator 9).

P(grade >= k) = sigmoid(w.x - t_k): all thresholds share the weights ``w`` over sparse text
features, and t_1 <= t_2 <= ... . Expected severity is the sum of these probabilities over k.

Features are the distinct folded words of a text and their first bytes (``PREFIXES``), as 64-bit
hashes, so inflected forms of a word share one. Only features whose rate of toxic documents is beyond
chance (``Z`` standard deviations, ``MIN_DF`` documents) get a weight: a very long clean text
gathers no score from the many common words it has.

Grades: 0 for not toxic, 1 for toxic, 2 for toxic and of low quality; ``grade_column`` gives
another rule. The model is fitted on the driver from at most ``SAMPLE`` labelled documents
of at most ``MAX_CHARS`` characters, chosen by a hash of the id. Their features are counted on Spark,
and the driver gets only those with a weight. Scoring reads every whole text.

Defined cases: a null text has no features; labels without id or toxic value are left out; of
several labels of one id the highest grade counts; without labels, or with a single grade,
no weight is fitted and nothing is rejected; repeated rows each give a row; other columns
are kept by ``drop_toxic``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import arrays
from llm.common import bound_batches, rows_of, stage, text_column

SAMPLE = 10_000
MAX_CHARS = 8_000
PREFIXES = (4, 5)
MIN_DF = 5
Z = 6.0
#: A document is rejected if a grade of at least one is more likely than not.
REJECT = 0.5


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes with their weights, and the thresholds in order."""

    feature: np.ndarray
    weight: np.ndarray
    threshold: np.ndarray

    def probabilities(self, total: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each text and each k from 1."""
        return _sigmoid(total[:, None] - self.threshold[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of a block, whole words and then prefixes, with their text numbers."""
    folded = arrays.fold_ascii(data)
    start, end, first = arrays.words(folded, offsets, arrays.ALNUM)
    hasher = arrays.Hasher(folded)
    whole = hasher.spans(start, end)
    keys = [whole]
    for n in PREFIXES:
        short = hasher.spans(start, np.minimum(end, start + n))
        keys.append(arrays.mix(short + np.uint64(n)))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.concatenate(keys), np.tile(text, len(keys))


def _sampled(batches):
    for batch in batches:
        out = []
        for lo, hi, data, offsets in arrays.blocks(batch.column("text")):
            key, text = _features(data, offsets)
            order = np.argsort(text, kind="stable")
            cut = np.searchsorted(text[order], np.arange(hi - lo + 1))
            key = key[order].view(np.int64)
            out += [np.unique(key[cut[i] : cut[i + 1]]) for i in range(hi - lo)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array(out, pa.list_(pa.int64()))], ["grade", "features"]
        )


def _keep_weighted(feature: np.ndarray):
    """Of each row's features the places in ``feature`` (sorted) of those that are there."""

    def run(batches):
        for batch in batches:
            listed = batch.column("features")
            size = listed.value_lengths().to_numpy(zero_copy_only=False)
            key = listed.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            place = np.minimum(np.searchsorted(feature, key), len(feature) - 1)
            on = feature[place] == key
            ends = np.concatenate([[0], np.cumsum(on)])[np.concatenate([[0], np.cumsum(size)])]
            places = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(place[on], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("grade"), places], ["at", "grade", "places"]
            )

    return run


def grade_column():
    """The default grade of a row of ``labels``."""
    toxic = F.col("toxic") == 1
    return F.when(toxic & (F.col("quality") == 0), 2).when(toxic, 1).otherwise(0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """A model from a bounded sample of labelled documents."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    graded = known.groupBy(F.col("doc_id").alias("doc")).agg(F.max(grade_column()).alias("grade"))
    # at most ``sample`` rows of two numbers: small enough to send to every task
    chosen = F.broadcast(graded.orderBy(F.xxhash64("doc"), "doc").limit(sample))
    sampled = (
        rows_of(docs, id_col, text_col)
        .where(F.length("text") <= MAX_CHARS)
        .join(chosen, "doc")
        .select("grade", "text")
        .mapInArrow(arrays.release_after(_sampled), "grade int, features array<long>")
        .withColumn("at", F.monotonically_increasing_id())
    )
    return _train(stage(sampled, "sampled"))


def _train(rows: DataFrame) -> Model:
    """A model from rows of a grade and features, summed in the order of ``at``."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(1, 50.0))
    grades = {x.grade: x.n for x in rows.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    levels = np.array(sorted(grades), np.int64)
    if len(levels) < 2:
        return none
    total = sum(grades.values())
    rate = (total - grades[levels[0]]) / total
    feature = _beyond_chance(rows, int(levels[0]), rate)
    if not len(feature):
        return none
    weighed = (
        rows.mapInArrow(_keep_weighted(feature), "at long, grade int, places array<long>")
        .toArrow()
        .sort_by("at")
    )
    grade = weighed.column("grade").to_numpy().astype(np.int64)
    places = weighed.column("places").combine_chunks()
    size = places.value_lengths().to_numpy(zero_copy_only=False)
    col = places.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(grade)), size)
    weight, threshold = _descend(grade, levels, row, col, len(feature))
    full = np.full(int(levels[-1]), threshold[-1])  # a grade that no sample has shares the next one's
    full[: int(levels[0])] = -50.0
    for low, up, t in zip(levels[:-1], levels[1:], threshold, strict=True):
        full[int(low) : int(up)] = t
    return Model(feature, weight, full)


def _beyond_chance(rows: DataFrame, lowest: int, rate: float) -> np.ndarray:
    """Sorted features whose rows have grades above the lowest more often or seldom than chance."""
    spread = F.sqrt(F.col("df") * rate * (1 - rate) + F.lit(1e-12))
    some = (
        rows.select("grade", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("df"), F.count_if(F.col("grade") > lowest).alias("positive"))
        .where(F.col("df") >= MIN_DF)
        .where(F.abs(F.col("positive") - F.col("df") * rate) >= F.lit(0.99 * Z) * spread)
        .toArrow()
    )
    df, positive = (some.column(x).to_numpy() for x in ("df", "positive"))
    z = (positive - df * rate) / np.sqrt(df * rate * (1 - rate) + 1e-12)
    return np.sort(some.column("feature").to_numpy()[np.abs(z) >= Z].view(np.uint64))


def _descend(grade, levels, row, col, n_features, steps: int = 300, rate: float = 0.1):
    """Adam on the penalised cumulative-link likelihood; threshold gaps stay positive."""
    level = np.searchsorted(levels, grade)
    cuts = len(levels) - 1
    share = np.array([(level >= k + 1).mean() for k in range(cuts)])
    threshold = -np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(n_features), threshold[:1]])
    theta = np.concatenate([theta, np.log(np.maximum(np.diff(threshold), 1e-3))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(level)
    for step in range(1, steps + 1):
        w, base, gaps = theta[:n_features], theta[n_features], np.exp(theta[n_features + 1 :])
        t = base + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(row, weights=w[col], minlength=n)
        p = np.concatenate(
            [np.ones((n, 1)), _sigmoid(eta[:, None] - t[None, :]), np.zeros((n, 1))], axis=1
        )
        slope = p * (1 - p)
        at = np.arange(n)
        likely = np.maximum(p[at, level] - p[at, level + 1], 1e-12)
        d_eta = -(slope[at, level] - slope[at, level + 1]) / likely / n
        d_t = np.zeros(cuts)
        np.add.at(d_t, np.maximum(level - 1, 0), np.where(level > 0, slope[at, level] / likely, 0))
        np.add.at(
            d_t,
            np.minimum(level, cuts - 1),
            np.where(level < cuts, -slope[at, level + 1] / likely, 0),
        )
        d_t /= n
        tail = np.cumsum(d_t[::-1])[::-1]
        grad = np.concatenate(
            [np.bincount(col, weights=d_eta[row], minlength=n_features) + 1e-4 * w]
            + [tail[:1], tail[1:] * gaps]
        )
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    t = theta[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(theta[n_features + 1 :]))])
    return theta[:n_features], t


def _totals(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text's distinct features."""
    key, text = _features(data, offsets)
    n = len(offsets) - 1
    at = np.searchsorted(model.feature, key)
    at = np.minimum(at, max(0, len(model.feature) - 1))
    on = model.feature[at] == key if len(model.feature) else np.zeros(len(key), bool)
    pair = np.unique(text[on] * max(1, len(model.feature)) + at[on])
    text, at = np.divmod(pair, max(1, len(model.feature)))
    return np.bincount(text, weights=model.weight[at], minlength=n)


def _score(shared, text_col: str):
    def run(batches):
        model = shared.value
        for batch in batches:
            row = batch.column("row")
            total = [
                _totals(model, data, offsets)
                for _, _, data, offsets in arrays.blocks(row.field(text_col))
            ]
            p = model.probabilities(np.concatenate(total) if total else np.zeros(0))
            columns = [p.sum(1), (p >= 0.5).sum(1).astype(np.int32), p[:, 0], p[:, 0] >= REJECT]
            yield pa.RecordBatch.from_arrays(
                [row, *(pa.array(x) for x in columns)],
                ["row", "severity", "grade", "toxic_probability", "toxic"],
            )

    return run


def grade_texts(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (all columns), ``severity``, ``grade``, ``toxic_probability``, ``toxic``."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    typed = docs.withColumn(text_col, text_column(text_col))
    rows = typed.select(F.struct("*").alias("row"))
    schema = T.StructType(
        [
            T.StructField("row", rows.schema["row"].dataType),
            T.StructField("severity", T.DoubleType()),
            T.StructField("grade", T.IntegerType()),
            T.StructField("toxic_probability", T.DoubleType()),
            T.StructField("toxic", T.BooleanType()),
        ]
    )
    return rows.mapInArrow(arrays.release_after(_score(shared, text_col)), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the model fitted on their labels doesn't reject, all columns."""
    graded = grade_texts(docs, fit(docs, labels, text_col=text_col, **options), text_col)
    return graded.where("NOT toxic").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    graded = grade_texts(docs, model)
    return graded.select(
        F.col("row.doc_id").alias("doc_id"), "severity", "grade", "toxic_probability", "toxic"
    )
