"""Fixed-width windows over (entity, position) rows, and the evenness verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readsift.operators.alignments import PAIR
from readsift.operators.joins import dimension_join

WINDOW_WIDTH = 8000
SMALL_WINDOWS = 65
EVEN_SHARE = 0.08
# Fixed values: (sum below, highest window allowed) for large genomes.
LADDER = [
    (10, 1), (20, 2), (40, 3), (80, 4), (120, 6),
    (160, 8), (200, 10), (240, 12), (280, 14), (320, 15),
]


def bin_position(position: Column, width: int = WINDOW_WIDTH) -> Column:
    """Number of the window a position lies in, from 1."""
    return F.floor(position / F.lit(width)).cast("long") + 1


def window_counts(
    placed: DataFrame,
    keys: Sequence[str] = tuple(PAIR),
    position: str = "start_genome",
    width: int = WINDOW_WIDTH,
) -> DataFrame:
    """Rows per window; rows without a position are left out."""
    return (
        placed.where(F.col(position).isNotNull())
        .groupBy(*keys, bin_position(F.col(position), width).alias("window"))
        .agg(F.count(F.lit(1)).alias("reads"))
    )


def extent_sizes(
    points: DataFrame, keys: Sequence[str], position: str, width: int = WINDOW_WIDTH
) -> DataFrame:
    """Highest position and number of windows per key, from the rows themselves."""
    sizes = points.groupBy(*keys).agg(F.max(position).alias("size"))
    return sizes.withColumn("n_windows", bin_position(F.col("size"), width))


def genome_sizes(offsets: DataFrame, pairs: DataFrame, width: int = WINDOW_WIDTH) -> DataFrame:
    """Length and number of windows of each genome, for every pair that hit it."""
    sizes = offsets.groupBy("genome").agg(F.max("end_pos").alias("size"))
    return (
        dimension_join(pairs, sizes, ["genome"], how="inner", null_safe=["genome"])
        .select(*PAIR, "size")
        .withColumn("n_windows", bin_position(F.col("size"), width))
    )


def coverage_totals(
    counts: DataFrame, sizes: DataFrame, keys: Sequence[str] = tuple(PAIR)
) -> DataFrame:
    """Sum and highest count over the windows of each key, and the number of windows.

    Empty windows change neither, so the grid of windows is never built. A count beyond
    the known size stretches the number of windows.
    """
    seen = counts.groupBy(*keys).agg(
        F.sum("reads").alias("reads_tot"),
        F.max("reads").alias("reads_max"),
        F.max("window").alias("last_window"),
    )
    return dimension_join(sizes, seen, keys, null_safe=keys).select(
        *keys,
        F.greatest("n_windows", "last_window").alias("n_windows"),
        F.coalesce("reads_tot", F.lit(0)).cast("long").alias("reads_tot"),
        F.coalesce("reads_max", F.lit(0)).cast("long").alias("reads_max"),
    )


def evenness(
    n_windows: Column,
    total: Column,
    highest: Column,
    small: int = SMALL_WINDOWS,
    share: float = EVEN_SHARE,
    ladder: Sequence[tuple[int, int]] = tuple(LADDER),
) -> Column:
    """TP where rows spread over the windows, FP where one window holds too many.

    Up to ``small`` windows, and beyond the ladder's last sum, the highest window must
    hold less than ``share`` of all rows; NULL if there are none. In between, the first
    rung whose sum is not reached limits the highest window.
    """
    ratio = F.try_divide(highest, total)
    by_share = F.when(ratio < share, "TP").when(ratio >= share, "FP")
    verdict = F.when(n_windows <= small, by_share)
    for below, limit in ladder:
        verdict = verdict.when(total < below, F.when(highest > limit, "FP").otherwise("TP"))
    return verdict.otherwise(by_share)


def best_genome(
    totals: DataFrame,
    group: Sequence[str] = ("sample", "kraken_genus_taxid"),
    by: str = "reads_tot",
) -> DataFrame:
    """Rows with the group's highest total, ties kept.

    Spark keeps only the top rank of each map task before the shuffle.
    """
    top = Window.partitionBy(*group).orderBy(F.desc(by))
    return totals.withColumn("_rank", F.rank().over(top)).where("_rank = 1").drop("_rank")


def coverage_verdict(
    counts: DataFrame,
    sizes: DataFrame,
    keys: Sequence[str] = tuple(PAIR),
    group: Sequence[str] | None = ("sample", "kraken_genus_taxid"),
    small: int = SMALL_WINDOWS,
    share: float = EVEN_SHARE,
    ladder: Sequence[tuple[int, int]] = tuple(LADDER),
) -> DataFrame:
    """Evenness verdict per key; with ``group``, for the best key of each group only."""
    totals = coverage_totals(counts, sizes, keys)
    judged = totals.withColumn(
        "indicator",
        evenness(
            F.col("n_windows"), F.col("reads_tot"), F.col("reads_max"), small, share, ladder
        ),
    )
    return best_genome(judged, group) if group else judged


def coverage_profile(
    counts: DataFrame,
    sizes: DataFrame,
    keys: Sequence[str] = tuple(PAIR),
) -> DataFrame:
    """Count of every window of every key, 0 where nothing lies.

    Counted and empty windows are united and added up: one partial aggregation in place
    of a join of the grid.
    """
    grid = sizes.select(
        *keys,
        F.explode(F.sequence(F.lit(1).cast("long"), "n_windows")).alias("window"),
        F.lit(0).cast("long").alias("reads"),
    )
    both = counts.select(*keys, "window", "reads").unionByName(grid)
    return both.groupBy(*keys, "window").agg(F.sum("reads").alias("reads"))


def judged_profile(
    counts: DataFrame, sizes: DataFrame, verdicts: DataFrame, nodes: DataFrame, by: str = "pair"
) -> DataFrame:
    """Profile of the judged genomes, named by genus.

    ``by="pair"`` keeps the judged (genome, genus) only; ``by="genome"`` keeps every genus
    on a judged genome. The restriction is applied before the grid is built.
    """
    on = {"pair": PAIR, "genome": ["sample", "genome"]}[by]
    judged = verdicts.select(*on).distinct()
    kept_sizes = dimension_join(sizes, judged, on, how="left_semi", null_safe=["genome"])
    kept_counts = dimension_join(counts, judged, on, how="left_semi", null_safe=["genome"])
    profile = coverage_profile(kept_counts, kept_sizes)
    names = nodes.select(F.col("id").cast("string").alias("kraken_genus_taxid"), "name")
    return dimension_join(profile, names, ["kraken_genus_taxid"])
