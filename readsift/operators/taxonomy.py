"""The taxonomy tree of a report: edges, level ids, ancestors, descendants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readsift.operators.joins import dimension_join
from readsift.operators.prefix import BLOCK_ROWS, running_max

ROOT_TAXID = 1
# Ranks with a letter of their own.
MAIN_RANKS = ["R", "K", "D", "P", "C", "O", "F", "G", "S"]


def taxon_closure(report: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """Every (ancestor, descendant) pair of a report, each taxon with itself included.

    Report rows are in pre-order, so the ancestor of a row at level ``b`` is the last
    earlier row of level ``b``. Each row is repeated for the levels 0 to its own, and one
    running maximum of lines per (sample, level) finds all ancestors: no recursion and no
    range join. The maximum runs by blocks of lines, so no task sees a whole report.

    Rows with taxid 0 are skipped. A row more than one level below the row before it, or
    a second row at the root's level, fails the query: the lines of its ancestors
    would not rise with their level.
    """
    rows = report.where(F.col("taxid") != 0).select(
        "sample", "line_no", F.col("level_num").cast("int").alias("level_num"), "taxid", "tax_rank"
    )
    roots = rows.groupBy("sample").agg(F.min("level_num").alias("_root"))
    leveled = dimension_join(rows, roots, ["sample"])
    depth = F.col("level_num") - F.col("_root")
    spread = leveled.withColumn("depth", depth).withColumn(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("depth")))
    )
    own = F.col("bucket") == F.col("depth")
    found = running_max(
        spread,
        ["sample", "bucket"],
        ["line_no"],
        F.when(own, F.struct("line_no", "taxid", "tax_rank")),
        "above",
        block=block,
    )
    up_down = Window.partitionBy("sample", "line_no").orderBy("bucket")
    line, higher = F.col("above.line_no"), F.lag("above.line_no").over(up_down)
    stray = line.isNull() | (higher.isNotNull() & (line <= higher))
    second_root = (F.col("bucket") == 0) & (F.col("above.taxid") != ROOT_TAXID)
    message = F.format_string(
        "report line %d of sample %s has no parent line", F.col("line_no"), F.col("sample")
    )
    ancestor = F.when(
        F.col("stray") | F.coalesce("second_root", F.lit(False)), F.raise_error(message).cast("int")
    ).otherwise(F.col("above.taxid"))
    return (
        found.withColumn("stray", stray)
        .withColumn("second_root", second_root)
        .select(
            "sample",
            ancestor.alias("ancestor"),
            F.col("taxid").alias("descendant"),
            (F.col("depth") - F.col("bucket")).alias("distance"),
            F.col("bucket").alias("ancestor_depth"),
            F.col("above.tax_rank").alias("ancestor_rank"),
            "line_no",
            "level_num",
            "tax_rank",
        )
    )


def report_edges(report: DataFrame) -> DataFrame:
    """Parent of every taxon; the root has a NULL parent."""
    near = taxon_closure(report).where(F.col("distance") <= 1)
    return near.groupBy("sample", F.col("descendant").alias("taxid")).agg(
        F.max(F.when(F.col("distance") == 1, F.col("ancestor"))).alias("parent_taxid"),
        F.max("level_num").alias("level_num"),
        F.max("line_no").alias("line_no"),
    )


def level_ids(report: DataFrame) -> DataFrame:
    """Level id of every taxon.

    A one-letter rank stands as it is. A taxon of rank ``-`` or of a longer rank gets the
    letter of the nearest ancestor with a main rank and its distance to it. The root is R.
    """
    closure = taxon_closure(report).withColumn(
        "ancestor_rank",
        F.when(F.col("ancestor") == ROOT_TAXID, "R").otherwise(F.col("ancestor_rank")),
    )
    main = F.col("ancestor_rank").isin(*MAIN_RANKS) & (F.col("distance") > 0)
    near = F.min(F.when(main, F.struct("distance", "ancestor_rank")))
    found = closure.groupBy("sample", F.col("descendant").alias("taxid")).agg(
        near.alias("near"), F.max("tax_rank").alias("tax_rank"), F.max("level_num").alias("level_num")
    )
    derived = F.concat(F.col("near.ancestor_rank"), F.col("near.distance").cast("string"))
    unranked = (F.col("tax_rank") == "-") | (F.length("tax_rank") > 1)
    level_id = (
        F.when(F.col("taxid") == ROOT_TAXID, "R")
        .when(unranked, derived)
        .otherwise(F.col("tax_rank"))
    )
    return found.select("sample", "taxid", "level_num", level_id.alias("level_id"))


def _wanted(closure: DataFrame, taxids: DataFrame, side: str, other: str) -> DataFrame:
    """Closure rows whose ``side`` is wanted, as (sample, target, taxid of ``other``)."""
    wanted = taxids.select("sample", F.col("taxid").alias("target"))
    pairs = closure.select("sample", F.col(side).alias("target"), F.col(other).alias("taxid"))
    return dimension_join(pairs, wanted, ["sample", "target"], how="left_semi")


def ancestors(closure: DataFrame, taxids: DataFrame) -> DataFrame:
    """(sample, target, taxid): each wanted taxid with itself and its ancestors.

    ``taxids`` has columns sample and taxid. One missing from the report stands for
    itself only.
    """
    own = taxids.select("sample", F.col("taxid").alias("target"), "taxid")
    return _wanted(closure, taxids, "descendant", "ancestor").unionByName(own).distinct()


def descendants(closure: DataFrame, taxids: DataFrame) -> DataFrame:
    """(sample, target, taxid): each wanted taxid with itself and its descendants."""
    own = taxids.select("sample", F.col("taxid").alias("target"), "taxid")
    return _wanted(closure, taxids, "ancestor", "descendant").unionByName(own).distinct()


def expand_taxa(
    closure: DataFrame, taxids: Sequence[int], children: bool = False, parents: bool = False
) -> DataFrame:
    """Taxa per sample that a list of taxids stands for, the list itself left out."""
    taxids = list(taxids)
    parts = []
    if parents:
        parts.append(closure.where(F.col("descendant").isin(taxids)).select("sample", "ancestor"))
    if children:
        parts.append(closure.where(F.col("ancestor").isin(taxids)).select("sample", "descendant"))
    cols = [df.toDF("sample", "taxid").where(~F.col("taxid").isin(taxids)) for df in parts]
    out = cols[0] if cols else closure.select("sample", F.col("ancestor").alias("taxid")).limit(0)
    for df in cols[1:]:
        out = out.unionByName(df)
    return out.distinct()
