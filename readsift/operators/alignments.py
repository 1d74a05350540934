"""Alignment rows: filters, annotation, first row per read, placement on genomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readsift.operators.joins import dimension_join

# Flag of an unmapped row, and the flags of primary rows.
UNMAPPED_FLAG = 4
PRIMARY_FLAGS = (0, 16)
# Fixed value: flag bit of a secondary row.
SECONDARY_BIT = 256

PAIR = ["sample", "genome", "kraken_genus_taxid"]


def mapped_only(alignments: DataFrame) -> DataFrame:
    """Drop unmapped rows, by equality and not by bit test."""
    return alignments.where(F.col("flag") != UNMAPPED_FLAG)


def is_primary(flag: str = "flag") -> Column:
    return F.col(flag).isin(*PRIMARY_FLAGS)


def primary_only(alignments: DataFrame) -> DataFrame:
    return alignments.where(is_primary())


def annotate_alignments(alignments: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Every alignment row with genome, taxon id and taxon name of its contig."""
    return dimension_join(alignments, taxonomy, ["accession"])


def alignment_hits(alignments: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Rows per (sample, genus, contig) with the contig's genome and taxon.

    The pair list, the agreement verdict and the species table need only these counts,
    so the rows are added up before any join: the join then sees each contig
    once per sample and genus, however many reads it drew.
    """
    counts = alignments.groupBy("accession", "kraken_genus_taxid", "sample").agg(
        F.count(F.lit(1)).alias("mapped"),
        F.count_if(is_primary()).alias("primary"),
    )
    return dimension_join(counts, taxonomy, ["accession"])


def primary_pairs(hits: DataFrame) -> DataFrame:
    """Distinct (sample, genome, genus) of primary rows."""
    return hits.where(F.col("primary") > 0).select(*PAIR).distinct()


def first_alignment(alignments: DataFrame) -> DataFrame:
    """First row of every read, secondary rows included.

    File order is (genus, file, line_no), or (genus, line_no) where the rows name no file.
    Without line numbers the order is genus, primary before secondary, higher mapping
    quality, contig, position.
    """
    names = alignments.columns
    if "line_no" in names:
        order = ["kraken_genus_taxid", *[c for c in ("file", "line_no") if c in names]]
    else:
        quality = [-F.col("mapq")] if "mapq" in names else []
        order = [
            "kraken_genus_taxid",
            F.col("flag").bitwiseAND(SECONDARY_BIT),
            *quality,
            "accession",
            "start_position",
        ]
    rest = [c for c in names if c not in ("sample", "read")]
    # One shuffle and one sort: a rank would be limited by a second sort before the shuffle,
    # which saves little where reads have one or two rows.
    rows = Window.partitionBy("read", "sample").orderBy(*order, *rest)
    return (
        alignments.withColumn("_before", F.lag(F.lit(True)).over(rows))
        .where(F.col("_before").isNull())
        .select("sample", "read", *rest)
    )


def placements(hits: DataFrame, offsets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Start of each hit contig on its genome, for pairs with a primary row.

    Of contigs with one name the first by (genome, start) is kept.
    """
    first = F.min(F.struct("genome", "start_pos")).alias("first")
    starts = offsets.groupBy("accession").agg(first).select("accession", "first.*")
    where = hits.select("sample", "kraken_genus_taxid", "accession").distinct()
    placed = dimension_join(where, starts, ["accession"], how="inner")
    return dimension_join(placed, pairs, PAIR, how="left_semi", null_safe=["genome"])


def place_reads(first: DataFrame, places: DataFrame) -> DataFrame:
    """First rows with their position on the genome.

    A read on a contig of unknown place, or on a genome without primary rows for its
    genus, has a NULL position.
    """
    return dimension_join(
        first.select("sample", "read", "kraken_genus_taxid", "accession", "start_position"),
        places,
        ["accession", "kraken_genus_taxid", "sample"],
    ).withColumn("start_genome", F.col("start_position") + F.col("start_pos"))


def placement_summary(placed: DataFrame) -> DataFrame:
    """Reads placed and left out, per sample."""
    return placed.groupBy("sample").agg(
        F.count("start_genome").alias("placed"),
        F.count_if(F.col("start_genome").isNull()).alias("unplaced"),
    )
