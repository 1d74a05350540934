"""Reports and verdicts per genus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readsift.functions import first_word, label
from readsift.operators.joins import dimension_join

GENUS = ["sample", "kraken_genus_taxid"]

# The host genus, left out by taxid in one list and by name in the other.
HOST_TAXID, HOST_NAME = 9605, "Homo"
MIN_CLADE_READS = 3
MIN_ALIGNMENTS = 3
AGREEMENT = 0.8
UNIQUE_SHARE = 0.8
TOP_SPECIES = 15
# Colours of the groups.
TRUE_COLOR, FALSE_COLOR, PLAIN_COLOR = "darkgreen", "red", "black"


def target_genera(report: DataFrame) -> DataFrame:
    """Taxids of all genera but the host, whatever their read count."""
    return report.where((F.col("tax_rank") == "G") & (F.col("taxid") != HOST_TAXID)).select(
        "sample", "taxid"
    )


def genus_report(report: DataFrame, min_reads: int = MIN_CLADE_READS) -> DataFrame:
    """Genus rows, host left out, with more than ``min_reads`` reads in the clade."""
    genus = report.where(F.trim("tax_rank") == "G").withColumn("name", F.trim("name"))
    genus = genus.where((F.col("name") != HOST_NAME) & (F.col("clade_reads") > min_reads))
    return genus.withColumn("kraken_genus_taxid", F.col("taxid").cast("string")).drop(
        "taxid", "level_num"
    )


def taxonomy_verdict(
    hits: DataFrame,
    genera: DataFrame,
    min_alignments: int = MIN_ALIGNMENTS,
    agreement: float = AGREEMENT,
) -> DataFrame:
    """Whether alignments land in the genus the classifier named.

    Counts primary rows whose contig's genus is, or is not, the reported one. Genera with
    at most ``min_alignments`` rows, unnamed ones included, get no verdict.
    """
    named = genera.select(*GENUS, F.col("name").alias("reported_name"))
    counted = hits.where(F.col("primary") > 0).select(*GENUS, "primary", "name")
    joined = dimension_join(counted, named, GENUS)
    same = F.col("reported_name") == first_word(F.col("name"))
    totals = joined.groupBy(*GENUS).agg(
        F.sum("primary").alias("alignments"),
        F.coalesce(F.sum(F.when(same, F.col("primary"))), F.lit(0)).alias("same"),
        F.coalesce(F.sum(F.when(~same, F.col("primary"))), F.lit(0)).alias("different"),
    )
    judged = totals.where(
        (F.col("alignments") > min_alignments) & (F.col("same") + F.col("different") > 0)
    )
    share = F.try_divide(F.col("same"), F.col("same") + F.col("different"))
    return judged.select(
        *GENUS,
        "same",
        "different",
        share.alias("percent_agreement"),
        F.when(share > agreement, "TP").when(share <= agreement, "FP").alias("tax_indicator"),
    )


def verdict_color(*verdicts: Column) -> Column:
    """Red if any verdict is FP, else green if any is TP, else NULL."""
    false = true = F.lit(False)
    for v in verdicts:
        false, true = false | (v == "FP"), true | (v == "TP")
    return F.when(false, FALSE_COLOR).when(true, TRUE_COLOR)


def refine_report(genera: DataFrame, coverage: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Genus rows with both verdicts, colour and label.

    Genera without a coverage verdict are dropped. Of genera with one name the first
    stays, in order of report line, then genome.
    """
    covered = coverage.where(F.col("indicator").isNotNull()).select(
        *GENUS, "genome", "reads_tot", "indicator"
    )
    joined = genera.join(covered, GENUS, "inner").join(taxonomy, GENUS, "left")
    order = (["line_no"] if "line_no" in genera.columns else []) + ["kraken_genus_taxid", "genome"]
    first = Window.partitionBy("sample", "name").orderBy(*order)
    kept = joined.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    colored = kept.withColumn(
        "tick_color", verdict_color(F.col("indicator"), F.col("tax_indicator"))
    )
    return colored.withColumn("tick_name", label(F.col("tick_color"), F.col("name")))


def unique_kmer_verdict(genera: DataFrame, share: float = UNIQUE_SHARE) -> DataFrame:
    """Verdict from the share of distinct k-mers; NULL if a genus has no k-mers."""
    ratio = F.try_divide("n_unique_kmers", "n_kmers")
    return (
        genera.withColumn("indicator", F.when(ratio < share, "FP").when(ratio >= share, "TP"))
        .withColumn("tick_color", verdict_color(F.col("indicator")))
        .withColumn("tick_name", label(F.col("tick_color"), F.col("name")))
    )


def species_top(
    hits: DataFrame, refined: DataFrame, nodes: DataFrame, n: int = TOP_SPECIES
) -> DataFrame:
    """The ``n`` most frequent aligned taxa of each accepted genus, ties kept."""
    accepted = refined.where(F.col("tick_color") == TRUE_COLOR).select(*GENUS)
    counts = (
        dimension_join(hits.select(*GENUS, "name", "mapped"), accepted, GENUS, how="left_semi")
        .groupBy(*GENUS, "name")
        .agg(F.sum("mapped").alias("n"))
    )
    by_count = Window.partitionBy(*GENUS).orderBy(F.desc("n"))
    top = counts.withColumn("_rank", F.rank().over(by_count)).where(F.col("_rank") <= n)
    genus_names = nodes.select(
        F.col("id").cast("string").alias("kraken_genus_taxid"), F.col("name").alias("genera")
    )
    return dimension_join(top.drop("_rank"), genus_names, ["kraken_genus_taxid"])


def compare_groupings(genera: DataFrame, refined: DataFrame, uniqued: DataFrame) -> DataFrame:
    """The genera as reported, refined and judged by k-mers, one row per panel."""
    cols = [*GENUS, "name", "clade_reads", "tick_color", "tick_name"]
    original = genera.withColumn("tick_color", F.lit(PLAIN_COLOR)).withColumn(
        "tick_name", label(F.lit(PLAIN_COLOR), F.col("name"))
    )
    panels = [("original", original), ("refined", refined), ("unique", uniqued)]
    parts = [df.select(F.lit(panel).alias("panel"), *cols) for panel, df in panels]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
