"""From alignments and reports to the verdicts of all samples, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readsift.operators import alignments as al
from readsift.operators import coverage as cov
from readsift.operators import verdict as vd
from readsift.operators.dims import contig_offsets, contig_taxonomy
from readsift.operators.order import sort_ranges, with_position
from readsift.session import stage
from readsift.sinks.writers import write_table


# Columns that choose and place the first row of a read.
PLACED_COLUMNS = (
    "sample read kraken_genus_taxid file line_no flag mapq accession start_position"
).split()


# Written tables of genera begin with these columns.
FIRST_COLUMNS = (
    "percentage clade_reads taxon_reads n_kmers n_unique_kmers tax_rank kraken_genus_taxid name"
).split()


PROFILE_ORDER = ["genome", "kraken_genus_taxid", "window"]


def species_order() -> list:
    """Rising reads; of equal ones by genus, then name, unnamed last."""
    return [F.col("n"), F.col("kraken_genus_taxid"), F.col("name").asc_nulls_last()]


@dataclass
class Inputs:
    """Tables of a run; every one but the dimensions carries ``sample``."""

    report: DataFrame
    alignments: DataFrame
    lengths: DataFrame
    contig_genomes: DataFrame
    genomes: DataFrame
    nodes: DataFrame


class Evaluation:
    """The results of a run, each a DataFrame over the same shared steps.

    Alignment rows are read for two things only: counts per (sample, genus, contig),
    which feed all that needs no position, and window counts of the first row per read.
    Both are small beside the rows. With ``staged`` they are written out once and
    shared by all results; without, each result is one lazy plan over the inputs.
    """

    def __init__(self, inputs: Inputs, width: int = cov.WINDOW_WIDTH, staged: bool = True):
        def keep(df, name):
            return stage(df, name) if staged else df

        self.nodes = inputs.nodes
        self.genera = vd.genus_report(inputs.report)
        mapped = al.mapped_only(inputs.alignments)
        taxonomy = contig_taxonomy(inputs.contig_genomes, inputs.genomes, inputs.nodes)
        self.hits = keep(al.alignment_hits(mapped, taxonomy), "hits")
        self.pairs = al.primary_pairs(self.hits)
        offsets = contig_offsets(inputs.lengths, taxonomy, pairs=self.pairs)
        self.offsets = keep(offsets, "offsets")
        places = keep(al.placements(self.hits, self.offsets, self.pairs), "places")
        needed = [c for c in PLACED_COLUMNS if c in mapped.columns]
        self.placed = al.place_reads(al.first_alignment(mapped.select(*needed)), places)
        self.counts = keep(cov.window_counts(self.placed, width=width), "windows")
        self.sizes = cov.genome_sizes(self.offsets, self.pairs, width=width)

    def coverage(self) -> DataFrame:
        return cov.coverage_verdict(self.counts, self.sizes)

    def taxonomy(self) -> DataFrame:
        return vd.taxonomy_verdict(self.hits, self.genera)

    def refined(self) -> DataFrame:
        return vd.refine_report(self.genera, self.coverage(), self.taxonomy())

    def uniqued(self) -> DataFrame:
        return vd.unique_kmer_verdict(self.genera)

    def species(self) -> DataFrame:
        return vd.species_top(self.hits, self.refined(), self.nodes)

    def profile(self, by: str = "pair") -> DataFrame:
        return cov.judged_profile(self.counts, self.sizes, self.coverage(), self.nodes, by)

    def sorted_species(self) -> DataFrame:
        """The species table with each row's position in its sample."""
        return with_position(self.species(), ["sample"], species_order())

    def sorted_profile(self, by: str = "pair") -> DataFrame:
        """The profile with each row's position in its sample."""
        order = [c for c in PROFILE_ORDER if c != "kraken_genus_taxid" or by == "pair"]
        return with_position(self.profile(by), ["sample"], [F.col(c) for c in order])

    def groupings(self) -> DataFrame:
        return vd.compare_groupings(self.genera, self.refined(), self.uniqued())

    def unplaced(self) -> DataFrame:
        return al.placement_summary(self.placed)

    def write(self, path: str, mode: str = "overwrite") -> None:
        """Refined, uniqued and species tables, profile and panels; one folder per sample each.

        Genera stand in the order of the report and species by rising reads. A sample has few of
        either, and they belong in one file. A profile is as long as its genomes, so it is written
        in sorted ranges, of which a sample may have several files.
        """
        genera = [F.col("line_no")]
        tables = {
            "refined": (self.refined(), genera),
            "uniqued": (self.uniqued(), genera),
            "species": (self.species(), species_order()),
            "panels": (self.groupings(), [F.col("panel"), F.col("clade_reads").desc(), F.col("name")]),
        }
        for name, (df, order) in tables.items():
            out = df.repartition("sample").sortWithinPartitions("sample", *order)
            self._write(out, f"{path.rstrip('/')}/{name}", mode)
        profile = sort_ranges(self.profile(), ["sample", *PROFILE_ORDER])
        self._write(profile, f"{path.rstrip('/')}/profile", mode)

    def _write(self, df: DataFrame, path: str, mode: str) -> None:
        names = [c for c in FIRST_COLUMNS if c in df.columns]
        rest = [c for c in df.columns if c not in names and c != "line_no"]
        write_table(df.select(*names, *rest), path, mode, partition_by=["sample"])
