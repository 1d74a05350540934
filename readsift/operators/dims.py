"""Contig, genome and taxon dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readsift.functions import first_word, genome_of_path
from readsift.operators.joins import dimension_join
from readsift.operators.prefix import BLOCK_ROWS, running_sum


def contig_lengths(contigs: DataFrame) -> DataFrame:
    """Base count per contig; of contigs with one name the first in file order stays.

    Takes the rows of the sequence reader (path, line_no, id, seq), or the chunks of contigs
    (with ``letters``), whose lengths are added up.
    """
    where = F.struct("path", "line_no").alias("place")
    if "letters" in contigs.columns:
        measured = contigs.groupBy(F.col("id").alias("accession"), where).agg(
            F.sum("letters").alias("contig_length")
        )
    else:
        length = F.length("seq").cast("long").alias("contig_length")
        measured = contigs.select(F.col("id").alias("accession"), where, length)
    return measured.groupBy("accession").agg(
        F.min_by("contig_length", "place").alias("contig_length"),
        F.min("place")["line_no"].alias("contig_no"),
        F.min("place")["path"].alias("path"),
    )


def contig_headers(contigs: DataFrame, path: str = "path", header: str = "description") -> DataFrame:
    """File and header of every contig; runs of ``:`` or ``>`` become field breaks."""
    return contigs.select(
        F.col(path).alias("path"),
        F.col(header).alias("header"),
        F.regexp_replace(header, "[:>]+", "\t").alias("fields"),
    )


def contig_genome(headers: DataFrame) -> DataFrame:
    """Accession (header up to the first whitespace) and the genome of its file."""
    return headers.select(
        first_word(F.col("header")).alias("accession"),
        genome_of_path(F.col("path")).alias("genome"),
    )


def read_lengths(reads: DataFrame) -> DataFrame:
    """Full header and length of every read."""
    return reads.select("description", F.length("seq").cast("long").alias("length"))


def contig_taxonomy(contig_genomes: DataFrame, genomes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Contigs with the taxon of their genome; NULL where a genome or taxon is unknown."""
    placed = dimension_join(
        contig_genomes.select("accession", "genome"),
        genomes.select("genome", "id"),
        ["genome"],
        null_safe=["genome"],
    )
    return dimension_join(
        placed, nodes.select("id", "name"), ["id"], null_safe=["id"]
    ).select("accession", "genome", "id", "name")


def contig_offsets(
    lengths: DataFrame,
    taxonomy: DataFrame,
    order: Sequence[str] = ("contig_no",),
    block: int = BLOCK_ROWS,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Place of every contig when the contigs of its genome are laid end to end.

    The first contig starts at 1 and the next one a base after the end of the one
    before. Contigs without a genome form one group. A genome may have any number of
    contigs: the running sum works by blocks. With ``pairs`` only genomes that occur there
    are laid out.
    """
    placed = dimension_join(
        lengths, taxonomy.select("accession", "genome"), ["accession"]
    )
    if pairs is not None:
        placed = genomes_hit(placed, pairs)
    summed = running_sum(
        placed,
        group=["genome"],
        order=order,
        value=F.col("contig_length") + 1,
        out="end_pos",
        tie=["accession"],
        block=block,
    )
    return summed.select(
        "accession",
        "genome",
        "contig_length",
        *order,
        (F.col("end_pos") - F.col("contig_length")).alias("start_pos"),
        "end_pos",
    )


def genomes_hit(contigs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Contigs of the genomes that occur in ``pairs``; NULL counts as a genome."""
    hit = pairs.select("genome").distinct()
    return dimension_join(
        contigs, hit, ["genome"], how="left_semi", null_safe=["genome"]
    )


def pair_contigs(contigs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Contigs once for every (sample, genus) that hit their genome."""
    return dimension_join(
        contigs,
        pairs.select("sample", "genome", "kraken_genus_taxid"),
        ["genome"],
        null_safe=["genome"],
    )
