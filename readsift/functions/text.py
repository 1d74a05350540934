"""Text parsing as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cut marks of genome file names, applied in this order; "." is any character.
GENOME_CUTS = [".fna", "_genomic", "_ASM", "_Viral", "_Genome", "_GRCh38"]
# Fixed value: the one genome that keeps its file suffix.
VECTOR_GENOME, VECTOR_GENOME_NAME = "UniVec_core", "UniVec_core.fna.gz"
# The letter code for artificial sequences and its taxid.
ARTIFICIAL_CODE, ARTIFICIAL_TAXID = "A", 81077


def int_or_null(text: Column, kind: str = "int") -> Column:
    return F.trim(text).try_cast(kind)


def first_word(text: Column) -> Column:
    """Text before the first whitespace character."""
    return F.split(text, r"\s", 2)[0]


def taxid_of(taxon: Column) -> Column:
    """Taxid of ``Name (taxid N)``, a bare number, or the letter for artificial sequences.

    Anything else fails the query, through the strict cast.
    """
    text = F.when(
        taxon.contains("taxid"), F.regexp_extract(taxon, r"^.*taxid (.*).$", 1)
    ).otherwise(taxon)
    return F.when(text == ARTIFICIAL_CODE, F.lit(ARTIFICIAL_TAXID)).otherwise(
        F.trim(text).cast("int")
    )


def genome_of_path(path: Column) -> Column:
    """Genome name of a sequence file: its base name, cut at the known marks."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    for mark in GENOME_CUTS:
        name = F.split(name, mark, 2)[0]
    return F.when(name == VECTOR_GENOME, F.lit(VECTOR_GENOME_NAME)).otherwise(name)


def id_base(read_id: Column, anywhere: bool = False) -> Column:
    """Read id without its mate mark.

    The mark is ``/1`` or ``/2`` at the end. With ``anywhere`` the last two
    characters go whenever a mark occurs at any place in the id.
    """
    if anywhere:
        marked = read_id.contains("/1") | read_id.contains("/2")
    else:
        marked = read_id.endswith("/1") | read_id.endswith("/2")
    return F.when(marked, F.substring(read_id, F.lit(1), F.length(read_id) - 2)).otherwise(read_id)


def label(color: Column, name: Column) -> Column:
    """Coloured tick label; a missing colour or name prints as NA."""
    return F.format_string(
        "<i style='color:%s'>%s</i>",
        F.coalesce(color, F.lit("NA")),
        F.coalesce(name, F.lit("NA")),
    )
