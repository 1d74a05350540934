"""Read extraction for all samples, with the tree of their reports built once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from readsift.operators import extract
from readsift.operators.taxonomy import taxon_closure
from readsift.operators.verdict import target_genera
from readsift.session import stage
from readsift.sinks.writers import write_reads


class Extraction:
    """Assignments, reads and reports of a run, joined by sample.

    The (ancestor, descendant) table is stored, as every request reads it and its known
    size lets Spark broadcast it where it is small.
    """

    def __init__(self, assignments: DataFrame, reads: DataFrame, report: DataFrame):
        self.assignments, self.reads, self.report = assignments, reads, report
        self.closure = stage(taxon_closure(report), "closure")

    def select(self, taxids: Sequence[int], **options) -> DataFrame:
        return extract.select_assignments(self.assignments, taxids, self.closure, **options)

    def extract(self, taxids: Sequence[int], **options) -> DataFrame:
        return extract.extract_reads(self.assignments, self.reads, taxids, self.closure, **options)

    def summary(self, taxids: Sequence[int], **options) -> DataFrame:
        return extract.extract_summary(self.assignments, self.reads, taxids, self.closure, **options)

    def write(self, taxids: Sequence[int], path: str, **options) -> DataFrame:
        """Write the reads of the taxa and give the summary, counted while writing."""
        return extract.extract_and_write(
            self.assignments, self.reads, taxids, path, self.closure, **options
        )

    def all_genera(self) -> DataFrame:
        """Reads of every genus of the reports, each with its descendants."""
        targets = target_genera(self.report)
        return extract.extract_all(self.assignments, self.reads, self.closure, targets)

    def write_all_genera(self, path: str, fmt: str = "fasta", mode: str = "overwrite") -> None:
        """One folder of reads per sample, genus and mate."""
        keys = [c for c in ("sample", "target", "mate") if c == "target" or c in self.reads.columns]
        write_reads(self.all_genera(), path, fmt, mode, partition_by=keys)
