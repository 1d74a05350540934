"""From genomes and reads to taxids and a report, with the index built once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from readsift.operators import kmer, sketches
from readsift.session import stage


class Classifier:
    """k-mer index and tree as stored tables, shared by all reads.

    The tree belongs to the database and holds for every sample. The index is bucketed by k-mer:
    a small one is broadcast, a large one is read in place, and only the k-mers of the reads
    move. Contigs may come whole or as the chunks of ``read_genome_chunks``.
    """

    def __init__(
        self,
        contigs: DataFrame,
        taxonomy: DataFrame,
        taxa: DataFrame,
        k: int = kmer.K,
        buckets: int | None = None,
    ):
        self.k = k
        self.closure = kmer.database_tree(taxa)
        parts = kmer.index_parts(contigs, k)
        shuffled = int(contigs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.index = kmer.store_index(
            kmer.kmer_index(contigs, taxonomy, self.closure, k, parts),
            buckets or max(parts, shuffled),
        )

    def matches(self, reads: DataFrame) -> kmer.Matches:
        """k-mers of the reads that the index knows; both results below can share them."""
        return kmer.kmer_matches(reads, self.index, self.k)

    def classify(self, reads: DataFrame, confidence: float = kmer.CONFIDENCE) -> DataFrame:
        return kmer.classify_matches(self.matches(reads), self.closure, confidence)

    def report(self, reads: DataFrame, confidence: float = kmer.CONFIDENCE) -> DataFrame:
        """Clade report of all samples, with k-mers and distinct k-mers.

        k-mers are made and looked up once, for the calls and for the counts.
        """
        matches = self.matches(reads)
        calls = stage(kmer.classify_matches(matches, self.closure, confidence), "calls")
        return kmer.clade_report(calls, self.closure, matches.kmers(), rounds=matches.rounds)

    def add_run(self, reads: DataFrame, path: str) -> kmer.Matches:
        """Look up the reads of a run and add its k-mer sketches to those stored at a path."""
        matches = self.matches(reads)
        sketches.add_run(sketches.kmer_sketches(matches.kmers()), path)
        return matches

    def clades_over_runs(self, path: str, by: tuple[str, ...] = ("sample",)) -> DataFrame:
        """k-mers and estimated distinct k-mers per clade, over all runs stored at a path."""
        runs = sketches.read_runs(self.closure.sparkSession, path)
        return sketches.estimated(sketches.clade_sketches(runs, self.closure, by))
