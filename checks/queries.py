"""Every operator as a query on the stand-in tables; all read whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readsift import fixtures as fx
from readsift.functions.kmers import kmer_text
from readsift.operators import alignments as al
from readsift.operators import coverage as cov
from readsift.operators import dims, extract, kmer, taxonomy
from readsift.operators import verdict as vd
from readsift.plans.classification import Classifier
from readsift.plans.evaluation import Evaluation, Inputs
from readsift.plans.extraction import Extraction
from readsift.session import stage, staging_path
from readsift.sinks import writers
from readsift.sources import sequences, text
from readsift.sources.chunks import read_genome_chunks

# Genus, species and an unknown taxid, so that every branch of the expansion occurs.
TAXIDS = [103, 1014, 1025, 99999]
MAX_READS = 1000
# Fewer than any sample has.
FILES_MAX_READS = 25
EVENT_KEYS = ["entity", "grp"]
EVENT_WIDTH = 60
K = 31
# Six standard errors of a sketch.
ESTIMATE_ERROR = 0.05
# Letters of a chunk, fewer than a contig has.
CHUNK = 1500
# Lines of each of several files, and how many files there are at least.
FILE_LINES = 1 << 20
FILES = 5
# Contigs of a compressed genome file, which one task reads.
FILE_CONTIGS = 1000
SAMPLE_FOLDER = r"sample=([^/]+)/"
MATE_FOLDER = r"sample=([^/]+)/mate=(\d)/"


class Standins:
    """The stand-in tables at one scale, in the library's schemas."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return fx.load(self.spark, self.sf_dir, f"fx_{name}")

    @property
    def lengths(self):
        return self.contigs.select("accession", "contig_length", "contig_no")

    @property
    def contig_genomes(self):
        return self.contigs.select("accession", "genome")

    @property
    def taxonomy(self):
        return dims.contig_taxonomy(self.contig_genomes, self.genomes, self.nodes)

    @property
    def hits(self):
        return al.alignment_hits(self.mapped, self.taxonomy)

    @property
    def mapped(self):
        return al.mapped_only(self.alignments)

    @property
    def closure(self):
        return stage(taxonomy.taxon_closure(self.report), "closure")

    def classifier(self) -> Classifier:
        contigs = self.contig_seq.repartition("accession")  # the table may be one split
        return Classifier(contigs, self.taxonomy, self.taxa, K)

    def evaluation(self) -> Evaluation:
        return Evaluation(
            Inputs(
                self.report, self.alignments, self.lengths, self.contig_genomes, self.genomes, self.nodes
            )
        )

    def staged(self, name: str, df: DataFrame, write) -> str:
        path = staging_path(self.spark, name)
        write(df, path)
        return path

    def in_files(self, lines: DataFrame) -> DataFrame:
        """Lines by ranges of ``line_no``, one file each of at most about ``FILE_LINES`` lines."""
        files = max(FILES, -(-lines.count() // FILE_LINES))
        return lines.repartitionByRange(files, "line_no")

    def by_sample(self, name: str, lines: DataFrame) -> str:
        """Lines written as text files below one folder per sample."""
        lines = lines.select("line", "sample")
        return self.staged(name, lines, lambda df, p: df.write.partitionBy("sample").text(p))


def target_list(s: Standins) -> DataFrame:
    return vd.target_genera(s.report)


def read_sequences(s: Standins) -> DataFrame:
    reads = s.mates.withColumn("description", F.concat("id", F.lit(" read of "), "sample"))
    path = s.staged(
        "fasta", reads, lambda df, p: writers.write_reads(df, p, partition_by=["sample", "mate"])
    )
    found = sequences.read_sequences(s.spark, path, path_pattern=MATE_FOLDER)
    return found.select("sample", "mate", "id", "description", "seq")


def read_fastq(s: Standins) -> DataFrame:
    reads = s.reads.select(
        "sample", F.concat("id", F.lit(" x")).alias("description"), "seq",
        F.regexp_replace("seq", "[ACGT]", "@").alias("qual"),
    )
    path = s.staged(
        "fastq", reads, lambda df, p: writers.write_reads(df, p, fmt="fastq", partition_by=["sample"])
    )
    found = sequences.read_sequences(s.spark, path, path_pattern=SAMPLE_FOLDER)
    return found.select("sample", "id", "description", "seq", "qual")


def read_genomes(s: Standins) -> DataFrame:
    contigs = s.contig_seq.select(F.concat("accession", F.lit(" contig of "), "genome").alias("description"), "seq")
    path = s.staged("genomes", contigs, lambda df, p: writers.write_reads(df, p))
    return sequences.read_genomes(s.spark, path, glob="*").select("id", "description", "seq")


def genome_chunks(s: Standins) -> DataFrame:
    """Contigs of their stated length, written compressed and read as chunks."""
    named = F.concat("accession", F.lit(" contig of "), "genome").alias("description")
    contigs = s.genome_seq.select(named, "seq")
    path = s.staged(
        "genomes", contigs,
        lambda df, p: writers.write_reads(df, p, compression="gzip", records_per_file=FILE_CONTIGS),
    )
    return read_genome_chunks(s.spark, path, glob="*", letters=CHUNK)


def contigs_of_chunks(s: Standins) -> DataFrame:
    """What the chunks of a contig make up, and how many of them are full."""
    own = F.expr("right(seq, letters)")
    each = genome_chunks(s).where("letters > 0").groupBy("path", "line_no", "id", "description").agg(
        F.array_sort(F.collect_list(F.struct("start", own.alias("seq")))).alias("parts"),
        F.max("letters").cast("long").alias("longest"),
    )
    seq = F.concat_ws("", "parts.seq")
    return each.select(
        "id", "description", F.length(seq).cast("long").alias("n_letters"), F.md5(seq).alias("seq_md5"),
        (F.col("longest") <= CHUNK).alias("cut"),
    )


def contig_lengths(s: Standins) -> DataFrame:
    return dims.contig_lengths(genome_chunks(s)).select("accession", "contig_length")


def read_assignments(s: Standins) -> DataFrame:
    path = s.by_sample("assignments", s.assignment_lines)
    rows = text.read_assignments(s.spark, path, path_pattern=SAMPLE_FOLDER)
    return rows.select("sample", "status", "read_id", "taxid", "length", "hits")


def report_levels(s: Standins) -> DataFrame:
    path = s.by_sample("report", s.report_lines)
    rows = text.read_report_tree(s.spark, path, path_pattern=SAMPLE_FOLDER)
    return rows.select("sample", "taxid", "level_num", "tax_rank")


def report_table(s: Standins) -> DataFrame:
    path = s.by_sample("report", s.report_lines)
    rows = text.read_report(s.spark, path, path_pattern=SAMPLE_FOLDER)
    return rows.drop("line_no")


def read_alignments(s: Standins) -> DataFrame:
    def write(df, path):
        df.write.partitionBy("sample", "kraken_genus_taxid").text(path)

    lines = s.alignment_lines.select("line", "sample", "kraken_genus_taxid")
    path = s.staged("sam", lines, write)
    rows = text.read_alignments(s.spark, path, glob=None, path_pattern=text.STAGED_SAM_PATH)
    return rows.drop("file", "line_no")


def first_alignment_files(s: Standins) -> DataFrame:
    """First rows of reads whose alignments of one genus come in several files."""
    keys = ["sample", "kraken_genus_taxid", "line_no"]
    lines = s.in_files(s.alignment_lines).sortWithinPartitions(*keys)
    lines = lines.select("line", "sample", "kraken_genus_taxid")
    path = s.staged(
        "sam", lines, lambda df, p: df.write.partitionBy("sample", "kraken_genus_taxid").text(p)
    )
    rows = text.read_alignments(s.spark, path, glob=None, path_pattern=text.STAGED_SAM_PATH)
    return al.first_alignment(rows).drop("file", "line_no", "mapq", "cigar")


def extract_max_files(s: Standins) -> DataFrame:
    """The first reads of each sample in assignments of several files."""
    lines = s.in_files(s.assignment_lines).sortWithinPartitions("sample", "line_no")
    path = s.by_sample("assignments", lines)
    rows = text.read_assignments(s.spark, path, path_pattern=SAMPLE_FOLDER)
    return Extraction(rows, s.reads, s.report).extract(TAXIDS, children=True, max_reads=FILES_MAX_READS)


def read_dimension(s: Standins) -> DataFrame:
    """Contigs of genome h3 have none."""
    known = s.contig_genomes.withColumn("genome", F.nullif("genome", F.lit("h3")))
    genomes = s.staged("a2g", known, writers.write_contig_genomes)
    lengths = s.staged("a2l", s.lengths, writers.write_contig_lengths)
    return (
        text.read_contig_genomes(s.spark, genomes)
        .join(text.read_contig_lengths(s.spark, lengths), "accession")
        .select("accession", "genome", "contig_length", "contig_no")
    )


def contig_offsets_from_files(s: Standins) -> DataFrame:
    lengths = s.staged("a2l", s.lengths.repartition(5), writers.write_contig_lengths)
    return dims.contig_offsets(text.read_contig_lengths(s.spark, lengths), s.taxonomy)


def extract_paired_files(s: Standins) -> DataFrame:
    """Two mate files per sample, written, read back and extracted from."""
    reads = s.mates.withColumn("description", F.col("id"))
    path = s.staged(
        "mates", reads, lambda df, p: writers.write_reads(df, p, partition_by=["sample", "mate"])
    )
    back = sequences.read_sequences(s.spark, path, path_pattern=MATE_FOLDER)
    found = Extraction(s.assignments, back, s.report).extract(TAXIDS, children=True)
    return found.select("sample", "mate", "id", "seq")


def write_table(s: Standins) -> DataFrame:
    """The species table of a run, written with its header and read back."""
    path = staging_path(s.spark, "tables")
    s.evaluation().write(path)
    schema = "kraken_genus_taxid string, name string, n long, genera string, sample string"
    return s.spark.read.schema(schema).csv(
        f"{path}/species", sep="\t", header=True, nullValue="NA", escape="\\"
    )


def read_taxon_list(s: Standins) -> DataFrame:
    path = s.staged("targets", target_list(s), writers.write_taxon_list)
    return text.read_taxon_list(s.spark, path, path_pattern=SAMPLE_FOLDER)


def list_samples(s: Standins) -> DataFrame:
    def write(df, path):
        df.write.partitionBy("sample", "kraken_genus_taxid").text(path)

    lines = s.alignment_lines.select("line", "sample", "kraken_genus_taxid")
    return text.list_samples(s.spark, s.staged("sam", lines, write), r"sample=([^/]+)/")


def contig_offsets(s: Standins) -> DataFrame:
    return dims.contig_offsets(s.lengths, s.taxonomy)


def first_alignment(s: Standins) -> DataFrame:
    return al.first_alignment(s.mapped)


def place_reads(s: Standins) -> DataFrame:
    hits = s.hits
    pairs = al.primary_pairs(hits)
    places = al.placements(hits, contig_offsets(s), pairs)
    return al.place_reads(al.first_alignment(s.mapped), places)


def event_counts(s: Standins) -> DataFrame:
    return cov.window_counts(s.event_points, EVENT_KEYS, "position", EVENT_WIDTH)


def event_verdict(s: Standins) -> DataFrame:
    points = s.event_points
    sizes = cov.extent_sizes(points, EVENT_KEYS, "position", EVENT_WIDTH)
    counts = cov.window_counts(points, EVENT_KEYS, "position", EVENT_WIDTH)
    return cov.coverage_verdict(counts, sizes, EVENT_KEYS, group=["entity"])


def event_profile(s: Standins) -> DataFrame:
    points = s.event_points.select("grp", "position")
    sizes = cov.extent_sizes(points, ["grp"], "position", EVENT_WIDTH)
    counts = cov.window_counts(points, ["grp"], "position", EVENT_WIDTH)
    return cov.coverage_profile(counts, sizes, ["grp"])


def extraction(s: Standins) -> Extraction:
    return Extraction(s.assignments, s.reads, s.report)


def _extract(s: Standins, **options) -> DataFrame:
    return extraction(s).extract(TAXIDS, children=True, **options)


def kmer_index(s: Standins) -> DataFrame:
    """The index of whole genomes, made from their chunks."""
    contigs = genome_chunks(s).withColumnRenamed("id", "accession")
    index = Classifier(contigs, s.taxonomy, s.taxa, K).index
    return index.select(kmer_text(F.col("kmer"), K).alias("kmer"), "taxid")


def classify_reads(s: Standins) -> DataFrame:
    return s.classifier().classify(s.kmer_reads)


def clade_report_kmers(s: Standins) -> DataFrame:
    return s.classifier().report(s.kmer_reads).drop("percentage")


def clade_kmers_estimated(s: Standins) -> DataFrame:
    """Distinct k-mers of clades over two runs, by stored sketches, held against exact counts."""
    classifier, path = s.classifier(), staging_path(s.spark, "sketches")
    first = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    runs = [classifier.add_run(s.kmer_reads.where(part), path) for part in (first, ~first)]
    both = runs[0].kmers().unionByName(runs[1].kmers())
    exact = kmer.clade_kmers(both, classifier.closure)
    exact = exact.select("sample", "taxid", F.col("n_unique_kmers").alias("exact"))
    off = F.abs(F.col("n_unique_kmers") - F.col("exact"))
    return classifier.clades_over_runs(path).join(exact, ["sample", "taxid"]).select(
        "sample", "taxid", "n_kmers", F.col("exact").alias("n_unique_kmers"),
        (off <= F.col("exact") * ESTIMATE_ERROR).alias("close"),
    )


def written_summary(s: Standins) -> DataFrame:
    """The summary that the job which writes the reads has counted."""
    reads = s.reads.withColumn("description", F.col("id"))
    run = Extraction(s.assignments, reads, s.report)
    return run.write(TAXIDS, staging_path(s.spark, "written"), children=True)


def taxa_frame(s: Standins) -> DataFrame:
    return s.report.select("sample").distinct().select("sample", F.explode(F.array(*map(F.lit, TAXIDS))).alias("taxid"))


QUERIES: dict[str, Callable[[Standins], DataFrame]] = {
    # sources and sinks
    "read_sequences": read_sequences,
    "read_fastq": read_fastq,
    "read_genomes": read_genomes,
    "read_genome_chunks": contigs_of_chunks,
    "read_assignments": read_assignments,
    "report_levels": report_levels,
    "report_table": report_table,
    "read_alignments": read_alignments,
    "read_dimension": read_dimension,
    "read_taxon_list": read_taxon_list,
    "contig_offsets_from_files": contig_offsets_from_files,
    "write_table": write_table,
    "list_samples": list_samples,
    # dimensions
    "contig_lengths": contig_lengths,
    "contig_headers": lambda s: dims.contig_headers(s.headers, "path", "header"),
    "contig_genome": lambda s: dims.contig_genome(s.headers),
    "read_lengths": lambda s: dims.read_lengths(s.reads.withColumn("description", F.col("id"))),
    "contig_taxonomy": lambda s: s.taxonomy,
    "contig_offsets": contig_offsets,
    # filters and joins
    "target_genera": target_list,
    "genus_report": lambda s: vd.genus_report(s.report),
    "annotate_alignments": lambda s: al.annotate_alignments(s.mapped, s.taxonomy),
    "alignment_hits": lambda s: s.hits,
    "primary_pairs": lambda s: al.primary_pairs(s.hits),
    "genomes_hit": lambda s: dims.genomes_hit(s.contig_genomes, al.primary_pairs(s.hits)),
    "pair_contigs": lambda s: dims.pair_contigs(s.contig_genomes, al.primary_pairs(s.hits)),
    "first_alignment": first_alignment,
    "first_alignment_files": first_alignment_files,
    # taxonomy
    "report_edges": lambda s: taxonomy.report_edges(s.report),
    "level_ids": lambda s: taxonomy.level_ids(s.report),
    "ancestors": lambda s: taxonomy.ancestors(s.closure, taxa_frame(s)),
    "descendants": lambda s: taxonomy.descendants(s.closure, taxa_frame(s)),
    # extraction
    "extract_reads": _extract,
    "extract_parents": lambda s: _extract(s, parents=True),
    "extract_exclude": lambda s: _extract(s, exclude=True),
    "extract_max": lambda s: _extract(s, max_reads=MAX_READS),
    "extract_max_files": extract_max_files,
    "extract_paired": lambda s: Extraction(s.assignments, s.mates, s.report).extract(
        TAXIDS, children=True
    ),
    "extract_paired_files": extract_paired_files,
    "extract_all_genera": lambda s: extraction(s).all_genera(),
    "taxon_counts": lambda s: extract.taxon_counts(extraction(s).select(TAXIDS, children=True)),
    "extract_summary": lambda s: extraction(s).summary(TAXIDS, children=True),
    "written_summary": written_summary,
    # coverage
    "place_reads": place_reads,
    "window_counts": lambda s: s.evaluation().counts,
    "genome_sizes": lambda s: s.evaluation().sizes,
    "coverage_totals": lambda s: (lambda e: cov.coverage_totals(e.counts, e.sizes))(s.evaluation()),
    "best_genome": lambda s: (lambda e: cov.best_genome(cov.coverage_totals(e.counts, e.sizes)))(
        s.evaluation()
    ),
    "coverage_verdict": lambda s: s.evaluation().coverage(),
    "coverage_profile": lambda s: s.evaluation().profile(),
    "event_window_counts": event_counts,
    "event_coverage_verdict": event_verdict,
    "event_coverage_profile": event_profile,
    # verdicts and reports
    "taxonomy_verdict": lambda s: vd.taxonomy_verdict(s.hits, vd.genus_report(s.report)),
    "refine_report": lambda s: s.evaluation().refined(),
    "unique_kmer_verdict": lambda s: vd.unique_kmer_verdict(vd.genus_report(s.report)),
    "species_top": lambda s: s.evaluation().species(),
    "sorted_species": lambda s: s.evaluation().sorted_species(),
    "sorted_profile": lambda s: s.evaluation().sorted_profile(),
    "compare_groupings": lambda s: s.evaluation().groupings(),
    "clade_report": lambda s: kmer.clade_report(s.assignments, s.closure),
    # k-mers
    "kmer_index": kmer_index,
    "classify_reads": classify_reads,
    "clade_report_kmers": clade_report_kmers,
    "clade_kmers_estimated": clade_kmers_estimated,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Standins(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
