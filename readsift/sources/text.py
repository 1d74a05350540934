"""Line-based inputs: assignments, reports, alignments, dimensions, lists.

Each ``parse_`` function takes lines as a DataFrame, so that staged lines and files go
through the same columns; each ``read_`` function takes a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readsift.functions import int_or_null, taxid_of
from readsift.operators.alignments import mapped_only

# Row number inside its partition, in an id from monotonically_increasing_id.
ROW_BITS = (1 << 33) - 1
# Bits of a line's place in its file.
FILE_BITS = 44

# Sample and genus of an alignment file: <sample>/<genus taxid>.sam, or a folder pair
# written by Spark.
SAM_PATH = r"([^/]+)/([^/]+)\.sam(?:\.gz)?$"
STAGED_SAM_PATH = r"sample=([^/]+)/kraken_genus_taxid=([^/]+)/[^/]+$"


def sample_of(path: Column) -> Column:
    """Base name of a file without ``.gz`` and the last extension."""
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.gz$", "")
    return F.regexp_replace(name, r"\.[^.]*$", "")


def line_place() -> list[Column]:
    """Path and order number of a row of a text scan.

    The number is the byte offset of the row's split plus its row number in the task. A row
    takes at least a byte, so numbers rise through a file, with gaps between splits.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS))
    return [
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start") + row).alias("line_no"),
    ]


def path_part(pattern: str, group: int = 1) -> Column:
    """What a pattern's group finds in column ``path``; a path that does not match is an error."""
    path = F.col("path")
    stray = F.raise_error(F.concat(F.lit(f"{pattern!r} does not match "), path)).cast("string")
    return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, group)).otherwise(stray)


def read_lines(
    spark: SparkSession, path: str, glob: str | None = None, path_pattern: str | None = None
) -> DataFrame:
    """Lines of all files below a path: sample, path, file, line_no, line.

    The sample is the file's base name, or what the first group of ``path_pattern`` finds. Lines of
    several files are in order by (file, line_no), ``file`` being the path below the one read.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    rows = reader.text(path).select(F.col("value").alias("line"), *line_place())
    sample = path_part(path_pattern) if path_pattern else sample_of(F.col("path"))
    return rows.withColumn("sample", sample).withColumn("file", _below(path))


def _below(root: str) -> Column:
    """The part of column ``path`` from the path that is read on, or all of it."""
    at = F.locate(root.rstrip("/"), F.col("path"))
    after = at + F.lit(len(root.rstrip("/")))
    return F.when(at > 0, F.substr("path", after)).otherwise(F.col("path"))


def _place(lines: DataFrame) -> list[str]:
    """The columns that order lines, as far as the rows have them."""
    return [c for c in ("file", "line_no") if c in lines.columns]


def parse_assignments(lines: DataFrame) -> DataFrame:
    """Assignments; lines of fewer than five fields are dropped."""
    rows = lines.withColumn("f", F.split("line", "\t", -1)).where(F.size("f") >= 5)
    return rows.select(
        "sample",
        *_place(lines),
        F.col("f")[0].alias("status"),
        F.col("f")[1].alias("read_id"),
        taxid_of(F.col("f")[2]).alias("taxid"),
        F.col("f")[3].alias("length"),
        F.col("f")[4].alias("hits"),
    )


def read_assignments(
    spark: SparkSession, path: str, path_pattern: str | None = None
) -> DataFrame:
    return parse_assignments(read_lines(spark, path, path_pattern=path_pattern))


def parse_report_tree(lines: DataFrame) -> DataFrame:
    """Report rows for the tree: taxid, level, rank; six or eight fields.

    Lines whose second field is no integer are dropped. The level is half the number of
    spaces before the name.
    """
    stripped = F.regexp_replace("line", r"^\s+|\s+$", "")
    rows = lines.withColumn("f", F.split(stripped, "\t", -1))
    rows = rows.where(int_or_null(F.get("f", F.lit(1)), "long").isNotNull())
    name = F.element_at("f", -1)
    spaces = F.length(name) - F.length(F.regexp_replace(name, "^ +", ""))
    return rows.select(
        "sample",
        "line_no",
        F.trim(F.element_at("f", -2)).cast("int").alias("taxid"),
        F.floor(spaces / 2).cast("int").alias("level_num"),
        F.element_at("f", -3).alias("tax_rank"),
    )


def parse_report_table(lines: DataFrame) -> DataFrame:
    """Report rows of eight named columns; text from ``#`` on is dropped, strings trimmed.

    The level is half the number of spaces before the name, as in the tree form.
    """
    rows = lines.withColumn("line", F.regexp_replace("line", "#.*$", ""))
    rows = rows.where(F.trim("line") != "").withColumn("f", F.split("line", "\t", -1))

    def field(i: int) -> Column:
        return F.trim(F.get("f", F.lit(i)))

    name = F.get("f", F.lit(7))
    spaces = F.length(name) - F.length(F.ltrim(name))

    return rows.select(
        "sample",
        "line_no",
        field(0).cast("double").alias("percentage"),
        field(1).cast("long").alias("clade_reads"),
        field(2).cast("long").alias("taxon_reads"),
        field(3).cast("long").alias("n_kmers"),
        field(4).cast("long").alias("n_unique_kmers"),
        field(5).alias("tax_rank"),
        field(6).cast("int").alias("taxid"),
        field(7).alias("name"),
        F.floor(spaces / 2).cast("int").alias("level_num"),
    )


def read_report_tree(
    spark: SparkSession, path: str, glob: str | None = None, path_pattern: str | None = None
) -> DataFrame:
    return parse_report_tree(read_lines(spark, path, glob, path_pattern))


def read_report(
    spark: SparkSession, path: str, glob: str | None = None, path_pattern: str | None = None
) -> DataFrame:
    return parse_report_table(read_lines(spark, path, glob, path_pattern))


def parse_alignments(lines: DataFrame) -> DataFrame:
    """Mapped rows of SAM lines with the first six fields; header lines are skipped.

    ``lines`` carries sample and kraken_genus_taxid.
    """
    rows = lines.where(~F.col("line").startswith("@") & (F.trim("line") != "")).withColumn(
        "f", F.split("line", "\t", 7)
    )
    return mapped_only(
        rows.select(
            "sample",
            *_place(lines),
            F.col("f")[0].alias("read"),
            F.col("f")[1].cast("int").alias("flag"),
            F.col("f")[2].alias("accession"),
            F.col("f")[3].cast("long").alias("start_position"),
            F.col("f")[4].cast("int").alias("mapq"),
            F.col("f")[5].alias("cigar"),
            "kraken_genus_taxid",
        )
    )


def read_alignments(
    spark: SparkSession, path: str, glob: str | None = "*.sam*", path_pattern: str = SAM_PATH
) -> DataFrame:
    """Alignments of all samples and genera in one scan.

    ``path_pattern`` finds the sample and the genus taxid in a file's path.
    """
    lines = read_lines(spark, path, glob)
    named = lines.withColumn("sample", path_part(path_pattern)).withColumn(
        "kraken_genus_taxid", path_part(path_pattern, 2)
    )
    return parse_alignments(named)


def read_contig_genomes(spark: SparkSession, path: str) -> DataFrame:
    """Contig to genome table, with a header line; NA and an empty genome are NULL."""
    rows = spark.read.schema("accession string, genome string").csv(
        path, sep="\t", header=True, quote="", nullValue="NA"
    )
    return rows.withColumn("genome", F.nullif("genome", F.lit("")))


def read_contig_lengths(spark: SparkSession, path: str) -> DataFrame:
    """Contig length table, without header.

    A third column is the contig's number; a table without one is numbered by file and line.
    """
    f = F.split("line", "\t", -1)
    rows = read_lines(spark, path)
    # one row per file: the parts of a table are few
    files = rows.select("path").distinct()
    numbered = files.withColumn("_file", F.row_number().over(Window.orderBy("path")) - 1)
    place = F.shiftleft(F.col("_file").cast("long"), FILE_BITS) + F.col("line_no")
    return rows.join(numbered, "path").select(
        f[0].alias("accession"),
        f[1].cast("long").alias("contig_length"),
        F.coalesce(F.get(f, F.lit(2)).cast("long"), place).alias("contig_no"),
    )


def read_taxon_list(spark: SparkSession, path: str, path_pattern: str | None = None) -> DataFrame:
    """One taxid per line."""
    lines = read_lines(spark, path, path_pattern=path_pattern).where(F.trim("line") != "")
    return lines.select("sample", F.trim("line").cast("int").alias("taxid"))


def list_samples(spark: SparkSession, path: str, path_pattern: str | None = None) -> DataFrame:
    """Distinct sample names of the files at a path; file contents are not read.

    The name is that of the file, or what ``path_pattern`` finds in its path.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    )
    name = path_part(path_pattern) if path_pattern else sample_of(F.col("path"))
    return files.select(name.alias("sample")).distinct()
