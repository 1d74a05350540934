import glob

import pytest

from readsift.sinks import writers
from readsift.sources import sequences
from tests.conftest import plain

READS = "sample string, mate int, description string, seq string, qual string"


def parts(path):
    return "".join(open(f).read() for f in sorted(glob.glob(f"{path}/**/part-*", recursive=True)))


def test_fasta_wraps_and_keeps_the_header(table, tmp_path):
    reads = table(READS, ("s", 1, "r1 more text", "A" * 130, None), ("s", 1, "r2", "C" * 60, None)).coalesce(1)
    writers.write_reads(reads, str(tmp_path / "o"))
    assert parts(tmp_path / "o") == ">r1 more text\n" + "A" * 60 + "\n" + "A" * 60 + "\n" + "A" * 10 + "\n>r2\n" + "C" * 60 + "\n"


def test_one_folder_per_sample_and_mate_and_append(spark, table, tmp_path):
    reads = table(READS, ("s", 1, "r1/1", "AC", "II"), ("s", 2, "r1/2", "GT", "@I"), ("t", 1, "q", "A", "+"))
    out = str(tmp_path / "o")
    writers.write_reads(reads, out, fmt="fastq", partition_by=["sample", "mate"])
    back = sequences.read_sequences(spark, f"{out}/sample=s/mate=2")
    assert plain(back, "id", "seq", "qual") == [("r1/2", "GT", "@I")]
    writers.write_reads(reads, out, fmt="fastq", partition_by=["sample", "mate"], mode="append")
    assert sequences.read_sequences(spark, out).count() == 6
    writers.write_reads(reads, out, fmt="fastq", partition_by=["sample", "mate"])
    assert sequences.read_sequences(spark, out).count() == 3


def test_gzipped_reads_come_back(spark, table, tmp_path):
    reads = table(READS, ("s", 1, "r1 x", "ACGT" * 40, None))
    writers.write_reads(reads, str(tmp_path / "o"), compression="gzip")
    assert plain(sequences.read_sequences(spark, str(tmp_path / "o")), "description", "seq") == [("r1 x", "ACGT" * 40)]


def test_fastq_needs_qualities(table, tmp_path):
    with pytest.raises(Exception, match="FASTQ output needs FASTQ input"):
        writers.write_reads(table(READS, ("s", 1, "r", "A", None)), str(tmp_path / "o"), fmt="fastq")


def test_table_quotes_strings_and_prints_na(table, tmp_path):
    df = table("name string, clade_reads long, percent_agreement double, indicator string",
               ('a "b"\'', 5, 0.5, None), (None, None, None, "TP")).coalesce(1)
    writers.write_table(df, str(tmp_path / "o"))
    assert parts(tmp_path / "o").splitlines() == [
        '"name"\t"cladeReads"\t"percent_agreement"\t"Indicator"', '"a \\"b\\"\'"\t5\t0.5\tNA', 'NA\tNA\tNA\t"TP"']


def test_taxon_list(table, tmp_path):
    writers.write_taxon_list(table("sample string, taxid int", ("s", 5), ("s", 7)).coalesce(1), str(tmp_path / "o"))
    assert parts(tmp_path / "o") == "5\n7\n"
