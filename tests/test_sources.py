import gzip
import random
import sqlite3

import pytest

from readsift.operators import dims
from readsift.sources import sequences, sqlite, text
from tests.conftest import plain


def write(path, data, zipped=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    raw = data.encode()
    path.write_bytes(gzip.compress(raw) if zipped else raw)
    return str(path)


FASTA = ">r1 one > two\nACGT\nAC\n>r2\nGG\n\n>r3 x:1\n"


@pytest.mark.parametrize("zipped", [False, True])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_fasta(spark, tmp_path, newline, zipped):
    name = "smp.fasta.gz" if zipped else "smp.fasta"
    path = write(tmp_path / name, FASTA.replace("\n", newline), zipped)
    rows = sequences.read_sequences(spark, path)
    assert plain(rows, "sample", "id", "description", "seq") == [
        ("smp", "r1", "r1 one > two", "ACGTAC"), ("smp", "r2", "r2", "GG"), ("smp", "r3", "r3 x:1", "")]


def fastq(n, newline="\n"):
    quals = ["@+AI", "+@II", "IIII", "@@@@"]
    return "".join(f"@r{i} d{newline}ACGT{newline}+{newline}{quals[i % 4]}{newline}" for i in range(n))


@pytest.mark.parametrize("size", [1, 7, 40, 333, 10_000])
def test_fastq_in_ranges_of_any_size(tmp_path, size):
    path = write(tmp_path / "s.fastq", fastq(97))
    reader = sequences.FastqReader({"path": path, "rangebytes": str(size)})
    got = []
    for part in reader.partitions():
        for batch in reader.read(part):
            got += batch.to_pylist()
    assert [r["description"] for r in got] == [f"r{i} d" for i in range(97)]
    assert got[0]["qual"] == "@+AI" and got[1]["qual"] == "+@II"
    assert [r["line_no"] for r in got] == sorted({r["line_no"] for r in got})


def wrapped(seed, n):
    """Records over several lines, with qualities that look like headers and separators."""
    rng = random.Random(seed)
    text, want = [], []
    for i in range(n):
        seq = "".join(rng.choices("ACGTN", k=rng.choice([1, 3, 8, 20, 61])))
        qual = "".join(rng.choices("@+AI#", k=len(seq)))
        width = rng.choice([4, 7, 100])
        cut = lambda x: [x[k : k + width] for k in range(0, len(x), width)]
        text += [f"@w{i} x", *cut(seq), rng.choice(["+", f"+w{i}"]), *cut(qual)]
        want.append((f"w{i} x", seq, qual))
    return text, want


@pytest.mark.parametrize("seed,size,chunk,newline", [
    (1, 10_000, 1 << 20, "\n"), (2, 50, 1 << 20, "\n"), (3, 7, 64, "\r\n"), (4, 333, 20, "\n"), (5, 90, 33, "\r\n")])
def test_wrapped_fastq_in_ranges_of_any_size(tmp_path, monkeypatch, seed, size, chunk, newline):
    monkeypatch.setattr(sequences, "CHUNK_BYTES", chunk)
    text, want = wrapped(seed, 80)
    path = write(tmp_path / "w.fastq", newline.join(text) + newline * (seed % 2))
    reader = sequences.FastqReader({"path": path, "rangebytes": str(size)})
    got = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]
    assert [(r["description"], r["seq"], r["qual"]) for r in got] == want
    raw = open(path, "rb").read()
    assert all(raw[r["line_no"] :].startswith(b"@" + r["description"].encode()) for r in got)


@pytest.mark.parametrize("text,error", [
    ("@a\nACGT\n+\nIIIII\n", "differ in length"), ("@a\nAC\nGT\n+\nII\n", "cut short"),
    ("@a\nAC\n+\nII\nb\nAC\n+\nII\n", "starts with @"), ("a\nAC\n+\nII\n", "not a FASTQ")])
def test_broken_fastq(tmp_path, text, error):
    reader = sequences.FastqReader({"path": write(tmp_path / "b.fastq", text)})
    with pytest.raises(ValueError, match=error):
        [b for part in reader.partitions() for b in reader.read(part)]


@pytest.mark.parametrize("zipped,newline", [(False, "\n"), (False, "\r\n"), (True, "\n")])
def test_fastq_by_spark(spark, tmp_path, zipped, newline):
    name = "smp.fastq.gz" if zipped else "smp.fastq"
    path = write(tmp_path / name, fastq(50, newline), zipped)
    rows = sequences.read_sequences(spark, path, mate=2)
    assert plain(rows, "sample", "mate", "id", "seq", "qual")[0] == ("smp", 2, "r0", "ACGT", "@+AI")
    assert rows.count() == 50


def test_fastq_without_final_line_break_and_cut_record(tmp_path):
    path = write(tmp_path / "a.fastq", fastq(3)[:-1])
    reader = sequences.FastqReader({"path": path})
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 3
    path = write(tmp_path / "b.fastq", fastq(3) + "@r9\nAC\n")
    reader = sequences.FastqReader({"path": path})
    with pytest.raises(ValueError, match="cut short"):
        [b for p in reader.partitions() for b in reader.read(p)]


@pytest.mark.parametrize("data,message", [("", "blank"), ("ACGT\n", "neither")])
def test_sequence_file_errors(spark, tmp_path, data, message):
    with pytest.raises(ValueError, match=message):
        sequences.read_sequences(spark, write(tmp_path / "x.fa", data))


def test_mixed_formats_fail(spark, tmp_path):
    write(tmp_path / "in" / "a.fa", FASTA)
    write(tmp_path / "in" / "b.fq", fastq(1))
    with pytest.raises(ValueError, match="mixed"):
        sequences.read_sequences(spark, str(tmp_path / "in"))


def test_genomes_and_their_dimensions(spark, tmp_path):
    write(tmp_path / "db" / "x" / "g1.1_ASM7v1_genomic.fna", ">c1 Genus1 x:1\nACGT\nA\n>c2\nAC\n")
    write(tmp_path / "db" / "g2_genomic.fna.gz", ">c3 a>b\nACG\n>c1 again\nA\n", zipped=True)
    write(tmp_path / "db" / "UniVec_core.fna", ">v1\nA\n")
    write(tmp_path / "db" / "notes.txt", "no contig\n")
    contigs = sequences.read_genomes(spark, str(tmp_path / "db"))
    lengths = dims.contig_lengths(contigs)
    assert plain(lengths, "accession", "contig_length") == [("c1", 1), ("c2", 2), ("c3", 3), ("v1", 1)]
    headers = dims.contig_headers(contigs)
    assert ("c3 a>b", "c3 a\tb") in plain(headers, "header", "fields")
    assert plain(dims.contig_genome(headers)) == [
        ("c1", "g1.1"), ("c1", "g2"), ("c2", "g1.1"), ("c3", "g2"), ("v1", "UniVec_core.fna.gz")]


def test_assignments(spark, tmp_path):
    path = write(tmp_path / "smp.out", "C\tr1\tGenus7 sp (taxid 1017)\t32\t1017:5\nC\tr2\t55\t32|30\t0:1\nC\tr3\tA\t3\t0:1\n"
                 "C\tr4\t7\t3\nU\tr5\tunclassified (taxid 0)\t3\t\n")
    assert plain(text.read_assignments(spark, path), "sample", "read_id", "taxid", "length") == [
        ("smp", "r1", 1017, "32"), ("smp", "r2", 55, "32|30"), ("smp", "r3", 81077, "3"), ("smp", "r5", 0, "3")]
    bad = write(tmp_path / "bad.out", "C\tr1\tB\t32\t1017:5\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        text.read_assignments(spark, bad).collect()


def test_report_tree_of_six_and_eight_fields(spark, tmp_path):
    lines = "# comment\thead\n 50.00\t100\t20\t1000\t700\tG\t107\t    Genus7\n  1.00\t5\t5\tS\t1017\t     odd name \n"
    rows = text.read_report_tree(spark, write(tmp_path / "s.report", lines))
    assert plain(rows, "sample", "taxid", "level_num", "tax_rank") == [("s", 1017, 2, "S"), ("s", 107, 2, "G")]


def test_report_table_cuts_comments_and_trims(spark, tmp_path):
    lines = "#all\n 50.00\t100\t20\t1000\t700\tG\t107\t    Genus7 # note\n\n"
    rows = text.read_report(spark, write(tmp_path / "s.report", lines))
    assert plain(rows.drop("line_no")) == [("s", 50.0, 100, 20, 1000, 700, "G", 107, "Genus7", 2)]


def test_alignments_of_all_samples_in_one_scan(spark, tmp_path):
    sam = "r{}\t{}\tc57\t1203\t44\t32M\t*\t0\t0\tACGT\tIIII\tAS:i:64\tXS:i:3\n"
    write(tmp_path / "sam" / "s1" / "107.sam", "@HD\tVN:1\n" + sam.format(1, 0) + sam.format(2, 4) + sam.format(3, 256))
    write(tmp_path / "sam" / "s2" / "9605.sam", sam.format(1, 16))
    write(tmp_path / "sam" / "s2" / "10.sam", "")
    rows = text.read_alignments(spark, str(tmp_path / "sam"))
    assert plain(rows, "sample", "kraken_genus_taxid", "read", "flag", "mapq", "cigar") == [
        ("s1", "107", "r1", 0, 44, "32M"), ("s1", "107", "r3", 256, 44, "32M"), ("s2", "9605", "r1", 16, 44, "32M")]


def test_line_numbers_rise_across_splits(spark, tmp_path):
    path = write(tmp_path / "l.txt", "".join(f"{i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = text.read_lines(spark, path).select("line", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [int(r.line) for r in sorted(rows, key=lambda r: r.line_no)] == list(range(5000))
    assert len({r.line_no for r in rows}) == 5000


def test_lists_and_dimensions(spark, tmp_path):
    assert plain(text.read_taxon_list(spark, write(tmp_path / "t.txt", "10\n 11\n\n")), "taxid") == [(10,), (11,)]
    write(tmp_path / "reads" / "a.b.fastq", fastq(1))
    write(tmp_path / "reads" / "c.fastq.gz", fastq(1), zipped=True)
    assert plain(text.list_samples(spark, str(tmp_path / "reads"))) == [("a.b",), ("c",)]
    a2l = write(tmp_path / "l.tsv", 'c"1\t5\nc2\t7\n')
    assert plain(text.read_contig_lengths(spark, a2l), "accession", "contig_length") == [('c"1', 5), ("c2", 7)]
    a2g = write(tmp_path / "g.tsv", 'accession\tgenome\nc"1\tg"\n')
    assert plain(text.read_contig_genomes(spark, a2g)) == [('c"1', 'g"')]


def test_sqlite_in_row_ranges(spark, tmp_path):
    db = str(tmp_path / "t.db")
    con = sqlite3.connect(db)
    con.execute("create table nodes (id INTEGER PRIMARY KEY, name VARCHAR(50), w REAL)")
    con.executemany("insert into nodes values (?, ?, ?)", [(i * 3, f"n{i}", i / 2) for i in range(1000)])
    con.execute("create table empty_one (id int, name text)")
    con.commit()
    con.close()
    rows = sqlite.read_taxonomy(spark, db, "nodes", range_rows=100)
    assert rows.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, rows.collect())) == [(i * 3, f"n{i}", i / 2) for i in range(1000)]
    assert sqlite.read_taxonomy(spark, db, "empty_one").count() == 0
    with pytest.raises(Exception, match="no table"):
        sqlite.read_taxonomy(spark, db, "missing").count()
