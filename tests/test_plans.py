import glob

import __spark_entry__ as entry
from readsift.operators import dims
from readsift.plans.evaluation import Evaluation, Inputs
from readsift.plans.extraction import Extraction
from readsift.sources import sequences, text
from tests.conftest import plain
from tests.test_oracle import SF_DIR

SAM = "{}\t{}\t{}\t{}\t44\t4M\t*\t0\t0\tACGT\tIIII\tAS:i:8\n"
REPORT = ("100.00\t60\t0\t9\t9\tR\t1\troot\n 50.00\t30\t5\t100\t90\tG\t10\t  Alpha\n 40.00\t25\t25\t50\t40\tS\t100\t    Alpha one\n"
          " 50.00\t30\t30\t100\t50\tG\t20\t  Beta\n  1.00\t3\t3\t9\t9\tG\t30\t  Gamma\n")


def files(root):
    """A run of two samples: reads of Alpha lie evenly, those of Beta on one spot."""
    db = root / "db"
    db.mkdir()
    (db / "gA_genomic.fna").write_text("".join(f">a{i} Alpha\n{'ACGT' * 5000}\n" for i in range(40)))
    (db / "gB_genomic.fna").write_text(">b1 Beta x\n" + "ACGT" * 150_000 + "\n")
    for sample in ("s1", "s2"):
        folder = root / "sam" / sample
        folder.mkdir(parents=True)
        even = [SAM.format(f"r{i}", 0, f"a{i}", 100 + i) for i in range(30)]
        spot = [SAM.format(f"q{i}", 16, "b1", 5000 + i) for i in range(30)]
        (folder / "10.sam").write_text("".join(even))
        (folder / "20.sam").write_text("".join(spot))
        (root / f"{sample}.report").write_text(REPORT)
        (root / f"{sample}.out").write_text("".join(f"C\tr{i}\tx (taxid {(10, 100, 20)[i % 3]})\t4\t0:1\n" for i in range(60)))
        (root / f"{sample}.fastq").write_text("".join(f"@r{i}/1 d\nACGT\n+\n@III\n" for i in range(60)))


def test_run_from_files_to_written_tables(spark, table, tmp_path):
    files(tmp_path)
    contigs = sequences.read_genomes(spark, str(tmp_path / "db"))
    run = Evaluation(Inputs(
        text.read_report(spark, str(tmp_path), glob="*.report"),
        text.read_alignments(spark, str(tmp_path / "sam")),
        dims.contig_lengths(contigs),
        dims.contig_genome(dims.contig_headers(contigs)),
        table("genome string, id int", ("gA", 100), ("gB", 20)),
        table("id int, name string", (100, "Alpha one"), (10, "Alpha"), (20, "Beta x")),
    ))
    got = plain(run.refined(), "sample", "name", "genome", "reads_tot", "indicator", "tax_indicator", "tick_color")
    assert got == [(s, *r) for s in ("s1", "s2") for r in (
        ("Alpha", "gA", 30, "TP", "TP", "darkgreen"), ("Beta", "gB", 30, "FP", "TP", "red"))]
    assert plain(run.species(), "sample", "name", "n", "genera") == [
        ("s1", "Alpha one", 30, "Alpha"), ("s2", "Alpha one", 30, "Alpha")]
    profile = run.profile().where("sample = 's1'")
    assert profile.groupBy().sum("reads").collect()[0][0] == 60
    assert plain(profile.groupBy("genome").count()) == [("gA", 101), ("gB", 76)]
    run.write(str(tmp_path / "out"))
    (part,) = glob.glob(f"{tmp_path}/out/refined/sample=s1/part-*")
    head, *rows = open(part).read().splitlines()
    assert '"cladeReads"' in head and '"Indicator"' in head and len(rows) == 2


def test_extraction_from_files_to_written_reads(spark, tmp_path):
    files(tmp_path)
    run = Extraction(
        text.read_assignments(spark, str(tmp_path / "*.out")),
        sequences.read_sequences(spark, str(tmp_path / "s1.fastq")),
        text.read_report_tree(spark, str(tmp_path), glob="*.report").where("sample = 's1'"),
    )
    assert plain(run.all_genera().groupBy("target").count()) == [(10, 40), (20, 20)]
    run.write_all_genera(str(tmp_path / "out"))
    back = sequences.read_sequences(spark, str(tmp_path / "out" / "sample=s1" / "target=20"))
    assert back.count() == 20 and set(plain(back, "description")[0]) == {"r11/1 d"}


def test_plans_have_no_nested_loops_or_whole_table_tasks(spark):
    for name in ("extract_reads", "extract_summary", "clade_report", "classify_reads", "report_edges", "place_reads"):
        plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
        assert "SinglePartition" not in plan, name
