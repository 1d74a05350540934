"""Steps whose time or disk grew too fast with the tables."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa

from readsift.functions import kmers as km
from readsift.operators import kmer
from readsift.operators.taxonomy import taxon_closure
from readsift.plans.classification import Classifier
from readsift.session import stage
from readsift.sources import chunks
from tests.conftest import plain
from tests.test_kmers import REPORT

TREE = [(1, 0), (2, 1), (10, 2), (100, 3), (101, 3), (11, 2), (110, 3)]


def text_batch(*rows):
    path, split, value = zip(*rows, strict=True)
    return pa.record_batch([pa.array(path), pa.array(split, pa.int64()), pa.array(value)], ["path", "split", "value"])


def test_lines_between_headers_are_cut_at_once(monkeypatch):
    taken = []
    whole = chunks._Split.lines
    monkeypatch.setattr(chunks._Split, "lines", lambda self, text: (taken.append(text), whole(self, text)))
    batch = text_batch(
        ("file:///a", 0, "AC"), ("file:///a", 0, ""), ("file:///a", 0, "GT\r"), ("file:///a", 0, ">x y\r"), ("file:///a", 0, " A\tC "),
        ("file:///a", 0, "G"), ("file:///a", 40, "TT"), ("hdfs://h/b", 40, ">z"), ("hdfs://h/b", 40, ">é"), ("hdfs://h/b", 40, "N"),
    )
    rows = [r for b in chunks._cut(2, 1)(iter([batch.slice(0, 5), batch.slice(5)])) for r in b.to_pylist()]
    assert taken == ["ACGT\r", " A\tC ", "G", "TT", "N"]
    got = [(r["path"], r["split"], r["description"], r["start"], r["seq"]) for r in rows if not r["summary"]]
    assert got == [
        ("file:/a", 0, None, 0, "AC"), ("file:/a", 0, None, 2, "CGT"), ("file:/a", 0, "x y", 0, "AC"), ("file:/a", 0, "x y", 2, "CG"),
        ("file:/a", 40, None, 0, "TT"), ("hdfs://h/b", 40, "z", 0, ""), ("hdfs://h/b", 40, "é", 0, "N"),
    ]


def test_paths_of_chunks_are_those_of_the_scan(spark, tmp_path):
    (tmp_path / "a b%é.fna").write_text(">c1\nACGT\n")
    want = spark.read.text(str(tmp_path)).select("_metadata.file_path").first()[0]
    assert {r.path for r in chunks.read_genome_chunks(spark, str(tmp_path)).collect()} == {want}


def test_kmers_of_a_long_run_are_numbered_when_distinct():
    rng = random.Random(4)
    word = "".join(rng.choices("ACGT", k=64))
    texts = [word * 100 + word[:30], "N" + word * 100, "".join(rng.choices("ACGTN", k=9000))]
    ends, numbers = np.cumsum([len(x) for x in texts]), np.array([7, 7, 3])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    (rows, values), = km._kmer_rows(data, ends, 31)
    pairs = [(v, n) for values_of, of in km._numbered(data, ends, numbers, 31) for v, n in zip(values_of, of)]
    assert len(pairs) == len(set(pairs)) and set(pairs) == set(zip(values, numbers[rows]))
    assert sum(n == 7 for _, n in pairs) == 64


def test_no_task_sorts_letters_for_the_index(spark, table):
    closure = taxon_closure(table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(TREE)])).drop("sample")
    contigs = table("accession string, seq string", ("c", "ACGTACGT"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = kmer.kmer_index(contigs, table("accession string, id int", ("c", 100)), closure, 5, 1)
        plan = index._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    joins = [x for x in plan.splitlines() if "LeftOuter" in x and "accession" in x]
    assert joins and all("ShuffledHashJoin" in x and "BuildRight" in x for x in joins)


def calls_and_counts(spark, table, rounds_of, monkeypatch):
    rng = random.Random(9)
    closure = taxon_closure(table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(TREE)])).drop("sample")
    contigs = {c: "".join(rng.choices("ACGT", k=60)) for c in ("c1", "c2", "c3")}
    taxonomy = table("accession string, id int", ("c1", 100), ("c2", 101), ("c3", 110))
    index = kmer.kmer_index(table("accession string, seq string", *contigs.items()), taxonomy, closure, 5)
    rows = [(f"s{i % 2}", f"r{i % 40}", "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=20))) for i in range(80)]
    reads = table("sample string, id string, seq string", *rows, (None, None, "ACGTACGT"), ("s0", None, contigs["c1"][:9]))
    monkeypatch.setattr(kmer, "ROUND_KMERS", rounds_of)
    matches = kmer.kmer_matches(reads, index, 5)
    kmers = matches.kmers().groupBy("sample", "taxid", "kmer").agg({"n": "sum"})
    counts = kmer.clade_kmers(matches.kmers(), closure, rounds=matches.rounds)
    return matches.rounds, plain(kmer.classify_matches(matches, closure)), plain(kmers), plain(counts)


def test_rounds_do_not_change_calls(spark, table, monkeypatch):
    one, *whole = calls_and_counts(spark, table, 1 << 28, monkeypatch)
    many, *parts = calls_and_counts(spark, table, 600, monkeypatch)
    assert one == 1 and 1 < many <= kmer.MAX_ROUNDS and parts == whole and len(whole[0]) == 42


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for d in disk.localDirs() for x in Path(d.getPath()).rglob("shuffle_*.data")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    staged = stage(spark.range(1000).repartition(7, "id"), "t")
    assert shuffle_files(spark) <= before and staged.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true"


def test_paths_of_reads_are_dealt_once(spark, table):
    closure = taxon_closure(table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(TREE)])).drop("sample")
    hits = table("id string, sample string, taxid int, hits long, n_kmers long, n_taxa long", ("a", "s", 100, 2, 5, 2), ("a", "s", 110, 2, 5, 2))
    best = kmer._best_taxon(hits, stage(closure, "closure"), 0.2)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1 and plain(best) == [("a", "s", 2, 5)]


def test_a_report_tells_kmers_apart_in_parts(spark, table, monkeypatch):
    rng = random.Random(2)
    taxa = table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(TREE)])
    contigs = {c: "".join(rng.choices("ACGT", k=60)) for c in ("c1", "c2")}
    taxonomy = table("accession string, id int", ("c1", 100), ("c2", 110))
    classifier = Classifier(table("accession string, seq string", *contigs.items()), taxonomy, taxa, 5, 2)
    rows = [("s", f"r{i}", contigs[f"c{1 + i % 2}"][i : i + 20]) for i in range(30)]
    reads = table("sample string, id string, seq string", *rows)
    whole = plain(classifier.report(reads))
    names = []
    monkeypatch.setattr(kmer, "stage", lambda df, name: (names.append(name), stage(df, name))[1])
    monkeypatch.setattr(kmer, "ROUND_KMERS", 300)
    assert plain(classifier.report(reads)) == whole and len(whole) == 6
    assert names.count("sums") == names.count("read_hits") == 2


def test_pieces_of_sliced_and_large_columns():
    lines = ["skipped", ">a", "AC", "", "GT", ">b", ">", "T", "G"]
    want = [(0, True, ">a"), (1, False, "ACGT"), (4, True, ">b"), (5, True, ">"), (6, False, "T"), (7, False, "G")]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(lines, kind).slice(1)
        assert list(chunks._pieces(column, np.array([0, 7]))) == want
    assert list(chunks._pieces(pa.array(["", ""]), np.array([0]))) == [(0, False, "")]
