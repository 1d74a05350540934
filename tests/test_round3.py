"""Steps whose memory or disk grew with the tables, and a limit that had been lowered."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import oracle, queries
from readsift.functions.kmers import kmer_spans, kmer_text
from readsift.operators import kmer
from readsift.operators.taxonomy import taxon_closure
from readsift.session import stage
from readsift.sinks import writers
from readsift.sources.chunks import read_genome_chunks
from tests.conftest import plain
from tests.test_kmers import REPORT, canonical

TREE = [(1, 0), (2, 1), (10, 2), (100, 3), (101, 3), (11, 2), (110, 3)]


def test_compressed_genomes_in_small_files(spark, table, tmp_path):
    rows = [(f"c{i} x", "ACGT" * (50 * i)) for i in range(12)]
    df = table("description string, seq string", *rows).coalesce(1)
    path = str(tmp_path / "genomes")
    writers.write_reads(df, path, compression="gzip", records_per_file=5)
    assert len(list(Path(path).glob("*.gz"))) == 3
    found = read_genome_chunks(spark, path, glob="*", letters=64)
    got = {r["id"]: r["n"] for r in found.groupBy("id").agg(F.sum("letters").alias("n")).collect()}
    assert got == {name.split()[0]: len(seq) for name, seq in rows}


def test_staged_tables_are_compressed_well(spark):
    staged = stage(spark.range(10).select(F.lit("ACGT").alias("seq")), "t")
    assert all(".zstd." in f for f in staged.inputFiles())


@pytest.mark.parametrize("parts", [1, 7])
def test_index_in_parts_against_brute_force(spark, table, parts):
    rng = random.Random(parts)
    closure = taxon_closure(
        table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(TREE)])
    ).drop("sample")
    above = {100: [1, 2, 10, 100], 101: [1, 2, 10, 101], 110: [1, 2, 11, 110]}
    contigs = [(f"c{i}", "".join(rng.choices("ACGTN", [5, 2, 2, 1, 0.2], k=30))) for i in range(20)]
    contigs += [(None, "ACGTACGT"), ("c0", None), ("none", "GGGGGGGG")]
    of = {f"c{i}": rng.choice(list(above)) for i in range(20)}
    taxonomy = table("accession string, id int", *of.items(), ("none", None), ("unused", 100))
    index = kmer.kmer_index(table("accession string, seq string", *contigs), taxonomy, closure, 5, parts)
    holders = {}
    for name, seq in contigs:
        for w in canonical(seq or "", 5) if name in of else ():
            if w:
                holders.setdefault(w, set()).add(of[name])
    want = sorted(
        (w, max((a for a in above[min(t)] if all(a in above[x] for x in t)), key=above[min(t)].index))
        for w, t in holders.items()
    )
    assert plain(index.select(kmer_text(F.col("kmer"), 5), "taxid")) == want


def test_spans_leave_out_rows_without_a_number(table):
    df = table("no int, seq string", (3, "AAAA"), (None, "AAAA"), (1, "AAAA"), (9, "CCCC"), (2, None))
    got = plain(kmer_spans(df.coalesce(1), 4, "no").select(kmer_text(F.col("kmer"), 4), "lo", "hi"))
    assert got == [("AAAA", 1, 3), ("CCCC", 9, 9)]


def test_parts_grow_with_the_contigs(spark, table, monkeypatch):
    monkeypatch.setattr(kmer, "PART_ROWS", 100)
    rng = random.Random(1)
    few, many = (
        kmer.index_parts(
            table("seq string", *[("".join(rng.choices("ACGT", k=80)),) for _ in range(n)]), 31
        )
        for n in (10, 100)
    )
    assert (few, many) == (5, 50)
    assert kmer.index_parts(spark.createDataFrame([], "seq string"), 31) == 1


def test_letters_are_never_sent_to_all_tasks(spark, table):
    closure = taxon_closure(
        table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(TREE)])
    ).drop("sample")
    contigs = table("accession string, seq string", ("c", "ACGTACGT")).hint("broadcast")
    taxonomy = table("accession string, id int", ("c", 100))
    index = kmer.kmer_index(contigs, taxonomy, closure, 5, 1)
    index.collect()
    plan = index._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "LeftOuter" in x and "accession" in x]
    assert joins and not any("BuildLeft" in x for x in joins)


def test_files_hold_a_bounded_number_of_lines(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_LINES", 10)
    lines = spark.range(1000).withColumnRenamed("id", "line_no")
    s = queries.Standins(spark, "")
    assert s.in_files(lines).rdd.getNumPartitions() == 100
    assert s.in_files(lines.limit(20)).rdd.getNumPartitions() == 5


def test_limit_of_extract_max():
    assert queries.MAX_READS == 1000
    assert "<= 1000)" in oracle.oracle_sql()["extract_max"]
