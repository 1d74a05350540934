import random

import pytest
from pyspark.sql import functions as F

from readsift.operators import alignments as al
from readsift.operators import dims, joins
from readsift.operators.prefix import running_sum
from tests.conftest import plain

LENGTHS = "accession string, contig_length long, contig_no long"
TAXONOMY = "accession string, genome string, id int, name string"
ALIGN = "sample string, read string, flag int, accession string, start_position long, kraken_genus_taxid string, line_no long"


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_running_sum_against_brute_force(table, block):
    rng = random.Random(block)
    rows = [(rng.choice(["g", "h", None]), n, rng.randrange(100)) for n in rng.sample(range(500), 200)]
    df = running_sum(table("g string, n long, v long", *rows), ["g"], ["n"], F.col("v"), "s", block=block)
    want = [(g, n, v, sum(w for h, m, w in rows if h == g and m <= n)) for g, n, v in rows]
    assert plain(df, "g", "n", "v", "s") == sorted(want, key=repr)


def test_offsets_start_at_one_with_contigs_one_apart(table):
    lengths = table(LENGTHS, ("b", 20, 2), ("a", 10, 1), ("x", 5, 1), ("y", 7, 2))
    taxonomy = table(TAXONOMY, ("a", "g", 1, "A"), ("b", "g", 1, "A"))
    got = plain(dims.contig_offsets(lengths, taxonomy, block=1), "accession", "genome", "start_pos", "end_pos")
    assert got == [("a", "g", 1, 11), ("b", "g", 12, 32), ("x", None, 1, 6), ("y", None, 7, 14)]


def test_contigs_of_several_files_follow_path_then_position(table):
    lengths = table("accession string, contig_length long, contig_no long, path string",
                    ("a", 10, 1, "p2"), ("b", 20, 1, "p1"), ("c", 30, 2, "p1"))
    taxonomy = table(TAXONOMY, ("a", "g", 1, ""), ("b", "g", 1, ""), ("c", "g", 1, ""))
    got = plain(dims.contig_offsets(lengths, taxonomy, order=["path", "contig_no"], block=1), "accession", "start_pos")
    assert got == [("a", 53), ("b", 1), ("c", 22)]


def test_unknown_genomes_and_taxa_stay(table):
    got = plain(dims.contig_taxonomy(
        table("accession string, genome string", ("a", "g"), ("b", "h"), ("c", None)),
        table("genome string, id int", ("g", 1), ("h", 2)), table("id int, name string", (1, "A"))))
    assert got == [("a", "g", 1, "A"), ("b", "h", 2, None), ("c", None, None, None)]


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_null_genomes_match_in_pair_joins(spark, table, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    contigs = table("accession string, genome string", ("a", "g"), ("b", None), ("c", "h"))
    pairs = table("sample string, genome string, kraken_genus_taxid string", ("s", None, "1"), ("s", "g", "2"), ("t", "g", "2"))
    try:
        assert plain(dims.genomes_hit(contigs, pairs)) == [("a", "g"), ("b", None)]
        assert plain(dims.pair_contigs(contigs, pairs), "accession", "genome", "sample", "kraken_genus_taxid") == [
            ("a", "g", "s", "2"), ("a", "g", "t", "2"), ("b", None, "s", "1"), ("c", "h", None, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_shuffled_join_equals_broadcast_join(spark, table, how):
    rows = table("k string, n int", *[("hot", i) for i in range(50)], ("b", 1), ("c", 2), (None, 3))
    dim = table("k string, v int", ("hot", 1), ("hot", 2), ("b", 3), (None, 4))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = joins.dimension_join(rows, dim, ["k"], how, null_safe=["k"])
        assert shuffled.columns == (["k", "n", "v"] if how in ("left", "inner") else ["k", "n"])
        got = plain(shuffled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert got == plain(joins.dimension_join(rows, dim, ["k"], how, null_safe=["k"]))


def place(table, rows, lengths, taxonomy):
    alignments = al.mapped_only(table(ALIGN, *rows))
    hits = al.alignment_hits(alignments, taxonomy)
    pairs = al.primary_pairs(hits)
    places = al.placements(hits, dims.contig_offsets(lengths, taxonomy), pairs)
    return al.place_reads(al.first_alignment(alignments), places)


def test_first_row_and_its_place(table):
    lengths = table(LENGTHS, ("a", 10, 1), ("b", 20, 2), ("n", 9, 3))
    taxonomy = table(TAXONOMY, ("a", "g", 1, "A"), ("b", "g", 1, "A"))
    rows = [
        ("s", "r1", 256, "b", 5, "10", 1), ("s", "r1", 0, "a", 3, "10", 2),   # secondary first
        ("s", "r2", 0, "a", 4, "9", 9), ("s", "r2", 0, "b", 4, "10", 3),      # genus order is by text
        ("s", "r3", 256, "a", 1, "77", 4),                                     # no primary row in its genus
        ("s", "r4", 0, "n", 2, "10", 5),                                       # contig without genome
        ("s", "r5", 0, "zz", 2, "10", 6), ("s", "r6", 4, "a", 2, "10", 7),     # unknown contig; unmapped
        ("t", "r1", 16, "a", 1, "10", 1),
    ]
    placed = place(table, rows, lengths, taxonomy)
    assert plain(placed, "sample", "read", "accession", "start_genome") == [
        ("s", "r1", "b", 17), ("s", "r2", "b", 16), ("s", "r3", "a", None), ("s", "r4", "n", 3),
        ("s", "r5", "zz", None), ("t", "r1", "a", 2)]
    assert plain(al.placement_summary(placed)) == [("s", 3, 2), ("t", 1, 0)]


def test_order_without_line_numbers(table):
    df = table("sample string, read string, flag int, mapq int, accession string, start_position long, kraken_genus_taxid string",
               ("s", "r", 256, 50, "a", 1, "1"), ("s", "r", 0, 10, "b", 1, "1"), ("s", "r", 16, 20, "c", 1, "1"),
               ("s", "q", 0, 5, "b", 2, "1"), ("s", "q", 0, 5, "a", 3, "1"))
    assert plain(al.first_alignment(df), "read", "accession") == [("q", "a"), ("r", "c")]


def test_contig_in_two_genomes_gets_one_place(table):
    lengths = table(LENGTHS, ("a", 10, 1))
    taxonomy = table(TAXONOMY, ("a", "h", 2, "B"), ("a", "g", 1, "A"))
    assert plain(place(table, [("s", "r", 0, "a", 3, "10", 1)], lengths, taxonomy), "genome", "start_genome") == [("g", 4)]
