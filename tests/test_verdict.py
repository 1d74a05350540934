from readsift.operators import verdict as vd
from readsift.operators.alignments import alignment_hits
from tests.conftest import plain

HITS = "sample string, kraken_genus_taxid string, accession string, name string, mapped long, primary long"
GENERA = ("sample string, line_no long, tax_rank string, name string, clade_reads long, n_kmers long, "
          "n_unique_kmers long, kraken_genus_taxid string")
COVERAGE = "sample string, kraken_genus_taxid string, genome string, reads_tot long, indicator string"
TAXVERDICT = ("sample string, kraken_genus_taxid string, same long, different long, "
              "percent_agreement double, tax_indicator string")


def genus(taxid, name, line_no=1, reads=9, sample="s", kmers=10, unique=10):
    return (sample, line_no, "G", name, reads, kmers, unique, taxid)


def test_report_filters(table):
    report = table(
        "sample string, line_no long, tax_rank string, taxid int, level_num int, name string, clade_reads long",
        ("s", 1, "G", 10, 1, "  A ", 4), ("s", 2, "G", 11, 1, "B", 3), ("s", 3, "G", 9605, 1, "Homo", 50),
        ("s", 4, "S", 12, 2, "A a", 9), ("s", 5, "G1", 13, 2, "A1", 9), ("s", 6, "G", 14, 1, " Homo", 9),
    )
    assert plain(vd.genus_report(report), "kraken_genus_taxid", "name") == [("10", "A")]
    assert plain(vd.target_genera(report), "taxid") == [(10,), (11,), (14,)]


def test_agreement_edges(table):
    genera = table(GENERA, *[genus(str(i), "A") for i in range(1, 8)])
    hits = table(
        HITS,
        ("s", "1", "c", "A a", 4, 4), ("s", "1", "d", "B b", 1, 1),      # exactly 0.8
        ("s", "2", "c", "A", 4, 4),                                      # only same
        ("s", "3", "c", "B b", 4, 4),                                    # only different
        ("s", "4", "c", "A a", 9, 3),                                    # 3 primary rows
        ("s", "5", "c", None, 9, 9),                                     # no names
        ("s", "6", "c", "A a", 3, 3), ("s", "6", "d", None, 1, 1),       # NULL names count to 4
        ("s", "8", "c", "A a", 9, 9),                                    # genus not reported
        ("s", "7", "c", "A a", 17, 17), ("s", "7", "d", "B b", 4, 4),
    )
    got = {r[0]: r[1:] for r in plain(
        vd.taxonomy_verdict(hits, genera), "kraken_genus_taxid", "same", "different",
        "percent_agreement", "tax_indicator")}
    assert got == {
        "1": (4, 1, 0.8, "FP"), "2": (4, 0, 1.0, "TP"), "3": (0, 4, 0.0, "FP"),
        "6": (3, 0, 1.0, "TP"), "7": (17, 4, 17 / 21, "TP"),
    }


def test_refined_colours_homonyms_and_missing_verdicts(table):
    genera = table(
        GENERA, genus("1", "A", 1), genus("2", "B", 2), genus("3", "C", 3), genus("4", "D", 4),
        genus("5", "A", 5), genus("6", "E", 6),
    )
    coverage = table(
        COVERAGE, ("s", "1", "g2", 5, "TP"), ("s", "1", "g1", 5, "TP"), ("s", "2", "g", 5, "TP"),
        ("s", "3", "g", 5, "FP"), ("s", "4", "g", 5, None), ("s", "5", "g0", 5, "FP"),
    )
    taxonomy = table(TAXVERDICT, ("s", "1", 4, 0, 1.0, "TP"), ("s", "2", 0, 4, 0.0, "FP"))
    got = plain(vd.refine_report(genera, coverage, taxonomy), "kraken_genus_taxid", "genome", "tick_color",
                "tick_name")
    assert got == [
        ("1", "g1", "darkgreen", "<i style='color:darkgreen'>A</i>"),
        ("2", "g", "red", "<i style='color:red'>B</i>"),
        ("3", "g", "red", "<i style='color:red'>C</i>"),
    ]


def test_unique_share(table):
    genera = table(GENERA, genus("1", "A", unique=8), genus("2", "B", unique=7), genus("3", "C", kmers=0, unique=0))
    assert plain(vd.unique_kmer_verdict(genera), "kraken_genus_taxid", "indicator", "tick_name") == [
        ("1", "TP", "<i style='color:darkgreen'>A</i>"),
        ("2", "FP", "<i style='color:red'>B</i>"),
        ("3", None, "<i style='color:NA'>C</i>"),
    ]


def test_species_ties_at_the_last_rank(table):
    hits = [("s", "1", f"c{i}", f"A {i:02d}", 100 - min(i, 14), 0) for i in range(20)]
    hits += [("s", "2", "c", "B", 9, 9), ("s", "1", "x", "A 00", 1, 0)]
    refined = table("sample string, kraken_genus_taxid string, tick_color string",
                    ("s", "1", "darkgreen"), ("s", "2", "red"))
    nodes = table("id int, name string", (1, "A"))
    got = plain(vd.species_top(table(HITS, *hits), refined, nodes), "name", "n", "genera")
    assert len(got) == 20 and got[0] == ("A 00", 101, "A")
    assert {n for _, n, _ in got[14:]} == {86}


def test_hits_add_up_rows_before_the_join(table):
    rows = table("sample string, read string, flag int, accession string, kraken_genus_taxid string",
                 ("s", "r", 0, "c", "1"), ("s", "r", 256, "c", "1"), ("s", "q", 16, "c", "1"), ("t", "q", 16, "x", "1"))
    taxonomy = table("accession string, genome string, id int, name string", ("c", "g", 7, "A a"), ("c", "h", 8, "B"))
    got = plain(alignment_hits(rows, taxonomy), "sample", "genome", "mapped", "primary")
    assert got == [("s", "g", 3, 2), ("s", "h", 3, 2), ("t", None, 1, 1)]


def test_no_genus_rows_give_empty_tables_with_all_columns(spark, table):
    genera = table(GENERA).limit(0)
    coverage, taxonomy = table(COVERAGE).limit(0), table(TAXVERDICT).limit(0)
    refined = vd.refine_report(genera, coverage, taxonomy)
    assert refined.count() == 0 and {"tick_name", "indicator", "percent_agreement"} <= set(refined.columns)
    uniqued = vd.unique_kmer_verdict(genera)
    assert vd.compare_groupings(genera, refined, uniqued).count() == 0
    hits = table(HITS).limit(0)
    assert vd.taxonomy_verdict(hits, genera).columns[-1] == "tax_indicator"
    assert vd.species_top(hits, refined, table("id int, name string")).count() == 0
