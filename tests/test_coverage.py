import random

import pytest
from pyspark.sql import functions as F

from readsift.operators import coverage as cov
from tests.conftest import plain

PAIRS = "sample string, genome string, kraken_genus_taxid string"
RUNGS = [(9, 1), (10, 2), (19, 2), (20, 3), (39, 3), (40, 4), (79, 4), (80, 6), (119, 6), (120, 8),
         (159, 8), (160, 10), (199, 10), (200, 12), (239, 12), (240, 14), (279, 14), (280, 15), (319, 15)]


def verdicts(table, *rows):
    df = table("n_windows long, s long, m long", *rows)
    out = df.select("n_windows", "s", "m", cov.evenness(F.col("n_windows"), F.col("s"), F.col("m")))
    return {tuple(r)[:3]: r[3] for r in out.collect()}


def test_each_rung_at_and_above_its_limit(table):
    rows = [(66, s, m) for s, limit in RUNGS for m in (limit, limit + 1)]
    got = verdicts(table, *rows)
    assert got == {(66, s, limit + d): ("TP", "FP")[d] for s, limit in RUNGS for d in (0, 1)}


def test_share_beyond_the_ladder_and_for_small_genomes(table):
    got = verdicts(
        table, (66, 320, 25), (66, 320, 26), (65, 100, 8), (65, 100, 7), (66, 400, 32),
        (65, 5, 1), (66, 5, 1), (65, 0, 0), (66, 0, 0),
    )
    assert got == {
        (66, 320, 25): "TP", (66, 320, 26): "FP", (65, 100, 8): "FP", (65, 100, 7): "TP",
        (66, 400, 32): "FP", (65, 5, 1): "FP", (66, 5, 1): "TP", (65, 0, 0): None, (66, 0, 0): "TP",
    }


def test_bins_start_at_one_and_rows_without_place_are_left_out(table):
    placed = table(PAIRS + ", start_genome long", ("s", "g", "1", 2), ("s", "g", "1", 7999),
                   ("s", "g", "1", 8000), ("s", "g", "1", None))
    assert plain(cov.window_counts(placed), "window", "reads") == [(1, 2), (2, 1)]


def test_profile_fills_empty_windows_and_keeps_null_genomes(table):
    counts = table(PAIRS + ", window long, reads long", ("s", None, "1", 2, 5))
    sizes = table(PAIRS + ", size long, n_windows long", ("s", None, "1", 20000, 3))
    assert plain(cov.coverage_profile(counts, sizes), "window", "reads") == [(1, 0), (2, 5), (3, 0)]
    totals = cov.coverage_totals(counts, sizes)
    assert plain(totals, "n_windows", "reads_tot", "reads_max") == [(3, 5, 5)]


def test_totals_of_a_pair_without_reads(table):
    counts = table(PAIRS + ", window long, reads long").limit(0)
    sizes = table(PAIRS + ", size long, n_windows long", ("s", "g", "1", 20000, 3))
    judged = cov.coverage_verdict(counts, sizes)
    assert plain(judged, "reads_tot", "reads_max", "indicator") == [(0, 0, None)]


def test_best_genome_keeps_ties(table):
    totals = table(PAIRS + ", reads_tot long", ("s", "a", "1", 5), ("s", "b", "1", 5), ("s", "c", "1", 4),
                   ("t", "c", "1", 1))
    assert plain(cov.best_genome(totals), "sample", "genome") == [("s", "a"), ("s", "b"), ("t", "c")]


def test_judged_profile_by_pair_and_by_genome(table):
    counts = table(PAIRS + ", window long, reads long", ("s", "g", "1", 1, 5), ("s", "g", "2", 1, 3))
    sizes = table(PAIRS + ", size long, n_windows long", ("s", "g", "1", 9, 1), ("s", "g", "2", 9, 1))
    verdict = table(PAIRS, ("s", "g", "1"))
    nodes = table("id int, name string", (1, "One"))
    by_pair = cov.judged_profile(counts, sizes, verdict, nodes)
    by_genome = cov.judged_profile(counts, sizes, verdict, nodes, by="genome")
    assert plain(by_pair, "kraken_genus_taxid", "name") == [("1", "One")]
    assert plain(by_genome, "kraken_genus_taxid", "name") == [("1", "One"), ("2", None)]


@pytest.mark.parametrize("seed", range(3))
def test_window_sums_and_verdict_against_brute_force(table, seed):
    rng = random.Random(seed)
    points = [(rng.choice("ab"), rng.randrange(1, 9000)) for _ in range(400)]
    df = table("entity string, position long", *points)
    sizes = cov.extent_sizes(df, ["entity"], "position", 100)
    counts = cov.window_counts(df, ["entity"], "position", 100)
    got = plain(cov.coverage_verdict(counts, sizes, ["entity"], group=None))
    want = []
    for e in "ab":
        own = [p for x, p in points if x == e]
        bins = [p // 100 + 1 for p in own]
        high = max(bins.count(b) for b in set(bins))
        limit = next((m for s, m in cov.LADDER if len(own) < s), None)
        even = high / len(own) < 0.08 if max(bins) <= 65 or limit is None else high <= limit
        want.append((e, max(bins), len(own), high, "TP" if even else "FP"))
    assert got == want
    assert sum(r[-1] for r in counts.collect()) == len(points)
