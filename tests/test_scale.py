"""Plans and steps that only matter at size: filters ahead of shuffles, buckets, ranges, sketches."""

import random

import pytest
from pyspark.sql import functions as F

from readsift.functions.kmers import count_kmers, kmer_lists, listed_rows
from readsift.operators import extract as ex
from readsift.operators import kmer, sketches
from readsift.operators.idfilter import keep_candidates
from readsift.operators.order import sort_ranges, with_position
from readsift.operators.taxonomy import taxon_closure
from readsift.sinks import writers
from tests.conftest import plain
from tests.test_kmers import REPORT, canonical

READS = "sample string, mate int, id string, description string, seq string"


@pytest.fixture
def closure(table):
    rows = [(1, 0), (2, 1), (10, 2), (100, 3), (101, 3), (11, 2), (110, 3)]
    tree = taxon_closure(table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(rows)]))
    return tree.drop("sample")


@pytest.mark.parametrize("range_keys,max_ranges,left", [(1 << 25, 4, 400), (64, 10, 400), (64, 2, 5000)])
def test_filter_loses_no_wanted_row(spark, range_keys, max_ranges, left):
    rows = spark.range(5000).withColumn("x", F.concat(F.lit("id"), "id"))
    wanted = rows.where("id % 13 = 5").select(F.xxhash64("x").alias("h"))
    kept = keep_candidates(rows, F.xxhash64("x"), wanted, range_keys, max_ranges)
    got = {r.id for r in kept.collect()}
    assert got >= {i for i in range(5000) if i % 13 == 5} and len(got) <= left + 60
    assert keep_candidates(rows, F.xxhash64("x"), wanted.limit(0)).count() == 0


def test_only_candidates_are_shuffled(spark, table):
    reads = table(READS, *[("s", 1, f"r{i}/1", "", "ACGT") for i in range(300)])
    ids = table("sample string, read_id string", ("s", "r7"), ("s", "r9/2"), ("t", "r11"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ex.match_reads(reads, ids)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    above = plan.index("Exchange")
    assert plan.index("ArrowEvalPython") > above and plan.index("Filter") > above
    assert plain(found, "id") == [("r7/1",)] == plain(ex.match_reads(reads, ids, prefilter=False), "id")


def test_index_is_not_shuffled_again(spark, table, closure):
    rng = random.Random(2)
    index = spark.range(4000).select(F.col("id").alias("kmer"), F.lit(100).alias("taxid"))
    stored = kmer.store_index(index, 8)
    reads = table("sample string, id string, seq string", *[
        ("s", f"r{i}", "".join(rng.choices("ACGT", k=30))) for i in range(40)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = reads.withColumn("no", F.monotonically_increasing_id()).withColumn("of", F.lit(1))
        lists = kmer_lists(numbered, 6, "no", "of")
        joined = lists.join(stored, "kmer")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        found = joined.select(F.explode(listed_rows()), "kmer").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    scan = plan[plan.index("FileScan") - 200 : plan.index("FileScan")]
    assert "Exchange" not in scan
    assert found == sum(1 for r in reads.collect() for w in canonical(r.seq, 6)
                        if int(w.translate(str.maketrans("ACGT", "0123")), 4) < 4000)


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_lists_against_brute_force(spark, table, batch):
    rng = random.Random(4)
    rows = [(rng.choice([4, 5, -9]), i, "".join(rng.choices("ACGN", [5, 1, 1, 0.3], k=rng.randrange(14))))
            for i in range(50)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = kmer_lists(table("of long, no long, seq string", *rows).coalesce(1), 4, "no", "of")
        got = got.withColumn("all", listed_rows()).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert all((r.more is None) == (len(r.all) == 1) for r in got)
    found = [(r.of, r.kmer, no) for r in got for no in r.all]
    digits = str.maketrans("ACGT", "0123")
    want = [(s, int(w.translate(digits), 4), i) for s, i, seq in rows for w in canonical(seq, 4) if w]
    assert sorted(found, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [True, False])
def test_matches_with_hot_kmers_and_mates(spark, table, closure, monkeypatch, hot):
    monkeypatch.setattr(kmer, "HOT_SHARE", 0.01 if hot else 2.0)
    reads = table("sample string, id string, seq string",
                  *[("s", f"r{i // 2}", "AAAAAAA" + ("CG" if i % 2 else "CC")) for i in range(40)],
                  ("s", "n", "NNNN"), ("t", "e", ""), ("t", "z", None))
    index = kmer.store_index(table("kmer long, taxid int", (0, 100), (5, 110)), 4)  # AAAA, AACC
    assert bool(kmer.hot_kmers(count_kmers(reads, 4), 4)) == hot
    hits = kmer.kmer_matches(reads, index, 4).hits()
    got = {(r.id, r.taxid): (r.hits, r.n_kmers, r.n_taxa) for r in hits.collect()}
    assert got["r3", 100] == (8, 12, 2) and got["r3", 110] == (1, 12, 2) and got["r3", None] == (0, 12, 2)
    kmers = kmer.kmer_matches(reads, index, 4).kmers().groupBy("sample", "kmer").agg(F.sum("n")).collect()
    assert sorted(map(tuple, kmers)) == [("s", 0, 160), ("s", 5, 20)]
    assert got["n", None] == got["e", None] == got["z", None] == (0, 0, 0) and len(got) == 63


@pytest.mark.parametrize("ranges", ["1", "7"])
def test_positions_in_ranges(spark, table, ranges):
    rng = random.Random(int(ranges))
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), i) for i in range(500)]
    df = table("g string, n int, i int", *rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = with_position(df, ["g"], [F.col("n").desc(), F.col("i")]).collect()
        parts = [[(r.n, r.i) for r in p] for p in sort_ranges(df, ["n", "i"]).rdd.glom().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for g in ("a", "b", None):
        mine = sorted(((n, i) for h, n, i in rows if h == g), key=lambda x: (-x[0], x[1]))
        assert sorted((r.position, r.n, r.i) for r in got if r.g == g) == [
            (k + 1, n, i) for k, (n, i) in enumerate(mine)]
    assert sum(parts, []) == sorted((n, i) for _, n, i in rows)


def test_runs_united_by_sketches(spark, table, closure, tmp_path):
    path, rows = str(tmp_path / "runs"), []
    for run in range(3):
        mine = [("s", 100 + run % 2, k, 2) for k in range(run * 500, run * 500 + 1000)]
        rows += mine
        found = table("sample string, taxid int, kmer long, n long", *mine)
        sketches.add_run(sketches.kmer_sketches(found), path)
    runs = sketches.read_runs(spark, path)
    got = sketches.estimated(sketches.clade_sketches(runs, closure)).collect()
    for r in got:
        below = {1: (100, 101), 2: (100, 101), 10: (100, 101), 100: (100,), 101: (101,)}[r.taxid]
        exact = len({k for _, t, k, _ in rows if t in below})
        assert r.n_kmers == sum(2 for _, t, _, _ in rows if t in below)
        assert abs(r.n_unique_kmers - exact) <= 0.05 * exact
    assert len(got) == 5 and sketches.unite(runs, ["taxid"]).count() == 2


@pytest.mark.parametrize("observed,fmt", [(200, "fasta"), (1, "fasta"), (1, "fastq")])
def test_counts_of_the_job_that_writes(spark, table, tmp_path, monkeypatch, observed, fmt):
    monkeypatch.setattr(ex, "OBSERVED", observed)
    assign = table("sample string, line_no long, read_id string, taxid int",
                   ("s", 1, "a", 10), ("s", 2, "b", 10), ("s", 3, "c", 11), ("t u", 1, "a", 10), ("v", 1, "a", 11))
    reads = table(READS + ", qual string", *[(s, m, i, i, "ACGT" * 40, "IIII" * 40)
                  for s in ("s", "t u", "v") for m in (1, 2) for i in ("a", "b", "c")])
    path = str(tmp_path / "out")
    got = ex.extract_and_write(assign, reads, [10], path, fmt=fmt)
    assert plain(got) == [("s", 1, 3, 2, 4), ("t u", 1, 1, 1, 2), ("v", 1, 1, 0, 0)]
    assert plain(got) == plain(ex.extract_summary(assign, reads, [10]))
    assert plain(writers.count_written(spark, path, fmt)) == [("s", 4), ("t u", 2)]
