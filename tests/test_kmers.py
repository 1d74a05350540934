import random

import pytest
from pyspark.sql import functions as F

from readsift.functions import kmers as km
from readsift.operators import kmer
from readsift.operators.taxonomy import taxon_closure
from tests.conftest import plain

REPORT = "sample string, line_no long, level_num int, tax_rank string, taxid int"
TREE = {1: None, 2: 1, 10: 2, 100: 10, 101: 10, 11: 2, 110: 11}
COMPLEMENT = str.maketrans("ACGT", "TGCA")


def canonical(seq, k):
    seq = seq.upper()
    words = [seq[i : i + k] for i in range(len(seq) - k + 1)]
    return [min(w, w.translate(COMPLEMENT)[::-1]) if set(w) <= set("ACGT") else None for w in words]


def path(t):
    out = []
    while t:
        out.append(t)
        t = TREE[t]
    return out[::-1]


def lca(taxa):
    common = [level[0] for level in zip(*map(path, taxa)) if len(set(level)) == 1]
    return common[-1]


@pytest.fixture
def closure(table):
    rows = [(1, 0), (2, 1), (10, 2), (100, 3), (101, 3), (11, 2), (110, 3)]
    return taxon_closure(table(REPORT, *[("db", i, lvl, "G", t) for i, (t, lvl) in enumerate(rows)]))


@pytest.mark.parametrize("k", [1, 2, 3, 5, 13, 16, 30, 31])
def test_kmers_against_brute_force(table, monkeypatch, k):
    rng = random.Random(k)
    seqs = ["".join(rng.choices("ACGTNacgt", [9, 9, 9, 9, 0.3, 1, 1, 1, 1], k=n)) for n in (0, 1, k, k + 1, 80, 200)]
    seqs += ["N" * 40, "A" * 60]
    df = table("id string, seq string", *[(f"r{i}", s) for i, s in enumerate(seqs)], ("none", None))
    got = km.kmers(df, k, ["id"], keep_empty=True)
    want = [(f"r{i}", w) for i, s in enumerate(seqs) for w in canonical(s, k) if w]
    assert plain(got.where("kmer >= 0").select("id", km.kmer_text(F.col("kmer"), k))) == sorted(want, key=repr)
    empty = {f"r{i}" for i, s in enumerate(seqs) if not any(canonical(s, k))} | {"none"}
    assert {r[0] for r in plain(got.where("kmer < 0"), "id")} == empty


def test_slices_overlap(monkeypatch):
    import numpy as np

    data = np.frombuffer(b"ACGTTGCAACGGTTAACC" * 5, np.uint8)
    ends = np.array([30, 30, 90])
    whole = [np.concatenate(x) for x in zip(*km._kmer_rows(data, ends, 7))]
    monkeypatch.setattr(km, "SLICE_BASES", 11)
    sliced = [np.concatenate(x) for x in zip(*km._kmer_rows(data, ends, 7))]
    assert all((a == b).all() for a, b in zip(whole, sliced)) and len(whole[0]) == 24 + 54


def test_k_out_of_range(table):
    with pytest.raises(ValueError):
        km.kmers(table("seq string", ("A",)), 32, [])


def call(hits, valid, confidence):
    if not hits:
        return 0
    score = {t: sum(hits.get(a, 0) for a in path(t)) for t in hits}
    best = lca([t for t in hits if score[t] == max(score.values())])
    for a in reversed(path(best)):
        if sum(n for t, n in hits.items() if a in path(t)) / valid >= confidence:
            return a
    return 0


@pytest.mark.parametrize("confidence", [0.0, 0.2, 0.5, 0.9])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_index_and_calls_against_brute_force(spark, table, closure, confidence, broadcast):
    k, rng = 4, random.Random(7)
    genomes = {"c1": 100, "c2": 101, "c3": 110, "c4": 100, "c5": 11}
    contigs = {c: "".join(rng.choices("ACGT", k=40)) for c in genomes}
    taxonomy = table("accession string, genome string, id int, name string",
                     *[(c, c, t, "") for c, t in genomes.items()], ("c6", "c6", None, None))
    seqs = table("accession string, seq string", *contigs.items(), ("c6", "ACGTACGT"))
    holders = {}
    for c, s in contigs.items():
        for w in canonical(s, k):
            holders.setdefault(w, set()).add(genomes[c])
    index = kmer.kmer_index(seqs, taxonomy, closure, k)
    want = {w: lca(t) for w, t in holders.items()}
    assert dict(plain(index.select(km.kmer_text(F.col("kmer"), k), "taxid"))) == want

    reads = {f"r{i}": "".join(rng.choices("ACGTN", [9, 9, 9, 9, 1], k=rng.randrange(1, 25))) for i in range(60)}
    df = table("sample string, id string, seq string", *[("s", i, s) for i, s in reads.items()])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        calls = kmer.classify_reads(df, index, closure, k, confidence)
        got = {r[0]: r[1:] for r in plain(calls, "id", "taxid", "n_kmers")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    for i, s in reads.items():
        words = [w for w in canonical(s, k) if w]
        hits = {}
        for w in words:
            if w in want:
                hits[want[w]] = hits.get(want[w], 0) + 1
        assert got[i] == (call(hits, len(words), confidence), len(words)), (i, hits)


def test_clade_report(table, closure):
    calls = table("sample string, taxid int", ("s", 100), ("s", 100), ("s", 10), ("s", 0), ("t", 110))
    one = closure.withColumn("sample", F.lit("s")).unionByName(closure.withColumn("sample", F.lit("t")))
    got = plain(kmer.clade_report(calls, one), "sample", "taxid", "clade_reads", "taxon_reads", "percentage")
    assert got == [("s", 1, 3, 0, 75.0), ("s", 10, 3, 1, 75.0), ("s", 100, 2, 2, 50.0), ("s", 2, 3, 0, 75.0),
                   ("t", 1, 1, 0, 100.0), ("t", 11, 1, 0, 100.0), ("t", 110, 1, 1, 100.0), ("t", 2, 1, 0, 100.0)]
