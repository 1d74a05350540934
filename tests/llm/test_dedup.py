import random
import re

import numpy as np
import pytest

from llm import arrays, minhash_dedup
from llm.exact_dedup import drop_copies, find_copies
from llm.minhash_dedup import drop_near_copies, near_copies
from tests.llm.helpers import PLAIN, corpus, fold, frame, plain, sha


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_copies(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(normal(text), []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[normal(text)]
        known = [x for x in ids if x is not None]
        keep = min(known) if known else None
        out.append((doc, keep, len(ids), doc == keep, sha(normal(text))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_exact_against_brute_force(spark, bits):
    rows = [*corpus(5), (None, "only here"), (2000, " "), (2001, "\t \n")]
    docs = frame(spark, rows)
    want = brute_copies(rows)
    assert plain(find_copies(docs, max_bits=bits)) == want
    kept = plain(drop_copies(docs, max_bits=bits), "doc_id")
    assert kept == sorted([(r[0],) for r in want if r[3]], key=repr)
    assert drop_copies(docs).columns == docs.columns


def test_exact_ties_nulls_and_empty(spark):
    rows = [(3, "a b"), (3, "a  b"), (None, "a b"), (9, None), (8, ""), (None, "z"), (None, "z")]
    docs = frame(spark, rows)
    got = plain(find_copies(docs), "doc_id", "keep_id", "group_size", "kept")
    assert got.count((3, 3, 3, True)) == 1 and got.count((3, 3, 3, False)) == 1
    assert (None, 3, 3, False) in got and (9, 8, 2, False) in got and (8, 8, 2, True) in got
    assert got.count((None, None, 2, True)) == 1
    assert drop_copies(docs).count() == 3
    assert find_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def brute_components(rows, size, percent):
    sets = []
    for _, text in rows:
        w = PLAIN.findall(fold(text))
        n = max(1, len(w) - size + 1) if w else 0
        sets.append({tuple(w[p : p + size]) for p in range(n)})
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(
        ((doc, len(sets[i]), least[root(i)], doc == least[root(i)]) for i, (doc, _) in enumerate(rows)),
        key=repr,
    )


def variants(seed, n=60, words=80):
    """One base text with more and more edits, so that similarities lie around the limit."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(900)}" for _ in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(6)):
            text[rng.randrange(words)] = f"v{rng.randrange(40)}"
        if i % 7 == 0:
            text = text[: words - rng.randrange(12)]
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed,small", [(6, 32), (7, 2)])
def test_near_against_brute_force(spark, seed, small):
    rows = corpus(seed) + [(5000 + i, t) for i, t in variants(seed)]
    got = near_copies(frame(spark, rows), small=small).drop("th")
    assert plain(got) == brute_components(rows, 3, 85)


def test_near_filter_keeps_one_of_each_group(spark):
    rows = corpus(8) + [(5000 + i, t) for i, t in variants(8)]
    docs = frame(spark, rows)
    want = [(doc,) for doc, _, _, kept in brute_components(rows, 5, 80) if kept]
    got = drop_near_copies(docs, 5, 80)
    assert plain(got, "doc_id") == sorted(want, key=repr) and got.columns == docs.columns


@pytest.mark.parametrize("n", [60, 120])
def test_near_group_without_links_makes_few_pairs(spark, monkeypatch, n):
    rng = random.Random(10)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):  # edits from a small pool, so most shingles are frequent
        text = list(base)
        for p in rng.sample(range(0, 120, 4), 8):
            text[p] = f"v{rng.randrange(3)}"
        rows.append((i, " ".join(text)))
    made, before = [], minhash_dedup._Search.pairs_close

    def counted(search, pairs, nodes):
        made.append(pairs.count())
        return before(search, pairs, nodes)

    monkeypatch.setattr(minhash_dedup._Search, "pairs_close", counted)
    got = near_copies(frame(spark, rows), small=8).drop("th")
    assert plain(got) == brute_components(rows, 3, 85)
    assert sum(made) < n


def test_near_starts_few_jobs(spark):
    """Each job costs the driver memory, so links are confirmed once and known labels are kept."""
    docs = frame(spark, corpus(6) + [(5000 + i, t) for i, t in variants(6)])
    context = spark.sparkContext
    context.setJobGroup("near", "near copies")
    try:
        near_copies(docs).collect()
    finally:
        context._jsc.clearJobGroup()
    assert len(context.statusTracker().getJobIdsForGroup("near")) < 150


@pytest.mark.parametrize("seed", [3, 4])
def test_components_of_links_known_at_once_or_in_turns(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in rng.sample(range(101, 140), 20)]
    links += [tuple(rng.sample(range(200, 260), 2)) for _ in range(35)]
    links = [rng.sample(x, 2) for x in links]
    rng.shuffle(links)
    label = {x: x for link in links for x in link}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    made = [spark.createDataFrame(x, "a long, b long") for x in (links[:60], links[60:], links)]
    want = sorted(label.items(), key=repr)
    assert plain(minhash_dedup.components(made[2]), "node", "label") == want
    known = minhash_dedup.components(made[0])
    assert plain(minhash_dedup._further(known, made[1]), "node", "label") == want


def test_parities_differ_in_no_more_bits_than_sets_in_shingles():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400)).astype(np.uint64)) for _ in range(30)]
    sets += [np.unique(np.append(x[rng.integers(0, 9) :], rng.integers(0, 99, 5).astype(np.uint64))) for x in sets]
    bits = minhash_dedup.parities(sets)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            apart = len(np.setxor1d(x, y))
            assert int(np.bitwise_count(bits[i] ^ bits[j]).sum()) <= apart


def test_near_odd_rows(spark):
    rows = [(4, "A b C d"), (2, "a B c D"), (2, "a B c D"), (None, "a b c d"), (9, None), (8, " ")]
    got = plain(near_copies(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(
        [(4, 2, 2, False), (2, 2, 2, True), (2, 2, 2, True), (None, 2, 2, False)]
        + [(9, 0, 9, True), (8, 0, 8, True)],
        key=repr,
    )
    assert near_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_window_argmin_and_words():
    rng = np.random.default_rng(1)
    order = rng.integers(0, 50, 300).astype(np.uint64) << np.uint64(40)
    for width in (1, 2, 3, 7, 69, 300):
        want = [i + int(np.argmin(order[i : i + width])) for i in range(300 - width + 1)]
        assert arrays.window_argmin(order, width).tolist() == want
    data = np.frombuffer(b"ab  cdef g", np.uint8)
    start, end, first = arrays.words(data, np.array([0, 6, 6, 10]), arrays.NOT_SPACE)
    assert [(s, e) for s, e in zip(start, end)] == [(0, 2), (4, 6), (6, 8), (9, 10)]
    assert first.tolist() == [0, 2, 2, 4]
