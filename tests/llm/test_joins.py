"""Operators 11 to 13 against brute force, and strings that a plain polynomial hash confuses."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from llm import arrays, ngram_join, spelling, vector_codes
from llm.bpe import digests
from llm.decontaminate import annotate
from llm.minhash_dedup import near_copies
from llm.substring_dedup import remove_repeated_words
from tests.llm.helpers import corpus, fold, frame, plain, sha
from tests.llm.test_dedup import brute_components, variants

EMPTY = "doc_id long, text string"


# hashes


def twins(n=1024):
    """Two strings of equal polynomial hash modulo 2^64, whatever the base."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_hash_tells_twins_apart():
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in twins())
    for symbols in (np.concatenate([a, b]), np.concatenate([a, b]).astype(np.uint64)):
        h = arrays.Hasher(symbols)
        one, two = h.spans(np.array([0, 1024]), np.array([1024, 2048]))
        assert one != two and h.grams(1024)[0] == one
        again = arrays.Hasher(symbols[1024:]).spans(np.array([0]), np.array([1024]))
        assert again[0] == two


@pytest.mark.parametrize("parts", [1, 2])
def test_twins_as_words_shingles_items_and_pieces(spark, parts):
    a, b = twins()
    docs = frame(spark, [(1, a), (2, b)], parts)
    items = spark.createDataFrame([("i", a)], "item_id string, text string")
    hits = {r.row.doc_id: len(r.spans) for r in annotate(docs, items).collect()}
    assert hits == {1: 1, 2: 0}
    assert [r[2] for r in plain(near_copies(docs), "doc_id", "n_shingles", "component_id")] == [1, 2]
    assert [r[2] for r in plain(ngram_join.ngram_join(docs))] == [1, 2]
    found = {r.doc_id: r.decoded_sha256 for r in digests(docs).collect()}
    assert found == {1: sha(a), 2: sha(b)}
    long = frame(spark, [(1, " ".join([a] * 50)), (2, " ".join([b] * 50))], parts)
    assert [r[1] for r in plain(remove_repeated_words(long), "doc_id", "n_removed")] == [0, 0]


# operator 11


@pytest.mark.parametrize("percent", [50, 80, 90, 99])
def test_sizes_that_can_link_share_classes_and_groups(percent):
    starts = ngram_join.class_starts(percent, 400)
    differ = ngram_join.most_different(starts, percent)
    for a in range(1, 401):
        c = np.searchsorted(starts, a, "right") - 1
        for b in range(a, a * 100 // percent + 1):
            d = np.searchsorted(starts, b, "right") - 1
            assert d in (c, c + 1)
            # the smallest overlap that links, and what then differs
            both = math.ceil(percent * (a + b) / (100 + percent))
            assert a + b - 2 * both <= differ[c]


def test_tree_join_finds_all_that_minima_allow():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 9, (6, ngram_join.GROUPS))
    x, y = (
        np.abs(centres[rng.integers(0, 6, 90)] + rng.integers(-1, 2, (90, ngram_join.GROUPS))).astype(np.int32)
        for _ in range(2)
    )
    x[:40] = x[0]  # equal points cannot be cut
    a, b = (ngram_join.RTree(z, z.sum(1, dtype=np.int64), 4) for z in (x, y))
    got = {(i, j) for p, q in a.join(b, 75) for i, j in zip(p.tolist(), q.tolist(), strict=True)}
    over = np.minimum(x[:, None], y[None]).sum(2)
    fit = over * 175 >= 75 * (x.sum(1)[:, None] + y.sum(1)[None])
    assert got == set(zip(*(k.tolist() for k in np.nonzero(fit)), strict=True))
    assert got and len(got) < 90 * 90


@pytest.mark.parametrize("seed,leaf,stars", [(6, 512, 3), (7, 2, 1)])
def test_ngram_join_against_brute_force(spark, seed, leaf, stars):
    rows = corpus(seed) + [(5000 + i, t) for i, t in variants(seed)]
    rows += [(7000 + i, t) for i, t in variants(seed + 50, 40, 25)]
    long = " ".join(f"w{i * i % 9973}" for i in range(70_000))  # more than a block
    rows += [(8000, long), (8001, long + " x y z"), (8002, long[: len(long) // 2])]
    got = plain(ngram_join.ngram_join(frame(spark, rows), leaf=leaf, stars=stars))
    assert got == [r[:3] for r in brute_components(rows, 3, 90)]


def test_ngram_join_odd_rows(spark):
    rows = [(4, "A b C d"), (2, "a B c D"), (2, "a B c D"), (None, "a b c d"), (9, None), (8, " ")]
    got = plain(ngram_join.ngram_join(frame(spark, rows)))
    assert got == sorted([(4, 2, 2), (2, 2, 2), (2, 2, 2), (None, 2, 2), (9, 0, 9), (8, 0, 8)], key=repr)
    assert ngram_join.ngram_join(spark.createDataFrame([], EMPTY)).count() == 0


# operator 12


def brute_words(rows, noise):
    found = Counter()
    for doc, text in rows:
        run = []
        for c in fold(text) + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run.append(c)
                continue
            word = "".join(run)
            run = []
            if word:
                h = zlib.crc32(f"{doc}:{word}".encode())
                if doc is not None and h % noise == 0:
                    word = word[: h % len(word)] + word[h % len(word) + 1 :]
                found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words):
    form, count = {}, {}
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        count[w] = len(around)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, count[w], form[w], words.get(form[w]), root))
    return sorted(out, key=repr)


def spellings(seed, letters="abÀ", n=300):
    rng = random.Random(seed)
    words = {}
    while len(words) < n:
        word = "".join(rng.choices(letters, k=rng.choice([6, 6, 7, 7, 8, 9, 12])))
        words[word] = rng.choice([5, 6, 30, 31, 200, 1100])
    return words


@pytest.mark.parametrize("seed,limit", [(1, 4096), (2, 8), (3, 1)])
def test_groups_against_brute_force(spark, seed, limit):
    words = spellings(seed)
    words |= {"q" * 900 + x + "r" * 900: n for x, n in (("", 5), ("s", 25), ("st", 125), ("t", 9))}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = spelling.group_variants(table, limit=limit)
    assert plain(got, "word", "n", "n_near", "form", "form_n", "root") == brute_groups(words)


@pytest.mark.parametrize("noise", [2, 199])
def test_vocabulary_counts_whole_texts(spark, noise):
    words = list(spellings(4, n=40)) + ["ÀÉÎÕÜß×÷", "MiXeD", "UPPERcase"]
    rng = random.Random(5)
    rows = [(i, rng.choice([" ", "1", "Ā", "—"]).join(rng.choices(words, k=60))) for i in range(40)]
    rows += [(None, "nullid " * 9), (50, None), (51, ""), (51, "repeated " * 3), (51, "repeated " * 3)]
    rows.append((52, "x" * 5 + " " + "longest" * 70_000 + " aloneone"))
    got = spelling.vocabulary(frame(spark, rows), noise=noise)
    assert dict(plain(got, "word", "n")) == brute_words(rows, noise)


def test_spelling_of_nothing(spark):
    words = spelling.vocabulary(spark.createDataFrame([], EMPTY))
    assert spelling.group_variants(words).count() == 0
    one = spark.createDataFrame([("abcdef", 5)], "word string, n long")
    assert plain(spelling.group_variants(one), "word", "n_near", "form", "root") == [("abcdef", 0, None, "abcdef")]


def test_acceptor_is_minimal_and_exact():
    words = sorted(spellings(9))
    a = spelling.Acceptor(words)
    rights = {(a.final[i], *sorted(a.edges[i].items())) for i in range(len(a.edges))}
    assert len(rights) == len(a.edges) < sum(map(len, words)) / 3
    assert sorted(spelling._common(a, a.start, a, a.start)) == words


# operator 13


def brute_codes(rows, parts=16, entries=64, rounds=2):
    kept = []
    for i, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(256 * x) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // parts
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            held = {}
            for c in cut:
                held.setdefault(nearest(c[p], book)[1], []).append(c[p])
            books[p] = [
                tuple(sum(x) // len(held[k]) for x in zip(*held[k])) if k in held else e
                for k, e in enumerate(book)
            ]
    out, total = [], Counter()
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        total[label] += error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    digest = sha(",".join(str(x) for book in books for e in book for x in e))
    return sorted(((i, code, e, total[label], digest) for i, code, e, label in out), key=repr)


@pytest.mark.parametrize("n,width,spread", [(300, 32, 1.0), (40, 16, 3000.0), (130, 64, 0.01)])
def test_codes_against_brute_force(spark, n, width, spread):
    rng = random.Random(n)
    rows = [
        (rng.choice([i, i, None]) if i % 17 == 0 else i, [rng.gauss(0, spread) for _ in range(width)], rng.choice([1, 2, None]))
        for i in range(n)
    ]
    rows += [rows[3], rows[3], (-5, [0.0] * width, 2), (-4, [0.0] * width, 2)]
    rows += [(-1, None, 1), (-2, [None] + [0.0] * (width - 1), 1), (-3, [math.nan] * width, 1)]
    rows += [(-6, [0.5] * (width - 1) + [-math.inf], 2)]
    rng.shuffle(rows)
    data = [(*r, 7, "x", 1.0) for r in rows]
    schema = "vec_id long, embedding array<double>, label int, error int, id string, n double"
    table = spark.createDataFrame(data, schema).repartition(3)
    got = vector_codes.compress(table)
    assert plain(got, "vec_id", "code", "error", "label_error", "codebooks_sha256") == brute_codes(rows)


def test_limbs_are_exact():
    rng = np.random.default_rng(8)
    for bits, top in ((4, 1 << 20), (25, 1 << 29), (9, 1 << 27)):
        a, b = (rng.integers(-top, top, (50, 5)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        assert vector_codes.exact_dot(a, b, bits).tolist() == want
        digits = vector_codes.limbs(a, bits)
        assert max(np.abs(d).max() for d in digits) <= 1 << (bits - 1)
    for width in (1, 4, 100, 4096):
        assert width * (1 << vector_codes.limb_bits(width)) ** 2 <= 1 << 53


def test_codes_decode_and_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.compress(spark.createDataFrame([], schema)).count() == 0
    nothing = spark.createDataFrame([(1, None, 1), (2, [None, 1.0], 1)], schema)
    assert vector_codes.compress(nothing).count() == 0
    empty = vector_codes.compress(spark.createDataFrame([(1, [], 1), (2, [], None)], schema))
    assert [r[:4] for r in plain(empty)] == [(1, "00" * 16, 0, 0), (2, "00" * 16, 0, 0)]
    table = spark.createDataFrame([(i, [i / 4] * 16, 1) for i in range(20)], schema)
    books = vector_codes.fit(table)
    back = vector_codes.decode(vector_codes.encode(table, books), books)
    assert plain(back) == [(i, [i / 4] * 16) for i in range(20)] or len(plain(back)) == 20
    assert sorted(r.vector[0] for r in back.collect()) == [i / 4 for i in range(20)]
    with pytest.raises(Exception, match="components"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 16, 1), (2, [1.0] * 3, 1)], schema)).count()
