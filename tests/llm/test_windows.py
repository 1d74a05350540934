import numpy as np
import pyarrow as pa
import pytest

from llm import windows
from llm.substring_dedup import remove_repeated_words
from llm.suffix_dedup import remove_repeated_bytes
from tests.llm.helpers import PLAIN, corpus, frame, plain


def key(doc):
    return (doc is None, doc or 0)


def brute_words(rows, size):
    words = [PLAIN.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            first[k] = min(first.get(k, key(doc)), key(doc))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < key(doc):
                gone |= set(range(p, p + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), kept))
    return sorted(out, key=repr)


def brute_bytes(rows, size):
    texts = [(doc, (t or "").encode()) for doc, t in rows]
    first = {}
    for doc, b in texts:
        for p in range(len(b) - size + 1):
            k = b[p : p + size]
            first[k] = min(first.get(k, (key(doc), p)), (key(doc), p))
    out = []
    for doc, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - size + 1):
            if first[b[p : p + size]] < (key(doc), p):
                gone[p : p + size] = [True] * size
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc, len(b), sum(gone), runs, bytearray(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,local,flush", [(1, 16384, 400_000), (2, 2, 50)])
def test_words_against_brute_force(spark, seed, local, flush):
    rows = corpus(seed)
    got = remove_repeated_words(frame(spark, rows), window=12, node=4, local=local, flush=flush)
    assert plain(got) == brute_words(rows, 12)


@pytest.mark.parametrize("seed,local,flush", [(3, 16384, 400_000), (4, 2, 50)])
def test_bytes_against_brute_force(spark, seed, local, flush):
    rows = corpus(seed, n=40)
    got = remove_repeated_bytes(frame(spark, rows), window=40, trigger=8, local=local, flush=flush)
    assert plain(got) == brute_bytes(rows, 40)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (5, text), (None, text), (7, text + " end"), (7, None)]
    got = remove_repeated_words(frame(spark, rows))
    assert plain(got, "doc_id", "n_removed") == sorted(
        [(5, 0), (5, 0), (None, 60), (7, 60), (7, 0)], key=repr
    )
    got = remove_repeated_bytes(frame(spark, rows))
    size = len(text)
    assert plain(got, "doc_id", "n_removed", "n_spans") == sorted(
        [(5, 0, 0), (5, 0, 0), (None, size, 1), (7, size, 1), (7, 0, 0)], key=repr
    )


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert remove_repeated_words(empty).count() == 0
    assert remove_repeated_bytes(empty).count() == 0


def test_windows_of_few_phrases_are_made_at_once(monkeypatch):
    rng = np.random.default_rng(9)
    n, kind = 9000, windows.Kind(100, 32, words=False, within=True)
    k = np.sort(np.append(rng.integers(0, 900, n - 3000), np.full(3000, 950)))  # the last in over one piece
    body = rng.integers(97, 99, (n, 104)).astype(np.uint8)
    body = body[rng.integers(0, 40, n)]
    columns = [k, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int32), np.full(n, 4, np.int32)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(x) for x in columns] + [pa.array([x.tobytes() for x in body])],
        ["k", "doc", "th", "a", "b", "payload"],
    )
    seen, want = {}, set()
    for i in range(n):
        for p in range(5):
            key = k[i], body[i, p : p + 100].tobytes()
            if seen.setdefault(key, (i, p)) < (i, p):
                want |= {(i, q) for q in range(p, p + 100)}
    rows, before = [], windows._windows
    monkeypatch.setattr(windows, "_windows", lambda a, x: rows.append(x.num_rows) or before(a, x))
    parts = [batch.slice(i, 4000) for i in range(0, n, 4000)]
    got = set()
    for out in windows._resolve(kind)(iter(parts)):
        for x in out.to_pylist():
            got |= {(x["doc"], q) for q in range(x["s"], x["e"])}
    assert got == want and want
    assert max(rows) <= 2048 and sum(rows) == n
