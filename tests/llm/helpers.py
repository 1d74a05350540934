"""Small inputs and brute-force versions shared by the tests of the subpackage."""

import hashlib
import random
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    None, "", " ", "\n\t", "a", "Ä ß ñ", "a" * 400, "x y " * 300, "<|endoftext|> it's\r\n  ok 12", "字" * 150,
]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def fold(text):
    return (text or "").translate(FOLD)


def corpus(seed, n=60, vocabulary=400):
    """Random texts with exact copies, near copies, shared passages and odd cases."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeABCÄ", k=rng.randrange(1, 6))) for _ in range(vocabulary)]
    passage = rng.choices(words, k=70)
    texts = []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(1, 160))
        kind = i % 6
        if kind == 1 and texts:
            text = rng.choice(texts)
        elif kind == 2 and texts:
            text = list(rng.choice(texts))
            text[rng.randrange(len(text))] = "edit%d" % i
        elif kind == 3:
            text = text[:20] + passage[rng.randrange(10) :] + text[20:]
        elif kind == 4:
            text = text[:30] * 4
        texts.append(text)
    rows = [(i, rng.choice([" ", "  ", "\n"]).join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    """Rows as documents with further columns whose names the operators use inside."""
    data = [(i, t, "k", 1, True) for i, t in rows]
    schema = "doc_id long, text string, th string, doc int, maybe boolean"
    return spark.createDataFrame(data, schema).repartition(parts)


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
