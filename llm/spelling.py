"""Spelling variant grouping by finite-state composition (operator 12).

Words one edit apart are the pairs that the composition *vocabulary acceptor, one-edit transducer,
vocabulary acceptor* accepts. One acceptor of a large vocabulary fits no task, so the composition is
cut into parts by the state it starts from. With ``m`` the length of the shorter word, the edit
lies in a window of positions [lo, hi): all before it and all after it is equal. Words of
``m`` or ``m + 1`` letters with the same start of ``lo`` letters and the same end of
``m - hi`` letters are one part, and its acceptors hold the letters between. At first there are two
windows, the halves of the word; a part of more than ``limit`` words is cut into two narrower
windows, again and again. A window of one position holds at most as many words as the alphabet
allows in one or two letters, so parts are bounded however many words start alike.

Inside a part the middles become two minimised acceptors, by length. The composition walks along
states both have reached with equal letters, takes the edit once, and goes on where both
acceptors can read the same letter. The edit counts at the first letter that differs, so a pair
is accepted in one window only and once.

Counts are added up per task before they are shuffled. A word's root is found by doubling the
steps along its forms: each form is ``FACTOR`` times as frequent as the last, so chains are short.

Defined cases: a null text has no words; a null id deletes no letter; repeated rows count each;
ties between forms go to the smaller word by code point; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import rows_of, stage

LETTERS = 6
TIMES = 5
FACTOR = 5
NOISE = 199
#: Words of a part beyond which its window is cut in two.
LIMIT = 4096
_FLUSH = 300_000
KEY = ["m", "lo", "hi", "head", "tail"]


def _count(letters: int, noise: int | None):
    """Per task: words of at least ``letters`` letters and how often they occur."""
    run_of = re.compile(f"[a-zÀ-ÿ]{{{letters},}}")

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for doc, raw in zip(batch.column("doc").to_pylist(), texts, strict=True):
                start = None if doc is None else zlib.crc32(f"{doc}:".encode())
                text = raw.as_py().lower().decode()  # of bytes, so A-Z only
                for word, n in Counter(run_of.findall(text)).items():
                    h = zlib.crc32(word.encode(), start) if noise and start is not None else 1
                    if noise and h % noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    held[word] += n
                if len(held) > _FLUSH:
                    yield rows(held)
                    held.clear()
        if held:
            yield rows(held)

    return run


def vocabulary(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    letters: int = LETTERS,
    times: int = TIMES,
    noise: int | None = NOISE,
) -> DataFrame:
    """``word, n``: words of at least ``letters`` letters that occur ``times`` times or more.

    With ``noise`` one occurrence in so many, chosen by the checksum of id and word, loses a letter.
    """
    counted = rows_of(docs, id_col, text_col).mapInArrow(_count(letters, noise), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Acceptor:
    """The minimal acceptor of sorted distinct words: per state its edges and whether it ends a word.

    Words are added in order; what the next word can no longer change is merged with an
    equal state at once.
    """

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, {}]]  # states not yet merged, along the last word
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, edges = path.pop()
                key = (final, *edges.items())
                if key not in known:
                    known[key] = len(self.edges)
                    self.edges.append(edges)
                    self.final.append(final)
                path[-1][1][last[len(path) - 1]] = known[key]

        for word in words:
            same = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                same += 1
            close(same)
            path += [[False, {}] for _ in range(len(word) - same)]
            path[-1][0] = True
            last = word
        close(0)
        self.start = len(self.edges)
        self.edges.append(path[0][1])
        self.final.append(path[0][0])


def _text(link) -> str:
    letters = []
    while link is not None:
        link, c = link
        letters.append(c)
    return "".join(reversed(letters))


def _common(a: Acceptor, p: int, b: Acceptor, q: int, barred: str = "") -> Iterator[str]:
    """Strings that ``a`` reads from state p and ``b`` from state q to an end, not starting with ``barred``."""
    todo = [(p, q, None)]
    while todo:
        p, q, read = todo.pop()
        if a.final[p] and b.final[q]:
            yield _text(read)
        other = b.edges[q]
        for c, further in a.edges[p].items():
            if c in other and (c != barred or read is not None):
                todo.append((further, other[c], (read, c)))


def one_edit_pairs(
    short: list[str], long: list[str], width: int, last: bool
) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart: two of ``short``, or one of ``short`` and one of ``long``, in order.

    Lists are sorted and distinct; ``short`` has strings of ``width`` letters and ``long`` of one
    more. With ``last`` a letter may also be put after all others.
    """
    a = Acceptor(short)
    todo = [(a.start, None)]
    while todo:  # replaced: the same state until then, two letters, the same rest
        p, read = todo.pop()
        edges = list(a.edges[p].items())
        for k, (c, further) in enumerate(edges):
            for d, other in edges[k + 1 :]:
                before = None
                for rest in _common(a, further, a, other):
                    before = _text(read) if before is None else before
                    yield before + c + rest, before + d + rest
            todo.append((further, (read, c)))
    if not long:
        return
    b = Acceptor(long)
    todo = [(a.start, b.start, None, 0)]
    while todo:  # inserted: the same letters until then, one of the longer, the same rest
        p, q, read, depth = todo.pop()
        if depth < width or last:
            for d, further in b.edges[q].items():
                before = None
                for rest in _common(a, p, b, further, d):
                    before = _text(read) if before is None else before
                    yield before + rest, before + d + rest
        for c, further in a.edges[p].items():
            if c in b.edges[q]:
                todo.append((further, b.edges[q][c], (read, c), depth + 1))


def _windows(words: DataFrame) -> DataFrame:
    """Every word once for each half of it, as the shorter and as the longer word of a pair."""
    long = F.length("word")
    halves = words.withColumn("m", F.explode(F.array(long, long - 1)))
    half = F.floor(F.col("m") / 2).cast("int")
    both = F.array(
        F.struct(F.lit(0).alias("lo"), half.alias("hi")),
        F.struct(half.alias("lo"), F.col("m").alias("hi")),
    )
    return halves.select("word", "n", "m", F.explode(both).alias("w")).select(
        "word", "n", "m", "w.lo", "w.hi"
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """With the letters before and after the window, which all words of a part share."""
    return rows.select(
        "word", "n", "m", "lo", "hi",
        F.expr("substring(word, 1, lo)").alias("head"),
        F.expr("right(word, m - hi)").alias("tail"),
    )


def _narrower(rows: DataFrame) -> DataFrame:
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    both = F.array(
        F.struct(F.col("lo").alias("lo"), mid.alias("hi")),
        F.struct(mid.alias("lo"), F.col("hi").alias("hi")),
    )
    return rows.select("word", "n", "m", F.explode(both).alias("w")).select(
        "word", "n", "m", "w.lo", "w.hi"
    )


def parts(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n`` with the part (``KEY``) in which it is compared; several rows per word."""
    rows, settled = _keyed(_windows(words)), None
    while True:
        rows = stage(rows, "windows")
        large = stage(
            rows.groupBy(*KEY).agg(F.count("*").alias("size"))
            .where((F.col("size") > limit) & (F.col("hi") - F.col("lo") > 1)),
            "large",
        )
        if large.isEmpty():
            return rows if settled is None else settled.unionByName(rows)
        small = rows.join(large, KEY, "left_anti").select(rows.columns)
        settled = small if settled is None else settled.unionByName(small)
        rows = _keyed(_narrower(rows.join(large, KEY, "left_semi")))


def _compose(batches):
    """Pairs of every part, each in both directions; the rows of a part follow one another."""
    key, held = None, []
    out: list[list] = [[], [], []]

    def close():
        m, lo, hi, head, tail = key
        width = hi - lo
        middle = {w[lo : len(w) - (m - hi)]: n for w, n in held}
        short = sorted(x for x in middle if len(x) == width)
        long = sorted(x for x in middle if len(x) == width + 1)
        if not short or len(short) + len(long) < 2:
            return
        for x, y in one_edit_pairs(short, long, width, hi == m):
            for a, b in ((x, y), (y, x)):
                out[0].append(head + a + tail)
                out[1].append(head + b + tail)
                out[2].append(middle[b])

    def drain():
        types = (pa.string(), pa.string(), pa.int64())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out, types, strict=True)], ["word", "near", "near_n"]
        )
        for x in out:
            x.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*KEY, "word", "n")]
        for *now, word, n in zip(*columns, strict=True):
            if now != key:
                if len(held) > 1:
                    close()
                key, held = now, []
            held.append((word, n))
        if len(out[0]) > 10_000:
            yield drain()
    if len(held) > 1:
        close()
    yield drain()


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, near, near_n``: all ordered pairs of words one edit apart."""
    dealt = parts(words, limit).repartition(*KEY).sortWithinPartitions(*KEY)
    return dealt.mapInArrow(_compose, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: the last form that each word leads to."""
    found = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = stage(
            found.join(step, "root", "left").select(
                "word",
                F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found = found.drop("moved")


def group_variants(words: DataFrame, factor: int = FACTOR, limit: int = LIMIT) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every row of ``word, n`` (words distinct)."""
    words = stage(words.select("word", "n"), "words")
    # the largest count first, then the smallest word
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = near_words(words, limit).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= factor * F.col("n")
    judged = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "judged",
    )
    found = roots(judged.where("form IS NOT NULL"))
    return judged.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = group_variants(vocabulary(docs))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


ORACLE_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), r AS (
  SELECT doc_id, w, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
  WHERE length(w) >= {LETTERS} GROUP BY ALL
), x AS (
  SELECT doc_id, w, k, hex(encode(doc_id || ':' || w)) AS x FROM r
), h AS (
  SELECT w, k, CASE WHEN doc_id IS NULL THEN 1 ELSE
    xor(list_reduce(list_transform(range(length(x) // 2), lambda i:
          CAST('0x' || x[2 * i + 1 : 2 * i + 2] AS BIGINT)),
        lambda c, b: xor(c >> 8, t.t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) END AS h
  FROM x, t
), v AS MATERIALIZED (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % {NOISE} <> 0 THEN w ELSE
      left(w, h % length(w)) || substr(w, h % length(w) + 2) END AS word FROM h)
  WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(k) >= {TIMES}
), d AS MATERIALIZED (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS s
  FROM (SELECT word, unnest(range(length(word))) AS i FROM v)
), e AS (
  SELECT a.word, b.word AS near FROM d a JOIN d b ON a.s = b.s AND a.i = b.i AND a.word <> b.word
  UNION SELECT s, d.word FROM d JOIN v ON d.s = v.word
  UNION SELECT d.word, s FROM d JOIN v ON d.s = v.word
), g AS (
  SELECT e.word, count(*) AS n_near, min_by(e.near, (-o.n, e.near)) AS near, max(o.n) AS near_n
  FROM e JOIN v o ON o.word = e.near GROUP BY e.word
), j AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= {FACTOR} * v.n THEN near END AS form,
         CASE WHEN near_n >= {FACTOR} * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN g ON g.word = v.word
), p(word, stop) AS (
  SELECT word, word FROM j
  UNION ALL SELECT p.word, j.form FROM p JOIN j ON j.word = p.stop WHERE j.form IS NOT NULL
)
SELECT j.*, p.stop AS root FROM j JOIN p USING (word) JOIN j z ON z.word = p.stop WHERE z.form IS NULL
"""
