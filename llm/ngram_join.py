"""N-gram Jaccard join over an R-tree of count vectors (operator 11).

Tokens are hashed shingles, and tokens are hashed into groups. How many tokens of a set fall into
each of ``GROUPS`` groups is its point. The sum of the coordinate minima of two points, or of two
boxes of points, bounds the overlap of their sets from above; what it allows is
confirmed on full sets.

1. Documents with the same set are one node.
2. The root of the tree. Sets of similarity ``percent`` differ in a number of tokens that sizes
   bound. With that many groups and ``SPARE`` + 1 more, they agree fully in more than
   ``SPARE`` groups. So sets are entered under what they hold in each group (a key), and linked sets meet
   under one key at least. Sizes go by classes so that both use the same groups: each set is entered
   for its own class and for the one below. Empty groups give no key; the few sets with more than
   ``SPARE`` empty groups share one more key.
3. Under a key nodes are compared with one node, first with that in the most company, then with
   chosen ones. Links make components, and keys whose nodes are one component are done. So a
   group of copies costs its size, not its square.
4. Under the keys left, nodes outside the largest component are packed into leaves of about
   ``LEAF`` points, all others as well, and pairs of leaves, of which one is of the former, are
   joined: each leaf is an R-tree of boxes, cut at the median of the widest coordinate, and pairs of
   boxes are followed while sizes and summed minima allow a link. Pairs of one component are left out.

Defined cases: null or wordless text is empty and linked with nothing; fewer words than a
shingle are one shingle; repeated rows are one node and share a component; a null id
counts as the largest; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import arrays
from llm.common import BitFilter, rows_of, stage
from llm.minhash_dedup import components, shingle_sets

SHINGLE = 3
PERCENT = 90
GROUPS = 64
SPARE = 2
LEAF = 512
BOX = 16
#: Times that the nodes of a key are compared with one of them before leaves are joined.
STARS = 3
#: Keys of a node that are sent along to find each pair under few of its keys.
KNOWN = 16
_LAST = np.iinfo(np.int64).max


def class_starts(percent: int, largest: int) -> np.ndarray:
    """First size of each class: sets of a class link within it and with the classes beside it."""
    starts = [1]
    while starts[-1] <= largest or len(starts) < 3:
        starts.append(max(starts[-1] + 1, (starts[-1] - 1) * 100 // percent + 1))
    return np.array([*starts, *[max(starts[-1] + 1, (starts[-1] - 1) * 100 // percent + 1)]], np.int64)


def most_different(starts: np.ndarray, percent: int) -> np.ndarray:
    """Largest number of tokens in which linked sets of class c and of c or c + 1 differ."""
    low = starts[1:-1] - 1
    high = np.minimum(low * 100 // percent, starts[2:] - 1)
    return (100 - percent) * (low + high) // (100 + percent)


def root_keys(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all sets (none empty), one after another, and how many each set has."""
    sizes = np.array([len(x) for x in sets], np.int64)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    starts = class_starts(percent, int(sizes.max()))
    differ = most_different(starts, percent)
    own = np.searchsorted(starts, sizes, "right") - 1
    value = arrays.mix(tokens)
    keys, of = [], []
    for kind in (own, own - 1):
        groups = np.where(kind >= 0, differ[kind] + 1 + SPARE, 0)
        groups[(kind < 0) | (differ[kind] == 0)] = 0  # then only equal sets are linked
        first = np.cumsum(groups) - groups
        inside = groups[owner] > 0
        many = groups[owner[inside]].astype(np.uint64)
        seed = arrays.mix(kind[owner[inside]].astype(np.uint64) + np.uint64(7))
        spread = arrays.mix(tokens[inside] ^ seed) >> np.uint64(32)
        at = first[owner[inside]] + ((spread * many) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(int(groups.sum()), np.uint64)
        np.add.at(total, at, value[inside])
        filled = np.bincount(at, minlength=len(total)) > 0
        doc = np.repeat(np.arange(len(sets)), groups)
        number = np.arange(len(total)) - first[doc]
        name = arrays.mix((kind[doc].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64))
        keys.append(arrays.mix(total + name)[filled])
        of.append(doc[filled])
        bare = np.flatnonzero(np.bincount(doc[~filled], minlength=len(sets)) > SPARE)
        keys.append(arrays.mix(~kind[bare].astype(np.uint64)))
        of.append(bare)
    keys, of = np.concatenate(keys), np.concatenate(of)
    return keys[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(sets))


def points(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens of each set fall into each group."""
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    group = owner * GROUPS + (arrays.mix(tokens + np.uint64(3)) % np.uint64(GROUPS)).astype(np.int64)
    return np.bincount(group, minlength=len(sets) * GROUPS).reshape(-1, GROUPS).astype(np.int32)


def _enter(size: int, percent: int):
    """Per document: set size, node, point and keys."""

    def run(batches):
        for batch in batches:
            n, node, point, keys, of = [], [], [], [], []
            for _, _, data, offsets in arrays.blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                full = [x for x in sets if len(x)]
                at = np.flatnonzero([len(x) > 0 for x in sets])
                n += [len(x) for x in sets]
                ids = np.zeros(len(sets), np.int64)
                held = np.zeros(len(sets), np.int64)
                rows: list = [None] * len(sets)
                if full:
                    ends = np.cumsum([0] + [len(x) for x in full[:-1]])
                    sums = np.add.reduceat(arrays.mix(np.concatenate(full)), ends)
                    ids[at] = arrays.mix(sums).view(np.int64)
                    found, held[at] = root_keys(full, percent)
                    keys.append(found)
                    for i, row in zip(at.tolist(), points(full), strict=True):
                        rows[i] = row.tobytes()
                node.append(ids)
                point += rows
                of.append(held)
            ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *of]))
            found = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("th"), pa.array(n, pa.int64())]
                + [pa.array(np.concatenate(node) if node else np.zeros(0, np.int64))]
                + [pa.array(point, pa.binary())]
                + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.view(np.int64)))],
                ["doc", "th", "n", "node", "point", "keys"],
            )

    return run


def _allowed(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes and at most this overlap can be linked."""
    return overlap * (100 + percent) >= percent * (a + b)


class RTree:
    """Points in boxes: a box is cut at the median of its widest coordinate until few points are left."""

    def __init__(self, point: np.ndarray, size: np.ndarray, box: int = BOX):
        self.point, self.size = point, size
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.least: list[int] = []
        self.most: list[int] = []
        self.inside: list = []  # two boxes, or the points of a leaf
        todo = [(np.arange(len(size)), -1, 0)]
        while todo:
            at, above, side = todo.pop()
            number = len(self.inside)
            if above >= 0:
                self.inside[above][side] = number
            here = point[at]
            self.high.append(here.max(0))
            self.low.append(here.min(0))
            self.least.append(int(size[at].min()))
            self.most.append(int(size[at].max()))
            spread = self.high[-1] - self.low[-1]
            if len(at) <= box or not spread.any():
                self.inside.append(at)
                continue
            order = at[np.argsort(here[:, int(spread.argmax())], kind="stable")]
            self.inside.append([0, 0])
            half = len(order) // 2
            todo += [(order[:half], number, 0), (order[half:], number, 1)]

    def join(self, other: RTree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of points of both trees that sizes and summed minima let be linked."""
        todo = [(0, 0)]
        while todo:
            i, j = todo.pop()
            if (
                self.most[i] * 100 < other.least[j] * percent
                or other.most[j] * 100 < self.least[i] * percent
                or not _allowed(
                    np.minimum(self.high[i], other.high[j]).sum(dtype=np.int64),
                    self.least[i], other.least[j], percent,
                )
            ):
                continue
            a, b = self.inside[i], other.inside[j]
            if isinstance(a, list) and (not isinstance(b, list) or self.most[i] >= other.most[j]):
                todo += [(a[0], j), (a[1], j)]
            elif isinstance(b, list):
                todo += [(i, b[0]), (i, b[1])]
            else:
                for lo in range(0, len(a), 64):  # a leaf of equal points may be large
                    part = a[lo : lo + 64]
                    over = np.zeros((len(part), len(b)), np.int64)
                    for g in range(self.point.shape[1]):
                        over += np.minimum(self.point[part, g][:, None], other.point[b, g])
                    x, y = np.nonzero(
                        _allowed(over, self.size[part][:, None], other.size[b][None, :], percent)
                    )
                    yield part[x], b[y]


def _close(percent: int):
    """Pairs whose points let them be linked."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(x).to_pylist()), np.int32).reshape(-1, GROUPS)
                for x in ("point_a", "point_b")
            )
            over = np.minimum(a, b).sum(1, dtype=np.int64)
            fit = _allowed(over, a.sum(1, dtype=np.int64), b.sum(1, dtype=np.int64), percent)
            yield batch.select(["a", "b"]).filter(pa.array(fit))

    return run


def _confirm(size: int, percent: int):
    """Pairs whose full sets are similar enough."""

    def run(batches):
        last: tuple = (None, None)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            left = batch.column("text_a")
            keep = np.zeros(len(a), bool)
            for lo, hi, data, offsets in arrays.blocks(batch.column("text_b")):
                for i, other in zip(range(lo, hi), shingle_sets(data, offsets, size), strict=True):
                    if last[0] != a[i]:
                        _, _, raw, at = next(arrays.blocks(left.slice(i, 1)))
                        last = a[i], shingle_sets(raw, at, size)[0]
                    both = len(np.intersect1d(last[1], other, assume_unique=True))
                    keep[i] = 100 * both >= percent * (len(last[1]) + len(other) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _join_leaves(percent: int):
    """Pairs of nodes of different components from pairs of leaves under one key."""

    def unpack(leaf):
        point = np.frombuffer(b"".join(x["point"] for x in leaf), np.int32).reshape(-1, GROUPS)
        return leaf, RTree(point, point.sum(1, dtype=np.int64))

    def run(batches):
        last, held = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "a_no", "a", "b_no", "b")]
            for key, a_no, a, b_no, b in zip(*columns, strict=True):
                if last != (key, a_no):
                    last, held = (key, a_no), unpack(a)
                (a, left), (b, right) = held, unpack(b)
                found: set = set()
                for some, others in left.join(right, percent):
                    for i, j in zip(some.tolist(), others.tolist(), strict=True):
                        x, y = a[i], b[j]
                        if x["label"] == y["label"] or (a_no == b_no and x["node"] > y["node"]):
                            continue
                        # found under a smaller key that both have
                        if any(k < key for k in set(x["known"]).intersection(y["known"])):
                            continue
                        found.add((min(x["node"], y["node"]), max(x["node"], y["node"])))
                pairs = list(zip(*found, strict=True)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pairs], ["a", "b"])

    return run


class _Join:
    def __init__(self, docs: DataFrame, size: int, percent: int, leaf: int, stars: int):
        self.size, self.percent, self.leaf, self.stars = size, percent, leaf, stars
        self.rows = docs.select("doc", F.xxhash64("text").alias("th"), "text")
        schema = "doc long, th long, n long, node long, point binary, keys array<long>"
        self.entered = stage(self.rows.mapInArrow(_enter(size, percent), schema), "entered")

    def nodes(self) -> DataFrame:
        """One row per distinct set that is not empty, with a document that has it."""
        full = self.entered.where("n > 0").withColumn("doc", F.coalesce("doc", F.lit(_LAST)))
        least = full.groupBy("node").agg(F.min(F.struct("doc", "th")).alias("first"))
        least = least.select("node", F.col("first.doc").alias("doc"), F.col("first.th").alias("th"))
        return full.join(least, ["node", "doc", "th"]).dropDuplicates(["node"])

    def texts(self, nodes: DataFrame) -> DataFrame:
        """A text of each node; only rows that may hold one are shuffled."""
        wanted = nodes.select("node", "doc", "th")
        key = F.xxhash64("doc", "th")
        maybe = BitFilter(wanted.select(key.alias("key")), "key").column(key)
        rows = self.rows.withColumn("doc", F.coalesce("doc", F.lit(_LAST))).where(maybe)
        return rows.join(wanted, ["doc", "th"]).dropDuplicates(["node"]).select("node", "text")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links among distinct pairs (a, b): by points first, then on full sets."""

        def beside(rows, table, column):
            for x in ("b", "a"):
                named = table.select(F.col("node").alias(x), F.col(column).alias(f"{column}_{x}"))
                rows = rows.join(named, x)
            return rows

        close = beside(pairs, self.points, "point").mapInArrow(_close(self.percent), "a long, b long")
        close = stage(close, "close")
        drawn = beside(close, self.held, "text")
        return stage(drawn.mapInArrow(_confirm(self.size, self.percent), "a long, b long"), "links")

    def fits(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def links(self) -> DataFrame:
        """Links (a, b) that hold together what is linked."""
        nodes = stage(self.nodes(), "nodes")
        each = nodes.select("node", "n", F.explode("keys").alias("key"))
        shared = each.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        members = stage(each.join(shared, "key").select("key", "node", "n", "size"), "members")
        company = stage(members.groupBy("node").agg(F.sum("size").alias("company")), "company")
        used = nodes.join(company, "node", "left_semi")
        self.points = stage(used.select("node", "point"), "points")
        self.held = stage(self.texts(used), "texts")
        links = None
        rows = members.join(company, "node").withColumn("label", F.col("node"))
        for turn in range(self.stars):
            rank = F.col("company") if turn == 0 else F.xxhash64("key", "node", F.lit(turn))
            found = self.confirmed(self.star(rows, rank))
            links = found if links is None else links.unionByName(found)
            rows = self.mixed(members.join(company, "node"), components(links))
        found = self.confirmed(self.leaf_pairs(rows))
        return links.unionByName(found)

    def star(self, rows: DataFrame, rank: Column) -> DataFrame:
        """Under each key, the node of the highest rank with all of other components."""
        mid = rows.groupBy("key").agg(
            F.max_by(F.struct("node", "n", "label"), F.struct(rank, -F.col("node"))).alias("mid")
        )
        apart = (F.col("label") != F.col("mid.label")) & self.fits(F.col("n"), F.col("mid.n"))
        a = F.least("node", "mid.node").alias("a")
        b = F.greatest("node", "mid.node").alias("b")
        return rows.join(mid, "key").where(apart).select(a, b).distinct()

    def mixed(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members with their component, under keys with several."""
        named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        named = stage(named, "named")
        several = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
        return stage(named.join(several.where("x != y").select("key"), "key", "left_semi"), "mixed")

    def leaf_pairs(self, rows: DataFrame) -> DataFrame:
        """Distinct pairs of different components under the keys that are left."""
        each = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
        most = each.groupBy("key").agg(
            F.max_by("label", F.struct("n", "label")).alias("main"),
            F.max("n").alias("of_main"), F.sum("n").alias("all"),
        )
        known = rows.groupBy("node").agg(
            F.slice(F.array_sort(F.collect_set("key")), 1, KNOWN).alias("known")
        )
        main = F.col("label") == F.col("main")
        count = F.when(main, F.col("of_main")).otherwise(F.col("all") - F.col("of_main"))
        number = F.pmod(F.xxhash64("node", "key"), F.ceil(count / self.leaf))
        placed = rows.join(most, "key").select(
            "key", "node", "label", main.alias("main"), F.struct(main, number).alias("no")
        )
        point = placed.join(known, "node").join(self.points, "node")
        leaves = point.groupBy("key", "no", "main").agg(
            F.collect_list(F.struct("node", "label", "known", "point")).alias("leaf")
        )
        leaves = stage(
            leaves.withColumn("no", F.xxhash64("no")), "leaves"
        )
        open_ = leaves.where("NOT main").select("key", F.col("no").alias("a_no"), F.col("leaf").alias("a"))
        other = leaves.select("key", F.col("no").alias("b_no"), F.col("leaf").alias("b"), "main")
        both = open_.join(other, "key").where("main OR a_no <= b_no").drop("main")
        return both.mapInArrow(_join_leaves(self.percent), "a long, b long").distinct()


def ngram_join(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf: int = LEAF,
    stars: int = STARS,
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id`` (the smallest id that links reach)."""
    search = _Join(rows_of(docs, id_col, text_col), shingle, percent, leaf, stars)
    labels = stage(components(search.links()), "last_labels")
    entered = search.entered.select("doc", "n", "node")
    classes = (
        entered.where("n > 0").groupBy("node").agg(F.min("doc").alias("least"))
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    lowest = classes.groupBy("label").agg(F.min("least").alias("component"))
    of = classes.join(lowest, "label").select("node", "component")
    return entered.join(of, "node", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(ws[p : p + {SHINGLE - 1}], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - {SHINGLE - 1}) + 1)) AS p
        FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS (
  SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b
  WHERE 100 * i.i >= {PERCENT} * (x.n + y.n - i.i)
), l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r(root, doc_id) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT r.root, l.b FROM r JOIN l ON r.doc_id = l.a
)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM w JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id
"""
