"""Near-duplicate groups by circulant MinHash (operator 5).

Two permutations make every coordinate of a signature: the first spreads shingles over
the 32-bit circle, the second is applied after the circle is turned by 0, 1, 2, ... places.
Signatures are cut into ``BANDS`` bands of ``ROWS``; documents that agree in a band meet in a bucket. At
similarity 0.85 a pair misses all bands with probability 1e-8.

Buckets never turn into all their pairs:

1. Documents with the same shingle set are one node.
2. In each bucket every node is compared with the node that is in the most company (the one
   whose buckets are largest, so the centre of a group of copies). Links make components. Buckets
   that still hold several do the same with other nodes, ``STARS`` times in all.
3. Only pairs of a bucket that are still in different components are left. Small buckets
   compare them directly. In a crowded bucket a node that fails the centre has few possible
   partners. Either both hold a shingle that at most ``SMALL`` nodes hold. With such shingles
   put first in one order for all nodes, the first that a pair has in common is within the prefix
   that the similarity leaves each of them, and they meet by that prefix if sizes and places
   allow. Or, with ``s`` of its shingles frequent, the intersection is at most ``s``, which
   bounds the size of a partner, and they meet by bucket and size.

A pair is made only if its parity sketches allow it: a node has ``PARITY`` bits, each the parity of
the shingles that hash to it, and two sets differ in at least as many shingles as bits. The test is
exact and part of the joins, so nodes of a crowded bucket that are similar, but not enough, make no rows.

Candidates must agree in ``AGREE`` of all coordinates (kept as one byte each) before texts move;
a pair at 0.85 falls short of that with probability 1e-8. Links are confirmed on full
sets. Components spread by smallest labels through joins.

Defined cases: null or wordless text is empty and linked with nothing; fewer words than a
shingle are one shingle; repeated rows are one node and share a component; a null id
counts as the largest; an empty table gives an empty result; other columns are ignored here
and kept by ``drop_near_copies``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import arrays
from llm.common import BitFilter, rows_of, stage

SHINGLE = 3
PERCENT = 85
BANDS = 25
ROWS = 4
AGREE = 60
#: Buckets up to this size compare all nodes of different components directly.
SMALL = 32
#: Times that a bucket's nodes are compared with one of them before other pairs are made.
STARS = 3
#: Bits of a parity sketch, 64 to a column.
PARITY = 256
_PARITY = [f"parity_{i}" for i in range(PARITY // 64)]
_LAST = np.iinfo(np.int64).max


def _second(x: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    folded = arrays.fold_ascii(data)
    start, end, first = arrays.words(folded, offsets, arrays.NOT_SPACE)
    hasher = arrays.Hasher(arrays.word_hashes(folded, start, end))
    grams = hasher.grams(size)
    sets = []
    for f, t in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if t - f >= size:
            sets.append(np.unique(grams[f : t - size + 1]))
        else:
            sets.append(hasher.spans(np.array([f]), np.array([t]))[: t - f])
    return sets


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """A row of ``length`` coordinates for each (not empty) set."""
    shingles = np.concatenate(sets)
    first = np.cumsum([0] + [len(x) for x in sets[:-1]])
    circle = (shingles >> np.uint64(32)).astype(np.uint32)  # the first permutation
    out = np.empty((len(sets), length), np.uint32)
    for turn in range(length):
        out[:, turn] = np.minimum.reduceat(_second(circle + np.uint32(turn)), first)
    return out


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``PARITY`` bits for each (not empty) set: how often its shingles hit each, modulo 2."""
    shingles = np.concatenate(sets)
    first = np.cumsum([0] + [len(x) for x in sets[:-1]])
    bit = np.uint64(1) << (shingles & np.uint64(63))
    word = (shingles >> np.uint64(6)) % np.uint64(len(_PARITY))
    return np.stack(
        [np.bitwise_xor.reduceat(bit * (word == np.uint64(i)), first) for i in range(len(_PARITY))], 1
    )


def _sign(size: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            n, node, band, sketch, parity = [], [], [], [], []
            for _, _, data, offsets in arrays.blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                full = np.flatnonzero([len(x) > 0 for x in sets])
                n += [len(x) for x in sets]
                keys = np.zeros(len(sets), np.int64)
                odd = np.zeros((len(sets), len(_PARITY)), np.uint64)
                here: list = [None] * len(sets)
                seen: list = [None] * len(sets)
                if len(full):
                    some = [sets[i] for i in full]
                    sums = np.add.reduceat(
                        arrays.mix(np.concatenate(some)),
                        np.cumsum([0] + [len(x) for x in some[:-1]]),
                    )
                    keys[full] = arrays.mix(sums).view(np.int64)
                    odd[full] = parities(some)
                    sig = signatures(some, bands * rows)
                    for b in range(bands):
                        part = sig[:, b * rows : (b + 1) * rows].astype(np.uint64)
                        key = np.full(len(some), b, np.uint64)
                        for j in range(rows):
                            key = arrays.mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, j])
                        band.append(key)
                    stacked = np.stack(band[-bands:], 1).view(np.int64)
                    del band[-bands:]
                    small = sig.astype(np.uint8)
                    for i, keyed, short in zip(full.tolist(), stacked, small, strict=True):
                        here[i], seen[i] = keyed, short.tobytes()
                node.append(keys)
                parity.append(odd)
                band += here
                sketch += seen
            parity = np.concatenate(parity) if parity else np.zeros((0, len(_PARITY)), np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("th"), pa.array(n, pa.int64())]
                + [pa.array(np.concatenate(node) if node else np.zeros(0, np.int64))]
                + [pa.array(band, pa.list_(pa.int64())), pa.array(sketch, pa.binary())]
                + [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in parity.T],
                ["doc", "th", "n", "node", "bands", "sketch", *_PARITY],
            )

    return run


def _agreement(batches):
    """Pairs whose sketches agree in enough coordinates."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint8).reshape(
                batch.num_rows, -1
            )
            for x in ("sketch_a", "sketch_b")
        )
        same = (a == b).sum(1) * 100 >= AGREE * a.shape[1]
        yield batch.select(["a", "b"]).filter(pa.array(same))


def _linked(size: int, percent: int):
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
            on = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for i in on], pa.int64()) for x in (a, b)], ["a", "b"]
            )

    return run


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that links (a, b) reach, for every node with a link.

    A round takes one aggregation of the labels of a node and of its neighbours, and one join that
    follows labels; it ends at the first aggregation that changes none.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(links.select(F.explode(ways).alias("way")).select("way.*"), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = stage(labels.select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        own = labels.select("node", "label", F.col("label").alias("was"))
        told = both.join(labels.withColumnRenamed("node", "a"), "a").select(
            F.col("b").alias("node"), "label", F.lit(None).cast("long").alias("was")
        )
        heard = own.unionByName(told).groupBy("node").agg(
            F.min("label").alias("label"), F.min("was").alias("was")
        )
        heard = stage(heard, "heard")
        if heard.where("label < was").isEmpty():
            return labels
        jump = heard.select(F.col("node").alias("label"), F.col("label").alias("further"))
        labels = stage(
            heard.join(jump, "label", "left").select(
                "node", F.coalesce("further", "label").alias("label")
            ),
            "labels",
        )


def _further(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of ``components`` when more links are known: one link a node stands for those before."""
    known = labels.where("node != label").select(F.col("node").alias("a"), F.col("label").alias("b"))
    return components(known.unionByName(links.select("a", "b")))


class _Search:
    def __init__(self, docs: DataFrame, size: int, percent: int, bands: int, rows: int, small: int):
        self.size, self.percent, self.small = size, percent, small
        self.rows = docs.select("doc", F.xxhash64("text").alias("th"), "text")
        schema = "doc long, th long, n long, node long, bands array<long>, sketch binary"
        schema += "".join(f", {x} long" for x in _PARITY)
        self.signed = stage(self.rows.mapInArrow(arrays.release_after(_sign(size, bands, rows)), schema), "signed")

    def nodes(self) -> DataFrame:
        """One row per distinct set that is not empty, with a text that has it."""
        full = self.signed.where("n > 0")
        least = full.groupBy("node").agg(F.min(F.coalesce("doc", F.lit(_LAST))).alias("doc"))
        full = full.withColumn("doc", F.coalesce("doc", F.lit(_LAST)))
        return full.join(least, ["node", "doc"]).dropDuplicates(["node"])

    def pairs_close(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) that sizes and sketches allow."""
        each = nodes.select("node", "sketch")
        drawn = pairs.join(
            each.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b"
        ).join(each.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        return drawn.mapInArrow(_agreement, "a long, b long")

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        drawn = pairs.join(
            texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
        ).join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        return drawn.mapInArrow(arrays.release_after(_linked(self.size, self.percent)), "a long, b long")

    def fits(self, a: str, b: str) -> Column:
        """Sizes and parities (columns named by a pattern for each node) that allow the similarity."""
        size, other = F.col(a.format("n")), F.col(b.format("n"))
        near = F.least(size, other) * 100 >= F.greatest(size, other) * self.percent
        bits = [F.bit_count(F.col(a.format(x)).bitwiseXOR(F.col(b.format(x)))) for x in _PARITY]
        # sets of i shingles in common differ in size + other - 2 * i
        return near & (sum(bits[1:], bits[0]) * (100 + self.percent) <= (size + other) * (100 - self.percent))

    def labels(self) -> DataFrame:
        """``node, label`` of every node with a link: the smallest node of its component."""
        nodes = stage(self.nodes(), "nodes")
        each = nodes.select("node", "n", *_PARITY, F.explode("bands").alias("key"))
        buckets = stage(
            each.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "buckets"
        )
        maybe = BitFilter(buckets, "key").column(F.col("key"))
        members = stage(each.where(maybe).join(buckets, "key"), "members")
        company = members.groupBy("node").agg(F.sum("size").alias("company"), F.first("n").alias("n"))
        company = stage(company, "company")
        # the centre of a bucket: packed so that the largest company, then the smallest node wins
        ranked = members.join(company.select("node", "company"), "node")
        centre = ranked.groupBy("key").agg(
            F.max_by(F.struct("node", "n", *_PARITY), F.struct("company", -F.col("node"))).alias("centre")
        )
        star = (
            members.join(centre, "key")
            .where((F.col("node") != F.col("centre.node")) & self.fits("{}", "centre.{}"))
            .select(F.col("centre.node").alias("a"), F.col("node").alias("b"))
            .distinct()
        )
        used = nodes.join(company, "node", "left_semi")
        used = stage(used.select("node", "doc", "th", "n", "sketch"), "holders")
        holders = used.select("node", "doc", "th")
        key = F.xxhash64("doc", "th")
        wanted = BitFilter(holders.select(key.alias("key")), "key")
        keyed = self.rows.withColumn("doc", F.coalesce("doc", F.lit(_LAST)))
        texts = stage(
            keyed.where(wanted.column(key))
            .join(holders, ["doc", "th"])
            .dropDuplicates(["node"])
            .select("node", "text"),
            "texts",
        )
        labels = components(self.confirmed(self.pairs_close(star, used), texts))
        open_ = self._open(members, labels)
        for turn in range(1, STARS):
            if open_.isEmpty():
                return labels
            other = open_.groupBy("key").agg(
                F.max_by(
                    F.struct("node", "n", "label", *_PARITY), F.xxhash64("key", "node", F.lit(turn))
                ).alias("mid")
            )
            pairs = (
                open_.join(other, "key")
                .where((F.col("label") != F.col("mid.label")) & self.fits("{}", "mid.{}"))
                .select(F.least("node", "mid.node").alias("a"), F.greatest("node", "mid.node").alias("b"))
                .distinct()
            )
            more = stage(self.confirmed(self.pairs_close(pairs, used), texts), "more")
            if not more.isEmpty():
                labels = _further(labels, more)
                open_ = self._open(open_.drop("label"), labels)  # components only grow
        rest = self._direct(open_)
        crowded = stage(open_.where(F.col("size") > self.small), "crowded")
        if not crowded.isEmpty():
            rest = rest.unionByName(self._crowded(crowded, centre, texts))
        last = stage(self.confirmed(self.pairs_close(rest.distinct(), used), texts), "last")
        return labels if last.isEmpty() else _further(labels, last)

    def _open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Members with their component, in buckets with several."""
        label = F.coalesce("label", "node").alias("label")
        placed = members.join(labels, "node", "left").select(*members.columns, label)
        placed = stage(placed, "placed")
        several = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        return stage(placed.join(several.where("low != high").select("key"), "key"), "open")

    def _direct(self, open_: DataFrame) -> DataFrame:
        """Pairs of different components in small buckets."""
        few = open_.where(F.col("size") <= self.small).select("key", "node", "n", "label", *_PARITY)
        other = few.select("key", *[F.col(x).alias(f"{x}_b") for x in ("node", "n", "label", *_PARITY)])
        return (
            few.join(other, "key")
            .where("label != label_b AND node < node_b")
            .where(self.fits("{}", "{}_b"))
            .select(F.col("node").alias("a"), F.col("node_b").alias("b"))
        )

    def _crowded(self, crowded: DataFrame, centre: DataFrame, texts: DataFrame) -> DataFrame:
        """Pairs of different components in crowded buckets, as far as shared shingles allow.

        A pair either has a shingle in common that few nodes hold, and meets there, or its
        intersection is at most the number of frequent shingles that either has.
        """
        many = crowded.select("key", "node", "n", "label", *_PARITY)
        middle = centre.select("key", F.col("centre.node").alias("mid"))
        labelled = many.select(F.col("node").alias("mid"), "key", F.col("label").alias("mid_label"))
        core = middle.join(labelled, ["key", "mid"]).select("key", "mid_label")
        here = many.select("node", "label", *_PARITY).distinct()
        own = texts.join(here, "node", "left_semi")
        counted = stage(
            own.select("text").mapInArrow(_count_shingles(self.size), "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1"),
            "shared",
        )
        frequent = BitFilter(counted.where(F.col("n") > self.small).select("shingle"), "shingle")
        few = counted.where(F.col("n") <= self.small).select("shingle")
        seldom = BitFilter(few, "shingle")
        schema = "node long, n long, s long, seldom array<long>"
        search = _shared_shingles(self.size, self.percent, frequent, seldom)
        bound = stage(own.mapInArrow(search, schema), "bound")
        # a pair that several buckets hold is made in the first of them only
        buckets = many.groupBy("node").agg(F.collect_set("key").alias("keys"))
        known = many.join(bound.select("node", "s"), "node").join(buckets, "node")
        outside = stage(known.join(core, "key").where("label != mid_label"), "outside")

        p = self.percent
        # intersection >= p/(100+p) * (|x|+|y|), and it is at most s(x)
        most = F.floor(F.col("s") * (100 + p) / p).cast("long") - F.col("n")
        sizes = (
            outside.withColumn("low", F.ceil(F.col("n") * p / 100).cast("long"))
            .withColumn("high", F.least(most, F.floor(F.col("n") * 100 / p).cast("long")))
            .where("low <= high")
            .select(
                *("key", "node", "n", "label", "keys", *_PARITY),
                F.explode(F.sequence("low", "high")).alias("n_b"),
            )
        )
        columns = ("node", "n", "label", "s", "keys", *_PARITY)
        other = known.select("key", *[F.col(x).alias(f"{x}_b") for x in columns])
        need = (F.col("n") + F.col("n_b")) * p <= F.col("s_b") * (100 + p)
        first = F.array_min(F.array_intersect("keys", "keys_b")) == F.col("key")
        by_size = (
            sizes.join(other, ["key", "n_b"])
            .where("label != label_b")
            .where(need & self.fits("{}", "{}_b"))
            .where(first)
        )

        held = (
            bound.join(here, "node")
            .select("node", "n", "label", *_PARITY, F.posexplode("seldom").alias("at", "shingle"))
            .join(few, "shingle", "left_semi")
        )
        left = held.join(outside.select("node").distinct(), "node", "left_semi")
        other = held.select("shingle", *[F.col(x).alias(f"{x}_b") for x in ("node", "n", "label", "at", *_PARITY)])
        # of the first shingle in common, all others in common come after it on both sides
        after = F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b"))
        enough = (F.col("n") + F.col("n_b")) * p <= after * (100 + p)
        by_shingle = (
            left.join(other, "shingle")
            .where("label != label_b")
            .where(self.fits("{}", "{}_b") & enough)
        )
        a, b = F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")
        return by_size.select(a, b).unionByName(by_shingle.select(a, b))


def _count_shingles(size: int, flush: int = 1_000_000):
    def run(batches):
        held, n = [], 0
        for batch in batches:
            for _, _, data, offsets in arrays.blocks(batch.column("text")):
                sets = shingle_sets(data, offsets, size)
                held += sets
                n += sum(map(len, sets))
                if n >= flush:
                    yield _counted(held)
                    held, n = [], 0
        if held:
            yield _counted(held)

    return run


def _counted(sets: list[np.ndarray]) -> pa.RecordBatch:
    key, n = np.unique(np.concatenate(sets), return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "n"]
    )


def _shared_shingles(size: int, percent: int, frequent: BitFilter, seldom: BitFilter):
    """Set size, how many frequent shingles a node may have, and the seldom ones of its prefix.

    Seldom shingles come first, by hash, in the order that all nodes share. A set of ``n`` that
    has ``m`` shingles in common with another holds one of them among its first ``n - m + 1``.
    """

    def run(batches):
        for batch in batches:
            n, s, rare = [], [], []
            for _, _, data, offsets in arrays.blocks(batch.column("text")):
                for own in shingle_sets(data, offsets, size):
                    many = frequent.contains(own)
                    n.append(len(own))
                    s.append(int(many.sum()))
                    prefix = len(own) - -(-len(own) * percent // 100) + 1
                    rare.append(own[seldom.contains(own) & ~many][:prefix].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(n, pa.int64()), pa.array(s, pa.int64())]
                + [pa.array(rare, pa.list_(pa.int64()))],
                ["node", "n", "s", "seldom"],
            )

    return run


def near_copies(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    small: int = SMALL,
) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept, th`` (``th``: hash of the text)."""
    search = _Search(rows_of(docs, id_col, text_col), shingle, percent, BANDS, ROWS, small)
    labels = search.labels()
    signed = search.signed.select("doc", "th", "n", "node")
    classes = (
        signed.where("n > 0").groupBy("node").agg(F.min("doc").alias("least"))
        .join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    lowest = classes.groupBy("label").agg(F.min("least").alias("component"))
    of = classes.join(lowest, "label").select("node", "component")
    out = signed.join(of, "node", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component_id"),
        "th",
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "th")


def drop_near_copies(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, with one document of each group of near copies.

    Rows that can go are found by a bit filter; all others pass without a shuffle. Of
    repeated rows of the document that stays, all stay (exact dedup is for those).
    """
    found = near_copies(docs, shingle, percent, id_col, text_col)
    gone = stage(found.where("NOT kept").select("doc_id", "th").distinct(), "gone")
    key = F.xxhash64("id", "th")
    maybe = BitFilter(gone.select(F.xxhash64("doc_id", "th").alias("key")), "key").column(key)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    flagged = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th")
    ).withColumn("maybe", maybe)
    match = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("th") == F.col("gone_th"))
    left = flagged.where("maybe").join(gone.withColumnRenamed("th", "gone_th"), match, "left_anti")
    return flagged.where(~F.col("maybe")).select("row.*").unionByName(left.select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("th")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(ws[p : p + 2], ' ')) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 2) + 1)) AS p
        FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT i.a, i.b FROM i JOIN n x ON x.doc_id = i.a JOIN n y ON y.doc_id = i.b
  WHERE 100 * i.i >= 85 * (x.n + y.n - i.i)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(root, doc_id) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT r.root, e.b FROM r JOIN e ON r.doc_id = e.a
), c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id,
       w.doc_id = component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
