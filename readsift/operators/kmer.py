"""k-mer index of genomes, read classification, and the report per clade."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from readsift.functions.kmers import count_kmers, kmer_lists, kmer_spans, kmers, listed_rows
from readsift.operators.joins import dimension_join
from readsift.operators.taxonomy import taxon_closure
from readsift.session import INDEX_TABLE, shuffles_freed, stage, staging_path, write_staged

K = 31
CONFIDENCE = 0.2
# k-mers that are looked at for those of a great part of all reads, and how great a part.
HOT_SAMPLE = 2_000_000
HOT_SHARE = 0.01
READ = ["id", "sample"]
# k-mers of reads that are looked up in one round, and the most rounds, each of which reads the index.
ROUND_KMERS = 1 << 29
MAX_ROUNDS = 16
# Rows of k-mers that one task adds up, and letters that are looked at to tell how many there are.
PART_ROWS = 2_000_000
PART_SAMPLE = 16_000_000


def database_tree(taxa: DataFrame) -> DataFrame:
    """The (ancestor, descendant) table of a database's one tree, stored, without a sample.

    ``taxa`` is one report: columns line_no, level_num, tax_rank and taxid. Reports of
    several samples mixed together, or a taxid on two lines, are an error.
    """
    one = taxa.select(F.lit("tree").alias("sample"), "line_no", "level_num", "tax_rank", "taxid")
    closure = stage(taxon_closure(one).drop("sample"), "closure")
    twice = closure.groupBy("descendant", "ancestor").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError("the tree of a database must have each taxid once")
    return closure


def index_parts(contigs: DataFrame, k: int = K) -> int:
    """Parts of about ``PART_ROWS`` k-mer rows that the index of these contigs is made in.

    Rows are counted in a sample of about ``PART_SAMPLE`` letters; results do not depend on it.
    """
    size = F.col("letters") if "letters" in contigs.columns else F.length("seq")
    letters = contigs.agg(F.sum(size)).first()[0] or 0
    share = min(1.0, PART_SAMPLE / max(letters, 1))
    some = contigs.select("seq", F.lit(0).alias("line")).sample(share, seed=1)
    return max(1, math.ceil(kmer_spans(some, k, "line").count() / share / PART_ROWS))


def kmer_index(
    contigs: DataFrame,
    taxonomy: DataFrame,
    closure: DataFrame,
    k: int = K,
    parts: int | None = None,
) -> DataFrame:
    """Canonical k-mer and the lowest common ancestor of the taxa that hold it.

    Taxa are numbered by their pre-order line before k-mers are made. The common ancestor
    of any set of taxa is that of its first and last line, so each k-mer needs just two
    numbers: a fixed-width min and max, added up before the shuffle even where
    thousands of genomes share a k-mer. Only distinct (first, last) pairs meet the tree.

    They are added up per slice before the shuffle and per k-mer after it, in ``parts`` parts
    (``index_parts``), so what a task holds does not grow with the genomes.
    """
    parts = parts or index_parts(contigs, k)
    tree = closure.select("ancestor", "ancestor_depth", "line_no")
    lines = closure.where(F.col("distance") == 0).select(
        F.col("descendant").alias("id"), F.col("line_no").alias("line")
    )
    numbered = dimension_join(
        taxonomy.where(F.col("id").isNotNull()).select("accession", "id"),
        lines,
        ["id"],
        how="inner",
    )
    # an outer join never sends the letters to all tasks, however well their files compress, and
    # with the numbers as the hash table no task sorts letters
    numbered = numbered.hint("shuffle_hash")
    named = contigs.select("accession", "seq").join(numbered, "accession", "left")
    spans = kmer_spans(named, k, "line").repartition(parts, "kmer").groupBy("kmer").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    pairs = spans.select("lo", "hi").distinct()
    above_lo = tree.select("ancestor", "ancestor_depth", F.col("line_no").alias("lo"))
    above_hi = tree.select("ancestor", F.col("line_no").alias("hi"))
    shared = dimension_join(pairs, above_lo, ["lo"], how="inner")
    common = dimension_join(shared, above_hi, ["hi", "ancestor"], how="inner")
    lca = common.groupBy("lo", "hi").agg(F.max_by("ancestor", "ancestor_depth").alias("taxid"))
    return dimension_join(spans, lca, ["lo", "hi"], how="inner").select(
        "kmer", "taxid"
    )


def store_index(index: DataFrame, buckets: int | None = None) -> DataFrame:
    """The index as a table bucketed and sorted by k-mer, in the staging folder.

    Whatever is joined with it on ``kmer`` is dealt to its buckets, and the index itself is never
    shuffled again. There are as many buckets as shuffle partitions, or the number given.
    """
    spark = index.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{INDEX_TABLE}_{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        (
            index.repartition(buckets, "kmer")
            .write.bucketBy(buckets, "kmer").sortBy("kmer")
            .option("path", staging_path(spark, "index")).saveAsTable(table)
        )
    return spark.table(table)


def hot_kmers(reads: DataFrame, k: int = K, total: int | None = None) -> list[int]:
    """k-mers that make up ``HOT_SHARE`` of a sample of reads with about ``HOT_SAMPLE`` k-mers.

    ``reads`` has seq and n_kmers, ``total`` in all. At most about 1 / ``HOT_SHARE`` numbers come back. They are
    matched apart, so that no bucket gathers the reads of a k-mer that a great part of all reads hold.
    Results do not depend on them.
    """
    if total is None:
        total = reads.agg(F.sum("n_kmers")).first()[0] or 0
    share = min(1.0, HOT_SAMPLE / max(total, 1))
    some = reads.select("seq").sample(share, seed=1)
    counts = kmers(some, k, keep=[]).groupBy("kmer").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") >= max(2, HOT_SHARE * share * total))
    return [r.kmer for r in hot.select("kmer").collect()]


@dataclass
class Matches:
    """k-mers of reads that the index knows, as stored tables.

    ``reads`` has sample, id, read_no and n_kmers (valid k-mers) of every row of reads. ``found`` has
    kmer, taxid, the number of the sample and the numbers of the reads that hold the k-mer (row,
    more), how many these are (n) and the round they were found in. ``samples`` has the name of each number. A read is in
    one of ``rounds`` rounds with all its rows.
    """

    reads: DataFrame
    found: DataFrame
    samples: DataFrame
    rounds: int = 1

    def kmers(self) -> DataFrame:
        """sample, taxid, kmer, n: how often a known k-mer occurs, in parts that add up."""
        parts = self.found.select("sample_no", "taxid", "kmer", "n")
        return dimension_join(parts, self.samples, ["sample_no"]).drop("sample_no")

    def hits(self, turn: int | None = None) -> DataFrame:
        """Known k-mers per read and taxon: sample, id, taxid, hits, n_kmers, n_taxa.

        With ``turn`` only of the reads of that round. Rows of one id, such as mates, are one read. Each read has a row without a taxon as well.
        ``n_kmers`` are the valid k-mers of the read and ``n_taxa`` its taxa.
        """
        reads, found = self.reads, self.found
        if turn is not None:
            reads, found = reads.where(_round(self.rounds) == turn), found.where(F.col("round") == turn)
        each = found.select(F.explode(listed_rows()).alias("read_no"), "taxid")
        per_row = each.repartition("read_no").groupBy("read_no", "taxid").agg(
            F.count(F.lit(1)).alias("hits")
        )
        none = F.lit(0).cast("long")
        known = per_row.join(reads.select("read_no", *READ), "read_no").select(
            *READ, "taxid", "hits", none.alias("valid")
        )
        valid = reads.select(
            *READ, F.lit(None).cast("int").alias("taxid"), none.alias("hits"), F.col("n_kmers").alias("valid")
        )
        # dealt by read at once: this serves the sums as well as the windows
        rows = known.unionByName(valid).repartition(*READ).groupBy(*READ, "taxid").agg(
            F.sum("hits").alias("hits"), F.sum("valid").alias("valid")
        )
        per_read = Window.partitionBy(*READ)
        return (
            rows.withColumn("n_taxa", F.count("taxid").over(per_read))
            .withColumn("n_kmers", F.sum("valid").over(per_read))
            .drop("valid")
        )


def _round(rounds: int) -> Column:
    """Round of a read, the same for all rows of one id."""
    return F.pmod(F.xxhash64(*READ), F.lit(rounds)).cast("int")


def kmer_matches(reads: DataFrame, index: DataFrame, k: int = K) -> Matches:
    """All k-mers of all reads looked up in the index, once.

    Reads are numbered and stored. Their k-mers travel as inverted lists, one row per distinct
    k-mer of a batch with the numbers of its reads. A bucketed index (``store_index``) is not
    moved. k-mers of a great part of all reads meet their few index rows apart.

    This goes by rounds of about ``ROUND_KMERS`` k-mers, each with a part of the reads, so that only
    those of one round lie on disk as shuffled rows.
    """
    named = [F.xxhash64("sample").alias("sample_no"), *READ, "seq"]
    numbered = reads.select(F.monotonically_increasing_id().alias("read_no"), *named)
    stored = stage(count_kmers(numbered, k), "reads")
    low, high = F.min("sample").alias("sample"), F.max("sample").alias("high")
    clash = F.raise_error(F.lit("two samples share a number")).cast("string")
    one = F.when(F.col("sample") == F.col("high"), F.col("sample"))
    one = one.when(F.col("high").isNotNull(), clash).alias("sample")
    samples = stored.groupBy("sample_no").agg(low, high).select("sample_no", one)
    samples = stage(samples, "samples")
    total = stored.agg(F.sum("n_kmers")).first()[0] or 0
    rounds = min(MAX_ROUNDS, max(1, math.ceil(total / ROUND_KMERS)))
    hot = hot_kmers(stored, k, total)
    is_hot = F.col("kmer").isin(hot) if hot else F.lit(False)
    path = staging_path(stored.sparkSession, "found")
    for turn in range(rounds):
        part = stored.where(_round(rounds) == turn) if rounds > 1 else stored
        lists = kmer_lists(part, k, "read_no", "sample_no")
        found = lists.where(~is_hot).join(index.where(~is_hot), "kmer")
        if hot:  # at most 1 / HOT_SHARE rows of the index
            few = index.where(is_hot)
            found = found.unionByName(lists.where(is_hot).join(F.broadcast(few), "kmer"))
        n = F.greatest(1 + F.coalesce(F.size("more"), F.lit(0)).cast("long"), F.lit(1)).alias("n")
        found = found.select("sample_no", "kmer", "taxid", "row", "more", n)
        write_staged(found, f"{path}/round={turn}")
    schema = StructType([*found.schema.fields, StructField("round", IntegerType())])
    found = stored.sparkSession.read.schema(schema).parquet(path)
    return Matches(stored.drop("seq", "sample_no"), found, samples, rounds)


def classify_reads(
    reads: DataFrame,
    index: DataFrame,
    closure: DataFrame,
    k: int = K,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """Taxid and number of valid k-mers of every read; 0 is unclassified."""
    return classify_matches(kmer_matches(reads, index, k), closure, confidence)


def classify_matches(
    matches: Matches, closure: DataFrame, confidence: float = CONFIDENCE
) -> DataFrame:
    """Taxid and number of valid k-mers of every read; 0 is unclassified.

    A taxon scores the hits on its path from the root, and the highest score wins, ties
    going to their common ancestor. From there the read moves up until the hits in the
    clade reach ``confidence`` of its valid k-mers.

    A read with hits in one taxon only is decided at once: all its clades hold the same hits.
    The others meet their paths, and windows score them. Several rounds are called one by one.
    """
    if matches.rounds == 1:
        return _classify_hits(matches.hits(), closure, confidence)
    return reduce(
        DataFrame.unionByName,
        [
            stage(_classify_hits(matches.hits(turn), closure, confidence), "calls")
            for turn in range(matches.rounds)
        ],
    )


def _classify_hits(hits: DataFrame, closure: DataFrame, confidence: float) -> DataFrame:
    """Call of every read from its hits per taxon."""
    counted = stage(hits, "read_hits")
    known = F.when(F.col("taxid").isNotNull(), F.col("hits"))
    one_taxon = (
        counted.where(F.col("n_taxa") <= 1)
        .groupBy(*READ)
        .agg(F.max("taxid").alias("only"), F.max(known).alias("own"), F.max("n_kmers").alias("n_kmers"))
        .withColumn("taxid", F.when(F.try_divide("own", "n_kmers") >= confidence, F.col("only")))
        .select(*READ, F.coalesce("taxid", F.lit(0)).alias("taxid"), "n_kmers")
    )
    several = counted.where((F.col("n_taxa") > 1) & F.col("taxid").isNotNull())
    return one_taxon.unionByName(_best_taxon(several, closure, confidence))


def _best_taxon(hits: DataFrame, closure: DataFrame, confidence: float) -> DataFrame:
    """Call of every read from its hits per taxon, by path score, ties and confidence."""
    tree = closure.groupBy(F.col("descendant").alias("taxid")).agg(
        F.collect_list(F.struct("ancestor", "ancestor_depth")).alias("path")
    )
    # dealt by read once, and only then a row for each ancestor: all windows below stay in place
    dealt = dimension_join(hits, tree, ["taxid"], how="inner").repartition(*READ)
    paths = dealt.select("*", F.inline("path")).drop("path")
    own = F.when(F.col("ancestor") == F.col("taxid"), F.col("hits"))
    per_read = Window.partitionBy(*READ)
    per_clade = Window.partitionBy(*READ, "ancestor")
    per_taxon = Window.partitionBy(*READ, "taxid")
    scored = (
        paths.withColumn("own", own)
        .withColumn("clade", F.sum("hits").over(per_clade))
        .withColumn("own_clade", F.sum("own").over(per_clade))
        .withColumn("score", F.sum("own_clade").over(per_taxon))
        .withColumn("tied", F.col("score") == F.max("score").over(per_read))
        .withColumn(
            "ties", F.sum(F.when(F.col("tied") & F.col("own").isNotNull(), 1)).over(per_read)
        )
        .withColumn("covers", F.sum(F.when(F.col("tied"), 1)).over(per_clade))
    )
    enough = F.try_divide("clade", "n_kmers") >= confidence
    fit = F.col("tied") & (F.col("covers") == F.col("ties")) & enough
    best = F.max_by(F.when(fit, F.col("ancestor")), F.when(fit, F.col("ancestor_depth")))
    return scored.groupBy(*READ).agg(
        F.coalesce(best, F.lit(0)).alias("taxid"), F.max("n_kmers").alias("n_kmers")
    )


def clade_report(
    assignments: DataFrame,
    closure: DataFrame,
    kmers_found: DataFrame | None = None,
    approximate: bool = False,
    rounds: int = 1,
) -> DataFrame:
    """Reads of every taxon and of its clade, with the percentage of the sample's reads.

    With ``kmers_found``, the rows of ``Matches.kmers``, also k-mers and distinct k-mers of the clade;
    ``approximate`` estimates the latter and ``rounds`` goes by parts of them. All rows are added up
    per taxid before they meet the tree, so no taxid is hot in the join. A tree without ``sample``
    serves all samples.
    """
    counts = assignments.groupBy("sample", "taxid").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("sample").agg(F.sum("n").alias("total"))
    on = ["sample", "taxid"] if "sample" in closure.columns else ["taxid"]
    tree = closure.select(
        *on[:-1], F.col("ancestor").alias("clade"), F.col("descendant").alias("taxid"), "distance"
    )
    clades = (
        dimension_join(counts, tree, on, how="inner")
        .groupBy("sample", "clade")
        .agg(
            F.sum("n").alias("clade_reads"),
            F.coalesce(F.sum(F.when(F.col("distance") == 0, F.col("n"))), F.lit(0)).alias(
                "taxon_reads"
            ),
        )
    )
    out = dimension_join(clades, totals, ["sample"]).select(
        "sample",
        F.col("clade").alias("taxid"),
        "clade_reads",
        "taxon_reads",
        (F.lit(100.0) * F.col("clade_reads") / F.col("total")).alias("percentage"),
    )
    if kmers_found is None:
        return out
    zero = {"n_kmers": 0, "n_unique_kmers": 0}
    by_clade = clade_kmers(kmers_found, closure, approximate, rounds)
    return out.join(by_clade, ["sample", "taxid"], "left").fillna(zero)


def clade_kmers(
    known: DataFrame, closure: DataFrame, approximate: bool = False, rounds: int = 1
) -> DataFrame:
    """k-mers and distinct k-mers of every clade that has any, of the rows of ``Matches.kmers``.

    A k-mer stands for one taxon, so the distinct k-mers of a clade are the sum over its taxa. With
    ``rounds`` they are told apart in as many parts of all k-mers, one after the other.
    """
    if approximate:
        sums = known.groupBy("sample", "taxid").agg(
            F.sum("n").alias("n"), F.approx_count_distinct("kmer").alias("n_unique")
        )
    elif rounds == 1:
        sums = _taxon_kmers(known)
    else:
        turn_of = F.pmod(F.xxhash64("kmer"), F.lit(rounds))
        parts = [stage(_taxon_kmers(known.where(turn_of == turn)), "sums") for turn in range(rounds)]
        sums = reduce(DataFrame.unionByName, parts)
    on = ["sample", "taxid"] if "sample" in closure.columns else ["taxid"]
    tree = closure.select(
        *on[:-1], F.col("ancestor").alias("clade"), F.col("descendant").alias("taxid")
    )
    return (
        dimension_join(sums, tree, on, how="inner")
        .groupBy("sample", F.col("clade").alias("taxid"))
        .agg(F.sum("n").alias("n_kmers"), F.sum("n_unique").alias("n_unique_kmers"))
    )


def _taxon_kmers(known: DataFrame) -> DataFrame:
    """k-mers and distinct k-mers of every taxon itself."""
    each = known.groupBy("sample", "taxid", "kmer").agg(F.sum("n").alias("n"))
    return each.groupBy("sample", "taxid").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_unique")
    )
