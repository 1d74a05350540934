"""Selection of reads by the taxon assigned to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from readsift.functions import id_base
from readsift.operators.idfilter import keep_candidates
from readsift.operators.joins import dimension_join
from readsift.operators.prefix import BLOCK_ROWS, running_sum
from readsift.operators.taxonomy import descendants, expand_taxa
from readsift.session import stage
from readsift.sinks.writers import count_written, write_reads

# Samples whose reads are counted by the job that writes them.
OBSERVED = 200


def select_assignments(
    assignments: DataFrame,
    taxids: Sequence[int],
    closure: DataFrame | None = None,
    children: bool = False,
    parents: bool = False,
    exclude: bool = False,
) -> DataFrame:
    """Assignment rows whose taxid is in the expanded set, or with ``exclude`` is not."""
    flagged = _flag(assignments, taxids, closure, children, parents, exclude)
    return flagged.where("_wanted").drop("_wanted")


def _flag(assignments, taxids, closure, children, parents, exclude) -> DataFrame:
    """All assignment rows, ``_wanted`` telling which are selected."""
    inside = F.col("taxid").isin(list(taxids))
    if children or parents:
        if closure is None:
            raise ValueError("including children or parents needs the closure of a report")
        more = expand_taxa(closure, taxids, children, parents).withColumn("_more", F.lit(True))
        assignments = dimension_join(assignments, more, ["taxid", "sample"])
        inside = inside | F.coalesce("_more", F.lit(False))
    return assignments.withColumn("_wanted", ~inside if exclude else inside).drop("_more")


def first_ids(
    selected: DataFrame, max_reads: int | None = None, block: int = BLOCK_ROWS
) -> DataFrame:
    """Distinct read ids per sample; with ``max_reads`` the first ones in file order.

    File order is (file, line_no) where the rows name their file, else line_no.
    The n-th id is found by a running count over blocks of lines, so a large limit
    neither sorts a sample in one task nor passes it through the driver.
    """
    if max_reads is None:
        return selected.select("sample", "read_id")
    order = [c for c in ("file", "line_no") if c in selected.columns]
    first = F.min(F.struct(*order)).alias("first")
    ids = selected.groupBy("read_id", "sample").agg(first).select("read_id", "sample", "first.*")
    numbered = running_sum(ids, ["sample"], order, F.lit(1), "_n", tie=["read_id"], block=block)
    return numbered.where(F.col("_n") <= max_reads).select("sample", "read_id")


def _mate_mark(full: Column, base: Column) -> Column:
    return F.substring(full, F.length(base) + 1, F.lit(2))


def match_reads(
    reads: DataFrame,
    ids: DataFrame,
    target: Sequence[str] = (),
    anywhere: bool = False,
    prefilter: bool = True,
) -> DataFrame:
    """Reads whose id, or id without its mate mark, is among the ids of their sample.

    An OR of two keys would leave only a nested loop, and one row per key would double
    the sequences in the shuffle. So reads are keyed by the id without mark, and each
    wanted id is listed under itself (fits every mark) and, if marked, under its base
    (fits that mark). One row per (sample, target, key) keeps a read from matching twice.

    With ``prefilter`` the wanted keys are stored, and a bit filter in the scan of the reads
    drops nearly all others, so only candidates are shuffled with their sequences.
    """
    base = id_base(F.col("read_id"), anywhere)
    plain = F.struct(F.col("read_id").alias("key"), F.lit("").alias("mark"))
    marked = F.struct(base.alias("key"), _mate_mark(F.col("read_id"), base).alias("mark"))
    entries = F.when(base == F.col("read_id"), F.array(plain)).otherwise(F.array(plain, marked))
    listed = ids.select("sample", *target, F.explode(entries).alias("e")).select(
        "sample", *target, F.col("e.key").alias("_key"), F.col("e.mark").alias("_mark")
    )
    if anywhere:
        fits = F.collect_set("_mark").alias("_marks")
        ok = F.array_contains("_marks", "") | F.array_contains("_marks", F.col("_own"))
        keyed = listed.distinct().groupBy("_key", "sample", *target).agg(fits)
    else:
        keyed = listed.groupBy("_key", "sample", *target).agg(
            F.max(F.col("_mark") == "").alias("_any"),
            F.max(F.col("_mark") == "/1").alias("_one"),
            F.max(F.col("_mark") == "/2").alias("_two"),
        )
        ok = (
            F.col("_any")
            | (F.col("_one") & (F.col("_own") == "/1"))
            | (F.col("_two") & (F.col("_own") == "/2"))
        )
    keyed = keyed.withColumnRenamed("sample", "_sample")
    read_key = id_base(F.col("id"), anywhere)
    sided = reads.withColumn("_rkey", read_key)
    if prefilter:
        keyed = stage(keyed, "wanted")
        wanted = keyed.select(F.xxhash64("_key", "_sample").alias("h"))
        sided = keep_candidates(sided, F.xxhash64("_rkey", "sample"), wanted)
    sided = sided.withColumn("_own", _mate_mark(F.col("id"), F.col("_rkey")))
    cond = (F.col("_rkey") == F.col("_key")) & (F.col("sample") == F.col("_sample")) & ok
    how = "inner" if target else "left_semi"
    return sided.join(keyed, cond, how).select(*target, *reads.columns)


def extract_reads(
    assignments: DataFrame,
    reads: DataFrame,
    taxids: Sequence[int],
    closure: DataFrame | None = None,
    children: bool = False,
    parents: bool = False,
    exclude: bool = False,
    max_reads: int | None = None,
    anywhere: bool = False,
) -> DataFrame:
    """Reads assigned to the given taxa, of both mate files where reads are paired."""
    selected = select_assignments(assignments, taxids, closure, children, parents, exclude)
    return match_reads(reads, first_ids(selected, max_reads), anywhere=anywhere)


def taxon_counts(selected: DataFrame) -> DataFrame:
    """Assignment rows per taxid."""
    return selected.groupBy("sample", "taxid").agg(F.count(F.lit(1)).alias("n"))


def extract_all(
    assignments: DataFrame,
    reads: DataFrame,
    closure: DataFrame,
    targets: DataFrame,
    anywhere: bool = False,
) -> DataFrame:
    """Reads of every target taxon and its descendants, in one job.

    ``targets`` has columns sample and taxid. A read under several targets occurs once for
    each, in column ``target``.
    """
    wanted = descendants(closure, targets)
    selected = dimension_join(
        assignments.select("sample", "taxid", "read_id"),
        wanted,
        ["taxid", "sample"],
        how="inner",
    )
    return match_reads(
        reads, selected.select("sample", "target", "read_id"), target=["target"], anywhere=anywhere
    )


class _Request:
    """The ids that a request selects, from one pass over the assignments.

    Assignments are added up by wanted id, all others to one row per sample and task, and
    stored for the counts and for the match.
    """

    def __init__(self, assignments, taxids, closure, children, parents, exclude, max_reads):
        self.taxids, self.closure = sorted(set(taxids)), closure
        self.children, self.parents = children, parents
        flagged = _flag(assignments, self.taxids, closure, children, parents, exclude)
        order = [c for c in ("file", "line_no") if c in assignments.columns]
        wanted = F.when(F.col("_wanted"), F.col("read_id")).alias("read_id")
        counted = flagged.groupBy("sample", wanted).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first")
        )
        self.by_id = stage(counted.select("sample", "read_id", "n", "first.*"), "ids")
        self.ids = first_ids(self.by_id.where(F.col("read_id").isNotNull()), max_reads)

    def summary(self, reads: DataFrame) -> DataFrame:
        """Counts per sample; ``reads`` has sample and ``_reads``, the reads found."""
        out = self.by_id.groupBy("sample").agg(F.sum("n").alias("assignments"))
        if self.children or self.parents:
            more = expand_taxa(self.closure, self.taxids, self.children, self.parents)
            more = more.groupBy("sample").agg(F.count(F.lit(1)).alias("_more"))
            out = out.join(more, "sample", "left")
        else:
            out = out.withColumn("_more", F.lit(0))
        ids = self.ids.groupBy("sample").agg(F.count_distinct("read_id").alias("_ids"))
        out = out.join(ids, "sample", "left").join(reads, "sample", "left")
        taxids = F.coalesce("_more", F.lit(0)) + F.lit(len(self.taxids))
        return out.select(
            "sample",
            taxids.cast("long").alias("taxids"),
            "assignments",
            F.coalesce("_ids", F.lit(0)).alias("ids"),
            F.coalesce("_reads", F.lit(0)).cast("long").alias("reads"),
        )


def extract_summary(
    assignments: DataFrame,
    reads: DataFrame,
    taxids: Sequence[int],
    closure: DataFrame | None = None,
    children: bool = False,
    parents: bool = False,
    exclude: bool = False,
    max_reads: int | None = None,
    anywhere: bool = False,
) -> DataFrame:
    """Per sample: taxa asked for, assignments read, ids kept, reads selected."""
    asked = _Request(assignments, taxids, closure, children, parents, exclude, max_reads)
    found = match_reads(reads, asked.ids, anywhere=anywhere)
    return asked.summary(found.groupBy("sample").agg(F.count(F.lit(1)).alias("_reads")))


def extract_and_write(
    assignments: DataFrame,
    reads: DataFrame,
    taxids: Sequence[int],
    path: str,
    closure: DataFrame | None = None,
    children: bool = False,
    parents: bool = False,
    exclude: bool = False,
    max_reads: int | None = None,
    anywhere: bool = False,
    fmt: str = "fasta",
    mode: str = "overwrite",
) -> DataFrame:
    """Write the reads of a request, one folder per sample (and mate), and give its summary.

    Reads are counted by the job that writes them, as observed metrics, so they are matched
    once. Each sample is a metric; of more than ``OBSERVED`` samples, the written records are
    counted instead.
    """
    asked = _Request(assignments, taxids, closure, children, parents, exclude, max_reads)
    found = match_reads(reads, asked.ids, anywhere=anywhere)
    keys = [c for c in ("sample", "mate") if c in found.columns]
    samples = [r.sample for r in asked.by_id.select("sample").distinct().limit(OBSERVED + 1).collect()]
    spark = reads.sparkSession
    if len(samples) > OBSERVED:
        write_reads(found, path, fmt, mode, partition_by=keys)
        return asked.summary(count_written(spark, path, fmt))
    seen = Observation()
    counts = [F.count_if(F.col("sample").eqNullSafe(s)).alias(f"s{k}") for k, s in enumerate(samples)]
    write_reads(found.observe(seen, *counts) if counts else found, path, fmt, mode, partition_by=keys)
    got = seen.get if counts else {}
    rows = [(s, got[f"s{k}"]) for k, s in enumerate(samples)]
    return asked.summary(spark.createDataFrame(rows, "sample string, _reads long"))
