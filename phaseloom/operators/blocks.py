"""Locus groups, parent blocks and their fragments: cuts where a gap is as wide as the window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phaseloom.operators.ordering import in_ranges, with_earlier
from phaseloom.storage import by_shuffle

def _islands(rows: DataFrame, keys: list[str], window: int, name: str) -> DataFrame:
    """Numbers the runs of each key's rows by (position, ref_len, row_idx): a row opens a run if it starts `window` or more after all earlier ends."""
    order = Window.partitionBy(*keys).orderBy("position", "ref_len", "row_idx")
    reach = F.max(F.col("position") + F.col("ref_len")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("position") - F.col("_reach") >= window, F.lit(True)).cast("int")
    marked = rows.withColumn("_reach", reach).withColumn("_opens", opens)
    return marked.withColumn(name, F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_reach", "_opens")


def locus_groups(variants: DataFrame, window: int) -> DataFrame:
    """variants with locus_group, numbered from 1 in each contig; no haplotype spans two groups.

    Contigs are cut into ranges of positions. The furthest end and the number of groups before a range come from one
    row a range, so a contig of any length is spread over tasks.
    """
    keys = ["position", "ref_len", "row_idx"]
    end = F.col("position") + F.col("ref_len")
    ranged = with_earlier(in_ranges(variants, ["contig", *keys], "loci"), ["contig"], _end_max=F.max(end))
    here = Window.partitionBy("contig", "_range").orderBy(*keys)
    reach = F.greatest(F.max(end).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.col("_end_max"))
    opens = F.coalesce(F.col("position") - F.col("_reach") >= window, F.lit(True)).cast("long")
    marked = ranged.withColumn("_reach", reach).withColumn("_opens", opens).drop("_end_max", "_reach")
    placed = with_earlier(marked, ["contig"], _groups=F.sum("_opens"))
    own = F.sum("_opens").over(here.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn("locus_group", own + F.coalesce(F.col("_groups"), F.lit(0))).drop("_range", "_opens", "_groups")


def multi_member_groups(grouped: DataFrame) -> DataFrame:
    """Rows of groups with two variants or more; others can have no haplotype."""
    sizes = grouped.groupBy("contig", "locus_group").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return grouped.join(by_shuffle(sizes.drop("_n")), ["contig", "locus_group"], "left_semi")


def parent_blocks(carriers: DataFrame, window: int) -> DataFrame:
    """Runs of two alternate alleles or more on one chromosome copy: sample, pop, strand, contig, block, parent (row_idx in order).

    Carriers with a locus_group are cut within it, which spreads a sample's rows over tasks without changing runs.
    """
    keys = ["s", "pop", "strand", "contig", *(["locus_group"] if "locus_group" in carriers.columns else [])]
    runs = _islands(carriers, keys, window, "block")
    member = F.struct("position", "ref_len", "row_idx")
    blocks = runs.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(member)).alias("m")).where("size(m) > 1")
    return blocks.select(*keys, "block", F.transform("m", lambda x: x["row_idx"]).alias("parent"))


def slices(parent, least: int = 2):
    """All contiguous runs of an array with `least` members or more."""
    n = F.size(parent)
    starts = F.when(n >= least, F.sequence(F.lit(1), n - least + 1)).otherwise(F.array().cast("array<int>"))
    return F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(least), n - i + 1), lambda k: F.slice(parent, i, k))))


def subfragments(parents: DataFrame) -> DataFrame:
    """A row for each contiguous run of two or more variants of each parent block."""
    keep = [c for c in parents.columns if c != "parent"]
    return parents.select(*keep, F.explode(slices(F.col("parent"))).alias("haplotype"))
