"""Reads per contig, their split between copies, and reads per haplotype group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ploidlake.functions.ids import clean_id
from ploidlake.functions.scalar import flags_clear, multiplicity
from ploidlake.params import Reads

#: Hex digits of the hash that make a bucket.
PREFIX = 3


def read_sets(placement: DataFrame) -> DataFrame:
    """``(contig_id, read)`` distinct, of rows with a name and a real contig; mate marks are dropped."""
    name = F.regexp_replace("query_name", "/[12]$", "")
    return placement.select(clean_id("ref").alias("contig_id"), F.when(name != "", name).alias("read")).filter("contig_id is not null and read is not null").distinct()


def paired_read_sets(records: DataFrame) -> DataFrame:
    """As ``read_sets`` from flagged records: both mates mapped, first mate only."""
    return read_sets(records.filter(flags_clear(F.col("flag"), 4 + 8) & (F.col("flag").bitwiseAND(64) != 0)))


def split_reads(sets: DataFrame, types: DataFrame, p: Reads = Reads(), seed_offset: int = 0, disjoint: bool = False) -> DataFrame:
    """``(contig_id, part, read)``: per contig of m copies, a share of 1/m of its reads, in the order of a seeded hash.

    The first part goes to all copies alike; with ``disjoint`` there is one part per copy. Places in the hash order come
    from counts of hash buckets, so that only reads of one bucket are ranked together, however many a contig has.
    """
    order = F.md5(F.concat("read", F.lit(f":{p.seed + seed_offset}")))
    rows = sets.select("contig_id", "read", order.alias("h")).withColumn("b", F.substring("h", 1, PREFIX))
    per = rows.groupBy("contig_id", "b").agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy("contig_id").orderBy("b")
    per = per.withColumns({"before": F.sum("k").over(w) - F.col("k"), "n": F.sum("k").over(Window.partitionBy("contig_id"))})
    per = per.join(types.select("contig_id", "contig_type"), "contig_id", "left").withColumn("m", multiplicity(F.coalesce("contig_type", F.lit("haplotig"))))
    per = per.withColumn("size", F.floor(F.col("n") / F.col("m")))
    most = F.col("size") * (F.col("m") if disjoint else F.lit(1))
    wanted = rows.join(per.filter(F.col("before") < most).select("contig_id", "b", "before", "size", "m"), ["contig_id", "b"])
    place = F.col("before") + F.row_number().over(Window.partitionBy("contig_id", "b").orderBy("h", "read")) - 1
    out = wanted.withColumn("place", place).filter(F.col("place") < most)
    return out.select("contig_id", F.floor(F.col("place") / F.col("size")).cast("int").alias("part"), "read")


def group_reads(parts: DataFrame, membership: DataFrame) -> DataFrame:
    """``(group_name, read)``: reads of each group's contigs.

    With disjoint parts the j-th group of a contig (by name) gets part j; a single part goes to every group.
    """
    nth = membership.withColumn("part", (F.row_number().over(Window.partitionBy("contig_id").orderBy("group_name")) - 1).cast("int"))
    shared = parts.groupBy("contig_id").agg(F.max("part").alias("last"))
    m = nth.join(shared, "contig_id").withColumn("part", F.when(F.col("last") == 0, 0).otherwise(F.col("part")))
    return parts.join(m.select("contig_id", "group_name", "part"), ["contig_id", "part"]).select("group_name", "read").distinct()


def mate_names(group_reads_: DataFrame) -> DataFrame:
    """Names of both mates of each read."""
    return group_reads_.select("group_name", F.explode(F.array(F.concat("read", F.lit("/1")), F.concat("read", F.lit("/2")))).alias("read"))


def good_pairs(records: DataFrame, min_mapq: int = 1, max_edits: int = 3) -> DataFrame:
    """Records with at least ``min_mapq`` and at most ``max_edits`` edits (both bounds inclusive); nulls are left out."""
    return records.filter((F.col("mapq") >= min_mapq) & (F.col("nm") <= max_edits))


def good_reads(reads: DataFrame, min_length: int = 1, min_quality: float = 0.0) -> DataFrame:
    """Reads at least as long and as good as asked; nulls are left out."""
    return reads.filter((F.col("length") >= min_length) & (F.col("quality") >= min_quality))
