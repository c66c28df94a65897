"""Assigning ungrouped contigs to haplotype groups by link density.

Assignments depend on earlier ones (longer contigs first): a contig that joins a group lends its links to later ones and
adds to the group's restriction sites. The result is that of the strict order, found without a walk: from a guess of all
assignments, each contig's is worked out again from those of the contigs before it, by joins, sums and running sums, until
nothing changes. What doesn't change any more is the strict order's result, as each contig depends on earlier ones only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ploidlake.functions.scalar import multiplicity
from ploidlake.operators.hic import adjacency, contig_group_links, group_sites
from ploidlake.operators.skew import attach
from ploidlake.params import Links
from ploidlake.runtime import Stages


def _first(length: str, name: str, than_length: str, than_name: str) -> Column:
    """Whether a contig is before another one in the order: longer, or as long and of smaller name."""
    return (F.col(length) > F.col(than_length)) | ((F.col(length) == F.col(than_length)) & (F.col(name) < F.col(than_name)))


def _edges(waiting: DataFrame, n: int) -> list[float]:
    """Lengths that part the contigs in about ``n`` bands."""
    return sorted({float(x) for x in waiting.approxQuantile("length", [i / n for i in range(1, n)], 0.0 if n > 100 else 0.001) or []}) if n > 1 else []


def _band(edges: list[float]) -> Column:
    return sum((F.when(F.col("length") < e, 1).otherwise(0) for e in edges), F.lit(0))


def reassign(contigs: DataFrame, types: DataFrame, links: DataFrame, membership: DataFrame, rounds: int = 4, p: Links = Links(), tile: int = 1 << 16) -> DataFrame:
    """``(contig_id, group_name, was_grouped)``: the given members, and contigs assigned to their densest groups.

    ``contigs(contig_id, length, re_sites)``. A contig of m copies joins m groups. Contigs whose strongest link into any
    group is below ``min_single``, or without links, stay out. Ties go to the smaller group name, contigs of equal length
    in the order of their names. The longest of ``rounds`` bands of length settle first, which saves work, but has no
    influence on the result; running sums of sites work in tiles of about ``tile`` contigs.
    """
    stages = Stages(contigs.sparkSession, "reassign")
    grouped = stages.write(membership.select("contig_id", "group_name").distinct())
    rows = contigs.join(grouped, "contig_id", "left_anti").join(types.select("contig_id", "contig_type"), "contig_id", "left")
    rows = rows.select("contig_id", F.coalesce("length", F.lit(-1)).alias("length"), F.coalesce("re_sites", F.lit(0)).alias("own_sites"), multiplicity(F.coalesce("contig_type", F.lit("haplotig"))).alias("copies"))
    waiting = stages.write(rows)
    bands = _edges(waiting, rounds)
    waiting = stages.write(waiting.withColumns({"band": _band(bands), "tile": _band(_edges(waiting, -(-waiting.count() // tile)))}))
    near = attach(adjacency(links), waiting.select("contig_id", "length"), "contig_id")
    fixed = contig_group_links(links, grouped).join(waiting.select("contig_id"), "contig_id", "left_semi").select("contig_id", "group_name", "links", "strongest")
    fixed = stages.write(fixed)
    among = attach(near, waiting.select(F.col("contig_id").alias("other"), F.col("length").alias("other_length")), "other")
    among = stages.write(among.filter(_first("other_length", "other", "length", "contig_id")).select("contig_id", "other", "links"))
    sites = stages.write(group_sites(grouped, contigs))
    last = now = stages.write(fixed.select("contig_id", "group_name").limit(0))
    k = 0
    while True:
        lent = among.join(now.withColumnRenamed("contig_id", "other"), "other").select("contig_id", "group_name", "links", F.col("links").alias("strongest"))
        got = fixed.unionByName(lent).withColumn("was", F.lit(False))
        was = now.withColumns({"links": F.lit(None).cast(fixed.schema["links"].dataType), "strongest": F.lit(None).cast(fixed.schema["links"].dataType), "was": F.lit(True)})
        per = got.unionByName(was).groupBy("contig_id", "group_name").agg(F.sum("links").alias("links"), F.max("strongest").alias("strongest"), F.max("was").alias("was"))
        state = per = stages.write(per.join(waiting.filter(F.col("band") <= k), "contig_id").withColumn("adds", F.when(F.col("was"), F.col("own_sites")).otherwise(0)))
        tiles = per.groupBy("group_name", "tile").agg(F.sum("adds").alias("t"))
        before = tiles.select("group_name", "tile", F.coalesce(F.sum("t").over(Window.partitionBy("group_name").orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
        inside = F.coalesce(F.sum("adds").over(Window.partitionBy("group_name", "tile").orderBy(F.desc("length"), "contig_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        per = per.withColumn("inside", inside).join(before, ["group_name", "tile"]).join(sites, "group_name")
        all_sites = F.col("re_sites") + F.col("before") + F.col("inside")
        per = per.withColumn("density", F.when(all_sites > 0, F.col("links") / all_sites).otherwise(0.0))
        w = Window.partitionBy("contig_id")
        ranked = per.withColumns({"best_single": F.max("strongest").over(w), "rn": F.row_number().over(w.orderBy(F.col("links").isNull(), F.desc("density"), "group_name"))})
        joins = F.coalesce(F.col("links").isNotNull() & (F.col("best_single") >= p.min_single) & (F.col("rn") <= F.col("copies")), F.lit(False))
        new = stages.write(ranked.select("contig_id", "group_name", "was", joins.alias("now")).filter("was or now"))
        stages.drop(state, last)
        last, now = new, new.filter("now").select("contig_id", "group_name")
        if k < len(bands):
            k += 1
        elif new.filter("was <> now").isEmpty():
            break
    return grouped.withColumn("was_grouped", F.lit(True)).unionByName(now.withColumn("was_grouped", F.lit(False)))


def reassign_within(contigs: DataFrame, types: DataFrame, links: DataFrame, membership: DataFrame, homes: DataFrame, rounds: int = 4, p: Links = Links()) -> DataFrame:
    """``(contig_id, group_name)`` after a ``reassign`` inside each chromosome, of all chromosomes in one job.

    ``homes(contig_id, chrom)``: a contig's chromosomes; it joins groups of these only. ``membership`` has the group's
    ``chrom`` too. A member of a chromosome's group that isn't at home there lends its links, but no restriction sites. A
    contig that is grouped on another chromosome only still waits in its own.
    """
    stages = Stages(contigs.sparkSession, "within")
    key = F.concat_ws("\x01", "chrom", "contig_id")
    homes = homes.select("contig_id", "chrom").distinct()
    members = membership.select("contig_id", "chrom", "group_name").distinct()
    scope = stages.write(homes.unionByName(members.select("contig_id", "chrom")).distinct())
    inside = links.join(scope.withColumnRenamed("contig_id", "ctg_i"), "ctg_i").join(scope.withColumnRenamed("contig_id", "ctg_j"), ["ctg_j", "chrom"])
    inside = stages.write(inside.select(*(F.concat_ws("\x01", "chrom", c).alias(c) for c in ("ctg_i", "ctg_j")), "links"))
    at_home = stages.write(contigs.select("contig_id", "length", "re_sites").join(homes, "contig_id").withColumn("contig_id", key).drop("chrom"))
    kinds = types.select("contig_id", "contig_type").join(homes, "contig_id").select(key.alias("contig_id"), "contig_type")
    got = reassign(at_home, kinds, inside, members.select(key.alias("contig_id"), "group_name"), rounds, p)
    return got.select(F.substring_index("contig_id", "\x01", -1).alias("contig_id"), "group_name").distinct()


def unassigned(contigs: DataFrame, assigned: DataFrame) -> DataFrame:
    return contigs.select("contig_id").join(assigned, "contig_id", "left_anti")


__all__ = ["contig_group_links", "group_sites", "reassign", "reassign_within", "unassigned"]
