"""Contact links: counts per pair, flank and half, distances per orientation, adjacency, density, normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ploidlake.functions import scalar as S
from ploidlake.operators.skew import attach, lookup
from ploidlake.params import Links
from ploidlake.runtime import Stages


def pair_links(hic_links: DataFrame) -> DataFrame:
    """``(ctg_i, ctg_j, links)``: counts summed over each ``count_id`` once; pairs of nulls only are left out."""
    once = hic_links.filter("ctg_i is not null and ctg_j is not null and ctg_i <> ctg_j and links is not null").dropDuplicates(["count_id"])
    return once.groupBy(F.least("ctg_i", "ctg_j").alias("ctg_i"), F.greatest("ctg_i", "ctg_j").alias("ctg_j")).agg(F.sum("links").alias("links"))


def mates(read_pairs: DataFrame, lengths: DataFrame) -> DataFrame:
    """First mates on two known contigs, in the order of (name, place): ``ctg_i, a, len_i, ctg_j, b, len_j`` (0-based)."""
    first = read_pairs.filter((F.col("flag").bitwiseAND(64) != 0) & (F.col("ref") != F.col("mref")))
    both = F.least(F.struct(F.col("ref").alias("c"), F.col("pos").alias("x")), F.struct(F.col("mref").alias("c"), F.col("mpos").alias("x"))), F.greatest(F.struct(F.col("ref").alias("c"), F.col("pos").alias("x")), F.struct(F.col("mref").alias("c"), F.col("mpos").alias("x")))
    rows = first.select(both[0].alias("i"), both[1].alias("j")).select(F.col("i.c").alias("ctg_i"), F.col("i.x").alias("a"), F.col("j.c").alias("ctg_j"), F.col("j.x").alias("b"))
    lengths = Stages(read_pairs.sparkSession, "lengths").write(lengths.select("contig_id", "length"))
    rows = attach(rows, lengths.withColumnsRenamed({"contig_id": "ctg_i", "length": "len_i"}), "ctg_i")
    return attach(rows, lengths.withColumnsRenamed({"contig_id": "ctg_j", "length": "len_j"}), "ctg_j")


def link_counts(pairs: DataFrame, p: Links = Links()) -> DataFrame:
    """Per pair: all links, and those with both places in a flank."""
    flank = S.in_flank(F.col("a") + 1, F.col("len_i"), p.flank) & S.in_flank(F.col("b") + 1, F.col("len_j"), p.flank)
    return pairs.groupBy("ctg_i", "ctg_j").agg(F.count(F.lit(1)).alias("links"), F.count_if(flank).alias("flank_links"))


def half_links(pairs: DataFrame) -> DataFrame:
    """Links between halves (H head, T tail) of contigs."""
    return pairs.groupBy("ctg_i", S.half_of(F.col("a") + 1, F.col("len_i")).alias("end_i"), "ctg_j", S.half_of(F.col("b") + 1, F.col("len_j")).alias("end_j")).agg(F.count(F.lit(1)).alias("links"))


_SIGNS = ("++", "+-", "-+", "--")


def orientation_distances(pairs: DataFrame, p: Links = Links()) -> DataFrame:
    """``(name_i, name_j, dist, links)``: how often each distance occurs for each orientation of a pair with enough links.

    The long form of ``orientations``, for pairs with any number of links.
    """
    d = S.orientation_distances(F.col("a"), F.col("len_i"), F.col("b"), F.col("len_j"))
    per = pairs.select("ctg_i", "ctg_j", F.posexplode(d).alias("o", "dist")).groupBy("ctg_i", "ctg_j", "o", "dist").agg(F.count(F.lit(1)).alias("links"))
    enough = pairs.groupBy("ctg_i", "ctg_j").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= p.clm_min).select("ctg_i", "ctg_j")
    sign = F.get(F.array(*map(F.lit, _SIGNS)), "o")
    kept = per.join(enough, ["ctg_i", "ctg_j"], "left_semi")
    return kept.select(F.concat("ctg_i", F.substring(sign, 1, 1)).alias("name_i"), F.concat("ctg_j", F.substring(sign, 2, 1)).alias("name_j"), "dist", "links")


def orientations(pairs: DataFrame, p: Links = Links()) -> DataFrame:
    """``(name_i, name_j, n, distances)``: for each orientation of a pair with enough links the distances, ascending.

    Each distance stands twice and ``n`` is twice the links, as scaffolders read it. A pair's links are listed in one row,
    which is what the format has; ``orientation_distances`` says the same in rows.
    """
    per = orientation_distances(pairs, p).groupBy("name_i", "name_j").agg(F.sort_array(F.collect_list(F.struct("dist", "links"))).alias("ds"), F.sum("links").alias("n"))
    listed = F.flatten(F.transform("ds", lambda x: F.array_repeat(x["dist"], (2 * x["links"]).cast("int"))))
    return per.select("name_i", "name_j", (2 * F.col("n")).alias("n"), F.array_join(listed, " ").alias("distances"))


def adjacency(links: DataFrame) -> DataFrame:
    """``(contig_id, other, links)``: every pair from both sides."""
    return links.selectExpr("stack(2, ctg_i, ctg_j, links, ctg_j, ctg_i, links) as (contig_id, other, links)")


def density(links: DataFrame, contigs: DataFrame) -> DataFrame:
    """``(contig_id, links, density)``: all links of a contig over its restriction sites; unknown contigs are left out."""
    total = adjacency(links).groupBy("contig_id").agg(F.sum("links").alias("links"))
    return total.join(contigs, "contig_id").select("contig_id", "links", (F.col("links") / F.col("re_sites")).alias("density"))


def normalised(links: DataFrame) -> DataFrame:
    """Links over the root of both contigs' totals, scaled so that their sum stays. Hot contigs are joined in shards."""
    stages = Stages(links.sparkSession, "normalised")
    links = stages.write(links)
    total = stages.write(adjacency(links).groupBy("contig_id").agg(F.sum("links").cast("double").alias("total")))
    both = lookup(links, total.withColumnsRenamed({"contig_id": "ctg_i", "total": "total_i"}), "ctg_i")
    both = lookup(stages.write(both), total.withColumnsRenamed({"contig_id": "ctg_j", "total": "total_j"}), "ctg_j")
    raw = stages.write(both).select("ctg_i", "ctg_j", "links", (F.col("links") / F.sqrt(F.col("total_i") * F.col("total_j"))).alias("raw"))
    sums = raw.agg(F.sum("links"), F.sum("raw")).first()
    return raw.select("ctg_i", "ctg_j", (F.col("raw") * F.lit(float(sums[0] or 0)) / F.lit(float(sums[1] or 1))).alias("norm_links"))


def typed(links: DataFrame, types: DataFrame) -> DataFrame:
    """Links with ``type_i`` and ``type_j``; contigs without type are haplotigs."""
    t = Stages(links.sparkSession, "types").write(types.select("contig_id", "contig_type"))
    both = attach(links, t.withColumnsRenamed({"contig_id": "ctg_i", "contig_type": "type_i"}), "ctg_i", "left")
    both = attach(both, t.withColumnsRenamed({"contig_id": "ctg_j", "contig_type": "type_j"}), "ctg_j", "left")
    return both.withColumns({c: F.coalesce(c, F.lit("haplotig")) for c in ("type_i", "type_j")})


def weighted(links: DataFrame, types: DataFrame) -> DataFrame:
    """Links times the weights of both contigs' types."""
    return typed(links, types).select("ctg_i", "ctg_j", (F.col("links") * S.link_weight(F.col("type_i")) * S.link_weight(F.col("type_j"))).alias("weighted"))


def contig_bins(contigs: DataFrame, size: int) -> DataFrame:
    """``(contig_id, bin_no, bin_start, bin_end)``: a contig in pieces of ``size``, the last one shorter."""
    bins = contigs.filter("length > 0").select("contig_id", "length", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / size))).alias("bin_no"))
    return bins.select("contig_id", "bin_no", (F.col("bin_no") * size).alias("bin_start"), F.least("length", (F.col("bin_no") + 1) * size).alias("bin_end"))


def bin_density(links: DataFrame, contigs: DataFrame, size: int) -> DataFrame:
    """Every bin's density: all links of its contig per 1000 positions of the bin."""
    total = adjacency(links).groupBy("contig_id").agg(F.sum("links").alias("links"))
    return contig_bins(contigs, size).join(total, "contig_id").select("contig_id", "bin_no", F.round(F.col("links") / ((F.col("bin_end") - F.col("bin_start")) / 1000), 4).alias("density"))


def shared_groups(rows: DataFrame, membership: DataFrame) -> DataFrame:
    """Rows ``(ctg_i, ctg_j, ...)`` once for each group that has both contigs."""
    a = membership.select(F.col("contig_id").alias("ctg_i"), "group_name")
    b = membership.select(F.col("contig_id").alias("ctg_j"), F.col("group_name").alias("other_group"))
    return attach(attach(rows, a, "ctg_i"), b, "ctg_j").filter("group_name = other_group").drop("other_group")


def group_sites(membership: DataFrame, contigs: DataFrame) -> DataFrame:
    """``(group_name, re_sites)``: 1 + the sum of each member's sites less one; unknown contigs add nothing."""
    m = membership.join(contigs.select("contig_id", "re_sites"), "contig_id", "left")
    return m.groupBy("group_name").agg((F.sum(F.coalesce(F.col("re_sites"), F.lit(1)) - 1) + 1).alias("re_sites"))


def contig_group_links(links: DataFrame, membership: DataFrame) -> DataFrame:
    """``(contig_id, group_name, links, strongest)``: links of a contig to the members of each group."""
    m = membership.select(F.col("contig_id").alias("other"), "group_name")
    return lookup(adjacency(links), m, "other").groupBy("contig_id", "group_name").agg(F.sum("links").alias("links"), F.max("links").alias("strongest"))


def read_pair_counts(reads: DataFrame) -> DataFrame:
    """``(ctg_i, ctg_j, reads)``: reads that touch exactly two contigs, counted once by name."""
    two = reads.distinct().groupBy("read").agg(F.min("ref").alias("ctg_i"), F.max("ref").alias("ctg_j"), F.count(F.lit(1)).alias("n")).filter("n = 2")
    return two.groupBy("ctg_i", "ctg_j").agg(F.count(F.lit(1)).alias("reads"))


def major_target(links: DataFrame, placed: DataFrame, top: int = 3, threshold: int = 10) -> DataFrame:
    """``(contig_id, target_id)`` by the targets of its ``top`` most linked contigs.

    The target all agree on, else that of the strongest link if it has more than ``threshold`` links, else ``Uncertain``.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("contig_id").orderBy(F.desc("links"), "other")
    near = adjacency(links).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top)
    known = near.join(placed.select(F.col("query_id").alias("other"), "target_id"), "other")
    per = known.groupBy("contig_id").agg(F.min("target_id").alias("lo"), F.max("target_id").alias("hi"), F.min_by("target_id", "rn").alias("first"), F.max("links").alias("most"))
    return per.select("contig_id", F.when(F.col("lo") == F.col("hi"), F.col("lo")).when(F.col("most") > threshold, F.col("first")).otherwise("Uncertain").alias("target_id"))
