"""The three pipelines, as compositions of operators. Results are lazy; nothing is written but what operators stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ploidlake.operators import align, allelic, assign, hic, merging, reads, similarity
from ploidlake.params import Bins, Links, Reads, Redundancy, Segments
from ploidlake.runtime import Stages


def mosaic_reference(sequences: DataFrame, self_paf: DataFrame, min_length: int = 10_000_000, p: Redundancy = Redundancy(), k: int = 21, sketch: int | None = None) -> dict[str, DataFrame]:
    """From contigs and their alignments: redundant contigs removed, collinear ones joined.

    Only contigs longer than ``min_length`` take part, and only alignments between similar ones count. ``similar`` (pairs
    with their distance), ``removed``, ``retained`` (ids), ``plans`` (how pairs join) and ``merged`` (sequences).
    """
    stages = Stages(sequences.sparkSession, "mosaic")
    long = sequences.filter(F.length("seq") > min_length)
    similar = stages.write(similar_contigs(long, p, k, sketch))
    aln = stages.write(between(align.alignments(self_paf), similar))
    removed = align.redundant_contigs(aln, p).join(long.select("contig_id"), "contig_id", "left_semi")
    retained = long.select("contig_id").join(removed, "contig_id", "left_anti")
    both = retained.select(F.col("contig_id").alias("x"))
    among = aln.join(both.withColumnRenamed("x", "query_id"), "query_id", "left_semi").join(both.withColumnRenamed("x", "target_id"), "target_id", "left_semi")
    candidates = merging.join_plans(among, p)
    pairs = merging.greedy_pairs(candidates.select("long_id", "short_id", "first_line"), "long_id", "short_id", "first_line")
    plans = candidates.join(pairs.select("long_id", "short_id"), ["long_id", "short_id"], "left_semi")
    kept = sequences.join(retained, "contig_id", "left_semi")
    return {"similar": similar, "removed": removed, "retained": retained, "plans": plans, "merged": merging.merged_sequences(plans, kept)}


def similar_contigs(sequences: DataFrame, p: Redundancy = Redundancy(), k: int = 21, sketch: int | None = None) -> DataFrame:
    """Pairs of contigs near enough to be aligned, by exact k-mer sets or bottom sketches of them."""
    members = similarity.kmers(sequences, k).withColumnRenamed("kmer", "member")
    return similarity.similar_pairs(members, p.max_distance, k, sketch)


def between(aln: DataFrame, pairs: DataFrame) -> DataFrame:
    """Alignments of the pairs ``(a, b)``, in either direction."""
    return aln.join(pairs.select("a", "b"), (F.least("query_id", "target_id") == F.col("a")) & (F.greatest("query_id", "target_id") == F.col("b")), "left_semi")


def haplotype_groups(paf: DataFrame, hic_links: DataFrame, contigs: DataFrame, types: DataFrame, bins: Bins = Bins(), seg: Segments = Segments(), p: Links = Links(), rounds: int = 8) -> dict[str, DataFrame]:
    """From alignments of unitigs to the reference and contact links: allelic table, groups, and leftovers assigned.

    ``contigs(contig_id, length, re_sites)``, ``types(contig_id, contig_type)``. Gives ``segments``, ``table``, ``groups``
    (in order, with repeats), ``membership`` and ``unassigned``. Leftovers go to groups of the chromosome they match best
    first, then what is still left to groups of any.
    """
    stages = Stages(paf.sparkSession, "groups")
    aln = stages.write(align.alignments(paf))
    near = align.on_best_target(align.primary(aln, seg.min_match, seg.min_query, strict=True), seg.min_ratio)
    segments = align.gap_segments(align.drop_contained(near), seg.gap)
    merged = align.best_segment(align.merge_segments(align.segment_rows(segments), seg).withColumn("seg_no", F.col("merged_no")))
    best = stages.write(aln.join(merged.select("query_id"), "query_id", "left_semi"))
    homes = align.best_ratio(best, bins.chromosomes).select(F.col("query_id").alias("contig_id"), F.col("target_id").alias("chrom"))
    table = stages.write(allelic.repair_bins(allelic.allelic_table(best, bins), contigs, bins))
    thin = stages.write(allelic.thin_bins(table, contigs, types, bins))
    links = stages.write(hic.pair_links(hic_links))
    groups = stages.write(allelic.linked_only(allelic.genotyped(thin, types, contigs, contigs, links, bins, p), links))
    members = stages.write(groups.select("contig_id", "chrom", F.concat("chrom", F.lit("g"), F.col("group_no").cast("string")).alias("group_name")).distinct())
    within = stages.write(assign.reassign_within(contigs, types, links, members, stages.write(homes), rounds, p))
    rescued = assign.reassign(contigs, types, links, within, rounds, p).select("contig_id", "group_name")
    membership = rescued.join(members.select("contig_id", "group_name", F.lit(True).alias("was_grouped")), ["contig_id", "group_name"], "left").na.fill(False, ["was_grouped"])
    return {"segments": merged, "table": thin, "groups": groups, "membership": membership, "unassigned": assign.unassigned(contigs, membership)}


def phased_reads(placement: DataFrame, types: DataFrame, membership: DataFrame, p: Reads = Reads(), seed_offset: int = 0, disjoint: bool = False) -> DataFrame:
    """``(group_name, read)``: reads of each group, split between the copies of collapsed contigs."""
    parts = reads.split_reads(reads.read_sets(placement), types, p, seed_offset, disjoint)
    return reads.group_reads(parts, membership.select("contig_id", "group_name").distinct())
