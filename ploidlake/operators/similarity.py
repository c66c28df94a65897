"""Similarity of sequences and sets: k-mers, sketches, Jaccard and the distance derived from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ploidlake.functions.scalar import reverse_complement


def kmers(sequences: DataFrame, k: int = 21, canonical: bool = True) -> DataFrame:
    """``(contig_id, kmer)`` distinct; ``canonical`` takes the smaller of a k-mer and its reverse complement."""
    at = sequences.filter(F.length("seq") >= k).select("contig_id", "seq", F.explode(F.sequence(F.lit(1), F.length("seq") - k + 1)).alias("i"))
    mer: Column = F.substring("seq", F.col("i"), F.lit(k))
    rows = at.select("contig_id", mer.alias("kmer"))
    if canonical:
        rows = rows.select("contig_id", F.least("kmer", reverse_complement(F.col("kmer"))).alias("kmer"))
    return rows.distinct()


def sketch(members: DataFrame, size: int = 1000) -> DataFrame:
    """``(contig_id, hash)``: the ``size`` smallest hashes of each set; ranked before and after the shuffle."""
    hashed = members.select("contig_id", F.md5("member").alias("hash")).distinct()
    return hashed.withColumn("rn", F.row_number().over(Window.partitionBy("contig_id").orderBy("hash"))).filter(F.col("rn") <= size).drop("rn")


def _meetings(m: DataFrame, carried: list[str], most_sets: int) -> DataFrame:
    """``(member, a, b, carried + _a, carried + _b)``: a row for each member that two sets ``a < b`` share.

    Members held by more than ``most_sets`` sets are matched in blocks of sets, each pair of blocks its own unit of work.
    """
    wide = m.groupBy("member").agg(F.ceil(F.count(F.lit(1)) / most_sets).cast("int").alias("blocks")).filter("blocks > 1")
    m = m.join(wide, "member", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("contig_id"), F.col("blocks")).cast("int"))
    # Row (member, i, j) meets block i with block j >= i.
    left = m.select("member", F.col("contig_id").alias("x"), *[F.col(c).alias(f"{c}_x") for c in carried], F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"))
    right = m.select("member", F.col("contig_id").alias("y"), *[F.col(c).alias(f"{c}_y") for c in carried], F.col("block").alias("j"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"))
    met = left.join(right, ["member", "i", "j"]).filter("x <> y and (i < j or x < y)")
    swap = F.col("x") > F.col("y")
    sides = [F.when(swap, F.col(f"{c}_{p}")).otherwise(F.col(f"{c}_{q}")).alias(f"{c}_{r}") for c in carried for p, q, r in (("y", "x", "a"), ("x", "y", "b"))]
    return met.select("member", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *sides)


def set_pairs(members: DataFrame, most_sets: int = 64) -> DataFrame:
    """``(a, b, shared, n_a, n_b, jaccard)`` for sets that share a member, exact."""
    m = members.select("contig_id", "member").distinct()
    n = m.groupBy("contig_id").agg(F.count(F.lit(1)).alias("n"))
    met = _meetings(m, [], most_sets).groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    out = met.join(n.withColumnsRenamed({"contig_id": "a", "n": "n_a"}), "a").join(n.withColumnsRenamed({"contig_id": "b", "n": "n_b"}), "b")
    return out.select("a", "b", "shared", "n_a", "n_b", (F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("jaccard"))


def sketch_pairs(sketches: DataFrame, size: int = 1000, most_sets: int = 64) -> DataFrame:
    """``(a, b, jaccard)`` estimated from sketches of at most ``size`` hashes, for sets whose sketches meet.

    Of the ``size`` smallest hashes of both sketches together, the share that is in both: right for sets of any sizes. A
    common hash has as many smaller ones in the union as in both sketches, less those they share.
    """
    w = Window.partitionBy("contig_id")
    ranked = sketches.select("contig_id", F.col("hash").alias("member")).distinct().withColumns({"rank": F.row_number().over(w.orderBy("member")), "n": F.count(F.lit(1)).over(w)})
    met = _meetings(ranked, ["rank", "n"], most_sets)
    pair = Window.partitionBy("a", "b")
    nth = F.row_number().over(pair.orderBy("member"))
    placed = met.withColumns({"place": F.col("rank_a") + F.col("rank_b") - nth, "of": F.least(F.lit(size), F.col("n_a") + F.col("n_b") - F.count(F.lit(1)).over(pair))})
    return placed.groupBy("a", "b").agg((F.count_if(F.col("place") <= F.col("of")) / F.max("of")).alias("jaccard")).filter("jaccard > 0")


def mash_distance(jaccard: Column, k: int = 21) -> Column:
    """Distance of a Jaccard index (Ondov et al. 2016): -ln(2 j / (1 + j)) / k; 1 for j = 0."""
    return F.when(jaccard > 0, F.greatest(F.lit(0.0), -F.log(2 * jaccard / (1 + jaccard)) / k)).otherwise(1.0)


def similar_pairs(members: DataFrame, max_distance: float = 0.15, k: int = 21, sketch_size: int | None = None) -> DataFrame:
    """Pairs of sets nearer than ``max_distance``, exact or by sketches of ``sketch_size`` hashes."""
    pairs = sketch_pairs(sketch(members, sketch_size), sketch_size) if sketch_size else set_pairs(members)
    return pairs.withColumn("distance", mash_distance(F.col("jaccard"), k)).filter(F.col("distance") < max_distance)
