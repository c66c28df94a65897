"""Joining collinear contigs end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ploidlake.folds.lis import join_plan
from ploidlake.functions.scalar import reverse_complement
from ploidlake.operators.align import oriented
from ploidlake.params import Redundancy
from ploidlake.runtime import Stages

_PLAN = "falling boolean, run int, coverage double, r2 double, short_first boolean, cut_short bigint, cut_long bigint, short_end string, long_end string"


def join_plans(aln: DataFrame, p: Redundancy = Redundancy()) -> DataFrame:
    """A row per collinear pair of contigs: how its sequences join.

    A pair's distinct alignments stand in one row, which a vectorised function plans by the batch of pairs. Pairs of one
    alignment have no correlation and are left out before.
    """
    sides = ["short_start", "short_end", "long_start", "long_end"]
    rows = oriented(aln).filter("long_id <> short_id")
    rows = rows.groupBy("long_id", "short_id", *sides).agg(F.max("long_len").alias("long_len"), F.max("short_len").alias("short_len"), F.min("line_no").alias("line_no"))
    pairs = rows.groupBy("long_id", "short_id").agg(
        F.max("long_len").alias("long_len"), F.max("short_len").alias("short_len"), F.min("line_no").alias("first_line"), F.sort_array(F.collect_list(F.struct("line_no", *sides))).alias("places"), F.count(F.lit(1)).alias("n")
    )
    if p.min_r2 > 0:
        pairs = pairs.filter("n > 1")
    min_r2, coverage = p.min_r2, p.lis_coverage
    kind = f"struct<{_PLAN.replace(' ', ':').replace(',:', ', ')}>"

    def plan(places, short_len, long_len):
        import pyarrow as pa

        def one(rows, s, t):
            return join_plan([tuple(r[c] for c in sides) for r in rows], s, t, min_r2, coverage)

        made = [one(r, s, t) for r, s, t in zip(places.to_pylist(), short_len.to_pylist(), long_len.to_pylist(), strict=True)]
        fields = [pa.field(n, {"boolean": pa.bool_(), "int": pa.int32(), "double": pa.float64(), "bigint": pa.int64(), "string": pa.string()}[k]) for n, k in (x.split() for x in _PLAN.split(", "))]
        return pa.array(made, pa.struct(fields))

    planned = pairs.withColumn("plan", F.arrow_udf(plan, kind)("places", "short_len", "long_len")).filter("plan is not null")
    return planned.select("long_id", "short_id", "first_line", "plan.*")


def greedy_pairs(pairs: DataFrame, a: str, b: str, order: str) -> DataFrame:
    """Pairs taken in order while both members are free; each member is in one pair at most.

    Rounds instead of a walk: a pair that comes first for both of its members is taken for sure; pairs that touch it go.
    """
    stages = Stages(pairs.sparkSession, "pairing")
    left = stages.write(pairs)
    taken: list[DataFrame] = []
    while not left.isEmpty():
        ends = left.select(F.explode(F.array(a, b)).alias("m"), F.col(order).alias("o")).groupBy("m").agg(F.min("o").alias("first"))
        marked = left.join(ends.select(F.col("m").alias(a), F.col("first").alias("fa")), a).join(ends.select(F.col("m").alias(b), F.col("first").alias("fb")), b)
        got = stages.write(marked.filter((F.col(order) == F.col("fa")) & (F.col(order) == F.col("fb"))).select(pairs.columns))
        taken.append(got)
        gone = got.select(F.explode(F.array(a, b)).alias("m"))
        done, left = left, stages.write(left.join(gone.withColumnRenamed("m", a), a, "left_anti").join(gone.withColumnRenamed("m", b), b, "left_anti").select(pairs.columns))
        stages.drop(done)
    out = left
    for t in taken:
        out = out.unionByName(t)
    return out


def merged_sequences(plans: DataFrame, sequences: DataFrame) -> DataFrame:
    """``(contig_id, seq)``: each planned pair joined, then the sequences no pair took."""
    short = sequences.select(F.col("contig_id").alias("short_id"), F.col("seq").alias("s"))
    long = sequences.select(F.col("contig_id").alias("long_id"), F.col("seq").alias("l"))
    both = plans.join(short, "short_id").join(long, "long_id").withColumn("l", F.when(F.col("falling"), reverse_complement(F.col("l"))).otherwise(F.col("l")))
    seq = F.expr("case when short_first then concat(substring(s, 1, int(cut_short)), substring(l, int(cut_long) + 1)) else concat(substring(l, 1, int(cut_long)), substring(s, int(cut_short) + 1)) end")
    used = plans.select(F.explode(F.array("long_id", "short_id")).alias("contig_id"))
    made = both.select(F.concat(F.lit("merged_"), "long_id", F.lit("_"), "short_id").alias("contig_id"), seq.alias("seq"))
    return made.unionByName(sequences.join(used, "contig_id", "left_anti").select("contig_id", "seq"))
