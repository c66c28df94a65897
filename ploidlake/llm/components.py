"""Groups from pairwise matches: hash-to-min over a distributed cluster relation.

A row ``(v, u)`` says that u is in the cluster set of v. In each round every vertex v sends its set to its smallest member
m, and m to all others of the set; the new set of a vertex is the union of what it receives. When nothing changes, the
smallest vertex of every component holds the whole component and each other vertex holds just that smallest one. Sets are
rows, never arrays, so a component with a third of all vertices is no unit of work: the minima form with partial
aggregation, and the join that hands them out gives vertices with very large sets (fewer than a fixed number) to all tasks,
so their rows stay where they are. Every few rounds finished components leave: those whose vertices all hold just their
smallest member, with no pair that leads out. Long chains then don't make the others go round with them. That a component
is finished is told to its vertices by its smallest one; the largest components' rows stay where they are then, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ploidlake.functions.ids import clean_id
from ploidlake.operators.skew import lookup
from ploidlake.runtime import Stages

#: A vertex with more than one in this many rows of the relation is handed out by broadcast; there are fewer than this.
BIG_SETS = 1000
#: Rounds are logarithmic in the longest chain; this many would need a chain beyond any number of records.
MAX_ROUNDS = 100
#: Rounds between two looks for finished components.
SETTLE_EVERY = 3


def hash_to_min(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(vertex, group)``: each vertex with a neighbour, and the smallest vertex it is linked with by any chain.

    Order is Spark's binary order (code points for strings). Pairs with a null side and pairs of a vertex with itself
    link nothing; directions and repeats don't matter; other columns are ignored; no pairs give no rows. Vertices that are
    no numbers are numbered in their order first, so that the rounds move and compare numbers only.
    """
    stages = Stages(edges.sparkSession, "components")
    pairs = edges.select(F.col(left).alias("v"), F.col(right).alias("u")).filter("v is not null and u is not null and v <> u")
    pairs = pairs.select(F.least("v", "u").alias("v"), F.greatest("v", "u").alias("u")).distinct()
    if isinstance(pairs.schema["v"].dataType, T.IntegralType):
        return _rounds(pairs, stages)
    pairs = stages.write(pairs)
    # Sorted and written, the numbers rise with the vertices and stay what they are.
    codes = stages.write(pairs.select(F.explode(F.array("v", "u")).alias("name")).distinct().orderBy("name").withColumn("code", F.monotonically_increasing_id()))
    coded = lookup(pairs, codes.withColumnsRenamed({"name": "v", "code": "a"}), "v").select("a", "u")
    coded = lookup(stages.write(coded), codes.withColumnsRenamed({"name": "u", "code": "b"}), "u").select(F.col("a").alias("v"), F.col("b").alias("u"))
    found = _rounds(coded, stages).join(codes.withColumnsRenamed({"code": "vertex", "name": "v"}), "vertex").select("v", "group")
    # One group may hold most vertices: its rows are told its name in shards.
    named = lookup(stages.write(found), codes.withColumnsRenamed({"code": "group", "name": "g"}), "group")
    return named.select(F.col("v").alias("vertex"), F.col("g").alias("group"))


def _rounds(pairs: DataFrame, stages: Stages) -> DataFrame:
    """``(vertex, group)`` of distinct pairs of numbers."""
    links = pairs.select(F.explode(F.array(F.struct("v", "u"), F.struct(F.col("u").alias("v"), F.col("v").alias("u")), F.struct(F.col("v"), F.col("v").alias("u")), F.struct(F.col("u").alias("v"), F.col("u")))).alias("p"))
    sets, state, settled = stages.write(links.select("p.v", "p.u").distinct()), None, []
    for k in range(1, MAX_ROUNDS + 1):
        seen = _state(sets)
        if seen == state or not seen[0]:
            break
        state = seen
        lowest = stages.write(sets.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n")))
        limit = max(1000, seen[0] // BIG_SETS)
        big = F.broadcast(lowest.filter(F.col("n") > limit).select("v", F.col("m").alias("bm"), F.col("n").alias("bn")))  # fewer than BIG_SETS rows
        marked = sets.join(big, "v", "left")
        told = marked.filter("bm is null").drop("bm", "bn").join(lowest.filter(F.col("n") <= limit), "v")
        told = told.unionByName(marked.filter("bm is not null").withColumnsRenamed({"bm": "m", "bn": "n"}))
        if k % SETTLE_EVERY == 0:
            told = stages.write(told)
            # A member of very many sets has a very large set itself, so the same few vertices go to all tasks.
            near = told.join(big.select(F.col("v").alias("u"), F.col("bm").alias("mu")), "u", "left").select("u", "v", "m", "n", "mu")
            rest = near.filter("mu is null").drop("mu").join(lowest.filter(F.col("n") <= limit).select(F.col("v").alias("u"), F.col("m").alias("mu")), "u")
            both = near.filter("mu is not null").unionByName(rest)
            unfinished = both.filter("m <> mu or (v <> m and n > 1)").select(F.explode(F.array("m", "mu")).alias("m")).distinct()
            unfinished = stages.write(unfinished)
            # All rows of a component may have one m: those of very many rows (fewer than BIG_SETS) are looked up by broadcast.
            crowded = stages.write(told.groupBy("m").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > limit).select("m").join(unfinished.withColumn("open", F.lit(True)), "m", "left"))

            def where(rows: DataFrame, is_open: bool, crowded: DataFrame = crowded, unfinished: DataFrame = unfinished) -> DataFrame:
                """Rows of components that are unfinished, or not."""
                few = rows.join(F.broadcast(crowded.select("m")), "m", "left_anti").join(unfinished.hint("merge"), "m", "left_semi" if is_open else "left_anti")
                return few.unionByName(rows.join(F.broadcast(crowded.filter("open is not null" if is_open else "open is null").select("m")), "m", "left_semi"))

            settled.append(stages.write(where(lowest.select("v", "m"), False).select("v", F.col("m").alias("g"))))
            told = where(told, True)
        sent = told.select(F.explode(F.array(F.struct(F.col("m").alias("v"), F.col("u")), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("p"))
        done, sets = sets, stages.write(sent.select("p.v", "p.u").distinct())
        stages.drop(done, lowest)
    else:
        raise RuntimeError(f"not stable after {MAX_ROUNDS} rounds")
    found = sets.groupBy("v").agg(F.min("u").alias("g"))
    for part in settled:
        found = found.unionByName(part)
    return found.select(F.col("v").alias("vertex"), F.col("g").alias("group"))


def _state(sets: DataFrame) -> tuple:
    """Row count and an order-free checksum: equal sets give equal states."""
    h = F.xxhash64("v", "u")
    r = sets.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(F.pmod(h, F.lit(2147483647)))).first()
    return tuple(r)


def contig_groups(self_paf: DataFrame) -> DataFrame:
    """``(contig_id, group_id)`` of contigs tied by alignment records with both ids present."""
    ids = self_paf.select(clean_id("query_id").alias("q"), clean_id("target_id").alias("t"))
    return hash_to_min(ids, "q", "t").select(F.col("vertex").alias("contig_id"), F.col("group").alias("group_id"))


def group_sizes(self_paf: DataFrame) -> DataFrame:
    """``(group_id, contigs)``."""
    return contig_groups(self_paf).groupBy("group_id").agg(F.count(F.lit(1)).alias("contigs"))
