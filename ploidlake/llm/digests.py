"""Percentiles per group by merging centroid digests, with a certified rank error.

A digest is a sorted list of centroids (mean, weight). Sorted values, or the centroids of several digests, are clustered
under the size function k(q) = delta / (2 pi) * asin(2 q - 1): what falls into the same unit of k becomes one centroid, so
centroids are small at the ends and a digest has about delta / 2 of them whatever it stands for. Digests of partitions or
days merge by clustering their centroids again. A second pass over the values counts how many lie below and at each
estimate; groups whose rank error is above the bound are digested again with a finer size function, and these counts are
reported, so the error is known and not just expected.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ploidlake.operators.skew import lookup
from ploidlake.runtime import Stages, partition_bound

DELTA = 200
#: Certified bound of the rank error, beyond the half step that a finite number of values can't avoid.
MAX_ERROR = 0.01
BUFFER = 1 << 18


def _clusterer(keys: list[str], delta: float, weighted: bool, hold_last: bool):
    """mapInArrow: rows ``keys, x`` or digests ``keys, means, weights`` to one digest per group and buffer."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def codes_of(t, k):
            return np.asarray(t[k].combine_chunks().dictionary_encode(null_encoding="encode").indices).astype(np.int64)

        def cluster(t):
            t = t.combine_chunks()
            if weighted:
                rows = np.repeat(np.arange(t.num_rows), pc.list_value_length(t["means"]).to_numpy())
                x, w = pc.list_flatten(t["means"]).to_numpy(), pc.list_flatten(t["weights"]).to_numpy()
            else:
                rows, x, w = np.arange(t.num_rows), t["x"].to_numpy(), np.ones(t.num_rows)
            codes = [codes_of(t, k)[rows] for k in keys]
            order = np.lexsort((x, *codes[::-1]))
            x, w, rows = x[order], w[order], rows[order]
            new = np.zeros(len(order), bool)
            new[0] = True
            for c in codes:
                c = c[order]
                new[1:] |= c[1:] != c[:-1]
            at = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            total = np.add.reduceat(w, at)[group]
            past = np.cumsum(w)
            past -= (past[at] - w[at])[group]  # weight up to and with this one, within its group
            q = np.clip((past - w / 2) / total, 0, 1)
            unit = np.floor(delta / (2 * np.pi) * np.arcsin(2 * q - 1)).astype(np.int64)
            opens = new.copy()
            opens[1:] |= unit[1:] != unit[:-1]
            begin = np.flatnonzero(opens)
            weight = np.add.reduceat(w, begin)
            mean = np.add.reduceat(x * w, begin) / weight
            same = np.minimum.reduceat(x, begin) == np.maximum.reduceat(x, begin)
            mean[same] = x[begin][same]  # ties stay exact
            offsets = pa.array(np.append(np.flatnonzero(new[begin]), len(begin)).astype(np.int32))
            heads = t.take(pa.array(rows[at]))
            ends = np.append(at[1:], len(order)) - 1
            low, high = (np.minimum.reduceat(t["low"].to_numpy()[rows], at), np.maximum.reduceat(t["high"].to_numpy()[rows], at)) if weighted else (x[at], x[ends])
            cols = [heads[k] for k in keys] + [pa.array(low), pa.array(high), pa.ListArray.from_arrays(offsets, pa.array(mean)), pa.ListArray.from_arrays(offsets, pa.array(weight))]
            return pa.table(cols, names=[*keys, "low", "high", "means", "weights"])

        held: list = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows * (DELTA // 8 if weighted else 1)
            if size >= BUFFER:
                t = pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                if hold_last:
                    begin = np.zeros(t.num_rows, bool)
                    begin[0] = True
                    for k in keys:
                        c = codes_of(t, k)
                        begin[1:] |= c[1:] != c[:-1]
                    cut = int(np.flatnonzero(begin)[-1])
                    held = cluster(t.slice(cut)).select(t.column_names).to_batches()
                    if not cut:
                        continue
                    t = t.slice(0, cut)
                yield from cluster(t).to_batches()
        if held:
            yield from cluster(pa.Table.from_batches(held)).to_batches()

    return run


def _schema(df: DataFrame, keys: list[str]) -> T.StructType:
    xs = T.ArrayType(T.DoubleType())
    ends = [T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]
    return T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], *ends, T.StructField("means", xs), T.StructField("weights", xs)])


def digests(values: DataFrame, keys: list[str], column: str, delta: float = DELTA) -> DataFrame:
    """One digest per combination of ``keys``: ``keys, low, high, means, weights``.

    Null, NaN and infinite values don't count; a null key is a key; groups without a value have no digest; repeated rows
    count each time. Every task digests its rows before the shuffle, so a hot group moves one digest per task.
    """
    x = F.col(column).cast("double")
    rows = values.select(*keys, x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x") & ~F.abs("x").eqNullSafe(float("inf")))
    return merge(rows.mapInArrow(_clusterer(keys, delta, False, False), _schema(rows, keys)), keys, delta)


def merge(parts: DataFrame, keys: list[str], delta: float = DELTA, fan_in: int = 64) -> DataFrame:
    """Digests of equal ``keys`` as one each, by clustering their centroids again.

    Merges in two levels, so that a group with a digest in each of very many tasks or days is merged by several tasks.
    """
    schema = _schema(parts, keys)
    if partition_bound(parts) > fan_in:
        salted = parts.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
        parts = salted.repartition(*keys, "__salt").sortWithinPartitions(*keys).select(parts.columns).mapInArrow(_clusterer(keys, delta, True, False), schema)
    return parts.select("low", "high", *keys, "means", "weights").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_clusterer(keys, delta, True, True), schema)


def estimates(digest: DataFrame, keys: list[str], percents: list[int]) -> DataFrame:
    """``keys, n, percent, estimate``: linear between the middles of neighbouring centroids, ends at the extremes."""
    ps = ", ".join(map(str, sorted(percents)))
    named = digest.select(*keys, "low", "high", "means", "weights", F.expr("aggregate(weights, 0D, (a, w) -> a + w)").alias("n"))
    mids = F.expr("transform(sequence(1, size(weights)), i -> aggregate(slice(weights, 1, i), 0D, (a, w) -> a + w) - weights[i - 1] / 2)")
    points = named.withColumn("at", F.concat(F.array(F.lit(0.0)), mids, F.array(F.col("n")))).withColumn("val", F.concat(F.array("low"), "means", F.array("high")))
    each = points.select(*keys, "n", "at", "val", F.explode(F.expr(f"array({ps})")).alias("percent")).withColumn("goal", F.col("percent") * F.col("n") / 100)
    each = each.withColumn("i", F.expr("greatest(1, least(size(at) - 1, size(filter(at, a -> a <= goal))))"))
    line = "val[i - 1] + (val[i] - val[i - 1]) * case when at[i] > at[i - 1] then least(1D, (goal - at[i - 1]) / (at[i] - at[i - 1])) else 1D end"
    return each.select(*keys, F.col("n").cast("bigint").alias("n"), "percent", F.expr(line).alias("estimate"))


def certify(values: DataFrame, found: DataFrame, key: str, column: str, percents: list[int]) -> DataFrame:
    """``found`` with ``rank_error``: how far each percent is from the ranks its estimate has among the values.

    Counts values below and at each estimate; values of hot groups are counted in shards.
    """
    packed = found.groupBy(key).agg(*[F.max(F.when(F.col("percent") == p, F.col("estimate"))).alias(f"__e{p}") for p in percents])
    packed = packed.withColumnsRenamed({f"__e{p}": f"e{p}" for p in percents})
    rows = values.select(key, F.col(column).cast("double").alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x") & ~F.abs("x").eqNullSafe(float("inf")))
    joined = lookup(rows, packed, key)
    sums = [F.sum((F.col("x") < F.col(f"e{p}")).cast("bigint")).alias(f"b{p}") for p in percents] + [F.sum((F.col("x") <= F.col(f"e{p}")).cast("bigint")).alias(f"u{p}") for p in percents]
    each = ", ".join(f"struct({p} as percent, b{p} as below, u{p} as upto)" for p in percents)
    ranks = joined.groupBy(key).agg(*sums).select(key, F.expr(f"inline(array({each}))"))
    goal = F.col("percent") * F.col("n") / 100
    off = F.greatest(F.lit(0.0), F.col("below") - goal, goal - F.col("upto"))
    return found.join(ranks, [key, "percent"]).withColumn("rank_error", off / F.col("n")).drop("below", "upto")


def percentiles(values: DataFrame, key: str, column: str, percents: list[int], max_error: float = MAX_ERROR, delta: float = DELTA, digest: DataFrame | None = None) -> DataFrame:
    """``(key, n, percent, estimate, rank_error)`` with ``rank_error <= max_error + 0.5 / n`` for every row.

    ``rank_error`` is the distance between the percent and the share of values below (or at) the estimate. Groups over
    the bound are digested again with a four times finer size function until none is left; at the latest every value is a
    centroid then, whose error is below half a step. ``digest`` takes digests made before (of days, say, merged).
    """
    stages = Stages(values.sparkSession, "digests")
    rows = values.select(F.col(key).alias("k"), F.col(column).alias("v")).filter(F.col("k").isNotNull())
    made = digest.withColumnRenamed(key, "k") if digest is not None else digests(rows, ["k"], "v", delta)
    good = None
    while True:
        guesses = stages.write(estimates(made, ["k"], percents))
        found = stages.write(certify(rows, guesses, "k", "v", percents))
        stages.drop(guesses)
        over = found.groupBy("k").agg(F.max(F.col("rank_error") - max_error - 0.5 / F.col("n")).alias("over")).filter("over > 1e-9")
        if over.isEmpty():
            good = found if good is None else good.unionByName(found)
            break
        kept = found.join(over, "k", "left_anti")
        good = kept if good is None else good.unionByName(kept)
        rows = stages.write(lookup(rows, over.select("k"), "k"))
        delta *= 4
        made = digests(rows, ["k"], "v", delta)
    return good.select(F.col("k").alias(key), "n", "percent", "estimate", "rank_error")


# -- read depth ------------------------------------------------------------------------------------------------------


def valid_depths(depth_win: DataFrame) -> DataFrame:
    """``(contig_id, win_start, load_day, depth)``: each window once, on its first load day; void depths left out."""
    d = F.col("depth")
    good = depth_win.filter("contig_id is not null").filter(d.isNotNull() & ~F.isnan(d) & (d >= 0) & (d < float("inf")))
    return good.groupBy("contig_id", "win_start").agg(F.min("loaded_at").cast("date").alias("load_day"), F.max("depth").alias("depth"))


def depth_percentiles(depth_win: DataFrame, percents: list[int]) -> DataFrame:
    """Percentiles of depth per contig, from digests of single load days that are then merged."""
    stages = Stages(depth_win.sparkSession, "depth")
    values = stages.write(valid_depths(depth_win))
    daily = digests(values, ["contig_id", "load_day"], "depth")
    merged = merge(daily.drop("load_day"), ["contig_id"])
    return percentiles(values, "contig_id", "depth", percents, digest=merged)


def uneven_contigs(depth_win: DataFrame, least: int = 20, ratio: float = 3.0) -> DataFrame:
    """``(contig_id)``: contigs with ``least`` windows whose 90th percentile is ``ratio`` times the median or more."""
    found = depth_percentiles(depth_win, [50, 90]).filter(F.col("n") >= least)
    wide = found.groupBy("contig_id").agg(F.max(F.expr("case when percent = 50 then estimate end")).alias("p50"), F.max(F.expr("case when percent = 90 then estimate end")).alias("p90"))
    return wide.filter(F.col("p90") >= ratio * F.col("p50")).select("contig_id")
