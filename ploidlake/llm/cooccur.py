"""How often items occur together, by a heavy-light decomposition.

Heavy items own at least a fixed share of all incidences, so there are never more than ``HEAVY`` of them. Their pairs are
counted with a bit matrix: a task gives each basket one bit in the row of each heavy item and counts common bits. Pairs of
light items are counted by hash: every basket emits its own. Mixed pairs come from probing a basket's list of heavy items
with its light ones. Both lists of a basket stand in one row, which all three counts read. Baskets with more light items than ``CHUNK`` are cut into chunks, and chunks meet in the cells of a
grid over the basket: a cell holds at most ``CELL`` by ``CELL`` chunks and is the unit of the join, so no basket is one task
however many items it has. The three counts are united and compared with what chance would give.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ploidlake.functions.ids import clean_id
from ploidlake.runtime import Stages, shuffle_width

#: Bound of the number of heavy items.
HEAVY = 256
#: Light items of one basket handled together.
CHUNK = 64
#: Chunks on either side of a cell of a large basket's grid.
CELL = 16
#: A basket with more than one in this many rows has its size handed out by broadcast; there are fewer than this.
HOT_BASKETS = 1000
#: Heavy items of baskets in one bit matrix.
MATRIX = 1 << 16


def _bit_counts(n_items: int):
    """mapInArrow over ``(big)``, a basket's heavy items: ``(a, b, shared)`` for pairs of heavy items that meet in the task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros((n_items, n_items), np.int64)

        def add(lists):
            items = np.asarray(lists.flatten())
            bits = np.zeros((n_items, len(lists)), np.uint8)
            bits[items, np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))] = 1
            rows = np.flatnonzero(bits.any(axis=1))
            packed = np.packbits(bits[rows], axis=1)
            packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)
            for i in range(len(rows) - 1):
                total[rows[i], rows[i + 1 :]] += np.bitwise_count(packed[i] & packed[i + 1 :]).sum(axis=1, dtype=np.int64)

        held, size = [], 0
        for batch in batches:
            lists = batch.column(0)
            if len(lists):
                held.append(lists)
                size += len(lists.flatten())
            if size >= MATRIX:
                add(pa.concat_arrays(held))
                held, size = [], 0
        if size:
            add(pa.concat_arrays(held))
        a, b = np.nonzero(total)
        if len(a):
            yield pa.record_batch([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[a, b])], names=["a", "b", "shared"])

    return run


def pair_counts(rows: DataFrame, basket: str, item: str, min_shared: int = 1, heavy: int = HEAVY, chunk: int = CHUNK) -> DataFrame:
    """``(item_i, item_j, shared, n_i, n_j, baskets, ratio)`` with ``item_i < item_j``, for pairs that share a basket.

    ``shared``, ``n_i``, ``n_j``: baskets with both, with each; ``baskets``: all with an item; ``ratio``: shared * baskets /
    (n_i * n_j), how often more than by chance. Rows with a null basket or item don't count; repeats count once; pairs
    below ``min_shared`` are left out (items in fewer baskets leave before pairs form, which changes nothing else); empty
    input gives no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    stages = Stages(spark, "pairs")
    held = rows.select(F.col(basket).alias("name"), F.col(item).alias("item")).filter("name is not null and item is not null")
    held = stages.write(held.distinct())
    baskets = held.select("name").distinct().count()
    items = stages.write(held.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_shared))
    incidences = held.count()
    least = max(2, -(-incidences // heavy))
    top = sorted(items.filter(F.col("n") >= least).select("item").collect(), key=lambda r: r.item)  # at most ``heavy`` rows
    codes = {r.item: k for k, r in enumerate(top)}
    kind = held.schema["item"].dataType.simpleString()
    numbers = F.broadcast(spark.createDataFrame([(i, k) for i, k in codes.items()], f"item {kind}, h int"))
    marked = held.join(numbers, "item", "left")
    light = marked.filter("h is null").select("name", "item")
    if min_shared > 1:
        light = light.join(items.select("item"), "item", "left_semi")
    big = marked.filter("h is not null").select("name", "h")
    large = stages.write(light.groupBy("name").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > chunk))
    hot = F.broadcast(large.filter(F.col("size") > incidences // HOT_BASKETS).select("name", F.col("size").alias("hot_size")))  # fewer than HOT_BASKETS rows
    # Rows of hot baskets know the size already; a salt spreads them over the join that tells the others.
    salted = light.join(hot, "name", "left").withColumn("salt", F.when(F.col("hot_size").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("item"), F.lit(1 << 20))).cast("int"))
    cut = salted.join(large.withColumn("salt", F.lit(0)), ["name", "salt"], "left").withColumn("size", F.coalesce("hot_size", "size"))
    cut = cut.withColumn("part", F.when(F.col("size").isNull(), 0).otherwise(F.pmod(F.xxhash64("item"), F.ceil(F.col("size") / chunk))).cast("int"))
    # A large basket's heavy items, which are few, are a part of their own.
    apart = big.join(large, "name", "left").withColumn("part", F.when(F.col("size").isNull(), 0).otherwise(-1))
    both = cut.select("name", "part", "size", "item", F.lit(None).cast("int").alias("h")).unionByName(apart.select("name", "part", "size", F.lit(None).cast(kind).alias("item"), "h"))
    lists = both.groupBy("name", "part").agg(F.sort_array(F.collect_list("item")).alias("small"), F.sort_array(F.collect_list("h")).alias("big"), F.max("size").alias("size"))
    lists = stages.write(lists.filter("size(small) + size(big) > 1 or size is not null"))  # a lone item of a basket meets nothing
    # heavy x heavy, with as many tasks as there are for other work: popcounts are much work for little data
    told = lists.filter("size(big) > 1").select("name", "big").repartition(shuffle_width(spark), "name").select("big")
    pairs = told.mapInArrow(_bit_counts(max(1, len(codes))), "a int, b int, shared bigint").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    names = F.broadcast(spark.createDataFrame([(k, i) for i, k in codes.items()], f"a int, item_i {kind}"))
    names_j = F.broadcast(spark.createDataFrame([(k, i) for i, k in codes.items()], f"b int, item_j {kind}"))
    heavy_pairs = pairs.join(names, "a").join(names_j, "b").select("item_i", "item_j", "shared")
    # light x light
    own = F.expr("flatten(transform(small, (x, i) -> transform(slice(small, i + 2, size(small)), y -> struct(x as a, y as b))))")
    # Chunks of line i of the grid go to its cells (i, *) and (*, i); two chunks count in the one cell of their own lines.
    lines = F.ceil(F.ceil(F.col("size") / chunk) / CELL).cast("int")
    parts = lists.filter("size is not null and part >= 0").withColumn("line", F.pmod("part", lines))
    more = parts.select("name", "part", "small", "line", F.explode(F.sequence(F.lit(0), lines - 1)).alias("other"))
    more = more.select("name", F.least("line", "other").alias("low"), F.greatest("line", "other").alias("high"), "line", "part", "small")
    across = more.join(more.withColumnsRenamed({"line": "line2", "part": "part2", "small": "small2"}), ["name", "low", "high"])
    across = across.filter("part < part2 and least(line, line2) = low and greatest(line, line2) = high")
    cross = F.expr("flatten(transform(small, x -> transform(small2, y -> struct(least(x, y) as a, greatest(x, y) as b))))")
    emitted = _explode(lists.filter("size(small) > 1"), own, "item_i", "item_j").unionByName(_explode(across, cross, "item_i", "item_j"))
    hashed = emitted.groupBy("item_i", "item_j").agg(F.count(F.lit(1)).alias("shared"))
    # mixed: a large basket's list of heavy items goes once to each of its lines
    probe = F.expr("flatten(transform(small, x -> transform(big, y -> struct(x as a, y as b))))")
    asked = parts.drop("big").join(lists.filter("part = -1").select("name", "big", F.explode(F.sequence(F.lit(0), lines - 1)).alias("line")), ["name", "line"])
    probed = _explode(lists.filter("size(small) > 0 and size(big) > 0"), probe, "item", "a").unionByName(_explode(asked, probe, "item", "a"))
    mixed = probed.groupBy("item", "a").agg(F.count(F.lit(1)).alias("shared")).join(names, "a")
    mixed = mixed.select(F.least("item", "item_i").alias("item_i"), F.greatest("item", "item_i").alias("item_j"), "shared")
    found = heavy_pairs.unionByName(hashed).unionByName(mixed).filter(F.col("shared") >= min_shared)
    n = items.select(F.col("item"), F.col("n"))
    out = found.join(n.withColumnsRenamed({"item": "item_i", "n": "n_i"}), "item_i").join(n.withColumnsRenamed({"item": "item_j", "n": "n_j"}), "item_j")
    return out.select("item_i", "item_j", "shared", "n_i", "n_j", F.lit(baskets).cast("bigint").alias("baskets"), (F.col("shared") / F.col("n_i") * F.lit(baskets) / F.col("n_j")).alias("ratio"))


def _explode(lists: DataFrame, pairs: Column, a: str, b: str) -> DataFrame:
    return lists.select(F.explode(pairs).alias("p")).select(F.col("p.a").alias(a), F.col("p.b").alias(b))


def placements(read_placement: DataFrame) -> DataFrame:
    """``(read, ref)`` of rows with a name and a real contig; mate marks ``/1`` and ``/2`` don't tell reads apart."""
    name = F.regexp_replace("query_name", "/[12]$", "")
    return read_placement.select(F.when(name != "", name).alias("read"), clean_id("ref").alias("ref")).filter("read is not null and ref is not null")


def contig_pairs(read_placement: DataFrame, min_shared: int = 1) -> DataFrame:
    """``(ctg_i, ctg_j, links, reads_i, reads_j, all_reads, ratio)``: contigs that share reads."""
    names = {"item_i": "ctg_i", "item_j": "ctg_j", "shared": "links", "n_i": "reads_i", "n_j": "reads_j", "baskets": "all_reads"}
    return pair_counts(placements(read_placement), "read", "ref", min_shared).withColumnsRenamed(names)


def tied_contigs(read_placement: DataFrame, min_shared: int = 8, ratio: int = 5) -> DataFrame:
    """``(ctg_i, ctg_j)`` with at least ``min_shared`` reads in common and ``ratio`` times as many as by chance."""
    wide = [F.col(c).cast("decimal(38,0)") for c in ("links", "all_reads", "reads_i", "reads_j")]
    exact = wide[0].cast("decimal(19,0)") * wide[1].cast("decimal(19,0)") >= F.lit(ratio).cast("decimal(10,0)") * (wide[2].cast("decimal(14,0)") * wide[3].cast("decimal(14,0)"))
    return contig_pairs(read_placement, min_shared).filter(exact).select("ctg_i", "ctg_j")
