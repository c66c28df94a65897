"""Continuous periods and gaps of intervals: a mergeable aggregate of sorted disjoint intervals.

A partial result is one row per key and tile of the start coordinate that holds the sorted, disjoint intervals of some of
its rows. Two partial results merge by interleaving their sorted lists, without sorting again, into another one, in any
order, so they combine in a reduction tree: rows become lists inside every input partition (before any shuffle), then
``fan_in`` partial results at a time merge while a key and tile has more of them, at last all that remain; inside a task
the lists of a key and tile merge two by two. Tiles keep every list short however many rows a key has. Between tiles only
their first start and furthest end travel: a running maximum of the ends decides which intervals of a tile continue an
earlier period, and the complement of the periods is emitted with them.

Coordinates may be integers, decimals, fractions, dates or timestamps with or without zone; results have their type.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ploidlake.runtime import Stages, partition_bound

#: Width of a tile of the start coordinate; of whole numbers a list has at most half as many intervals.
TILE = 1 << 19
#: Width of a tile of timestamps, in microseconds: an hour.
TIME_TILE = 3_600_000_000
#: Partial results merged at a time.
FAN_IN = 8
#: Most crowded keys and tiles that are told to every task; more of them are joined.
MAX_TOLD = 100_000
#: Rows or intervals that a task gathers before it merges them.
BUFFER = 1 << 18
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _ticks(kind: T.DataType) -> tuple[Callable[[Column], Column], Callable[[Column], Column], int]:
    """How coordinates become bigint or double and what they were again, and how many ticks a tile of ``TILE`` has."""
    if isinstance(kind, _WHOLE):
        return lambda c: c.cast("bigint"), lambda c: c.cast(kind), TILE
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return lambda c: F.nanvl(c.cast("double"), F.lit(None).cast("double")), lambda c: c.cast(kind), TILE
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        unit = F.lit(10**kind.scale).cast("decimal(19,0)")
        return lambda c: (c * unit).cast("bigint"), lambda c: (c.cast("decimal(19,0)") / unit).cast(kind), TILE * 10**kind.scale
    if isinstance(kind, T.DateType):
        return lambda c: F.unix_date(c).cast("bigint"), lambda c: F.date_from_unix_date(c.cast("int")), TILE
    if isinstance(kind, T.TimestampType):
        return F.unix_micros, F.timestamp_micros, TIME_TILE
    if isinstance(kind, T.TimestampNTZType):

        def micros(c: Column) -> Column:  # no zone comes in between, so no hour is lost or doubled
            since = c - F.expr(_EPOCH)
            day, hour, minute = (F.extract(F.lit(x), since).cast("bigint") for x in ("DAY", "HOUR", "MINUTE"))
            return ((day * 24 + hour) * 60 + minute) * 60_000_000 + (F.extract(F.lit("SECOND"), since) * 1_000_000).cast("bigint")

        return micros, lambda c: F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (c.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")), TIME_TILE
    raise TypeError(f"intervals of {kind.simpleString()}")


def _common(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of both coordinates."""
    if a == b:
        return a
    numbers = (*_WHOLE, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.LongType() if isinstance(a, _WHOLE) and isinstance(b, _WHOLE) else T.DoubleType()
    raise TypeError(f"intervals from {a.simpleString()} to {b.simpleString()}")


def _sweep(pa, np, keys: list, starts, ends) -> tuple:
    """Rows into lists: numbers of the groups' first rows, list offsets, and sorted disjoint intervals per group of ``keys``."""
    codes = [np.asarray((k.combine_chunks() if isinstance(k, pa.ChunkedArray) else k).dictionary_encode(null_encoding="encode").indices).astype(np.int64) for k in keys]
    order = np.lexsort((starts, *codes[::-1]))
    s, e = starts[order], ends[order]
    new = np.zeros(len(order), bool)
    new[0] = True
    for c in codes:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    group = np.cumsum(new) - 1
    low, high = (int(e.min()), int(e.max())) if e.dtype.kind == "i" else (0, 1 << 62)
    if (high - low + 1) * (int(group[-1]) + 1) < 1 << 62:
        span = high - low + 1
        reach = np.maximum.accumulate(e - low + group * span) - group * span + low
    else:  # ranks instead of wide or fractional coordinates
        levels, rank = np.unique(e, return_inverse=True)
        reach = levels[np.maximum.accumulate(rank + group * len(levels)) - group * len(levels)]
    opens = new.copy()
    opens[1:] |= s[1:] > reach[:-1]  # touching intervals continue a period
    at = np.flatnonzero(opens)
    last = np.append(at[1:], len(order)) - 1
    offsets = np.append(np.flatnonzero(new[at]), len(at))
    return order[np.flatnonzero(new)], offsets, s[at], reach[last]


def _interleave(np, group, offsets, s, e) -> tuple:
    """Sorted disjoint lists of equal ``group`` (side by side) merged two by two until each group has one.

    An interval's place is its place in its own list and its rank in the other one; what is covered before it are the last
    ends of both lists before that place. So a merge needs no sort and no pass but one over both lists.
    """
    while True:
        new = np.append(True, group[1:] != group[:-1])
        first = np.flatnonzero(new)
        nth = np.arange(len(group)) - first[np.cumsum(new) - 1]
        if len(first) == len(group):
            return offsets, s, e
        odd = nth % 2 == 1
        mate = np.where(odd, np.arange(len(group)) - 1, np.arange(len(group)) + 1)
        alone = ~odd & np.append(new[1:], True)
        own = np.repeat(np.arange(len(group)), np.diff(offsets))
        nobody = alone[own]
        mate = np.where(alone, 0, mate)
        low, high = offsets[mate[own]], offsets[mate[own] + 1]
        base = low.copy()
        high = np.where(nobody, low, high)
        right = odd[own]
        todo = np.flatnonzero(low < high)
        while len(todo):  # ranks by bisection, of all intervals at once
            mid = (low[todo] + high[todo]) >> 1
            up = np.where(right[todo], s[mid] <= s[todo], s[mid] < s[todo])
            low[todo] = np.where(up, mid + 1, low[todo])
            high[todo] = np.where(up, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        rank = low - base
        place = np.arange(len(s)) - offsets[own]
        to = offsets[np.where(right, mate[own], own)] + place + rank
        mine, theirs = place > 0, rank > 0
        last_mine, last_theirs = e[np.arange(len(s)) - mine], e[low - theirs]
        opens = ~((mine & (s <= last_mine)) | (theirs & (s <= last_theirs)))  # touching intervals continue a period
        reach = np.where(theirs, np.maximum(e, last_theirs), e)
        s2, reach2, opens2 = np.empty_like(s), np.empty_like(e), np.empty(len(s), bool)
        s2[to], reach2[to], opens2[to] = s, reach, opens
        at = np.flatnonzero(opens2)
        s, e = s2[at], reach2[np.append(at[1:], len(s2)) - 1]
        kept = np.flatnonzero(~odd)
        offsets = np.append(np.searchsorted(at, offsets[kept]), len(at))
        group = group[kept]


def _merger(keys: list[str], lists: bool, hold_last: bool):
    """A mapInArrow function that makes lists of rows, or merges partial results of equal keys and tiles, within a buffer.

    Partial results come sorted by key and tile. With ``hold_last`` a group that a buffer ends in is carried to the next
    one, so every group gives exactly one row.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        by = [*keys, "tile"]

        def begins(t):
            new = np.zeros(t.num_rows, bool)
            new[0] = True
            for k in by:
                c = np.asarray(t[k].combine_chunks().dictionary_encode(null_encoding="encode").indices)
                new[1:] |= c[1:] != c[:-1]
            return new

        def merge(t):
            t = t.combine_chunks()
            if lists:
                new = begins(t)
                first = np.flatnonzero(new)
                starts, ends = (t[c].combine_chunks() for c in ("starts", "ends"))
                offsets = np.append(0, np.cumsum(np.asarray(starts.value_lengths()))).astype(np.int64)
                offsets, s, e = _interleave(np, np.cumsum(new), offsets, np.asarray(starts.flatten()), np.asarray(ends.flatten()))
            else:
                first, offsets, s, e = _sweep(pa, np, [t[k] for k in by], t["s"].to_numpy(), t["e"].to_numpy())
            got = t.take(pa.array(first))
            offs = pa.array(offsets.astype(np.int32))
            cols = [got[k] for k in [*by, "node"]] + [pa.ListArray.from_arrays(offs, pa.array(s)), pa.ListArray.from_arrays(offs, pa.array(e))]
            return pa.table(cols, names=[*by, "node", "starts", "ends"])

        held: list = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += len(batch.column("starts").flatten()) if lists else batch.num_rows
            if size >= BUFFER:
                t = pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
                if hold_last:
                    cut = int(np.flatnonzero(begins(t))[-1])
                    rest = merge(t.slice(cut))  # the open group, already merged: it stays short
                    held = rest.select(t.column_names).to_batches()
                    if not cut:
                        continue
                    t = t.slice(0, cut)
                yield from merge(t).to_batches()
        if size:
            yield from merge(pa.Table.from_batches(held)).to_batches()

    return run


def interval_lists(df: DataFrame, keys: list[str], start: str, end: str, stages: Stages, tile: float = TILE, fan_in: int = FAN_IN) -> tuple[DataFrame, list[DataFrame]]:
    """One row per key and tile: ``keys, tile, starts, ends`` with sorted disjoint intervals of bigint or double.

    Also the stages it reads, which can go once it is written.
    """
    rows = df.select(*keys, F.col(start).alias("s"), F.col(end).alias("e")).filter(F.col("e") > F.col("s"))
    far = 9e15  # infinite starts have a tile, too
    rows = rows.withColumn("tile", F.floor(F.greatest(F.least(F.col("s") / F.lit(tile), F.lit(far)), F.lit(-far))).cast("bigint")).withColumn("node", F.spark_partition_id().cast("bigint"))
    kinds = [T.StructField(k, df.schema[k].dataType) for k in keys]
    spans = T.ArrayType(df.schema[start].dataType)
    schema = T.StructType([*kinds, T.StructField("tile", T.LongType()), T.StructField("node", T.LongType()), T.StructField("starts", spans), T.StructField("ends", spans)])
    by = [*keys, "tile"]
    parts = partition_bound(rows)
    partial = rows.mapInArrow(_merger(keys, lists=False, hold_last=False), schema)
    calm, read = [], []
    if parts > fan_in:
        partial = stages.write(partial)
        read.append(partial)
    while parts > fan_in:
        crowded = stages.write(partial.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > fan_in).select(*by))
        read.append(crowded)
        many = crowded.count()
        if not many:
            break
        crowded = crowded.hint("broadcast" if many <= MAX_TOLD else "merge")  # few are told to all tasks, so that lists stay where they are
        calm.append(partial.join(crowded, by, "left_anti"))
        up = partial.join(crowded, by, "left_semi").withColumn("node", F.floor(F.col("node") / fan_in).cast("bigint"))
        partial = stages.write(up.repartition(*by, "node").sortWithinPartitions(*by, "node").mapInArrow(_merger(keys, True, False), schema))
        read.append(partial)
        parts = -(-parts // fan_in)
    for rest in calm:
        partial = partial.unionByName(rest)
    return partial.repartition(*by).sortWithinPartitions(*by).mapInArrow(_merger(keys, True, True), schema).drop("node"), read


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str, tile: float | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """``keys, span_kind, span_start, span_end`` of half-open intervals per key.

    ``'period'`` is a longest stretch covered without a hole (touching intervals make one), ``'gap'`` the stretch between
    two neighbouring periods. Rows with a null key, null or empty or reversed interval count for nothing; repeated rows
    change nothing; extra columns are ignored; an empty table gives no rows. Two rows per key and coordinate never arise.
    NaN bounds count for nothing, infinite ones are as good as others. Spans have the type of the columns (bigint or double
    if these are of two kinds of numbers); other types raise. ``tile`` is in units of the column, microseconds for
    timestamps, and has no influence on the result.
    """
    kind = _common(df.schema[start].dataType, df.schema[end].dataType)
    ticks, back, width = _ticks(kind)
    tile = tile * width / TILE if tile and isinstance(kind, T.DecimalType) else tile or width
    df = df.filter(" and ".join(f"`{k}` is not null" for k in keys))
    renamed = [f"k{i}" for i in range(len(keys))]
    slim = df.select(*[F.col(k).alias(r) for k, r in zip(keys, renamed, strict=True)], ticks(F.col(start).cast(kind)).alias("i_start"), ticks(F.col(end).cast(kind)).alias("i_end"))
    stages = Stages(df.sparkSession, "intervals")
    lists, read = interval_lists(slim, renamed, "i_start", "i_end", stages, tile, fan_in)
    lists = stages.write(lists.withColumn("reach", F.element_at("ends", -1)))
    stages.drop(*read)
    key, by = Window.partitionBy(*renamed), [*renamed, "tile"]
    before = key.orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    seams = lists.select(*by, "reach").select(*by, F.max("reach").over(before).alias("carry"), F.max("reach").over(key).alias("key_reach"), F.count(F.lit(1)).over(key).alias("tiles"))
    seams = seams.filter("tiles > 1").drop("tiles")
    # Intervals that begin at or before the carried end continue an earlier period; the others open one each.
    cut = lists.join(seams, by, "left").withColumn("pairs", F.arrays_zip("starts", "ends"))
    cut = cut.select(
        *by,
        F.coalesce("key_reach", "reach").alias("key_reach"),
        F.expr("case when carry is null or starts[0] > carry then pairs else filter(pairs, x -> x.starts > carry) end").alias("opens"),
        F.expr("greatest(carry, case when starts[0] <= carry then array_max(transform(filter(pairs, x -> x.starts <= carry), x -> x.ends)) end)").alias("behind"),
    )
    base = stages.write(cut.filter("size(opens) > 0"))
    stages.drop(lists)
    # A tile's last period ends where the period before the next tile's first opening does.
    edges = base.select(*by, "key_reach", "behind", F.expr("opens[0].starts").alias("first_open"), F.expr("opens[size(opens) - 1].starts").alias("last_open"))
    edges = edges.withColumn("closes", F.coalesce(F.lead("behind").over(key.orderBy("tile")), "key_reach"))
    edges = edges.select(*renamed, F.expr("stack(2, 'period', last_open, closes, 'gap', behind, first_open) as (span_kind, span_start, span_end)")).filter("span_start is not null")
    inner = base.filter("size(opens) > 1").select(*renamed, F.expr("inline(transform(slice(opens, 1, size(opens) - 1), (x, i) -> struct(x.starts as s, x.ends as e, opens[i + 1].starts as n)))"))
    inner = inner.select(*renamed, F.expr("stack(2, 'period', s, e, 'gap', e, n) as (span_kind, span_start, span_end)"))
    spans = edges.unionByName(inner)
    return spans.select(*[F.col(r).alias(k) for k, r in zip(keys, renamed, strict=True)], "span_kind", back(F.col("span_start")).alias("span_start"), back(F.col("span_end")).alias("span_end"))


def alignment_periods(paf: DataFrame) -> DataFrame:
    """Covered periods and gaps of each query on each target, from the records with both ids."""
    from ploidlake.functions.ids import clean_id

    rows = paf.select(clean_id("query_id").alias("query_id"), clean_id("target_id").alias("target_id"), "target_start", "target_end")
    return periods_and_gaps(rows, ["query_id", "target_id"], "target_start", "target_end")
