"""The N best items of every group by descending score bands.

Scores are cut into ranges at ranks that grow geometrically from the top, and the ranges are processed from the highest
down, each read from the input on its own. First the rows of groups already filled leave by an anti-join; what is left is
ranked by (score, ties), and in the band where a group's places run out only as many rows as there are places are taken.
A row is shuffled once at most, by its group; groups with a large share of all rows don't move as a whole: they are spread
by item and keep N rows per group and task before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ploidlake.functions.ids import clean_id
from ploidlake.runtime import Stages, fresh

#: Shares of all rows above the lower edges of the bands; the last band takes the rest.
BAND_TOPS = (0.02, 0.10, 0.40)
#: Groups with at least this share of all rows are spread by item; there are at most 1 / HOT of them.
HOT = 0.002
#: Accuracy of the bands' edges, which say only what is done together.
ACCURACY = 1000


def top_n(df: DataFrame, group: str, score: str, ties: list[tuple[str, bool]], item: str, n: int) -> DataFrame:
    """``(group, item, rank)``: per group its ``n`` highest scores, ties by ``ties`` (column, ascending), nulls there last.

    Rows with a null group, score or item don't take part; an item delivered again counts once per group, by the best of its
    rows; NaN scores rank lowest; the item itself is the last tie key; groups with fewer items give what they have; an empty
    table gives no rows; other columns are ignored. ``df`` is read once for each band and twice for their edges.
    """
    stages = Stages(df.sparkSession, "topn")
    value = F.col(score)
    if df.schema[score].dataType.typeName() in ("double", "float"):
        value = F.when(F.isnan(score), F.lit(float("-inf"))).otherwise(value)
    keys = [f"t{k}" for k in range(len(ties))]
    rows = df.select(F.col(group).alias("g"), value.alias("s"), F.col(item).alias("i"), *[F.col(c).alias(k) for (c, _), k in zip(ties, keys, strict=True)])
    rows = rows.filter("g is not null and s is not null and i is not null")
    order: list[Column] = [F.col("s").desc(), *[F.col(k).asc_nulls_last() if up else F.col(k).desc_nulls_last() for (_, up), k in zip(ties, keys, strict=True)], F.col("i").asc()]
    total, tops = rows.agg(F.count(F.lit(1)), F.percentile_approx("s", [1 - t for t in BAND_TOPS], ACCURACY)).first()
    edges = sorted(set(tops or []), reverse=True)
    hot = [r.g for r in rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= max(2, HOT * total)).select("g").collect()]  # at most 1 / HOT
    is_hot = F.col("g").isin(hot) if hot else F.lit(False)
    best_row, by = Window.partitionBy("g", "i").orderBy(*order), Window.partitionBy("g").orderBy(*order)

    def ranked(band: DataFrame, state: DataFrame | None, hint: str) -> DataFrame:
        """The best rows of a band's unfilled groups, as many as they have places."""
        if state is not None:
            band = band.join(state.filter(F.col("taken") >= n).select("g").hint(hint), "g", "left_anti")
            band = band.join(state.filter(F.col("taken") < n).hint(hint), "g", "left").filter(~F.coalesce(F.array_contains("held", F.col("i")), F.lit(False))).drop("held")
        else:
            band = band.withColumn("taken", F.lit(0).cast("bigint"))
        once = band.withColumn("one", F.row_number().over(best_row)).filter("one = 1")
        places = once.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= n)
        return places.select("g", "i", (F.col("r") + F.coalesce("taken", F.lit(0))).cast("int").alias("r")).filter(F.col("r") <= n)

    state, parts = None, []
    for k in range(len(edges) + 1):
        band = rows
        if k < len(edges):
            band = band.filter(F.col("s") >= F.lit(edges[k]))
        if k:
            band = band.filter(F.col("s") < F.lit(edges[k - 1]))
        # Merge joins put a group's rows side by side, where they are ranked; the first band is put there without a join.
        cold = band.filter(~is_hot)
        best = ranked(cold if k else cold.repartition("g"), state, "merge")
        if hot:
            best = best.unionByName(ranked(band.filter(is_hot), state.filter(is_hot) if k else None, "broadcast"))  # at most 1 / HOT rows
        parts.append(stages.write(best))
        if k < len(edges):
            found = parts[0]
            for p in parts[1:]:
                found = found.unionByName(p)
            older, state = state, stages.write(found.groupBy("g").agg(F.count(F.lit(1)).alias("taken"), F.collect_list("i").alias("held")))  # n items at most
            stages.drop(older)
    stages.drop(state)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return found.select(F.col("g").alias(group), F.col("i").alias(item), F.col("r").alias(fresh([group, item], "rank")))


def strongest_alignments(paf: DataFrame, n: int = 3) -> DataFrame:
    """``(query_id, line_no, rank)``: the strongest alignments of every query."""
    rows = paf.select(clean_id("query_id").alias("query_id"), "match_len", "target_start", "line_no")
    return top_n(rows, "query_id", "match_len", [("target_start", True)], "line_no", n)
