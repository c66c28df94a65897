"""Alignments: cleaning and filters, contig pairs and redundancy, best targets, segments of neighbouring alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ploidlake.functions import scalar as S
from ploidlake.functions.ids import clean_id
from ploidlake.operators.intervals import periods_and_gaps
from ploidlake.params import Redundancy, Segments
from ploidlake.runtime import Stages


def alignments(paf: DataFrame) -> DataFrame:
    """Usable records, each ``line_no`` once: both ids, a match length, and intervals that are not empty or reversed."""
    rows = paf.withColumns({"query_id": clean_id("query_id"), "target_id": clean_id("target_id")})
    rows = rows.filter("query_id is not null and target_id is not null and match_len is not null and query_end > query_start and target_end > target_start")
    return rows.dropDuplicates(["line_no"])


def primary(aln: DataFrame, min_match: int, min_query: int, strict: bool = False) -> DataFrame:
    """Without secondary records, short matches and short queries; ``strict`` also drops matches of just ``min_match``."""
    long_enough = F.col("match_len") > min_match if strict else F.col("match_len") >= min_match
    return aln.filter(S.is_primary(F.col("tp")) & long_enough & (F.col("query_len") >= min_query))


def oriented(aln: DataFrame) -> DataFrame:
    """Records with ``long_*`` and ``short_*`` sides; between equal lengths the target is the long side."""
    q = F.col("query_len") > F.col("target_len")
    sides = {f"{a}_{c}": F.when(q == (a == "long"), F.col(f"query_{c}")).otherwise(F.col(f"target_{c}")) for a in ("long", "short") for c in ("id", "len", "start", "end")}
    return aln.withColumns(sides)


def pair_stats(aln: DataFrame, p: Redundancy = Redundancy()) -> DataFrame:
    """Per contig pair: match ratios, collinearity and containment, and whether the short contig is redundant.

    One shuffle: all three tests are conditional aggregates over the pair.
    """
    rows = oriented(primary(aln, p.min_match, p.min_query)).filter("long_id <> short_id")
    point = F.col("match_len") > p.point_match
    x, y = F.when(point, F.col("long_start")), F.when(point, F.col("short_start"))
    margin = F.floor(F.col("long_len") * p.margin)
    inside = (F.col("long_start") > margin) & (F.col("long_end") < F.col("long_len") - margin)
    per = rows.groupBy("long_id", "short_id").agg(
        F.max("long_len").alias("long_len"),
        F.max("short_len").alias("short_len"),
        F.sum("match_len").alias("matched"),
        F.count_if(point).alias("points"),
        S.r_squared(x, y).alias("r2"),
        F.avg(F.when(point, inside.cast("double"))).alias("inside_share"),
    )
    per = per.withColumn("ratio_long", F.col("matched") / F.col("long_len")).withColumn("ratio_short", F.col("matched") / F.col("short_len"))
    tests = (F.col("ratio_long") > p.ratio_long) & (F.col("ratio_short") > p.ratio_short), F.coalesce(F.col("r2") >= p.min_r2, F.lit(False)), F.coalesce(F.col("inside_share") >= p.inside, F.lit(False))
    return per.withColumns({"ratio_pass": tests[0], "collinear": tests[1], "contained": tests[2], "redundant": tests[0] & tests[1] & tests[2]})


def directed_stats(aln: DataFrame, p: Redundancy = Redundancy()) -> DataFrame:
    """Per contig pair, in the direction seen first: matches over the query, aligned length over the target.

    The shorter contig is redundant if either share is above ``either_ratio``; between equal lengths the target is the long
    one. Secondary records count. Directions are told apart after the aggregate, so records are shuffled once.
    """
    rows = aln.filter((F.col("query_id") != F.col("target_id")) & (F.col("match_len") >= p.min_match) & (F.col("query_len") >= p.min_query))
    per = rows.groupBy("query_id", "target_id").agg(
        F.max("query_len").alias("query_len"),
        F.max("target_len").alias("target_len"),
        F.sum("match_len").alias("matched"),
        F.coalesce(F.sum("block_len"), F.lit(0)).alias("aligned"),
        F.min("line_no").alias("first_line"),
    )
    pair = Window.partitionBy(F.least("query_id", "target_id"), F.greatest("query_id", "target_id"))
    per = per.withColumn("of_pair", F.min("first_line").over(pair)).filter("first_line = of_pair")
    per = per.withColumns({"query_ratio": F.col("matched") / F.col("query_len"), "target_ratio": F.col("aligned") / F.col("target_len")})
    short = F.when(F.col("query_len") > F.col("target_len"), F.col("target_id")).otherwise(F.col("query_id"))
    redundant = (F.col("query_ratio") > p.either_ratio) | (F.col("target_ratio") > p.either_ratio)
    return per.select("query_id", "target_id", "matched", "aligned", "query_ratio", "target_ratio", short.alias("short_id"), redundant.alias("redundant"))


def contig_lengths(aln: DataFrame) -> DataFrame:
    """``(contig_id, length)`` from both sides of the records."""
    both = aln.selectExpr("stack(2, query_id, query_len, target_id, target_len) as (contig_id, length)")
    return both.groupBy("contig_id").agg(F.max("length").alias("length"))


def redundant_contigs(aln: DataFrame, p: Redundancy = Redundancy()) -> DataFrame:
    return pair_stats(aln, p).filter("redundant").select(F.col("short_id").alias("contig_id")).distinct()


def retained_contigs(aln: DataFrame, p: Redundancy = Redundancy(), min_length: int = 0) -> DataFrame:
    return contig_lengths(aln).filter(F.col("length") >= min_length).join(redundant_contigs(aln, p), "contig_id", "left_anti")


def pair_identity(aln: DataFrame) -> DataFrame:
    """Directed pairs: matches by CIGAR and their share of either side."""
    rows = aln.filter(S.is_primary(F.col("tp")))
    per = rows.groupBy("query_id", "target_id").agg(F.sum(S.cigar_matches(F.col("cigar"))).alias("matched"), F.max("query_len").alias("query_len"), F.max("target_len").alias("target_len"))
    return per.withColumns({"query_ratio": F.col("matched") / F.col("query_len"), "target_ratio": F.col("matched") / F.col("target_len")})


def first_direction(aln: DataFrame) -> DataFrame:
    """Records of an unordered pair in the direction that was seen first."""
    pair = Window.partitionBy(F.least("query_id", "target_id"), F.greatest("query_id", "target_id"))
    firsts = aln.groupBy("query_id", "target_id").agg(F.min("line_no").alias("first_line"))
    kept = firsts.withColumn("of_pair", F.min("first_line").over(pair)).filter("first_line = of_pair").select("query_id", "target_id")
    return aln.join(kept, ["query_id", "target_id"], "left_semi")


def union_coverage(aln: DataFrame) -> DataFrame:
    """Per directed pair: length of the union of query and of target intervals, and the shares covered."""

    needed = ["query_id", "target_id", "query_len", "target_len", "query_start", "query_end", "target_start", "target_end", "strand", "match_len"]
    aln = Stages(aln.sparkSession, "coverage").write(aln.select(needed))

    def side(name: str) -> DataFrame:
        spans = periods_and_gaps(aln, ["query_id", "target_id"], f"{name}_start", f"{name}_end").filter("span_kind = 'period'")
        return spans.groupBy("query_id", "target_id").agg(F.sum(F.col("span_end") - F.col("span_start")).alias(f"{name}_covered"))

    lengths = aln.groupBy("query_id", "target_id").agg(
        F.max("query_len").alias("query_len"), F.max("target_len").alias("target_len"), F.sum(F.when(F.col("strand") == "+", F.col("match_len")).otherwise(-F.col("match_len"))).alias("balance")
    )
    out = lengths.join(side("query"), ["query_id", "target_id"]).join(side("target"), ["query_id", "target_id"])
    return out.select(
        "query_id", "target_id", "query_covered", "target_covered", (F.col("query_covered") / F.col("query_len")).alias("query_ratio"), (F.col("target_covered") / F.col("target_len")).alias("target_ratio"),
        F.when(F.col("balance") > 0, "+").otherwise("-").alias("direction"), "query_len", "target_len",
    )


def covered_shorter(coverage: DataFrame, most: float = 0.1) -> DataFrame:
    """Contigs that are the shorter of a pair and covered by more than ``most``; equal lengths prune none."""
    shorter = F.when((F.col("query_len") < F.col("target_len")) & (F.col("query_ratio") > most), F.col("query_id")).when((F.col("target_len") < F.col("query_len")) & (F.col("target_ratio") > most), F.col("target_id"))
    return coverage.select(shorter.alias("contig_id")).filter("contig_id is not null").distinct()


# -- targets ---------------------------------------------------------------------------------------------------------


def top_targets(aln: DataFrame, n: int) -> DataFrame:
    """``(target_id, target_len)`` of the longest targets, ties by first appearance."""
    per = aln.groupBy("target_id").agg(F.max("target_len").alias("target_len"), F.min("line_no").alias("first_line"))
    return per.orderBy(F.desc("target_len"), "first_line").limit(n).select("target_id", "target_len")


def best_target(aln: DataFrame, min_ratio: float | None = None) -> DataFrame:
    """Per query the target with the most matched bases, ties by first appearance; with ``min_ratio`` only if that share is reached."""
    per = aln.groupBy("query_id", "target_id").agg(F.sum("match_len").alias("matched"), F.count(F.lit(1)).alias("records"), F.min("line_no").alias("first_line"), F.max("query_len").alias("query_len"))
    best = per.withColumn("rn", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("matched"), "first_line"))).filter("rn = 1")
    best = best.select("query_id", "target_id", "matched", "records", (F.col("matched") / F.col("query_len")).alias("ratio"))
    return best if min_ratio is None else best.filter(F.col("ratio") >= min_ratio)


def on_best_target(aln: DataFrame, min_ratio: float | None = None) -> DataFrame:
    return aln.join(best_target(aln, min_ratio).select("query_id", "target_id"), ["query_id", "target_id"], "left_semi")


def cigar_ratios(aln: DataFrame) -> DataFrame:
    """``(query_id, target_id, ratio)``: CIGAR matches of primary records over the query's length."""
    rows = aln.filter(S.is_primary(F.col("tp")))
    per = rows.groupBy("query_id", "target_id").agg(F.sum(S.cigar_matches(F.col("cigar"))).alias("matched"), F.max("query_len").alias("query_len"), F.min("line_no").alias("first_line"))
    return per.select("query_id", "target_id", (F.col("matched") / F.col("query_len")).alias("ratio"), "first_line")


def best_ratio(aln: DataFrame, n_targets: int) -> DataFrame:
    """Per query its target of highest CIGAR ratio, kept if above zero and among the longest targets."""
    best = cigar_ratios(aln).filter("ratio > 0").withColumn("rn", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("ratio"), "first_line"))).filter("rn = 1")
    return best.join(top_targets(aln, n_targets), "target_id", "left_semi").select("query_id", "target_id", "ratio")


def ratios_above(aln: DataFrame, n_targets: int, cutoff: float = 0.2) -> DataFrame:
    return cigar_ratios(aln).filter(F.col("ratio") > cutoff).join(top_targets(aln, n_targets), "target_id", "left_semi").select("query_id", "target_id", "ratio")


def ratio_matrix(aln: DataFrame, targets: list[str]) -> DataFrame:
    """A row per query and a column per target of ``targets``; 0 where there is no match."""
    return cigar_ratios(aln).groupBy("query_id").pivot("target_id", targets).agg(F.sum("ratio")).na.fill(0.0)


def off_target(aln: DataFrame, n_targets: int) -> DataFrame:
    """Queries whose best target is none of the longest."""
    return aln.select("query_id").distinct().join(best_ratio(aln, n_targets), "query_id", "left_anti")


# -- segments --------------------------------------------------------------------------------------------------------


#: Width of the tiles that ordered passes work in. Only a summary row per tile meets its neighbours, so that a query and
#: target with very many records is many units of work.
TILE = 1 << 17


def _tiled(df: DataFrame, tile: int) -> DataFrame:
    return df.withColumn("__tile", F.floor(F.col("target_start") / F.lit(tile)).cast("bigint"))


def drop_contained(aln: DataFrame, tile: int = TILE) -> DataFrame:
    """Without records whose target interval lies in another record's of the same query and target; equal ones drop each other.

    An interval that occurs once lies in another if an earlier start reaches its end, or if an equal start ends later. The
    furthest end of earlier starts comes from the tile and from the tiles before it. Repeats of an interval cost nothing.
    """
    key = ["query_id", "target_id"]
    spans = _tiled(aln.groupBy(*key, "target_start", "target_end").agg(F.count(F.lit(1)).alias("n")), tile)
    before = Window.partitionBy(*key).orderBy("__tile").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.groupBy(*key, "__tile").agg(F.max("target_end").alias("reach")).withColumn("carry", F.max("reach").over(before)).drop("reach")
    earlier = F.max("target_end").over(Window.partitionBy(*key, "__tile").orderBy("target_start").rangeBetween(Window.unboundedPreceding, -1))
    same = F.max("target_end").over(Window.partitionBy(*key, "__tile", "target_start"))
    seen = spans.withColumns({"earlier": earlier, "same": same}).join(carried, [*key, "__tile"])
    kept = seen.filter((F.col("n") == 1) & F.coalesce(F.greatest("earlier", "carry") < F.col("target_end"), F.lit(True)) & (F.col("same") == F.col("target_end")))
    return aln.join(kept.select(*key, "target_start", "target_end"), [*key, "target_start", "target_end"], "left_semi")


def gap_segments(aln: DataFrame, gap: int, tile: int = TILE) -> DataFrame:
    """Records with ``seg_no``: a new segment where the start is more than ``gap`` beyond the previous record's end.

    The previous record is that before in order of (target_start, line_no) for the same query and target.
    """
    key = ["query_id", "target_id"]
    w = Window.partitionBy(*key, "__tile").orderBy("target_start", "line_no")
    rows = _tiled(aln, tile)
    rows = rows.withColumn("__open", F.coalesce(F.col("target_start") - F.lag("target_end").over(w) > gap, F.lit(False)).cast("int"))
    rows = rows.withColumn("__inner", F.sum("__open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    order = F.struct("target_start", "line_no")
    tiles = rows.groupBy(*key, "__tile").agg(F.min("target_start").alias("first"), F.max_by("target_end", order).alias("last"), F.max("__inner").alias("inner"))
    by = Window.partitionBy(*key).orderBy("__tile")
    tiles = tiles.withColumn("opens", F.coalesce(F.col("first") - F.lag("last").over(by) > gap, F.lit(False)).cast("int"))
    tiles = tiles.withColumn("__base", F.sum(F.col("opens") + F.col("inner")).over(by) - F.col("inner")).select(*key, "__tile", "__base")
    out = rows.join(tiles, [*key, "__tile"]).withColumn("seg_no", (F.col("__base") + F.col("__inner")).cast("int"))
    return out.select(*aln.columns, "seg_no")


def segment_rows(segments: DataFrame) -> DataFrame:
    """One row per segment: ``rows, matched, first_start, last_start, last_end``."""
    order = F.struct("target_start", "line_no")
    return segments.groupBy("query_id", "target_id", "seg_no").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("match_len").alias("matched"), F.min_by("target_start", order).alias("first_start"), F.max_by("target_start", order).alias("last_start"), F.max_by("target_end", order).alias("last_end")
    )


def best_segment(segs: DataFrame) -> DataFrame:
    """Per query the segment with most records, then most matches, then the first."""
    w = Window.partitionBy("query_id").orderBy(F.desc("rows"), F.desc("matched"), "seg_no", "target_id")
    return segs.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


#: One pass over a query's segments in order, inside the JVM. The accumulator holds the merged segments so far.
_PASS_1 = """aggregate(slice(segs, 2, size(segs)), array(segs[0]), (acc, s) ->
  case when abs(s.first_start - element_at(acc, -1).last_end) <= {dist} and (element_at(acc, -1).rows >= {rows} or element_at(acc, -1).matched >= {length})
       then concat(slice(acc, 1, size(acc) - 1), array({joined})) else concat(acc, array(s)) end)"""
_PASS_2 = """aggregate(slice(segs, 2, size(segs)), array(segs[0]), (acc, s) ->
  case when s.rows < {rows} and s.first_start - element_at(acc, -1).last_end <= {dist}
       then concat(slice(acc, 1, size(acc) - 1), array({joined})) else concat(acc, array(s)) end)"""
_JOINED = """struct(element_at(acc, -1).last_start as last_start, element_at(acc, -1).seg_no as seg_no, element_at(acc, -1).target_id as target_id, element_at(acc, -1).rows + s.rows as rows,
  element_at(acc, -1).matched + s.matched as matched, element_at(acc, -1).first_start as first_start, s.last_end as last_end)"""


def merge_segments(segs: DataFrame, p: Segments = Segments()) -> DataFrame:
    """Neighbouring segments of a query merged in two passes.

    Segments go in order of the start of their last record. First a segment joins the one before if it begins within
    ``max_distance`` of its end and that one has ``min_rows`` records or ``min_length`` matches; then small segments join
    the one before within the (signed) distance. A query has few segments, since each spans more than ``gap``.
    """
    names = ["last_start", "seg_no", "target_id", "rows", "matched", "first_start", "last_end"]
    per = segs.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("segs"))
    args = {"dist": p.max_distance, "rows": p.min_rows, "length": p.min_length, "joined": _JOINED}
    merged = per.withColumn("segs", F.expr(_PASS_1.format(**args))).withColumn("segs", F.expr(_PASS_2.format(**args)))
    return merged.select("query_id", F.posexplode("segs").alias("merged_no", "s")).select("query_id", "merged_no", "s.target_id", "s.rows", "s.matched", "s.first_start", "s.last_end")
