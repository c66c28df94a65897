"""Queries of the reference operators over the assembly tables, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ploidlake.functions import scalar as S
from ploidlake.functions.ids import clean_label
from ploidlake.operators import align, allelic, assign, dosage, hic, merging, reads, similarity
from ploidlake.params import Bins, Links, Reads, Redundancy, Segments
from ploidlake.queries.problems import SQL_ID
from ploidlake.runtime import table
from ploidlake.streaming import arrivals

#: Parameters of the queries where the tables' contigs are shorter than the defaults' draft assemblies.
RED = Redundancy(min_query=10_000)
SEG = Segments(gap=500_000)
BINS = Bins(size=100_000, min_query=20_000)
LINKS = Links(flank=20_000)
CHROMS = [f"chr{k:02d}" for k in range(1, 13)]


# -- tables as the operators take them -------------------------------------------------------------------------------


def _aln(s: SparkSession, d: str) -> DataFrame:
    return align.alignments(table(s, d, "paf"))


def _self(s: SparkSession, d: str) -> DataFrame:
    return align.alignments(table(s, d, "self_paf"))


def _types(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "contig_types").filter("contig_id is not null")
    return t.groupBy("contig_id").agg(F.min(clean_label("contig_type")).alias("contig_type"))


def _contigs(s: SparkSession, d: str) -> DataFrame:
    """Contigs of the contig alignments; restriction sites as expected of their length, one in 256 positions."""
    return align.contig_lengths(_self(s, d)).withColumn("re_sites", F.floor(F.col("length") / 256) + 1)


def _unitigs(s: SparkSession, d: str) -> DataFrame:
    return _aln(s, d).groupBy(F.col("query_id").alias("contig_id")).agg(F.max("query_len").alias("length")).withColumn("re_sites", F.floor(F.col("length") / 256) + 1)


def _links(s: SparkSession, d: str) -> DataFrame:
    return hic.pair_links(table(s, d, "hic_links"))


def _mates(s: SparkSession, d: str) -> DataFrame:
    """Alignment records read as contacts: a record on + is a first mate at its two starts."""
    rows = _self(s, d).select(F.when(F.col("strand") == "+", 64).otherwise(128).alias("flag"), F.col("query_id").alias("ref"), F.col("query_start").alias("pos"), F.col("target_id").alias("mref"), F.col("target_start").alias("mpos"))
    return hic.mates(rows, _contigs(s, d))


def _members(s: SparkSession, d: str) -> DataFrame:
    """Typed contigs dealt to four groups by number; every fifth is left ungrouped."""
    n = F.substring("contig_id", 4, 9).cast("int") % 5
    return _types(s, d).filter(n < 4).select("contig_id", F.concat(F.lit("g"), (n + 1).cast("string")).alias("group_name"))


def _bins(s: SparkSession, d: str) -> DataFrame:
    return allelic.allelic_table(_aln(s, d), BINS)


def _segments(s: SparkSession, d: str) -> DataFrame:
    return align.gap_segments(align.on_best_target(align.primary(_aln(s, d), SEG.min_match, SEG.min_query, strict=True), SEG.min_ratio), SEG.gap)


def _sets(s: SparkSession, d: str) -> DataFrame:
    return reads.read_sets(table(s, d, "read_placement"))


def _as_members(s: SparkSession, d: str) -> DataFrame:
    return _sets(s, d).select("contig_id", F.col("read").alias("member"))


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _genotype(s: SparkSession, d: str) -> DataFrame:
    u = _unitigs(s, d)
    return allelic.genotyped(_bins(s, d), _types(s, d), u, u, _links(s, d), BINS, LINKS)


def _reassigned(s: SparkSession, d: str, rounds: int) -> DataFrame:
    return assign.reassign(_unitigs(s, d), _types(s, d), _links(s, d), _members(s, d), rounds, LINKS)


def _repaired(s: SparkSession, d: str) -> DataFrame:
    return allelic.repair_bins(_bins(s, d), _unitigs(s, d), BINS)


def _texts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents").select(F.col("doc_id").cast("string").alias("contig_id"), F.col("text").alias("seq")).filter("seq is not null")


QUERIES = {
    "dosage_mean": lambda s, d: dosage.mean_depth(dosage.valid_windows(table(s, d, "depth_win"))),
    "dosage_class": lambda s, d: dosage.classify(dosage.mean_depth(dosage.valid_windows(table(s, d, "depth_win")))),
    "dosage_class_alt": lambda s, d: dosage.classify(dosage.mean_depth(dosage.valid_windows(table(s, d, "depth_win"))), "documented"),
    "dosage_class_hexa": lambda s, d: dosage.classify(dosage.mean_depth(dosage.valid_windows(table(s, d, "depth_win"))), "hexaploid"),
    "dosage_class_hexa21": lambda s, d: dosage.classify(dosage.mean_depth(dosage.valid_windows(table(s, d, "depth_win"))), "hexaploid21"),
    "depth_hist": lambda s, d: dosage.histogram(dosage.valid_windows(table(s, d, "depth_win"))),
    "paf_filter": lambda s, d: align.primary(_aln(s, d), SEG.min_match, SEG.min_query, strict=True).select("line_no", "query_id", "target_id", "match_len"),
    "pair_stats": lambda s, d: _round(align.pair_stats(_self(s, d), RED).select("long_id", "short_id", "long_len", "short_len", "matched", "points", "ratio_long", "ratio_short"), "ratio_long", "ratio_short"),
    "pair_r2": lambda s, d: _round(align.pair_stats(_self(s, d), RED).select("long_id", "short_id", "r2", "collinear"), "r2"),
    "pair_contained": lambda s, d: _round(align.pair_stats(_self(s, d), RED).select("long_id", "short_id", "inside_share", "contained"), "inside_share"),
    "directed_stats": lambda s, d: _round(align.directed_stats(_self(s, d), RED), "query_ratio", "target_ratio"),
    "redundant_contigs": lambda s, d: align.redundant_contigs(_self(s, d), RED),
    "retained_contigs": lambda s, d: align.retained_contigs(_self(s, d), RED),
    "pair_identity": lambda s, d: _round(align.pair_identity(_self(s, d)), "query_ratio", "target_ratio"),
    "first_direction": lambda s, d: align.first_direction(_self(s, d)).select("line_no", "query_id", "target_id"),
    "interval_union": lambda s, d: _round(align.union_coverage(_self(s, d)).drop("query_len", "target_len"), "query_ratio", "target_ratio"),
    "covered_shorter": lambda s, d: align.covered_shorter(align.union_coverage(_self(s, d))),
    "best_target": lambda s, d: _round(align.best_target(_aln(s, d)), "ratio"),
    "best_target_ratio": lambda s, d: _round(align.best_target(align.primary(_aln(s, d), SEG.min_match, SEG.min_query, strict=True), SEG.min_ratio), "ratio"),
    "top_targets": lambda s, d: align.top_targets(align.primary(_aln(s, d), BINS.min_match, BINS.min_query), BINS.chromosomes),
    "cigar_match_ratio": lambda s, d: _round(align.best_ratio(_aln(s, d), BINS.chromosomes), "ratio"),
    "match_matrix": lambda s, d: _round(align.ratio_matrix(_aln(s, d), CHROMS), *CHROMS),
    "match_ratios": lambda s, d: _round(align.cigar_ratios(_aln(s, d)).select("query_id", "target_id", F.coalesce("ratio", F.lit(0.0)).alias("ratio")), "ratio"),  # match_matrix in long form, over every target
    "match_above_cutoff": lambda s, d: _round(align.ratios_above(_aln(s, d), BINS.chromosomes), "ratio"),
    "off_target_contigs": lambda s, d: align.off_target(_aln(s, d), BINS.chromosomes),
    "contained_filter": lambda s, d: align.drop_contained(_aln(s, d)).select("line_no", "query_id", "target_id"),
    "gap_segments": lambda s, d: _segments(s, d).select("line_no", "query_id", "target_id", "seg_no"),
    "best_segment": lambda s, d: align.best_segment(align.segment_rows(_segments(s, d))),
    "segment_merge": lambda s, d: align.merge_segments(align.segment_rows(_segments(s, d)), SEG),
    "bin_overlap": lambda s, d: allelic.bin_overlaps(_aln(s, d), BINS.size),
    "topn_per_bin": lambda s, d: allelic.top_per_bin(allelic.bin_overlaps(_aln(s, d), BINS.size), BINS.top_n),
    "topn_budget": lambda s, d: allelic.budget_per_bin(allelic.bin_overlaps(_aln(s, d), BINS.size), _types(s, d)),
    "mad_filter": lambda s, d: allelic.mad_filter(_aln(s, d)).select("line_no", "query_id", "target_id"),
    "allelic_table": _bins,
    "overlap_ratio": lambda s, d: _round(allelic.overlap_ratios(_bins(s, d)), "ratio"),
    "bin_repair": _repaired,
    "table_filter": lambda s, d: allelic.thin_bins(_repaired(s, d), _unitigs(s, d), _types(s, d), BINS),
    "genotype": _genotype,
    "linked_only": lambda s, d: allelic.linked_only(_types(s, d).select("contig_id"), _links(s, d)),
    "link_totals": _links,
    "link_full": lambda s, d: hic.link_counts(_mates(s, d), LINKS),
    "link_ht": lambda s, d: hic.half_links(_mates(s, d)),
    "link_clm": lambda s, d: hic.orientations(_mates(s, d), LINKS),
    "link_distances": lambda s, d: hic.orientation_distances(_mates(s, d), LINKS),
    "link_adjacency": lambda s, d: hic.adjacency(_links(s, d)),
    "link_density": lambda s, d: _round(hic.density(_links(s, d), _unitigs(s, d)), "density"),
    "link_norm": lambda s, d: _round(hic.normalised(_links(s, d)), "norm_links"),
    "link_weighted": lambda s, d: _round(hic.weighted(_links(s, d), _types(s, d)), "weighted"),
    "link_bins": lambda s, d: hic.bin_density(_links(s, d), _unitigs(s, d), BINS.size),
    "contig_bins": lambda s, d: hic.contig_bins(_unitigs(s, d), BINS.size),
    "group_re": lambda s, d: hic.group_sites(_members(s, d), _unitigs(s, d)),
    "ctg_group_links": lambda s, d: hic.contig_group_links(_links(s, d), _members(s, d)),
    "clm_split": lambda s, d: hic.shared_groups(_links(s, d), _members(s, d)).select("ctg_i", "ctg_j", "group_name", "links"),
    "read_pair_counts": lambda s, d: hic.read_pair_counts(_sets(s, d).select(F.col("contig_id").alias("ref"), "read")),
    "major_target": lambda s, d: hic.major_target(_links(s, d), align.best_target(_aln(s, d))),
    "reassign_density": lambda s, d: _reassigned(s, d, 4),
    "rescue_density": lambda s, d: assign.unassigned(_unitigs(s, d), _reassigned(s, d, 8)),
    "read_sets": _sets,
    "read_split": lambda s, d: reads.split_reads(_sets(s, d), _types(s, d), Reads()),
    "read_split_disjoint": lambda s, d: reads.split_reads(_sets(s, d), _types(s, d), Reads(), disjoint=True),
    "group_reads": lambda s, d: reads.group_reads(reads.split_reads(_sets(s, d), _types(s, d)), _members(s, d)),
    "re_sites": lambda s, d: _texts(s, d).select("contig_id", S.site_count(F.col("seq"), "the").alias("re_sites")),
    "flank_re_sites": lambda s, d: _texts(s, d).select("contig_id", S.site_count(S.flank_sequence(F.col("seq"), 100), "the").alias("re_sites")),
    "revcomp": lambda s, d: _texts(s, d).select("contig_id", F.md5(S.reverse_complement(F.col("seq"))).alias("digest")),
    "kmer_counts": lambda s, d: similarity.kmers(_texts(s, d), 21).groupBy("contig_id").agg(F.count(F.lit(1)).alias("kmers")),
    "set_jaccard": lambda s, d: _round(similarity.set_pairs(_as_members(s, d)), "jaccard"),
    "mash_pairs": lambda s, d: _round(similarity.similar_pairs(_as_members(s, d)), "jaccard", "distance"),
    "minhash_sketch": lambda s, d: similarity.sketch(_as_members(s, d)),
    "sketch_jaccard": lambda s, d: _round(similarity.sketch_pairs(similarity.sketch(_as_members(s, d), 16), 16), "jaccard"),  # small sketches of sets of many sizes
    "stream_loads": lambda s, d: arrivals.loads_per_day(s, f"{d}/paf.parquet*"),  # a pattern: the table is one file or a folder of them
    "lis_merge": lambda s, d: _round(merging.join_plans(_self(s, d), RED), "coverage", "r2"),
    "greedy_pairs": lambda s, d: merging.greedy_pairs(merging.join_plans(_self(s, d), RED).select("long_id", "short_id", "first_line"), "long_id", "short_id", "first_line"),
}

# -- the same in SQL -------------------------------------------------------------------------------------------------


def _records(name: str, source: str) -> str:
    q, t = SQL_ID.format("query_id"), SQL_ID.format("target_id")
    return f"""{name} as (select distinct on (line_no) line_no, {q} as query_id, query_len, query_start, query_end, strand, {t} as target_id, target_len, target_start, target_end, match_len, tp, cigar
  from {source} where {q} is not null and {t} is not null and match_len is not null and query_end > query_start and target_end > target_start)"""


_A, _SELF = _records("a", "paf"), _records("a", "self_paf")
_PRIMARY = "coalesce(right(tp, 1) <> 'S', true)"
_DEPTH = "w as (select contig_id, win_start, max(depth) as depth from depth_win where contig_id is not null and depth >= 0 and isfinite(depth) group by all)"
_MEAN = f"{_DEPTH}, m as (select contig_id, cast(sum(cast(round(depth, 6) as decimal(24, 6))) as double) / count(*) as average_depth from w group by 1)"
_TYPES = "t as (select contig_id, min(nullif(lower(trim(contig_type, E' \\t\\r\\n')), '')) as contig_type from contig_types where contig_id is not null group by 1)"
_MULT = "case {0} when 'diplotig' then 2 when 'triplotig' then 3 when 'tetraplotig' then 4 else 1 end"
_CONTIGS = "c as (select contig_id, max(length) as length, max(length) // 256 + 1 as re_sites from (select query_id as contig_id, query_len as length from a union all select target_id, target_len from a) group by 1)"
_UNITIGS = "u as (select query_id as contig_id, max(query_len) as length, max(query_len) // 256 + 1 as re_sites from a group by 1)"
_L = """l as (select least(ctg_i, ctg_j) as ctg_i, greatest(ctg_i, ctg_j) as ctg_j, cast(sum(links) as bigint) as links from
  (select distinct on (count_id) * from hic_links where ctg_i is not null and ctg_j is not null and ctg_i <> ctg_j and links is not null) group by 1, 2)"""
_ADJ = "adj as (select ctg_i as contig_id, ctg_j as other, links from l union all select ctg_j, ctg_i, links from l)"
_MEMBERS = "g as (select contig_id, 'g' || cast(cast(substr(contig_id, 4, 9) as int) % 5 + 1 as varchar) as group_name from t where cast(substr(contig_id, 4, 9) as int) % 5 < 4)"
_ORIENTED = f"""o as (select *, case when q then query_id else target_id end as long_id, case when q then target_id else query_id end as short_id, case when q then query_len else target_len end as long_len,
  case when q then target_len else query_len end as short_len, case when q then query_start else target_start end as long_start, case when q then query_end else target_end end as long_end,
  case when q then target_start else query_start end as short_start, match_len > {RED.point_match} as point
  from (select *, query_len > target_len as q from a where {_PRIMARY} and match_len >= {RED.min_match} and query_len >= {RED.min_query}))"""
_PAIRS = f"""{_SELF}, {_ORIENTED}, p as (select long_id, short_id, max(long_len) as long_len, max(short_len) as short_len, cast(sum(match_len) as bigint) as matched, count(*) filter (point) as points,
  case when count(*) filter (point) < 2 then null when min(case when point then long_start end) = max(case when point then long_start end) or min(case when point then short_start end) = max(case when point then short_start end) then 0
    else regr_r2(case when point then short_start end, case when point then long_start end) end as r2,
  avg(case when point then cast(long_start > floor(long_len * {RED.margin}) and long_end < long_len - floor(long_len * {RED.margin}) as int) end) as inside_share
  from o where long_id <> short_id group by 1, 2),
f as (select *, matched / long_len as ratio_long, matched / short_len as ratio_short, coalesce(r2 >= {RED.min_r2}, false) as collinear, coalesce(inside_share >= {RED.inside}, false) as contained from p),
r as (select distinct short_id as contig_id from f where ratio_long > {RED.ratio_long} and ratio_short > {RED.ratio_short} and collinear and contained)"""
_SEGF = f"f as (select * from a where {_PRIMARY} and match_len > {SEG.min_match} and query_len >= {SEG.min_query})"


def _best(source: str, name: str = "b", where: str = "") -> str:
    return f"""{name} as (select query_id, target_id, matched, records, matched / query_len as ratio from (select *, row_number() over (partition by query_id order by matched desc, first_line) as rn from
  (select query_id, target_id, cast(sum(match_len) as bigint) as matched, count(*) as records, min(line_no) as first_line, max(query_len) as query_len from {source} group by 1, 2)) where rn = 1 {where})"""


def _tops(source: str, n: int) -> str:
    return f"tops as (select target_id, target_len from (select target_id, max(target_len) as target_len, min(line_no) as first_line from {source} group by 1) order by target_len desc, first_line limit {n})"


_CIGAR = f"""k as (select query_id, target_id, matched / query_len as ratio, first_line from (select query_id, target_id, cast(sum(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint)))) as bigint) as matched, max(query_len) as query_len, min(line_no) as first_line
  from a where {_PRIMARY} group by 1, 2))"""
_BESTK = "bk as (select query_id, target_id, ratio from (select *, row_number() over (partition by query_id order by ratio desc, first_line) as rn from k where ratio > 0) where rn = 1 and target_id in (select target_id from tops))"
_SEGS = f"""{_A}, {_SEGF}, {_best("f", where=f"and matched / query_len >= {SEG.min_ratio}")}, h as (select f.* from f join b using (query_id, target_id)),
s0 as (select *, coalesce(target_start - lag(target_end) over (partition by query_id, target_id order by target_start, line_no) > {SEG.gap}, false) as opens from h),
s as (select *, cast(sum(cast(opens as int)) over (partition by query_id, target_id order by target_start, line_no rows unbounded preceding) as int) as seg_no from s0),
sr as (select query_id, target_id, seg_no, count(*) as rows, cast(sum(match_len) as bigint) as matched, arg_min(target_start, (target_start, line_no)) as first_start, arg_max(target_start, (target_start, line_no)) as last_start, arg_max(target_end, (target_start, line_no)) as last_end from s group by 1, 2, 3)"""


def _overlaps(source: str) -> str:
    z = BINS.size
    return f"""bo as (select target_id, b * {z} as bin_start, query_id, cast(sum(least(target_end, (b + 1) * {z}) - greatest(target_start, b * {z})) as bigint) as overlap from
  (select *, unnest(generate_series(target_start // {z}, (target_end - 1) // {z})) as b from {source}) group by 1, 2, 3),
top as (select * from (select *, row_number() over (partition by target_id, bin_start order by overlap desc, query_id) as rank from bo) where rank <= {BINS.top_n})"""


_TABLE = f"""{_A}, ft as (select * from a where {_PRIMARY} and match_len >= {BINS.min_match} and query_len >= {BINS.min_query}), {_best("ft")}, {_tops("ft", BINS.chromosomes)},
ht as (select ft.* from ft join b using (query_id, target_id) where target_id in (select target_id from tops)), {_overlaps("ht")},
tab as (select target_id as chrom, bin_start, query_id as unitig, cast(rank as int) as rank from top)"""
_REPAIRED = f"""{_TABLE}, {_UNITIGS}, nr as (select chrom, bin_start, row_number() over (partition by chrom order by bin_start) as row_no from (select distinct chrom, bin_start from tab)),
e as (select chrom, unitig, row_no from tab join nr using (chrom, bin_start)),
mi as (select distinct r.chrom, r.row_no, p.unitig from nr r join e p on p.chrom = r.chrom and p.row_no between r.row_no - {BINS.search_range} and r.row_no - 1 join e q on q.chrom = r.chrom and q.unitig = p.unitig and q.row_no between r.row_no + 1 and r.row_no + {BINS.search_range}
  where not exists (select 1 from e where e.chrom = r.chrom and e.row_no = r.row_no and e.unitig = p.unitig)),
al as (select *, 0 as new from e union all select chrom, unitig, row_no, 1 from mi),
k as (select al.*, max(new) over (partition by chrom, row_no) as grew, row_number() over (partition by chrom, row_no order by coalesce(length, 0) desc, unitig) as place from al left join u on u.contig_id = al.unitig),
rep as (select chrom, bin_start, cast(row_no as int) as row_no, unitig from k join nr using (chrom, row_no) where grew = 0 or place <= {BINS.top_n})"""
_MATES = f"""{_SELF}, {_CONTIGS}, m0 as (select least((query_id, query_start), (target_id, target_start)) as i, greatest((query_id, query_start), (target_id, target_start)) as j from a where strand = '+' and query_id <> target_id),
m as (select i[1] as ctg_i, i[2] as a, x.length as len_i, j[1] as ctg_j, j[2] as b, y.length as len_j from m0 join c x on x.contig_id = i[1] join c y on y.contig_id = j[1])"""
_FLANK = "({0} + 1 <= 20000 or {0} + 1 > {1} - 20000)"
_READS = "rs as (select distinct trim(ref, E' \\t\\r\\n') as contig_id, regexp_replace(query_name, '/[12]$', '') as read from read_placement where regexp_replace(query_name, '/[12]$', '') <> '' and trim(ref, E' \\t\\r\\n') not in ('', '*'))"
_SPLIT = f"""{_READS}, {_TYPES}, sp as (select contig_id, read, row_number() over (partition by contig_id order by md5(read || ':100'), read) - 1 as place, count(*) over (partition by contig_id) // {_MULT.format("contig_type")} as size, {_MULT.format("contig_type")} as m
  from rs left join t using (contig_id))"""
_JACC = f"""{_READS}, n as (select contig_id, count(*) as n from rs group by 1), jj as (select x.contig_id as a, y.contig_id as b, count(*) as shared from rs x join rs y on x.read = y.read and x.contig_id < y.contig_id group by 1, 2),
j as (select a, b, shared, u.n as n_a, v.n as n_b, shared / (u.n + v.n - shared) as jaccard from jj join n u on u.contig_id = a join n v on v.contig_id = b)"""
_MASH = "greatest(0, -ln(2 * jaccard / (1 + jaccard)) / 21)"
_TEXTS = "x as (select cast(doc_id as varchar) as contig_id, text as seq from documents where text is not null)"


def _class(cases: str) -> str:
    return f"with {_MEAN} select contig_id, average_depth, case {cases} else 'other' end as contig_type from (select *, round(average_depth, 2) as d from m)"


_UNION = f"""{_SELF}, {{0}}, len as (select query_id, target_id, max(query_len) as query_len, max(target_len) as target_len, sum(case when strand = '+' then match_len else -match_len end) as balance from a group by 1, 2)"""


def _islands(side: str) -> str:
    return f"""{side}i as (select *, max({side}_end) over (partition by query_id, target_id order by {side}_start, {side}_end rows between unbounded preceding and 1 preceding) as before from a),
{side}g as (select *, sum(case when before is null or {side}_start > before then 1 else 0 end) over (partition by query_id, target_id order by {side}_start, {side}_end rows unbounded preceding) as isle from {side}i),
{side}u as (select query_id, target_id, cast(sum(e - s) as bigint) as covered from (select query_id, target_id, isle, min({side}_start) as s, max({side}_end) as e from {side}g group by 1, 2, 3) group by 1, 2)"""


_COVER = f"""{_UNION.format(_islands("query") + ", " + _islands("target"))}, cov as (select query_id, target_id, q.covered as query_covered, t.covered as target_covered, q.covered / query_len as query_ratio, t.covered / target_len as target_ratio,
  case when balance > 0 then '+' else '-' end as direction, query_len, target_len from len join queryu q using (query_id, target_id) join targetu t using (query_id, target_id))"""

SQL = {
    "dosage_mean": f"with {_MEAN} select * from m",
    "dosage_class": _class("when 0.5 * 28 <= d and d < 1.5 * 28 then 'haplotig' when 1.5 * 28 <= d and d < 2.5 * 28 then 'diplotig' when 2.5 * 28 <= d and d < 3.5 * 28 then 'triplotig' when 3.5 * 28 <= d and d < 4.5 * 28 then 'tetraplotig' when d >= 4.5 * 28 then 'replotig'"),
    "dosage_class_alt": _class("when 15 <= d and d < 45 then 'haplotig' when 45 <= d and d < 74 then 'diplotig' when 74 <= d and d < 103 then 'triplotig' when 103 <= d and d < 132 then 'tetraplotig' when d >= 132 then 'replotig'"),
    "dosage_class_hexa": _class("when 17 <= d and d < 49 then 'haplotig' when 49 <= d and d < 81 then 'diplotig' when 81 <= d and d < 113 then 'triplotig' when 113 <= d and d < 145 then 'tetraplotig' when 145 <= d and d < 177 then 'pentaplotig' when 177 <= d and d < 209 then 'hexaplotig' when d >= 209 then 'replotig'"),
    "dosage_class_hexa21": _class("when 11 <= d and d < 32 then 'haplotig' when 32 <= d and d < 53 then 'diplotig' when 53 <= d and d < 74 then 'triplotig' when 74 <= d and d < 95 then 'tetraplotig' when 95 <= d and d < 116 then 'pentaplotig' when 116 <= d and d < 137 then 'hexaplotig' when d >= 137 then 'replotig'"),
    "depth_hist": f"with {_DEPTH} select cast(round_even(depth, 0) as bigint) as depth, count(*) as windows from w group by 1",
    "paf_filter": f"with {_A}, {_SEGF} select line_no, query_id, target_id, match_len from f",
    "pair_stats": f"with {_PAIRS} select long_id, short_id, long_len, short_len, matched, points, round(ratio_long, 6) as ratio_long, round(ratio_short, 6) as ratio_short from f",
    "pair_r2": f"with {_PAIRS} select long_id, short_id, round(r2, 6) as r2, collinear from f",
    "pair_contained": f"with {_PAIRS} select long_id, short_id, round(inside_share, 6) as inside_share, contained from f",
    "directed_stats": f"""with {_SELF}, b as (select line_no, any_value(block_len) as block_len from self_paf group by 1),
f as (select query_id, target_id, max(query_len) as ql, max(target_len) as tl, cast(sum(match_len) as bigint) as matched, cast(coalesce(sum(block_len), 0) as bigint) as aligned, min(line_no) as n
  from a join b using (line_no) where query_id <> target_id and match_len >= {RED.min_match} and query_len >= {RED.min_query} group by 1, 2),
k as (select *, min(n) over (partition by least(query_id, target_id), greatest(query_id, target_id)) as m from f)
select query_id, target_id, matched, aligned, round(matched / ql, 6) as query_ratio, round(aligned / tl, 6) as target_ratio, case when ql > tl then target_id else query_id end as short_id,
  matched / ql > {RED.either_ratio} or aligned / tl > {RED.either_ratio} as redundant from k where n = m""",
    "redundant_contigs": f"with {_PAIRS} select contig_id from r",
    "retained_contigs": f"with {_PAIRS}, {_CONTIGS} select contig_id, length from c where contig_id not in (select contig_id from r)",
    "pair_identity": f"""with {_SELF} select query_id, target_id, cast(sum(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint)))) as bigint) as matched, max(query_len) as query_len, max(target_len) as target_len,
  round(cast(sum(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint)))) as bigint) / max(query_len), 6) as query_ratio,
  round(cast(sum(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda x: cast(x as bigint)))) as bigint) / max(target_len), 6) as target_ratio from a where {_PRIMARY} group by 1, 2""",
    "first_direction": f"""with {_SELF}, f as (select query_id, target_id, min(line_no) as n from a group by 1, 2), k as (select *, min(n) over (partition by least(query_id, target_id), greatest(query_id, target_id)) as m from f)
select line_no, query_id, target_id from a join k using (query_id, target_id) where n = m""",
    "interval_union": f"with {_COVER} select query_id, target_id, query_covered, target_covered, round(query_ratio, 6) as query_ratio, round(target_ratio, 6) as target_ratio, direction from cov",
    "covered_shorter": f"with {_COVER} select distinct case when query_len < target_len and query_ratio > 0.1 then query_id when target_len < query_len and target_ratio > 0.1 then target_id end as contig_id from cov where contig_id is not null",
    "best_target": f"with {_A}, {_best('a')} select query_id, target_id, matched, records, round(ratio, 6) as ratio from b",
    "best_target_ratio": f"with {_A}, {_SEGF}, {_best('f', where=f'and matched / query_len >= {SEG.min_ratio}')} select query_id, target_id, matched, records, round(ratio, 6) as ratio from b",
    "top_targets": f"with {_A}, f as (select * from a where {_PRIMARY} and match_len >= {BINS.min_match} and query_len >= {BINS.min_query}), {_tops('f', BINS.chromosomes)} select * from tops",
    "cigar_match_ratio": f"with {_A}, {_CIGAR}, {_tops('a', BINS.chromosomes)}, {_BESTK} select query_id, target_id, round(ratio, 6) as ratio from bk",
    "match_matrix": f"with {_A}, {_CIGAR} select query_id, {', '.join(f'round(coalesce(sum(ratio) filter (target_id = {c!r}), 0), 6) as {c}' for c in CHROMS)} from k group by 1",
    "match_ratios": f"with {_A}, {_CIGAR} select query_id, target_id, round(coalesce(ratio, 0), 6) as ratio from k",
    "match_above_cutoff": f"with {_A}, {_CIGAR}, {_tops('a', BINS.chromosomes)} select query_id, target_id, round(ratio, 6) as ratio from k where ratio > 0.2 and target_id in (select target_id from tops)",
    "off_target_contigs": f"with {_A}, {_CIGAR}, {_tops('a', BINS.chromosomes)}, {_BESTK} select distinct query_id from a where query_id not in (select query_id from bk)",
    "contained_filter": f"""with {_A}, sp as (select query_id, target_id, target_start, target_end, count(*) as n from a group by 1, 2, 3, 4),
v as (select *, max(target_end) over (partition by query_id, target_id order by target_start range between unbounded preceding and 1 preceding) as earlier, max(target_end) over (partition by query_id, target_id, target_start) as same from sp)
select line_no, query_id, target_id from a join v using (query_id, target_id, target_start, target_end) where n = 1 and (earlier is null or earlier < target_end) and same = target_end""",
    "gap_segments": f"with {_SEGS} select line_no, query_id, target_id, seg_no from s",
    "best_segment": f"with {_SEGS} select query_id, target_id, seg_no, rows, matched, first_start, last_start, last_end from (select *, row_number() over (partition by query_id order by rows desc, matched desc, seg_no, target_id) as rn from sr) where rn = 1",
    "bin_overlap": f"with {_A}, {_overlaps('a')} select * from bo",
    "topn_per_bin": f"with {_A}, {_overlaps('a')} select target_id, bin_start, query_id, overlap, cast(rank as int) as rank from top",
    "mad_filter": f"""with {_A}, med as (select query_id, target_id, median(target_start) as ms, median(target_end) as me from a group by 1, 2), o as (select a.*, abs(target_start - ms) as os, abs(target_end - me) as oe from a join med using (query_id, target_id)),
mad as (select query_id, target_id, median(os) as ds, median(oe) as de from o group by 1, 2) select line_no, query_id, target_id from o join mad using (query_id, target_id) where os <= 3 * ds and oe <= 3 * de""",
    "allelic_table": f"with {_TABLE} select * from tab",
    "overlap_ratio": f"with {_TABLE}, n as (select unitig, count(*) as n from tab group by 1) select x.unitig as u1, y.unitig as u2, round(count(*) / any_value(n), 6) as ratio from tab x join tab y on x.chrom = y.chrom and x.bin_start = y.bin_start join n on n.unitig = x.unitig group by 1, 2",
    "bin_repair": f"with {_REPAIRED} select * from rep",
    "table_filter": f"""with recursive {_REPAIRED}, {_TYPES},
d as (select chrom, row_no, bin_start, rep.unitig, coalesce(length, 0) as length, {_MULT.format("contig_type")} as m from rep left join u on u.contig_id = rep.unitig left join t on t.contig_id = rep.unitig),
x as (select chrom, bin_start, row_number() over (partition by chrom order by bin_start) as k, list((length, unitig, m) order by length, unitig) as us, list(unitig) as ids, sum(m) as total from d group by 1, 2),
y as (select *, coalesce(lag(ids) over w, []) as p, coalesce(lead(ids) over w, []) as n, (chrom, bin_start) in ((select min((chrom, bin_start)) from x), (select max((chrom, bin_start)) from x)) as exempt from x window w as (partition by chrom order by bin_start)),
z as (select *, total > {BINS.ploidy} and not exempt and len(list_filter(ids, lambda i: not list_contains(p, i) and not list_contains(n, i))) = 0 as drops from y),
walk as (select chrom, 0::bigint as k, []::varchar[] as seen, []::varchar[] as rest, 0::bigint as bin_start, true as drops from z group by chrom
  union all select z.chrom, z.k, case when z.drops then w.seen else list_distinct(list_concat(w.seen, r.rest)) end, r.rest, z.bin_start, z.drops from walk w join z on z.chrom = w.chrom and z.k = w.k + 1,
  lateral (select list_filter(z.us, lambda v: list_contains(w.seen, v[2])) as c), 
  lateral (select coalesce(list_min(list_filter(range(0, len(c) + 1), lambda j: z.total - coalesce(list_sum(list_transform(c[1:j], lambda v: v[3])), 0) <= {BINS.ploidy})), len(c)) as j),
  lateral (select list_filter(z.ids, lambda i: not list_contains(list_transform(c[1:j], lambda v: v[2]), i)) as rest) r)
select chrom, bin_start, unnest(rest) as unitig from walk where not drops""",
    "segment_merge": f"""with recursive {_SEGS},
s1 as (select *, row_number() over (partition by query_id order by last_start, seg_no, target_id) as k from sr),
p1 as (select query_id, k, 1 as no, target_id, rows, matched, first_start, last_end from s1 where k = 1
  union all select s.query_id, s.k, case when j then p.no else p.no + 1 end, case when j then p.target_id else s.target_id end, case when j then p.rows + s.rows else s.rows end, case when j then p.matched + s.matched else s.matched end,
    case when j then p.first_start else s.first_start end, s.last_end
  from (select p1.*, abs(n.first_start - p1.last_end) <= {SEG.max_distance} and (p1.rows >= {SEG.min_rows} or p1.matched >= {SEG.min_length}) as j from p1 join s1 n on n.query_id = p1.query_id and n.k = p1.k + 1) p join s1 s on s.query_id = p.query_id and s.k = p.k + 1),
s2 as (select query_id, no as k, arg_max(target_id, p1.k) as target_id, arg_max(rows, p1.k) as rows, arg_max(matched, p1.k) as matched, arg_max(first_start, p1.k) as first_start, arg_max(last_end, p1.k) as last_end from p1 group by 1, 2),
p2 as (select query_id, k, 1 as no, target_id, rows, matched, first_start, last_end from s2 where k = 1
  union all select s.query_id, s.k, case when j then p.no else p.no + 1 end, case when j then p.target_id else s.target_id end, case when j then p.rows + s.rows else s.rows end, case when j then p.matched + s.matched else s.matched end,
    case when j then p.first_start else s.first_start end, s.last_end
  from (select p2.*, n.rows < {SEG.min_rows} and n.first_start - p2.last_end <= {SEG.max_distance} as j from p2 join s2 n on n.query_id = p2.query_id and n.k = p2.k + 1) p join s2 s on s.query_id = p.query_id and s.k = p.k + 1)
select query_id, cast(no - 1 as int) as merged_no, arg_max(target_id, k) as target_id, arg_max(rows, k) as rows, arg_max(matched, k) as matched, arg_max(first_start, k) as first_start, arg_max(last_end, k) as last_end from p2 group by 1, 2""",
    "topn_budget": f"""with recursive {_A}, {_overlaps("a")}, {_TYPES}, o as (select target_id, bin_start, query_id, contig_type, row_number() over (partition by target_id, bin_start order by overlap desc, query_id) as k from bo left join t on t.contig_id = query_id),
w as (select target_id, bin_start, 0::bigint as k, 4 as budget, '' as query_id, false as took from (select distinct target_id, bin_start from o)
  union all select o.target_id, o.bin_start, o.k, case when takes then w.budget - costs else w.budget end, o.query_id, takes from w join o on o.target_id = w.target_id and o.bin_start = w.bin_start and o.k = w.k + 1,
  lateral (select case contig_type when 'diplotig' then w.budget > 0 when 'triplotig' then w.budget > 1 when 'tetraplotig' then w.budget > 2 else w.budget > 0 end as takes, case contig_type when 'diplotig' then 2 when 'triplotig' then 3 when 'tetraplotig' then 4 else 1 end as costs)
  where w.budget > 0)
select target_id, bin_start, query_id from w where took""",
    "kmer_counts": f"""with {_TEXTS}, g as (select distinct contig_id, substr(seq, i, 21) as g from (select contig_id, seq, unnest(generate_series(1, length(seq) - 20)) as i from x where length(seq) >= 21)),
r as (select g, array_to_string(list_reverse(string_split(translate(g, 'ACGTN', 'TGCAN'), '')), '') as r from (select distinct g from g))
select contig_id, count(distinct least(g, r)) as kmers from g join r using (g) group by 1""",
    "stream_loads": "select cast(loaded_at as date) as load_day, count(*) as stored_rows from paf group by 1",
    "linked_only": f"with {_TYPES}, {_L}, {_ADJ} select contig_id from t where contig_id in (select contig_id from adj)",
    "link_totals": f"with {_L} select * from l",
    "link_full": f"with {_MATES} select ctg_i, ctg_j, count(*) as links, count(*) filter ({_FLANK.format('a', 'len_i')} and {_FLANK.format('b', 'len_j')}) as flank_links from m group by 1, 2",
    "link_ht": f"with {_MATES} select ctg_i, case when 2 * (a + 1) > len_i then 'T' else 'H' end as end_i, ctg_j, case when 2 * (b + 1) > len_j then 'T' else 'H' end as end_j, count(*) as links from m group by all",
    "link_clm": f"""with {_MATES}, d as (select ctg_i, ctg_j, unnest([('+', '+', len_i - a + b), ('+', '-', len_i - a + len_j - b), ('-', '+', a + b), ('-', '-', a + len_j - b)]) as o from m),
e as (select ctg_i || o[1] as name_i, ctg_j || o[2] as name_j, o[3] as dist from d)
select name_i, name_j, 2 * count(*) as n, string_agg(dist || ' ' || dist, ' ' order by dist) as distances from e group by 1, 2 having count(*) >= 2""",
    "link_distances": f"""with {_MATES}, d as (select ctg_i, ctg_j, count(*) over (partition by ctg_i, ctg_j) as n, unnest([('+', '+', len_i - a + b), ('+', '-', len_i - a + len_j - b), ('-', '+', a + b), ('-', '-', a + len_j - b)]) as o from m)
select ctg_i || o[1] as name_i, ctg_j || o[2] as name_j, o[3] as dist, count(*) as links from d where n >= 2 group by 1, 2, 3""",
    "link_adjacency": f"with {_L}, {_ADJ} select * from adj",
    "link_density": f"with {_A}, {_UNITIGS}, {_L}, {_ADJ} select contig_id, cast(sum(links) as bigint) as links, round(cast(sum(links) as bigint) / any_value(re_sites), 6) as density from adj join u using (contig_id) group by 1",
    "link_norm": f"""with {_L}, {_ADJ}, tt as (select contig_id, cast(sum(links) as double) as total from adj group by 1), r as (select ctg_i, ctg_j, links, links / sqrt(x.total * y.total) as raw from l join tt x on x.contig_id = ctg_i join tt y on y.contig_id = ctg_j)
select ctg_i, ctg_j, round(raw * (select cast(sum(links) as double) from r) / (select sum(raw) from r), 6) as norm_links from r""",
    "link_weighted": f"""with {_L}, {_TYPES}, w as (select contig_id, case contig_type when 'diplotig' then 0.5::double when 'triplotig' then 0.333::double when 'tetraplotig' then 0.25::double else 1::double end as w from t)
select ctg_i, ctg_j, round(links * coalesce(x.w, 1) * coalesce(y.w, 1), 6) as weighted from l left join w x on x.contig_id = ctg_i left join w y on y.contig_id = ctg_j""",
    "contig_bins": f"with {_A}, {_UNITIGS} select contig_id, b as bin_no, b * {BINS.size} as bin_start, least(length, (b + 1) * {BINS.size}) as bin_end from (select *, unnest(generate_series(0, (length - 1) // {BINS.size})) as b from u where length > 0)",
    "link_bins": f"""with {_A}, {_UNITIGS}, {_L}, {_ADJ}, tt as (select contig_id, cast(sum(links) as bigint) as links from adj group by 1)
select contig_id, b as bin_no, round(links / ((least(length, (b + 1) * {BINS.size}) - b * {BINS.size}) / 1000), 4) as density from (select *, unnest(generate_series(0, (length - 1) // {BINS.size})) as b from u where length > 0) join tt using (contig_id)""",
    "group_re": f"with {_A}, {_UNITIGS}, {_TYPES}, {_MEMBERS} select group_name, cast(sum(coalesce(re_sites, 1) - 1) + 1 as bigint) as re_sites from g left join u using (contig_id) group by 1",
    "ctg_group_links": f"with {_L}, {_ADJ}, {_TYPES}, {_MEMBERS} select adj.contig_id, group_name, cast(sum(links) as bigint) as links, max(links) as strongest from adj join g on g.contig_id = other group by 1, 2",
    "clm_split": f"with {_L}, {_TYPES}, {_MEMBERS} select ctg_i, ctg_j, x.group_name, links from l join g x on x.contig_id = ctg_i join g y on y.contig_id = ctg_j and x.group_name = y.group_name",
    "read_pair_counts": f"with {_READS}, p as (select read, min(contig_id) as ctg_i, max(contig_id) as ctg_j from rs group by 1 having count(*) = 2) select ctg_i, ctg_j, count(*) as reads from p group by 1, 2",
    "major_target": f"""with {_A}, {_best("a")}, {_L}, {_ADJ}, near as (select * from (select *, row_number() over (partition by contig_id order by links desc, other) as rn from adj) where rn <= 3),
k as (select contig_id, min(target_id) as lo, max(target_id) as hi, arg_min(target_id, rn) as first, max(links) as most from near join b on b.query_id = other group by 1)
select contig_id, case when lo = hi then lo when most > 10 then first else 'Uncertain' end as target_id from k""",
    "read_sets": f"with {_READS} select * from rs",
    "read_split": f"with {_SPLIT} select contig_id, cast(0 as int) as part, read from sp where place < size",
    "read_split_disjoint": f"with {_SPLIT} select contig_id, cast(place // size as int) as part, read from sp where size > 0 and place < size * m",
    "group_reads": f"with {_SPLIT}, {_MEMBERS} select distinct group_name, read from sp join g using (contig_id) where place < size",
    "re_sites": f"with {_TEXTS} select contig_id, (length(seq) - length(replace(seq, 'the', ''))) // 3 + 1 as re_sites from x",
    "flank_re_sites": f"with {_TEXTS}, y as (select contig_id, case when length(seq) < 2 then seq else left(seq, least(100, length(seq) // 2)) || right(seq, least(100, length(seq) // 2)) end as seq from x) select contig_id, (length(seq) - length(replace(seq, 'the', ''))) // 3 + 1 as re_sites from y",
    "revcomp": f"with {_TEXTS} select contig_id, md5(array_to_string(list_reverse(string_split(translate(seq, 'ACGTN', 'TGCAN'), '')), '')) as digest from x",
    "set_jaccard": f"with {_JACC} select a, b, shared, n_a, n_b, round(jaccard, 6) as jaccard from j",
    "mash_pairs": f"with {_JACC} select a, b, shared, n_a, n_b, round(jaccard, 6) as jaccard, round({_MASH}, 6) as distance from j where {_MASH} < 0.15",
    "minhash_sketch": f"with {_READS} select contig_id, hash from (select contig_id, hash, row_number() over (partition by contig_id order by hash) as rn from (select distinct contig_id, md5(read) as hash from rs)) where rn <= 1000",
    "sketch_jaccard": f"""with {_READS}, sk as (select contig_id, hash from (select contig_id, hash, row_number() over (partition by contig_id order by hash) as rn from (select distinct contig_id, md5(read) as hash from rs)) where rn <= 16),
p as (select distinct x.contig_id as a, y.contig_id as b from sk x join sk y on x.hash = y.hash and x.contig_id < y.contig_id),
u as (select a, b, hash, count(*) as c from (select a, b, hash from p join sk on contig_id = a union all select a, b, hash from p join sk on contig_id = b) group by 1, 2, 3),
r as (select *, row_number() over (partition by a, b order by hash) as rn from u)
select a, b, round(count(*) filter (c = 2) / count(*), 6) as jaccard from r where rn <= 16 group by 1, 2 having count(*) filter (c = 2) > 0""",
}
