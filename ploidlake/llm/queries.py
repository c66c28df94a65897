"""Queries of the training-data problems, with SQL where it can say the same on whole tables."""

from __future__ import annotations

from ploidlake.functions.ids import clean_label
from ploidlake.llm import components, cooccur, digests, leakage, mixing, readability, topn
from ploidlake.runtime import table

PERCENTS = [10, 25, 50, 75, 90, 99]


def _bounded(s, d):
    """Ranks of the estimates, counted anew by a plain join, and how far off they may be.

    ``(contig_id, percent, n, below_at_most, upto_at_least)``: of ``n`` windows so many lie below the estimate at most, and
    so many at or below it at least; a count beyond the bound of the rank error shows instead of the bound.
    """
    from pyspark.sql import functions as F

    values = digests.valid_depths(table(s, d, "depth_win")).select("contig_id", "depth")
    found = digests.depth_percentiles(table(s, d, "depth_win"), PERCENTS).select("contig_id", "percent", "estimate")
    counted = values.join(found, "contig_id").groupBy("contig_id", "percent").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("depth") < F.col("estimate")).alias("below"), F.count_if(F.col("depth") <= F.col("estimate")).alias("upto"))
    most, least = F.floor(((F.col("percent") + 1) * F.col("n") + 50) / 100), F.floor(((F.col("percent") - 1) * F.col("n") - 50 + 99) / 100)  # MAX_ERROR is one percent
    return counted.select("contig_id", "percent", "n", F.greatest("below", most).alias("below_at_most"), F.least("upto", least).alias("upto_at_least"))


def _days(s, d):
    """``(contig_id, load_day, windows, low, high)`` as the digests of single load days have them."""
    from pyspark.sql import functions as F

    daily = digests.digests(digests.valid_depths(table(s, d, "depth_win")), ["contig_id", "load_day"], "depth")
    return daily.select("contig_id", "load_day", F.expr("cast(round(aggregate(weights, 0D, (a, w) -> a + w)) as bigint)").alias("windows"), "low", "high")


def _limits(s, d):
    """What the rounding keeps to, with characters for sizes, which SQL can count: ``docs`` rows, ``docs_in_range`` of them
    taken as often as planned or once less or more and never too often, and copies in all between two neighbouring sums.

    Blocks are small, so that the reduction tree has levels at every size.
    """
    from pyspark.sql import functions as F

    sizes = table(s, d, "documents").select("doc_id", clean_label("source").alias("source"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("tokens")).filter("source is not null")
    planned = mixing.plan(sizes, table(s, d, "mix_targets"))
    want = s.createDataFrame([(x["source"], int(x["max_repeats"]), float(x["copies"]), int(x["docs"])) for x in planned], "source string, most int, each double, n bigint")
    got = mixing.mix(sizes, planned, block=50, fan_in=4)
    got = got.join(F.broadcast(want.drop("n")), "source")  # a row per row of targets, which the plan bounds
    in_range = (F.abs(F.col("copies") - F.col("each")) < 1) & (F.col("copies") <= F.col("most"))
    per = got.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.count_if(in_range).alias("docs_in_range"), F.sum("copies").alias("copies"))
    planned_sum, zero = F.round(F.col("each") * F.col("n"), 6), F.lit(0).cast("bigint")
    joined = want.join(per, "source", "left").withColumns({c: F.coalesce(c, zero) for c in ("docs", "docs_in_range", "copies")})
    return joined.select("source", "docs", "docs_in_range", F.least("copies", F.floor(planned_sum)).alias("copies_at_least"), F.greatest("copies", F.ceil(planned_sum)).alias("copies_at_most"))


def _lix(levels):
    """``(doc_id, n_long, lix_grade, rix_grade)``: the formulas for all languages."""
    from pyspark.sql import functions as F

    return levels.select("doc_id", "n_long", F.round("lix_grade", 6).alias("lix_grade"), "rix_grade")


QUERIES = {
    "p2_found": lambda s, d: components.contig_groups(table(s, d, "self_paf")),
    "p2_group_sizes": lambda s, d: components.group_sizes(table(s, d, "self_paf")),
    "p4_found": lambda s, d: topn.strongest_alignments(table(s, d, "paf")).select("query_id", "line_no"),
    "p4_ranked": lambda s, d: topn.strongest_alignments(table(s, d, "paf")),
    "p5_found": lambda s, d: digests.uneven_contigs(table(s, d, "depth_win")),
    "p5_percentiles": lambda s, d: digests.depth_percentiles(table(s, d, "depth_win"), PERCENTS),
    "p5_certified": _bounded,
    "p5_days": _days,
    "p6_found": lambda s, d: cooccur.tied_contigs(table(s, d, "read_placement")),
    "p6_pairs": lambda s, d: cooccur.contig_pairs(table(s, d, "read_placement")),
    "p7_found": lambda s, d: leakage.leaked_passages(table(s, d, "documents"), table(s, d, "eval_items")),
    "p7_leaks": lambda s, d: leakage.leaks(table(s, d, "documents"), table(s, d, "eval_items")),
    "p7_items": lambda s, d: leakage.leaked_items(table(s, d, "documents"), table(s, d, "eval_items")),
    "p8_found": lambda s, d: mixing.short_sources(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p8_mixture": lambda s, d: mixing.mixture(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p8_shares": lambda s, d: mixing.shares(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p8_limits": _limits,
    "p9_found": lambda s, d: readability.demanding(table(s, d, "documents")),
    "p9_levels": lambda s, d: readability.reading_levels(table(s, d, "documents"), "doc_id", "text", "lang"),
    "p9_counts": lambda s, d: readability.reading_levels(table(s, d, "documents"), "doc_id", "text", "lang").select("doc_id", "n_words", "n_sentences", "n_chars"),
    "p9_lix": lambda s, d: _lix(readability.reading_levels(table(s, d, "documents"), "doc_id", "text", "lang")),
    "p9_profile": lambda s, d: readability.level_profile(table(s, d, "documents")),
}

_LABEL = "nullif(lower(trim(source, E' \\t\\r\\n')), '')"
_ID = "nullif(nullif(trim({0}, E' \\t\\r\\n'), ''), '*')"
_GROUPS = f"""
with recursive e as (select distinct {_ID.format("query_id")} as a, {_ID.format("target_id")} as b from self_paf),
l as (select a, b from e where a <> b union select b, a from e where a <> b),
g(v, m) using key (v) as (
  select a, least(a, min(b)) from l group by a
  union
  select l.a, min(g.m) from l join g on g.v = l.b join recurring.g as own on own.v = l.a group by l.a, own.m having min(g.m) < own.m)
"""
_RANKED = f"""
select query_id, line_no, cast(rn as int) as rank from (
  select *, row_number() over (partition by query_id order by match_len desc, target_start nulls last, line_no) as rn from
    (select distinct {_ID.format("query_id")} as query_id, match_len, target_start, line_no from paf)
  where query_id is not null and match_len is not null) where rn <= 3"""
_DEPTHS = "(select contig_id, win_start, max(depth) as depth from depth_win where contig_id is not null and depth >= 0 and isfinite(depth) group by all)"
_PAIRS = """
with p as (select distinct regexp_replace(query_name, '/[12]$', '') as r, trim(ref, E' \\t\\r\\n') as ref from read_placement where regexp_replace(query_name, '/[12]$', '') <> '' and trim(ref, E' \\t\\r\\n') not in ('', '*')),
n as (select ref, count(*) as n from p group by 1), a as (select count(distinct r) as a from p),
j as (select x.ref as i, y.ref as j, count(*) as s from p x join p y on x.r = y.r and x.ref < y.ref group by all)
select i as ctg_i, j as ctg_j, s as links, u.n as reads_i, v.n as reads_j, a as all_reads, s / u.n * a / v.n as ratio from j join n u on u.ref = i join n v on v.ref = j, a"""

SQL = {
    "p2_found": _GROUPS + "select v as contig_id, m as group_id from g",
    "p2_group_sizes": _GROUPS + "select m as group_id, count(*) as contigs from g group by 1",
    "p4_found": f"select query_id, line_no from ({_RANKED})",
    "p4_ranked": _RANKED,
    "p5_found": f"select contig_id from {_DEPTHS} group by 1 having count(*) >= 20 and quantile_cont(depth, 0.9) >= 3 * median(depth)",
    "p5_certified": f"""
select contig_id, cast(percent as int) as percent, n, cast(floor(((percent + 1) * n + 50) / 100) as bigint) as below_at_most, cast(floor(((percent - 1) * n - 50 + 99) / 100) as bigint) as upto_at_least
from (select contig_id, count(*) as n from {_DEPTHS} group by 1), (select unnest({PERCENTS}) as percent)""",
    "p5_days": """
select contig_id, load_day, count(*) as windows, min(depth) as low, max(depth) as high from
  (select contig_id, win_start, max(depth) as depth, cast(min(loaded_at) as date) as load_day from depth_win where contig_id is not null and depth >= 0 and isfinite(depth) group by 1, 2) group by 1, 2""",
    "p6_found": f"select ctg_i, ctg_j from ({_PAIRS}) where links >= 8 and links * all_reads >= 5 * reads_i * reads_j",
    "p6_pairs": _PAIRS,
    "p8_limits": f"""
with d as (select {_LABEL} as key, length(text) as size from documents where {_LABEL} is not null),
t as (select source, {_LABEL} as key, coalesce(target_share, 0) as share, coalesce(max_repeats, 0) as most from mix_targets where {_LABEL} is not null),
h as (select t.source, share, most, count(d.key) as docs, coalesce(sum(size), 0) as size from t left join d using (key) group by all),
w as (select *, case when size > 0 then least(share * (select sum(size) from h) / size, most) else 0 end as each from h)
select source, docs, docs as docs_in_range, cast(floor(round(each * docs, 6)) as bigint) as copies_at_least, cast(ceil(round(each * docs, 6)) as bigint) as copies_at_most from w""",
    "p9_counts": r"""
select doc_id, w as n_words, case when w > 0 then s else 0 end as n_sentences, c as n_chars from (
  select doc_id, coalesce(len(regexp_extract_all(text, '[^\s\p{Z}]*[\p{L}\p{N}][^\s\p{Z}]*')), 0) as w, 1 + coalesce(len(regexp_extract_all(text, '[.!?…][\s\p{Z}]+\p{Lu}')), 0) as s, coalesce(len(regexp_extract_all(text, '[\p{L}\p{N}]')), 0) as c from documents)""",
    "p9_lix": r"""
select doc_id, l as n_long, case when w > 0 then round((w / s + 100 * l / w - 10) / 4, 6) end as lix_grade,
  case when w > 0 then 1e0 + len(list_filter([0.2e0, 0.5e0, 0.8e0, 1.3e0, 1.8e0, 2.4e0, 3e0, 3.7e0, 4.5e0, 5.3e0, 6.2e0, 7.2e0], lambda t: l / s >= t)) end as rix_grade from (
  select doc_id, coalesce(len(p), 0) as w, 1 + coalesce(len(regexp_extract_all(text, '[.!?…][\s\p{Z}]+\p{Lu}')), 0) as s, coalesce(len(list_filter(p, lambda x: len(regexp_extract_all(x, '[\p{L}\p{N}]')) > 6)), 0) as l
  from (select doc_id, text, regexp_extract_all(text, '[^\s\p{Z}]*[\p{L}\p{N}][^\s\p{Z}]*') as p from documents))""",
    "p9_found": r"""
select distinct doc_id from (
  select doc_id, len(regexp_extract_all(text, '[^\s\p{Z}]*[\p{L}\p{N}][^\s\p{Z}]*')) as w, 1 + len(regexp_extract_all(text, '[.!?…][\s\p{Z}]+\p{Lu}')) as s, len(regexp_extract_all(text, '[\p{L}\p{N}]')) as c from documents)
where w >= 20 and w >= 18 * s and c >= 5.8 * w""",
}
