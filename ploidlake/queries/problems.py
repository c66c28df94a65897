"""Queries of the general data problems: uneven keys (1) and intervals (3)."""

from __future__ import annotations

from ploidlake.operators import intervals, skew
from ploidlake.runtime import table

#: An id of the PAF tables in SQL: without outer blanks and tabs, null for none.
SQL_ID = "nullif(nullif(trim({0}, E' \\t\\r\\n'), ''), '*')"
_LABEL = "nullif(lower(trim({0}, E' \\t\\r\\n')), '')"

QUERIES = {
    "p1_found": lambda s, d: skew.hot_keys(table(s, d, "hic_links"), table(s, d, "contig_types")),
    "p1_contig_totals": lambda s, d: skew.contig_totals(table(s, d, "hic_links"), table(s, d, "contig_types")),
    "p1_type_totals": lambda s, d: skew.type_totals(table(s, d, "hic_links"), table(s, d, "contig_types")),
    "p3_found": lambda s, d: intervals.alignment_periods(table(s, d, "paf")),
}

_FACTS = """facts as (select unnest(list_distinct([ctg_i, ctg_j])) as contig_id, links, copies from
  (select count_id, ctg_i, ctg_j, max(links) as links, count(*) as copies from hic_links group by all)),
types as (select contig_id, min({label}) as contig_type from contig_types group by 1)""".format(label=_LABEL.format("contig_type"))

SQL = {
    "p1_found": f"""
select 'contig_id' as key_name, k as key_value from
  (select unnest(list_distinct([ctg_i, ctg_j])) as k from hic_links) where k is not null
  group by k having count(*) * 25 >= (select count(*) from hic_links)
union all
select 'contig_type', t from (select {_LABEL.format("contig_type")} as t from contig_types) where t is not null
  group by t having count(*) * 10 >= (select count(*) from contig_types)""",
    "p1_contig_totals": f"""
with {_FACTS}
select f.contig_id, cast(sum(copies) as bigint) as stored_rows, count(*) as n_counts, cast(sum(links) as bigint) as links_total, min(contig_type) as contig_type
from facts f left join types t on f.contig_id = t.contig_id where f.contig_id is not null group by 1""",
    "p1_type_totals": f"""
with {_FACTS},
stored as (select {_LABEL.format("contig_type")} as contig_type, count(*) as stored_rows from contig_types group by 1),
per as (select contig_id, sum(links) as links from facts group by 1)
select s.contig_type, any_value(s.stored_rows) as stored_rows, count(t.contig_id) as contigs, cast(sum(p.links) as bigint) as links_total
from stored s left join types t on s.contig_type = t.contig_type left join per p on p.contig_id = t.contig_id
where s.contig_type is not null group by 1""",
    "p3_found": f"""
with r as (select distinct {SQL_ID.format("query_id")} as query_id, {SQL_ID.format("target_id")} as target_id, target_start as s, target_end as e from paf where target_end > target_start),
m as (select *, max(e) over (partition by query_id, target_id order by s, e rows between unbounded preceding and 1 preceding) as before from r where query_id is not null and target_id is not null),
g as (select *, sum(case when before is null or s > before then 1 else 0 end) over (partition by query_id, target_id order by s, e rows unbounded preceding) as g from m),
p as (select query_id, target_id, g, min(s) as s, max(e) as e from g group by all)
select query_id, target_id, 'period' as span_kind, s as span_start, e as span_end from p
union all
select query_id, target_id, 'gap', l, s from (select *, lag(e) over (partition by query_id, target_id order by s) as l from p) where l is not null""",
}
