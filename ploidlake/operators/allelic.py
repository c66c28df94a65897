"""Allelic tables: which unitigs cover each bin of the reference, and their repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ploidlake.folds import genotype
from ploidlake.functions.scalar import multiplicity
from ploidlake.operators import align
from ploidlake.operators.hic import adjacency
from ploidlake.operators.skew import attach
from ploidlake.params import Bins, Links
from ploidlake.runtime import Stages


def bin_overlaps(aln: DataFrame, size: int) -> DataFrame:
    """``(target_id, bin_start, query_id, overlap)``: alignments cut at bin borders, summed per bin and query."""
    cut = aln.select("query_id", "target_id", "target_start", "target_end", F.explode(F.sequence(F.floor(F.col("target_start") / size), F.floor((F.col("target_end") - 1) / size))).alias("b"))
    piece = F.least("target_end", (F.col("b") + 1) * size) - F.greatest("target_start", F.col("b") * size)
    return cut.groupBy("target_id", (F.col("b") * size).alias("bin_start"), "query_id").agg(F.sum(piece).alias("overlap"))


def top_per_bin(overlaps: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("target_id", "bin_start").orderBy(F.desc("overlap"), "query_id")
    return overlaps.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def budget_per_bin(overlaps: DataFrame, types: DataFrame, ploidy: int = 4) -> DataFrame:
    """Unitigs of a bin, best first, while copies are left: a type of m copies needs a budget above m - 2 (above 0 for one copy).

    One that doesn't fit costs nothing and the walk goes on. The budget only falls, so of one number of copies the best are
    taken, ``ploidy`` of them at most: the walk is over lists of so many for each number, whatever else is in the bin.
    """
    kinds = types.select(F.col("contig_id").alias("query_id"), "contig_type")
    costed = overlaps.join(kinds, "query_id", "left").withColumn("m", multiplicity(F.coalesce("contig_type", F.lit("haplotig"))))
    w = Window.partitionBy("target_id", "bin_start", "m").orderBy(F.desc("overlap"), "query_id")
    ranked = costed.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= ploidy)
    place = F.struct((-F.col("overlap")).alias("o"), "query_id", "m")
    lists = ranked.groupBy("target_id", "bin_start").agg(F.sort_array(F.collect_list(place)).alias("us"))
    walk = f"""aggregate(us, struct({ploidy} as left, cast(array() as array<string>) as took), (acc, u) ->
      case when acc.left > greatest(0, u.m - 2) then struct(acc.left - u.m as left, concat(acc.took, array(u.query_id)) as took) else acc end, acc -> acc.took)"""
    return lists.select("target_id", "bin_start", F.explode(F.expr(walk)).alias("query_id"))


def medians(df: DataFrame, key: list[str], column: str, out: str, width: int = 1 << 16) -> DataFrame:
    """``(key, out)``: exact medians of whole numbers, however many a key has.

    Equal values are counted first, then values in buckets of ``width``; only the buckets that hold the middle are ordered.
    """
    own = [f"g{i}" for i in range(len(key))]
    values = df.groupBy(*[F.col(k).alias(g) for k, g in zip(key, own, strict=True)], F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("c")).withColumn("b", F.floor(F.col("v") / width).cast("bigint"))
    per = values.groupBy(*own, "b").agg(F.sum("c").alias("k"))
    whole = Window.partitionBy(*own)
    per = per.withColumns({"n": F.sum("k").over(whole), "before": F.sum("k").over(whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("k")})
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    middle = per.filter((F.col("before") < high) & (F.col("before") + F.col("k") >= low)).select(*own, "b", "n", "before")
    upto = F.col("before") + F.sum("c").over(Window.partitionBy(*own, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    held = values.join(middle, [*own, "b"]).withColumn("upto", upto)
    taken = [F.max(F.when((F.col("upto") >= r) & (F.col("upto") - F.col("c") < r), F.col("v"))) for r in (low, high)]
    return held.groupBy(*[F.col(g).alias(k) for k, g in zip(key, own, strict=True)]).agg(((taken[0] + taken[1]) / 2).alias(out))


def mad_filter(aln: DataFrame, times: float = 3.0) -> DataFrame:
    """Records whose target start and end lie within ``times`` the median absolute deviation of their query and target.

    Twice the deviations are whole numbers, so all four medians are exact.
    """
    key = ["query_id", "target_id"]
    stages = Stages(aln.sparkSession, "mad")
    aln = stages.write(aln)
    centre = medians(aln, key, "target_start", "ms").join(medians(aln, key, "target_end", "me"), key)
    off = {f"off_{x}": F.abs(2 * F.col(c) - (2 * F.col(f"m{x}")).cast("bigint")) for x, c in (("s", "target_start"), ("e", "target_end"))}
    off = stages.write(aln.join(centre, key).withColumns(off).drop("ms", "me"))
    stages.drop(aln)
    spread = medians(off, key, "off_s", "ds").join(medians(off, key, "off_e", "de"), key)
    return off.join(spread, key).filter((F.col("off_s") <= times * F.col("ds")) & (F.col("off_e") <= times * F.col("de"))).drop("off_s", "off_e", "ds", "de")


def allelic_table(aln: DataFrame, p: Bins = Bins()) -> DataFrame:
    """``(chrom, bin_start, unitig, rank)``: the best unitigs in each bin of the longest targets, from best targets only."""
    rows = align.primary(aln, p.min_match, p.min_query)
    best = align.on_best_target(rows)
    tops = align.top_targets(rows, p.chromosomes).select("target_id")
    kept = top_per_bin(bin_overlaps(best.join(tops, "target_id", "left_semi"), p.size), p.top_n)
    return kept.select(F.col("target_id").alias("chrom"), "bin_start", F.col("query_id").alias("unitig"), "rank")


def overlap_ratios(table: DataFrame) -> DataFrame:
    """``(u1, u2, ratio)``: share of u1's bins that u2 is in, for pairs with a common bin. A bin has a few unitigs at most."""
    long = table.select("chrom", "bin_start", "unitig").distinct()
    n = long.groupBy("unitig").agg(F.count(F.lit(1)).alias("n"))
    a, b = long.withColumnRenamed("unitig", "u1"), long.withColumnRenamed("unitig", "u2")
    both = a.join(b, ["chrom", "bin_start"]).groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("common"))
    return both.join(n.withColumnRenamed("unitig", "u1"), "u1").select("u1", "u2", (F.col("common") / F.col("n")).alias("ratio"))


def numbered(table: DataFrame) -> DataFrame:
    """With ``row_no``, the place of the bin among its chromosome's rows."""
    rows = table.select("chrom", "bin_start").distinct().withColumn("row_no", F.row_number().over(Window.partitionBy("chrom").orderBy("bin_start")))
    return table.join(rows, ["chrom", "bin_start"])


def repair_bins(table: DataFrame, lengths: DataFrame, p: Bins = Bins()) -> DataFrame:
    """``(chrom, bin_start, row_no, unitig)`` with unitigs added that stand within ``search_range`` rows before and after.

    Between two neighbouring rows of a unitig the rows near enough to both lack it. A row that got unitigs keeps its
    ``top_n`` longest; other rows stay as they are. Unknown lengths count as 0; ties keep the smaller id.
    """
    rows = Stages(table.sparkSession, "repair").write(numbered(table.select("chrom", "bin_start", "unitig").distinct()))
    after = F.lead("row_no").over(Window.partitionBy("chrom", "unitig").orderBy("row_no"))
    r = p.search_range
    gaps = rows.select("chrom", "unitig", F.col("row_no").alias("a"), after.alias("b")).filter(f"b - a > 1 and b - a <= {2 * r}")
    missing = gaps.select("chrom", "unitig", F.explode(F.expr(f"sequence(greatest(a + 1, b - {r}), least(b - 1, a + {r}))")).alias("row_no"))
    bins = rows.select("chrom", "row_no", "bin_start").distinct()
    added = missing.join(bins, ["chrom", "row_no"]).select("chrom", "bin_start", "row_no", "unitig", F.lit(1).alias("new"))
    every = rows.select("chrom", "bin_start", "row_no", "unitig", F.lit(0).alias("new")).unionByName(added)
    row = Window.partitionBy("chrom", "row_no")
    every = every.join(lengths.select(F.col("contig_id").alias("unitig"), "length"), "unitig", "left")
    ranked = every.withColumns({"grew": F.max("new").over(row), "place": F.row_number().over(row.orderBy(F.coalesce("length", F.lit(0)).desc(), "unitig"))})
    return ranked.filter((F.col("grew") == 0) | (F.col("place") <= p.top_n)).select("chrom", "bin_start", "row_no", "unitig")


def _rows(table: DataFrame, lengths: DataFrame, types: DataFrame) -> DataFrame:
    t = table.join(lengths.select(F.col("contig_id").alias("unitig"), "length"), "unitig", "left").join(types.select(F.col("contig_id").alias("unitig"), "contig_type"), "unitig", "left")
    t = t.withColumns({"length": F.coalesce("length", F.lit(0)).cast("bigint"), "copies": multiplicity(F.coalesce("contig_type", F.lit("haplotig"))), "contig_type": F.coalesce("contig_type", F.lit("haplotig"))})
    return t.select("chrom", "bin_start", "row_no", "unitig", "length", "copies", "contig_type")


def thin_bins(table: DataFrame, lengths: DataFrame, types: DataFrame, p: Bins = Bins()) -> DataFrame:
    """``(chrom, bin_start, unitig)``: rows of more copies than the ploidy lose unitigs seen before, or drop out.

    A row (but the table's first and last) drops if each of its unitigs also stands in the row before or after it, as given.
    Else unitigs that an earlier row kept leave, shortest first, until the copies fit or none is left. A unitig's first row
    that stays keeps it for sure, so which ones were seen is known without walking along the chromosome.
    """
    stages = Stages(table.sparkSession, "thin")
    rows = stages.write(numbered(_rows(table, lengths, types).drop("row_no")))
    ends = rows.agg(F.min(F.struct("chrom", "bin_start")).alias("a"), F.max(F.struct("chrom", "bin_start")).alias("z")).first()
    exempt = F.lit(False)
    for end in (ends.a, ends.z):
        if end is not None:
            exempt = exempt | ((F.col("chrom") == end.chrom) & (F.col("bin_start") == end.bin_start))
    bin_, own = Window.partitionBy("chrom", "row_no"), Window.partitionBy("chrom", "unitig")
    along = own.orderBy("row_no")
    beside = F.coalesce(F.lag("row_no").over(along) == F.col("row_no") - 1, F.lit(False)) | F.coalesce(F.lead("row_no").over(along) == F.col("row_no") + 1, F.lit(False))
    known = rows.withColumn("alone", (~beside).cast("int"))
    known = known.withColumns({"total": F.sum("copies").over(bin_), "own": F.sum("alone").over(bin_)})
    known = known.withColumn("drops", (F.col("total") > p.ploidy) & (F.col("own") == 0) & ~exempt)
    known = known.withColumn("seen", F.coalesce(F.min(F.when(~F.col("drops"), F.col("row_no"))).over(own) < F.col("row_no"), F.lit(False))).filter("not drops")
    left = F.coalesce(F.sum(F.when(F.col("seen"), F.col("copies"))).over(bin_.orderBy("length", "unitig").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    leaves = F.col("seen") & (F.col("total") - left > p.ploidy)
    return known.withColumn("leaves", leaves).filter("not leaves").select("chrom", "bin_start", "unitig")


def genotyped(table: DataFrame, types: DataFrame, lengths: DataFrame, sites: DataFrame, links: DataFrame, p: Bins = Bins(), q: Links = Links(), compat: bool = True) -> DataFrame:
    """``(chrom, group_no, pos, contig_id)``: unitigs of each chromosome's bins dealt to haplotype groups, in order.

    An ordered walk along each chromosome, cogrouped with the links among the unitigs of its table. Unitigs of a chromosome
    are at most ``top_n`` per bin, so groups are bounded by the reference's length.
    """
    table = Stages(table.sparkSession, "bins").write(table.select("chrom", "bin_start", "unitig").distinct())
    rows = _rows(numbered(table), lengths, types)
    rows = rows.join(sites.select(F.col("contig_id").alias("unitig"), "re_sites"), "unitig", "left").withColumn("re_sites", F.coalesce("re_sites", F.lit(1)).cast("bigint"))
    home = table.select("unitig", F.col("chrom").alias("home")).distinct()
    mine, theirs = home.withColumnsRenamed({"unitig": "contig_id", "home": "at"}), home.withColumnsRenamed({"unitig": "other", "home": "other_at"})
    adj = attach(attach(adjacency(links), mine, "contig_id"), theirs, "other").filter("at = other_at").select("at", "contig_id", "other", "links", F.lit(None).cast("double").alias("ratio"))
    ratios = overlap_ratios(table).select(F.col("u1").alias("contig_id"), F.col("u2").alias("other"), "ratio").join(mine, "contig_id").select("at", "contig_id", "other", F.lit(None).cast("bigint").alias("links"), "ratio")
    facts = adj.unionByName(ratios)
    ploidy = p.ploidy
    linked = adjacency(links).select(F.col("contig_id").alias("unitig")).distinct()
    rows = rows.join(linked.withColumn("has_links", F.lit(True)), "unitig", "left").withColumn("has_links", F.coalesce("has_links", F.lit(False)))

    def walk(left, right):
        return genotype.deal_chromosome(left, right, ploidy, q.allelic_signal, q.max_overlap, compat)

    return rows.groupBy("chrom").cogroup(facts.groupBy("at")).applyInPandas(walk, "chrom string, group_no int, pos int, contig_id string")


def linked_only(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Members that have any link."""
    return groups.join(adjacency(links).select("contig_id").distinct(), "contig_id", "left_semi")
