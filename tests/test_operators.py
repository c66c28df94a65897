import random

from conftest import rows

from ploidlake.operators import align, allelic, assign, merging, reads, similarity
from ploidlake.params import Bins, Links, Reads, Segments
from ploidlake.plans import pipelines

PAF = "query_id string, query_len bigint, query_start bigint, query_end bigint, strand string, target_id string, target_len bigint, target_start bigint, target_end bigint, match_len bigint, block_len bigint, mapq int, tp string, cigar string, line_no bigint"


def paf(spark, items):
    """Items ``(query, target, target_start, target_end)``, with the match length of the interval."""
    return spark.createDataFrame([(q, 50_000, 0, 10, "+", t, 1_000_000, s, e, e - s, e - s, 60, "tp:A:P", "cg:Z:5M", i) for i, (q, t, s, e) in enumerate(items)], PAF)


def test_contained_records(spark):
    a = paf(spark, [("q", "t", 0, 10), ("q", "t", 2, 5), ("q", "t", 20, 30), ("q", "t", 20, 30), ("q", "t", 40, 50), ("q", "t", 40, 60), ("q", "t", 60, 70), ("q", "u", 2, 5)])
    assert sorted(r.line_no for r in align.drop_contained(a).collect()) == [0, 5, 6, 7]


def test_contained_equals_pairwise_rule(spark):
    rnd = random.Random(5)
    items = [("q", "t", s := rnd.randrange(40), s + rnd.randrange(1, 20)) for _ in range(60)]
    want = [i for i, (_, _, s, e) in enumerate(items) if not any(j != i and items[j][2] <= s and items[j][3] >= e for j in range(len(items)))]
    for tile in (7, 1000):
        assert sorted(r.line_no for r in align.drop_contained(paf(spark, items), tile).collect()) == want


def test_gap_segments_limits(spark):
    a = paf(spark, [("q", "t", 0, 100), ("q", "t", 600, 700), ("q", "t", 1201, 1300), ("q", "t", 1210, 1220)])
    for tile in (50, 400, 10_000):
        got = align.gap_segments(a, 500, tile)
        assert [r.seg_no for r in got.orderBy("line_no").collect()] == [0, 0, 1, 1]


def test_segment_merge(spark):
    names = "query_id string, target_id string, seg_no int, rows bigint, matched bigint, first_start bigint, last_start bigint, last_end bigint"
    p = Segments(min_rows=5, max_distance=100, min_length=1000)

    def merged(segs):
        return [(r.rows, r.matched, r.first_start, r.last_end) for r in align.merge_segments(spark.createDataFrame([("q", "t", i, n, m, f, f, e) for i, (n, m, f, e) in enumerate(segs)], names), p).orderBy("merged_no").collect()]

    assert merged([(1, 10, 0, 50)]) == [(1, 10, 0, 50)]
    assert merged([(6, 10, 0, 50), (1, 10, 120, 150)]) == [(7, 20, 0, 150)]
    assert merged([(1, 2000, 0, 50), (6, 10, 120, 150)]) == [(7, 2010, 0, 150)]  # by length alone
    assert merged([(1, 10, 0, 50), (6, 10, 120, 150)]) == [(1, 10, 0, 50), (6, 10, 120, 150)]
    assert merged([(6, 10, 0, 50), (1, 10, 500, 550)]) == [(6, 10, 0, 50), (1, 10, 500, 550)]


def test_bin_overlaps_keep_lengths(spark):
    items = [("q", "t", 95, 305), ("q", "t", 0, 100), ("r", "t", 100, 101)]
    got = allelic.bin_overlaps(paf(spark, items), 100)
    assert sum(r.overlap for r in got.collect()) == sum(e - s for _, _, s, e in items)
    assert ("t", 0, "q", 105) in rows(got)


def test_repair_within_range_and_overflow(spark):
    t = spark.createDataFrame([("c", 0, "a"), ("c", 1, "b"), ("c", 2, "a"), ("c", 3, "b"), ("c", 9, "a")], "chrom string, bin_start bigint, unitig string")
    lengths = spark.createDataFrame([("a", 10), ("b", 5)], "contig_id string, length bigint")
    got = {(r.bin_start, r.unitig) for r in allelic.repair_bins(t, lengths, Bins(top_n=4, search_range=1)).collect()}
    assert got == {(0, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (3, "b"), (9, "a")}
    one = {(r.bin_start, r.unitig) for r in allelic.repair_bins(t, lengths, Bins(top_n=1, search_range=1)).collect()}
    assert one == {(0, "a"), (1, "a"), (2, "a"), (3, "a"), (9, "a")}


def sequential(contigs, copies, links, members, least, known=None):
    """The strict order: one contig after the other, longest first. ``known``: the members with sites."""
    group_of = {c: set(g) for c, g in members.items()}
    sited = members if known is None else known
    sites = {g: 1 + sum(contigs[c][1] - 1 for c in sited if g in members[c]) for gs in members.values() for g in gs}
    for c in sorted(contigs, key=lambda c: -contigs[c][0]):
        if c in group_of:
            continue
        per, single = {}, 0
        for (a, b), n in links.items():
            other = b if a == c else a if b == c else None
            for g in group_of.get(other, ()):
                per[g] = per.get(g, 0) + n
                single = max(single, n)
        if not per or single < least:
            continue
        top = sorted(per, key=lambda g: (-per[g] / sites[g], g))[: copies.get(c, 1)]
        group_of[c] = set(top)
        for g in top:
            sites[g] += contigs[c][1]
    return sorted((c, g) for c, gs in group_of.items() for g in gs)


def test_reassign_with_a_band_per_contig_is_the_strict_order(spark):
    rnd = random.Random(11)
    contigs = {f"c{i:02d}": (1000 + 10 * i, rnd.randrange(2, 9)) for i in range(14)}
    copies = {"c12": 2, "c03": 3}
    links = {(f"c{i:02d}", f"c{j:02d}"): rnd.randrange(1, 20) for i in range(14) for j in range(i + 1, 14) if rnd.random() < 0.5}
    members = {"c00": {"g1"}, "c05": {"g2"}, "c13": {"g1", "g3"}}
    df = spark.createDataFrame([(c, *x) for c, x in contigs.items()], "contig_id string, length bigint, re_sites bigint")
    types = spark.createDataFrame([("c12", "diplotig"), ("c03", "triplotig"), ("c01", "other")], "contig_id string, contig_type string")
    lk = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "ctg_i string, ctg_j string, links bigint")
    ms = spark.createDataFrame([(c, g) for c, gs in members.items() for g in gs], "contig_id string, group_name string")
    got = assign.reassign(df, types, lk, ms, rounds=14, p=Links(min_single=5))
    assert rows(got.select("contig_id", "group_name")) == sequential(contigs, copies, links, members, 5)


def test_reassign_minimum_single_link(spark):
    df = spark.createDataFrame([("a", 9, 2), ("b", 8, 2), ("c", 7, 2)], "contig_id string, length bigint, re_sites bigint")
    ms = spark.createDataFrame([("a", "g1")], "contig_id string, group_name string")
    lk = spark.createDataFrame([("a", "b", 4), ("a", "c", 5)], "ctg_i string, ctg_j string, links bigint")
    types = spark.createDataFrame([], "contig_id string, contig_type string")
    assert rows(assign.reassign(df, types, lk, ms, 1).select("contig_id")) == [("a",), ("c",)]


def greedy(pairs):
    used, out = set(), []
    for a, b, o in sorted(pairs, key=lambda p: p[2]):
        if a not in used and b not in used:
            used |= {a, b}
            out.append((a, b, o))
    return sorted(out)


def test_greedy_pairs(spark):
    rnd = random.Random(2)
    chain = [("a", "b", 1), ("b", "c", 2), ("c", "d", 3)]
    many = [(f"n{x}", f"n{y}", i) for i, (x, y) in enumerate(rnd.sample([(x, y) for x in range(12) for y in range(x)], 30))]
    for pairs in (chain, many, []):
        df = spark.createDataFrame(pairs, "a string, b string, o bigint")
        assert rows(merging.greedy_pairs(df, "a", "b", "o")) == greedy(pairs)


def test_merged_sequences(spark):
    plan = spark.createDataFrame([("L", "S", True, True, 3, 2)], "long_id string, short_id string, falling boolean, short_first boolean, cut_short bigint, cut_long bigint")
    seqs = spark.createDataFrame([("L", "AACCG"), ("S", "TTTGG"), ("x", "A")], "contig_id string, seq string")
    assert rows(merging.merged_sequences(plan, seqs)) == [("merged_L_S", "TTT" + "CGGTT"[2:]), ("x", "A")]


def test_split_sizes(spark):
    sets = spark.createDataFrame([(c, f"r{i}") for c in "hdtq" for i in range(7)], "contig_id string, read string")
    types = spark.createDataFrame([("h", "haplotig"), ("d", "diplotig"), ("t", "triplotig"), ("q", "tetraplotig")], "contig_id string, contig_type string")
    shared = reads.split_reads(sets, types, Reads())
    assert {r.contig_id: r["count"] for r in shared.groupBy("contig_id").count().collect()} == {"h": 7, "d": 3, "t": 2, "q": 1}
    apart = reads.split_reads(sets, types, Reads(), disjoint=True)
    assert rows(apart.groupBy("contig_id", "part").count()) == sorted([("h", 0, 7), ("d", 0, 3), ("d", 1, 3), *[("t", k, 2) for k in range(3)], *[("q", k, 1) for k in range(4)]], key=repr)
    assert apart.groupBy("contig_id", "read").count().filter("count > 1").count() == 0
    ms = spark.createDataFrame([("d", "g1"), ("d", "g2"), ("h", "g2")], "contig_id string, group_name string")
    both = reads.group_reads(shared.filter("contig_id = 'd'"), ms)
    assert {r["count"] for r in both.groupBy("group_name").count().collect()} == {3}


def test_kmers_and_distance(spark):
    s = spark.createDataFrame([("a", "ACGTT"), ("b", "AACGT"), ("c", "AC")], "contig_id string, seq string")
    assert rows(similarity.kmers(s, 3)) == sorted([("a", "ACG"), ("a", "AAC"), ("b", "AAC"), ("b", "ACG")])
    m = similarity.kmers(s, 3).withColumnRenamed("kmer", "member")
    assert [(r.a, r.b, r.jaccard, r.distance) for r in similarity.similar_pairs(m, k=3).collect()] == [("a", "b", 1.0, 0.0)]


def test_set_pairs_with_members_in_very_many_sets(spark):
    rnd = random.Random(1)
    sets = {f"s{i:02d}": {"hot"} | {f"m{rnd.randrange(20)}" for _ in range(3)} for i in range(30)}
    df = spark.createDataFrame([(c, m) for c, ms in sets.items() for m in ms], "contig_id string, member string")
    got = {(r.a, r.b): r.shared for r in similarity.set_pairs(df, most_sets=4).collect()}
    assert got == {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b}


def test_pipelines_compose(spark, data):
    from ploidlake.queries import domain as d

    t = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    u = d._unitigs(spark, data)
    out = pipelines.haplotype_groups(t("paf"), t("hic_links"), u, d._types(spark, data), d.BINS, d.SEG, rounds=2)
    assert out["table"].count() > 0 and out["segments"].count() > 0
    n = out["membership"].select("contig_id").distinct().count() + out["unassigned"].count()
    assert n >= u.count()
    assert pipelines.phased_reads(t("read_placement"), d._types(spark, data), out["membership"]).count() > 0
    ids = d._contigs(spark, data).selectExpr("contig_id", "repeat('ACGT', 8) as seq")
    m = pipelines.mosaic_reference(ids, t("self_paf"), 1, d.RED)
    assert m["removed"].join(m["retained"], "contig_id").count() == 0
    assert m["merged"].count() == m["retained"].count() - m["plans"].count()
