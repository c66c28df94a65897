"""Ordered walks over the tables, and hand cases, against plain versions of the rules."""

import random

from conftest import rows
from pyspark.sql import functions as F
from test_folds import thin_rows
from test_operators import greedy, sequential

from ploidlake.functions.scalar import dosage_class
from ploidlake.operators import allelic, merging, similarity
from ploidlake.params import MULTIPLICITY, SCHEMES, Bins
from ploidlake.queries import domain


def walk(bin_, kinds, budget=4):
    took = []
    for name, _ in sorted(bin_, key=lambda x: (-x[1], x[0])):
        kind = kinds.get(name, "haplotig")
        least, cost = {"diplotig": (0, 2), "triplotig": (1, 3), "tetraplotig": (2, 4)}.get(kind, (0, 1))
        if budget > least:
            took.append(name)
            budget -= cost
    return took


def test_a_unitig_that_does_not_fit_costs_nothing(spark):
    rnd = random.Random(8)
    kinds = {f"u{i:02d}": rnd.choice(["haplotig", "diplotig", "triplotig", "tetraplotig", "replotig"]) for i in range(30)} | {"h1": "haplotig", "h2": "haplotig", "x1": "tetraplotig", "x2": "tetraplotig", "h3": "haplotig", "h4": "haplotig"}
    bins = {0: [(n, 100 - i) for i, n in enumerate(["h1", "h2", "x1", "x2", "h3", "h4"])]}
    bins |= {k: [(u, rnd.randrange(1, 9)) for u in rnd.sample([u for u in kinds if u[0] == "u"], rnd.randrange(1, 25))] for k in range(1, 40)}
    df = spark.createDataFrame([("c", b, u, o) for b, us in bins.items() for u, o in us], "target_id string, bin_start bigint, query_id string, overlap bigint")
    types = spark.createDataFrame(list(kinds.items()), "contig_id string, contig_type string")
    got = {(r.bin_start, r.query_id) for r in allelic.budget_per_bin(df, types).collect()}
    assert got == {(b, u) for b, us in bins.items() for u in walk(us, kinds)}
    assert {u for b, u in got if b == 0} == {"h1", "h2", "h3", "h4"}


def test_dosage_schemes_by_hand(spark):
    cases = {
        "documented": [(14.99, "other"), (15, "haplotig"), (44.99, "haplotig"), (45, "diplotig"), (103, "tetraplotig"), (132, "replotig"), (44.996, "diplotig")],
        "hexaploid": [(16, "other"), (17, "haplotig"), (49, "diplotig"), (81, "triplotig"), (113, "tetraplotig"), (145, "pentaplotig"), (177, "hexaplotig"), (209, "replotig")],
        "hexaploid21": [(10, "other"), (11, "haplotig"), (32, "diplotig"), (53, "triplotig"), (74, "tetraplotig"), (95, "pentaplotig"), (116, "hexaplotig"), (137, "replotig")],
    }
    for scheme, pairs in cases.items():
        df = spark.createDataFrame([(float(d), want) for d, want in pairs], "d double, want string")
        assert df.filter(dosage_class(F.col("d"), SCHEMES[scheme]) != F.col("want")).count() == 0


def test_thinned_bins_equal_a_walk(spark):
    rnd = random.Random(21)
    ids = [f"u{i}" for i in range(9)]
    kinds = {u: rnd.choice(["haplotig", "haplotig", "diplotig", "triplotig", "tetraplotig"]) for u in ids}
    length = {u: rnd.choice([10, 10, 20, 30]) for u in ids}
    bins = {(c, 100 * b): rnd.sample(ids, rnd.randrange(1, 6)) for c in ("c1", "c2", "c3") for b in rnd.sample(range(60), 40)}
    df = spark.createDataFrame([(c, b, 0, u) for (c, b), us in bins.items() for u in us], "chrom string, bin_start bigint, row_no int, unitig string")
    got = rows(allelic.thin_bins(df, spark.createDataFrame(list(length.items()), "contig_id string, length bigint"), spark.createDataFrame(list(kinds.items()), "contig_id string, contig_type string"), Bins()))
    want = []
    for chrom in ("c1", "c2", "c3"):
        mine = sorted(b for c, b in bins if c == chrom)
        exempt = {k for k, b in enumerate(mine) if (chrom, b) in (min(bins), max(bins))}
        for b, row in zip(mine, thin_rows([sorted(bins[chrom, b]) for b in mine], {u: MULTIPLICITY[k] for u, k in kinds.items()}, length, 4, exempt), strict=True):
            want += [(chrom, b, u) for u in row or []]
    assert got == sorted(want, key=repr) and len(got) < sum(map(len, bins.values()))
    assert allelic.thin_bins(df.limit(0), spark.createDataFrame([], "contig_id string, length bigint"), spark.createDataFrame([], "contig_id string, contig_type string")).count() == 0


def test_medians_equal_sorted_ones(spark):
    rnd = random.Random(3)
    items = [("hot", rnd.choice([7, rnd.randrange(-500_000, 500_000)])) for _ in range(2001)] + [(f"k{i % 7}", rnd.randrange(200)) for i in range(60)] + [("one", 5), ("two", 1), ("two", 4)]
    df = spark.createDataFrame(items, "k string, v bigint").repartition(5)

    def middle(vs):
        vs = sorted(vs)
        return (vs[(len(vs) - 1) // 2] + vs[len(vs) // 2]) / 2

    want = sorted(((k, middle([v for q, v in items if q == k])) for k in {k for k, _ in items}), key=repr)
    for width in (1, 10, 1 << 16):
        assert rows(allelic.medians(df, ["k"], "v", "m", width)) == want


def test_sketches_of_unequal_sets(spark):
    """A tenth of a set inside it: the share of the sketches' own hashes would say a twentieth."""
    members = spark.range(20_000).select(F.lit("whole").alias("contig_id"), F.col("id").cast("string").alias("member")).unionByName(spark.range(2000).select(F.lit("part").alias("contig_id"), (F.col("id") * 10).cast("string").alias("member")))
    got = similarity.sketch_pairs(similarity.sketch(members, 1000), 1000).first()
    assert (got.a, got.b) == ("part", "whole") and abs(got.jaccard - 0.1) < 0.03
    small = members.filter("cast(member as int) < 300")  # sketches that hold whole sets are exact
    exact = similarity.set_pairs(small).first().jaccard
    assert abs(similarity.sketch_pairs(similarity.sketch(small, 1000), 1000, most_sets=1).first().jaccard - exact) < 1e-12


def test_reassigned_tables_are_the_strict_order(spark, data):
    u = {r.contig_id: (r.length, r.re_sites) for r in domain._unitigs(spark, data).collect()}
    kinds = {r.contig_id: r.contig_type for r in domain._types(spark, data).collect()}
    links = {(r.ctg_i, r.ctg_j): r.links for r in domain._links(spark, data).collect()}
    members = {}
    for r in domain._members(spark, data).collect():
        members.setdefault(r.contig_id, set()).add(r.group_name)
    ordered = dict(sorted(u.items(), key=lambda x: (-x[1][0], x[0])))
    known = {c: g for c, g in members.items() if c in u}  # others have no sites
    want = sequential(ordered, {c: MULTIPLICITY.get(k, 1) for c, k in kinds.items()}, links, members, 5, known)
    assert rows(domain.QUERIES["reassign_density"](spark, data).select("contig_id", "group_name")) == want
    left = set(u) - {c for c, _ in want}
    assert {r.contig_id for r in domain.QUERIES["rescue_density"](spark, data).collect()} == left


def longest(points, sign):
    best = []
    for x, y in sorted(points, key=lambda p: (p[0], sign * p[1])):
        best.append(((x, y), 1 + max((n for (a, b), n in best if a <= x and sign * b < sign * y), default=0)))
    return max(n for _, n in best)


def test_joined_pairs_of_the_tables(spark, data):
    """Runs are longest ones by a quadratic rule; pairs are taken as a walk takes them."""
    plans = merging.join_plans(domain._self(spark, data), domain.RED).collect()
    points = {}
    for r in merging.oriented(domain._self(spark, data)).filter("long_id <> short_id").collect():
        points.setdefault((r.long_id, r.short_id), set()).add((r.short_start, r.short_end, r.long_start, r.long_end))
    assert plans
    for r in plans:
        held = [(p[0], p[2]) for p in points[r.long_id, r.short_id]]
        rise, fall = longest(held, 1), longest(held, -1)
        assert r.run == max(rise, fall) and r.falling == (fall > rise) and abs(r.coverage - r.run / len(held)) < 1e-12
    want = greedy([(r.long_id, r.short_id, r.first_line) for r in plans])
    assert rows(domain.QUERIES["greedy_pairs"](spark, data)) == want
    assert {(r.long_id, r.short_id, r.run) for r in domain.QUERIES["lis_merge"](spark, data).collect()} == {(r.long_id, r.short_id, r.run) for r in plans}


def test_genotyped_tables_keep_to_their_rows(spark, data):
    got = domain.QUERIES["genotype"](spark, data).collect()
    home = {(r.chrom, r.unitig) for r in domain._bins(spark, data).collect()}
    assert got and {(r.chrom, r.contig_id) for r in got} <= home
    by = {}
    for r in got:
        by.setdefault((r.chrom, r.group_no), []).append(r.pos)
    assert all(sorted(ps) == list(range(len(ps))) and g in range(1, 5) for (_, g), ps in by.items())
