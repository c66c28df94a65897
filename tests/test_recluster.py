import random

from conftest import rows
from pyspark.sql import functions as F
from test_operators import paf, sequential

from ploidlake.operators import assign
from ploidlake.plans import pipelines
from ploidlake.queries import domain


def small(spark, monkeypatch, contigs, links, members):
    """The domain queries' tables replaced by small ones; all contigs are haplotigs."""
    tables = {
        "_unitigs": spark.createDataFrame(contigs, "contig_id string, length bigint, re_sites bigint"),
        "_types": spark.createDataFrame([], "contig_id string, contig_type string"),
        "_links": spark.createDataFrame(links, "ctg_i string, ctg_j string, links bigint"),
        "_members": spark.createDataFrame(members, "contig_id string, group_name string"),
    }
    for name, df in tables.items():
        monkeypatch.setattr(domain, name, lambda s, d, df=df: df)


def test_rescue_takes_contigs_with_a_link_of_five(spark, monkeypatch):
    contigs = [("a", 900, 4), ("b", 800, 3), ("c", 700, 3), ("d", 600, 3), ("e", 500, 2)]
    small(spark, monkeypatch, contigs, [("a", "b", 299), ("a", "c", 5), ("a", "d", 4)], [("a", "g1")])
    assert rows(domain.QUERIES["rescue_density"](spark, "")) == [("d",), ("e",)]


def test_match_ratios_have_every_target(spark, monkeypatch):
    a = paf(spark, [("p", "chr01", 0, 10), ("p", "chr12", 0, 10), ("p", "chr12", 20, 30), ("q", "scf0007", 0, 10)])
    monkeypatch.setattr(domain, "_aln", lambda s, d: a)
    assert rows(domain.QUERIES["match_ratios"](spark, "")) == [("p", "chr01", 0.0001), ("p", "chr12", 0.0002), ("q", "scf0007", 0.0001)]


def test_own_chromosome_first_then_all(spark, monkeypatch):
    """Through the pipeline, with the genotype step's groups given: u is at home on chr1, but denser linked to chr2's group; v is at home nowhere."""
    a = paf(spark, [(c, t, 0, 10) for c, t in [("a", "chr1"), ("b", "chr2"), ("u", "chr1"), ("w", "chr2")]])
    contigs = spark.createDataFrame([("a", 900, 10), ("b", 800, 10), ("u", 700, 5), ("v", 600, 5), ("w", 500, 5)], "contig_id string, length bigint, re_sites bigint")
    types = spark.createDataFrame([], "contig_id string, contig_type string")
    links = spark.createDataFrame([("1", "a", "u", 6), ("2", "b", "u", 60), ("3", "u", "v", 9), ("4", "b", "w", 7), ("5", "u", "w", 90)], "count_id string, ctg_i string, ctg_j string, links bigint")
    groups = spark.createDataFrame([("chr1", 1, 0, "a"), ("chr2", 1, 0, "b")], "chrom string, group_no int, pos int, contig_id string")
    monkeypatch.setattr(pipelines.align, "alignments", lambda x: x)
    monkeypatch.setattr(pipelines.align, "best_segment", lambda x: a.select("query_id", "line_no").distinct().withColumn("merged_no", F.lit(0)))
    monkeypatch.setattr(pipelines.allelic, "linked_only", lambda g, lk: groups)
    monkeypatch.setattr(pipelines.allelic, "genotyped", lambda *x: groups)
    out = pipelines.haplotype_groups(a, links, contigs, types, rounds=5)
    assert rows(out["membership"]) == [("a", "chr1g1", True), ("b", "chr2g1", True), ("u", "chr1g1", False), ("v", "chr1g1", False), ("w", "chr2g1", False)]
    assert out["unassigned"].count() == 0


def test_reassign_within_keeps_chromosomes_apart(spark):
    """x is a member on chr2 but at home on chr1: it waits there, and adds no sites to chr2's group."""
    contigs = spark.createDataFrame([("a", 900, 10), ("b", 800, 10), ("x", 700, 100), ("y", 600, 4)], "contig_id string, length bigint, re_sites bigint")
    homes = spark.createDataFrame([("a", "chr1"), ("b", "chr2"), ("x", "chr1"), ("y", "chr2")], "contig_id string, chrom string")
    members = spark.createDataFrame([("a", "chr1", "g1"), ("b", "chr2", "h1"), ("x", "chr2", "h2")], "contig_id string, chrom string, group_name string")
    links = spark.createDataFrame([("a", "x", 8), ("a", "y", 500), ("b", "y", 9), ("x", "y", 8)], "ctg_i string, ctg_j string, links bigint")
    got = assign.reassign_within(contigs, spark.createDataFrame([], "contig_id string, contig_type string"), links, members, homes, 4)
    assert rows(got) == [("a", "g1"), ("b", "h1"), ("x", "g1"), ("x", "h2"), ("y", "h2")]


def test_reassign_is_the_strict_order_whatever_the_bands(spark):
    """Chains of ungrouped contigs, equal lengths, several copies; a single band, a few, and small tiles of the running sums."""
    rnd = random.Random(7)
    contigs = {f"c{i:02d}": (1000 + 10 * (i // 2), rnd.randrange(2, 9)) for i in range(20)}
    copies = {f"c{i:02d}": rnd.choice([1, 1, 2, 3]) for i in range(20)}
    links = {(f"c{i:02d}", f"c{j:02d}"): rnd.randrange(1, 20) for i in range(20) for j in range(i + 1, min(i + 6, 20)) if rnd.random() < 0.6}
    members = {"c19": {"g1"}, "c18": {"g2"}, "c16": {"g1", "g3"}}
    ordered = dict(sorted(contigs.items(), key=lambda x: (-x[1][0], x[0])))
    df = spark.createDataFrame([(c, *x) for c, x in contigs.items()], "contig_id string, length bigint, re_sites bigint")
    types = spark.createDataFrame([(c, ["haplotig", "diplotig", "triplotig"][n - 1]) for c, n in copies.items()], "contig_id string, contig_type string")
    lk = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "ctg_i string, ctg_j string, links bigint")
    ms = spark.createDataFrame([(c, g) for c, gs in members.items() for g in gs], "contig_id string, group_name string")
    want = sequential(ordered, copies, links, members, 5)
    for rounds, tile in ((1, 1 << 16), (4, 5)):
        got = assign.reassign(df, types, lk, ms, rounds, tile=tile)
        assert rows(got.select("contig_id", "group_name")) == want
