import gzip

from conftest import rows

from ploidlake.functions import scalar as S
from ploidlake.operators import hic
from ploidlake.params import Links
from ploidlake.sources import sinks, text


def put(tmp_path, name, content):
    p = tmp_path / name
    p.write_text(content)
    return str(p)


def test_fasta(spark, tmp_path):
    p = put(tmp_path, "a.fa", ">a\nac\n>b\r\nGG\r\n\n>a one > two\nacgt\nGATC\n>d\nACGTACGTA\n>d\nACG\n>c\n")
    assert rows(text.fasta(spark, p).select("contig_id", "seq", "length")) == [("a", "ACGTGATC", 8), ("b", "GG", 2), ("c", "", 0), ("d", "ACG", 3)]
    assert rows(text.fasta(spark, p, upper=False, min_length=4).select("seq")) == [("acgtGATC",)]
    assert rows(text.contig_table(text.fasta(spark, p))) == [("a", 8, 2), ("b", 2, 1), ("c", 0, 1), ("d", 3, 1)]


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("x", "ACGT"), ("y", "GG"), ("z", "T" * 5000)], "contig_id string, seq string")
    sinks.fasta(df, str(tmp_path / "out"), longer_than=3)
    assert rows(text.fasta(spark, str(tmp_path / "out")).select("contig_id", "seq")) == [("x", "ACGT"), ("z", "T" * 5000)]
    assert rows(sinks.without_sequence(spark.createDataFrame([("x",), ("w",), ("w",)], "contig_id string"), df)) == [("w",)]


def test_delta_skips_headers_indels_and_self_hits(spark, tmp_path):
    content = "/a/ref.fa /a/qry.fa\nNUCMER\n>t1 q1 500 90\n11 60 1 50 3 3 0\n5\n-7\n0\n101 120 40 21 0 0 0\n0\n>q1 q1 90 90\n1 90 1 90 0 0 0\n0\n>t2 q1 40 90\r\n1 4 2 5 1 1 0\r\n0\r\n"
    p = put(tmp_path, "a.delta", content)
    want = [("q1", 90, 0, 50, "+", "t1", 500, 10, 60, 47, 50), ("q1", 90, 1, 5, "+", "t2", 40, 0, 4, 3, 4), ("q1", 90, 20, 40, "-", "t1", 500, 100, 120, 20, 20)]
    assert rows(text.delta(spark, p)) == want
    assert text.delta(spark, p, keep_self=True).filter("query_id = target_id").count() == 1
    assert text.delta(spark, put(tmp_path, "empty.delta", "")).count() == 0


def test_paf_finds_tags_by_name(spark, tmp_path):
    p = put(tmp_path, "a.paf", "q\t100\t0\t50\t+\tt\t900\t10\t60\t50\t50\t60\tNM:i:0\ttp:A:S\tcg:Z:50M\nq\t100\t0\tx\t-\tt\t900\t10\t60\t7\t50\t60\n\n")
    got = text.paf(spark, p).orderBy("line_no").collect()
    assert (got[0].tp, got[0].cigar, got[0].target_end, got[0].mapq) == ("tp:A:S", "cg:Z:50M", 60, 60)
    assert got[1].tp is None and got[1].query_end is None and got[1].match_len == 7


def test_gfa_sam_depth_types(spark, tmp_path):
    assert rows(text.gfa(spark, put(tmp_path, "g", "H\tx\nS\tu1\tACGT\tLN:i:4\nL\tu1\n"))) == [("u1", "ACGT")]
    sam = text.sam_pairs(spark, put(tmp_path, "s", "@SQ\tx\nr1\t65\tc1\t11\t60\t5M\tc2\t21\t0\nr2\t65\tc1\t11\t60\t5M\t=\t31\t0\nr3\t77\t*\t0\t0\t*\t*\t0\t0\n"))
    assert rows(sam) == [("r1", 65, "c1", 10, "c2", 20), ("r2", 65, "c1", 10, "c1", 30), ("r3", 77, None, -1, None, -1)]
    with gzip.open(tmp_path / "d.tsv.gz", "wt") as f:
        f.write("#Chr\tStart\nc1\t1\t10\t10\t9\t270\t90.0\t27.0\n")
    assert [r.depth for r in text.depth_windows(spark, str(tmp_path / "d.tsv.gz")).collect()] == [27.0]
    assert rows(text.contig_types(spark, put(tmp_path, "t", "contig_ID\taverage_depth\tcontig_type\na\t28.0\thaplotig\n"))) == [("a", 28.0, "haplotig")]


def test_clusters_and_bins_round_trip(spark, tmp_path):
    m = spark.createDataFrame([("g1", "b"), ("g1", "a"), ("g2", "c"), ("g1", "a")], "group_name string, contig_id string")
    for count in (True, False):
        sinks.clusters(m, str(tmp_path / f"c{count}"), count)
        assert rows(text.clusters(spark, str(tmp_path / f"c{count}"), count)) == [("g1", 0, "a"), ("g1", 1, "b"), ("g2", 0, "c")]
    t = spark.createDataFrame([("chr01", 0, "u2"), ("chr01", 0, "u1"), ("chr01", 100, "u3")], "chrom string, bin_start bigint, unitig string")
    sinks.allelic_rows(t, str(tmp_path / "b"), 100)
    assert rows(text.allelic_rows(spark, str(tmp_path / "b"))) == [("chr01", 0, 100, "u1"), ("chr01", 0, 100, "u2"), ("chr01", 100, 200, "u3")]


def test_clm_round_trip(spark, tmp_path):
    pairs = spark.createDataFrame([("a", 10, 100, "b", 5, 50), ("a", 20, 100, "b", 7, 50), ("a", 1, 100, "c", 1, 9)], "ctg_i string, a bigint, len_i bigint, ctg_j string, b bigint, len_j bigint")
    got = hic.orientations(pairs, Links())
    assert rows(got)[0] == ("a+", "b+", 4, "87 87 95 95")  # 100 - 20 + 7, 100 - 10 + 5; one link makes no line
    assert got.count() == 4
    sinks.clm(got, str(tmp_path / "clm"))
    back = text.clm(spark, str(tmp_path / "clm"))
    assert back.filter("dir_i = '+' and dir_j = '+'").first().distances == [87, 87, 95, 95]


def test_scalars(spark):
    from pyspark.sql import functions as F

    one = spark.createDataFrame([("GATCxxGATC", "5S10M2I30M3=", "ACGTN", 2.5)], "s string, c string, d string, x double")
    r = one.select(
        S.site_count(F.col("s"), "GATC").alias("n"), S.cigar_matches(F.col("c")).alias("m"), S.reverse_complement(F.col("d")).alias("rc"), F.rint("x").alias("r"),
        S.flank_sequence(F.lit("GAxxxxxxTC"), 2).alias("f"), S.flank_sequence(F.lit("A"), 5).alias("f1"), S.flank_sequence(F.lit("ABCD"), 50).alias("f2"),
        S.in_flank(F.lit(5), F.lit(100), 5).alias("i1"), S.in_flank(F.lit(95), F.lit(100), 5).alias("i2"), S.half_of(F.lit(50), F.lit(100)).alias("h"), S.half_of(F.lit(51), F.lit(100)).alias("t"),
        S.dosage_class(F.lit(41.994), [(42.0, "di"), (14.0, "ha")]).alias("k1"), S.dosage_class(F.lit(41.996), [(42.0, "di"), (14.0, "ha")]).alias("k2"), S.dosage_class(F.lit(3.0), [(14.0, "ha")]).alias("k3"),
        S.flags_clear(F.lit(256), S.NOT_PRIMARY).alias("p1"), S.flags_clear(F.lit(65), S.NOT_PRIMARY).alias("p2"),
    ).first()
    assert tuple(r) == (3, 40, "NACGT", 2.0, "GATC", "A", "ABCD", True, False, "H", "T", "ha", "di", "other", False, True)
