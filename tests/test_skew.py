from collections import Counter

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ploidlake.operators import skew


def test_pack_levels_loads():
    where, loads = skew.pack([50, 10, 10, 10, 10, 10], 2)
    assert sorted(loads) == [50, 50] and len(where) == 6


def test_heavy_keys_are_split_in_proportion(spark):
    df = spark.range(10_000).select(F.when(F.col("id") < 6000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"))
    plan = skew.plan_loads(df, "key", tasks=4)
    assert plan.total == 10_000
    assert list(plan.heavy) == ["hot"] and len(plan.heavy["hot"]) == 10  # 6000 rows, shards of 625
    assert max(plan.task_load) <= 1.2 * 10_000 / 4
    placed = skew._placed(df.withColumn("salt", F.xxhash64("key", F.monotonically_increasing_id())), plan, replicate=False)
    per = [len(p) for p in placed.rdd.glom().collect()]
    assert max(per) <= 1.3 * 10_000 / 4


def test_ten_thousand_tasks_are_all_loaded(spark):
    df = spark.range(400_000).select(F.concat(F.lit("k"), (F.col("id") % 300_000).cast("string")).alias("key")).unionByName(spark.range(100_000).select(F.lit("hot").alias("key")))
    plan = skew.plan_loads(df, "key", tasks=10_000)
    assert plan.total == 500_000 and len(plan.heavy["hot"]) > 1000
    assert 25 <= min(plan.task_load) and max(plan.task_load) <= 100  # fair: 50
    salted = df.withColumn("salt", F.xxhash64("key", F.monotonically_increasing_id()))
    per = [r["count"] for r in skew._dealt(salted, plan, replicate=False).groupBy("task").count().collect()]
    assert len(per) == 10_000 and max(per) <= 100


def test_sums_are_made_before_rows_move(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    plan = skew.keyed_totals(df, "k", {"s": "v"}, match=spark.createDataFrame([("hot", "x")], "k string, m string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("shufflepartitionidpassthrough") < plan.rindex("partial_sum(")  # plans print from the last step down
    assert plan.count("shufflepartitionidpassthrough") == 2


def test_matching_side_goes_only_to_the_shards(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("key"))
    plan = skew.plan_loads(df, "key", tasks=4)
    match = spark.createDataFrame([("hot",), ("3500",)], "key string")
    got = Counter(r.key for r in skew._placed(match, plan, replicate=True).collect())
    assert got == {"hot": len(plan.heavy["hot"]), "3500": 1}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "", None]), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60))
def test_totals_equal_brute_force(spark, pairs):
    df = spark.createDataFrame(pairs, "k string, v bigint")
    match = spark.createDataFrame([("a", "x"), ("a", "y"), ("", None), (None, "z")], "k string, v string")
    got = {r.k: (r.n_rows, r.total, r.v) for r in skew.keyed_totals(df, "k", {"total": "v"}, match=match).collect()}
    want = {}
    for k in {k for k, _ in pairs if k is not None}:
        vs = [v for q, v in pairs if q == k and v is not None]
        want[k] = (sum(q == k for q, _ in pairs), sum(vs) if vs else None, "x" if k == "a" else None)
    assert got == want


def test_lookup_with_clashing_names_and_nulls(spark):
    facts = spark.createDataFrame([("a", 1, "t"), ("a", 2, "t"), (None, 3, "t"), ("z", 4, None)], "key string, task int, __shard string")
    match = spark.createDataFrame([("a", 7), ("a", 8), (None, 9)], "key string, task int")
    assert rows(skew.lookup(facts, match, "key")) == rows(spark.createDataFrame([("a", 1, "t", 7), ("a", 1, "t", 8), ("a", 2, "t", 7), ("a", 2, "t", 8)], "a string, b int, c string, d int"))
    assert skew.lookup(facts, match, "key").columns == ["key", "task", "__shard", "task_"]
    assert skew.lookup(facts, match, "key", how="left").count() == 5


def test_attach_is_lookup_whatever_the_size(spark):
    facts = spark.createDataFrame([("a", 1, "t"), ("a", 2, "t"), (None, 3, "t"), ("z", 4, None)], "key string, task int, m0 string")
    match = spark.createDataFrame([("a", 7), ("a", 8), (None, 9)], "key string, task int")
    for how in ("inner", "left"):
        want = skew.lookup(facts, match, "key", how=how)
        for most in (0, 100):
            got = skew.attach(facts, match, "key", how, most)
            assert got.columns == want.columns == ["key", "task", "m0", "task_"] and rows(got) == rows(want)


def test_empty(spark):
    none = spark.createDataFrame([], "k string, v bigint")
    assert skew.keyed_totals(none, "k", {"s": "v"}).count() == 0
    assert skew.lookup(none, none, "k").count() == 0


def test_links_count_each_delivery_once(spark):
    links = spark.createDataFrame([("a", "b", 3, 1, 1), ("a", "b", 3, 1, 1), ("a", "c", None, 1, 2), (None, "a", 2, 1, 3)], "ctg_i string, ctg_j string, links bigint, run_id int, count_id bigint")
    types = spark.createDataFrame([("a", 1.0, " HAPLOTIG"), ("a", 1.0, "haplotig"), ("b", None, None)], "contig_id string, average_depth double, contig_type string")
    got = {r.contig_id: tuple(r)[1:] for r in skew.contig_totals(links, types).collect()}
    assert got == {"a": (4, 3, 5, "haplotig"), "b": (2, 1, 3, None), "c": (1, 1, None, None)}
    assert rows(skew.hot_keys(links, types, 0.5, 0.6)) == [("contig_id", "a"), ("contig_id", "b"), ("contig_type", "haplotig")]
    assert rows(skew.type_totals(links, types)) == [("haplotig", 2, 1, 5)]
