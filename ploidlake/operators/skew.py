"""Per-key work when a few keys hold most rows: fragment-replicate by estimated load.

1. The load of every key is estimated through hash buckets, a fixed number for each task (one small pass with map-side
   sums), and keys inside overfull buckets are counted, so every key above one shard's share is known with its exact load.
   There are fewer such keys than shards, whatever the data.
2. Light buckets and the proportionate shards of heavy keys are packed into tasks, largest first into the least loaded.
3. Rows know their task and shard before they move. Where only sums are wanted, rows of one (task, shard, key) are added up
   where they are read, and the sums travel; a join sends the rows themselves. Either goes to its task directly
   (``repartitionById``); rows of the matching side go once to the task of their bucket, or to each shard of their heavy
   key and nowhere else.
4. The last step adds a handful of rows per heavy key.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ploidlake.runtime import Stages, fresh, shuffle_width

#: Hash buckets for the load estimate: so many for each task, and this many at least. The plan on the driver has a row
#: for each and one per shard: it grows with the tasks, not with the data.
BUCKETS_PER_TASK = 16
LEAST_BUCKETS = 1024
#: Shards a task's fair share is cut into; a key above one shard's load is split.
SHARDS_PER_TASK = 4
#: Most rows of a table of contigs that every task holds instead of being sent its part.
MOST_TOLD = 200_000


@dataclass(frozen=True)
class LoadPlan:
    """Bucket i goes to task ``bucket_task[i]``; shard j of heavy key k to task ``heavy[k][j]``."""

    tasks: int
    total: int
    bucket_task: list[int]
    heavy: dict[object, list[int]]
    task_load: list[int] = field(default_factory=list)


def pack(sizes: list[int], tasks: int) -> tuple[list[int], list[int]]:
    """Task of each item, largest item first into the least loaded task; and the loads."""
    heap, where = [(0, t) for t in range(tasks)], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, t = heapq.heappop(heap)
        where[i] = t
        heapq.heappush(heap, (load + sizes[i], t))
    loads = [0] * tasks
    for size, t in zip(sizes, where, strict=True):
        loads[t] += size
    return where, loads


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def plan_loads(facts: DataFrame, key: str, tasks: int | None = None) -> LoadPlan:
    """Estimate loads of ``facts`` by ``key`` and pack them. Null keys have no load."""
    tasks = tasks or shuffle_width(facts.sparkSession)
    buckets = max(LEAST_BUCKETS, BUCKETS_PER_TASK * tasks)
    keyed = facts.select(F.col(key)).filter(F.col(key).isNotNull())
    loads = [0] * buckets
    for r in keyed.groupBy(_bucket(key, buckets).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect():  # <= buckets rows
        loads[r.b] = r.n
    total = sum(loads)
    share = max(1, -(-total // (tasks * SHARDS_PER_TASK)))
    full = [(b,) for b, n in enumerate(loads) if n > share]  # fewer than tasks * SHARDS_PER_TASK
    heavy: list[tuple[object, int]] = []
    spark = facts.sparkSession
    if full:
        inside = keyed.withColumn("__b", _bucket(key, buckets)).join(F.broadcast(spark.createDataFrame(full, "__b int")), "__b", "left_semi")
        counted = inside.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > share)
        heavy = sorted(((r[0], r[1]) for r in counted.collect()), key=lambda x: (-x[1], str(x[0])))  # < tasks * SHARDS_PER_TASK rows
    items, shards = [], []
    if heavy:
        kind = T.StructType([T.StructField("k", facts.schema[key].dataType)])
        homes = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k, _ in heavy], kind).select("k", _bucket("k", buckets)).collect()}
        for k, n in heavy:
            loads[homes[k]] -= n
            pieces = -(-n // share)
            shards.append((k, len(items), pieces))
            items += [-(-n // pieces)] * pieces
    where, task_load = pack(loads + items, tasks)
    return LoadPlan(tasks, total, where[:buckets], {k: where[buckets + i : buckets + i + p] for k, i, p in shards}, task_load)


def _tables(df: DataFrame, plan: LoadPlan) -> tuple[DataFrame, DataFrame]:
    """The plan as two small tables: a row per bucket, and fewer rows than shards."""
    spark = df.sparkSession
    buckets = spark.createDataFrame(list(enumerate(plan.bucket_task)), "b int, t int")
    kind = T.StructType([T.StructField("hk", df.schema["key"].dataType), T.StructField("ts", T.ArrayType(T.IntegerType()))])
    return buckets, spark.createDataFrame([(k, ts) for k, ts in plan.heavy.items()], kind)


def _dealt(df: DataFrame, plan: LoadPlan, replicate: bool) -> DataFrame:
    """``df`` (with ``key``) and ``task``, ``shard``; nothing moves yet.

    With ``replicate``, rows of a heavy key once for each of its shards; else each row in the shard its ``salt`` says.
    """
    buckets, heavy = _tables(df, plan)
    marked = df.withColumn("b", _bucket("key", len(plan.bucket_task))).join(F.broadcast(buckets), "b").drop("b")
    marked = marked.join(F.broadcast(heavy), F.col("key") == F.col("hk"), "left").drop("hk")
    if replicate:
        marked = marked.select("*", F.posexplode(F.coalesce("ts", F.array("t"))).alias("shard", "task"))
    else:
        marked = marked.withColumn("shard", F.when(F.col("ts").isNull(), 0).otherwise(F.pmod("salt", F.size("ts"))).cast("int")).drop("salt")
        marked = marked.withColumn("task", F.when(F.col("ts").isNull(), F.col("t")).otherwise(F.get("ts", F.col("shard"))))
    return marked.drop("t", "ts")


def _placed(df: DataFrame, plan: LoadPlan, replicate: bool) -> DataFrame:
    """The rows of ``_dealt`` at their tasks."""
    return _dealt(df, plan, replicate).repartitionById(plan.tasks, F.col("task"))


def _salt(df: DataFrame) -> Column:
    """A number of the row and its partition: repeated rows spread too, and a task that runs again deals alike."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind], F.spark_partition_id())


def _numbered(df: DataFrame, key: str, letter: str) -> tuple[DataFrame, dict[str, str]]:
    """Rows with a key, columns under names of our own, so that none can clash; and the columns' names."""
    names = {c: f"{letter}{i}" for i, c in enumerate(df.columns) if c != key}
    return df.filter(F.col(f"`{key}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), *[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def keyed_totals(facts: DataFrame, key: str, sums: dict[str, Column | str], match: DataFrame | None = None, plan: LoadPlan | None = None) -> DataFrame:
    """Row count ``n_rows`` and sums per key, and the columns of ``match`` (one row per key), without a long task.

    ``sums`` maps result columns to summed columns (nulls count for nothing; a sum of nulls only is null). Keys that
    ``match`` lacks get nulls there; rows without key give no result. Repeated rows of ``facts`` count each time; of
    several ``match`` rows of one key, the smallest value of each column is taken. Empty ``facts`` give no rows. Other
    columns of ``facts`` only help to deal its rows; columns of ``match`` named like the key or a result get underscores.
    """
    slim = facts.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), _salt(facts).alias("salt"), *[(F.col(c) if isinstance(c, str) else c).alias(f"s{i}") for i, c in enumerate(sums.values())])
    plan = plan or plan_loads(slim, "key")
    parts = [F.sum(f"s{i}").alias(f"s{i}") for i in range(len(sums))]
    unit = ["task", "shard", "key"]
    local = _dealt(slim, plan, replicate=False).groupBy(*unit).agg(F.count(F.lit(1)).alias("n"), *parts).repartitionById(plan.tasks, F.col("task"))
    extra: dict[str, str] = {}
    if match is not None:
        one, extra = _numbered(match, key, "m")
        one = one.groupBy("key").agg(*[F.min(c).alias(c) for c in extra.values()])
        local = local.join(_placed(one, plan, replicate=True), unit, "left")
    whole = local.groupBy("key").agg(F.sum("n").alias("n"), *parts, *[F.min(c).alias(c) for c in extra.values()])
    taken = [key, "n_rows", *sums]
    out = [F.col("key").alias(key), F.col("n").alias("n_rows"), *[F.col(f"s{i}").alias(c) for i, c in enumerate(sums)]]
    for c, n in extra.items():
        taken.append(fresh(taken, c))
        out.append(F.col(n).alias(taken[-1]))
    return whole.select(*out)


def lookup(facts: DataFrame, match: DataFrame, key: str, plan: LoadPlan | None = None, how: str = "inner") -> DataFrame:
    """``facts`` joined with ``match`` on ``key``, hot keys in shards: the row-level form of the operator.

    Rows without key match nothing and are left out; ``match`` may have several rows per key; its columns get underscores
    where ``facts`` has their names. Empty sides give what the join (``inner`` or ``left``) gives.
    """
    a, own = _numbered(facts, key, "f")
    b, theirs = _numbered(match, key, "m")
    plan = plan or plan_loads(a, "key")
    joined = _placed(a.withColumn("salt", _salt(a)), plan, replicate=False).join(_placed(b, plan, replicate=True), ["task", "shard", "key"], how)
    return _renamed(joined, facts, key, own, theirs)


def _renamed(joined: DataFrame, facts: DataFrame, key: str, own: dict[str, str], theirs: dict[str, str]) -> DataFrame:
    out = [F.col("key").alias(key) if c == key else F.col(own[c]).alias(c) for c in facts.columns]
    taken = list(facts.columns)
    for c, n in theirs.items():
        taken.append(fresh(taken, c))
        out.append(F.col(n).alias(taken[-1]))
    return joined.select(*out)


def attach(facts: DataFrame, match: DataFrame, key: str, how: str = "inner", most: int = MOST_TOLD) -> DataFrame:
    """What ``lookup`` gives, but a ``match`` of at most ``most`` rows goes to every task, and ``facts`` stay where they are."""
    stages = Stages(facts.sparkSession, "attach")
    match = stages.write(match)
    if match.count() > most:
        return lookup(stages.write(facts), match, key, how=how)
    a, own = _numbered(facts, key, "f")
    b, theirs = _numbered(match, key, "m")
    return _renamed(a.join(F.broadcast(b), "key", how), facts, key, own, theirs)


# -- links per contig and per contig type ---------------------------------------------------------------------------


def link_facts(links: DataFrame) -> DataFrame:
    """``(contig_id, count_id, links, copies)``: a row for each contig of each count, once for each ``count_id``.

    ``copies`` says how many stored rows it stands for. A contig linked with itself counts once; null ids are left out.
    """
    once = links.groupBy("count_id", "ctg_i", "ctg_j").agg(F.max("links").alias("links"), F.count(F.lit(1)).alias("copies"))
    return once.select(F.explode(F.array_distinct(F.array("ctg_i", "ctg_j"))).alias("contig_id"), "count_id", "links", "copies").filter(F.col("contig_id").isNotNull())


def contig_totals(links: DataFrame, types: DataFrame) -> DataFrame:
    """``(contig_id, stored_rows, n_counts, links_total, contig_type)`` for each contig that has links."""
    from ploidlake.functions.ids import clean_label

    named = types.select("contig_id", clean_label("contig_type").alias("contig_type"))
    facts = Stages(links.sparkSession, "links").write(link_facts(links))  # the load estimate reads its keys again
    got = keyed_totals(facts, "contig_id", {"stored_rows": "copies", "links_total": "links"}, match=named)
    return got.select("contig_id", "stored_rows", F.col("n_rows").alias("n_counts"), "links_total", "contig_type")


def type_totals(links: DataFrame, types: DataFrame) -> DataFrame:
    """``(contig_type, stored_rows, contigs, links_total)``: rows and contigs of contig_types, and links of their contigs."""
    from ploidlake.functions.ids import clean_label

    rows = types.select("contig_id", clean_label("contig_type").alias("contig_type")).filter(F.col("contig_type").isNotNull())
    stored = keyed_totals(rows, "contig_type", {})
    stages = Stages(links.sparkSession, "links")
    per_contig = stages.write(keyed_totals(stages.write(link_facts(links)), "contig_id", {"links_total": "links"}, match=rows))
    linked = keyed_totals(per_contig.filter(F.col("contig_type").isNotNull()), "contig_type", {"links_total": "links_total"})
    once = keyed_totals(rows.groupBy("contig_id").agg(F.min("contig_type").alias("contig_type")), "contig_type", {})
    return (
        stored.withColumnRenamed("n_rows", "stored_rows")
        .join(once.withColumnRenamed("n_rows", "contigs"), "contig_type", "left")
        .join(linked.select("contig_type", "links_total"), "contig_type", "left")
        .select("contig_type", "stored_rows", F.coalesce("contigs", F.lit(0).cast("bigint")).alias("contigs"), "links_total")
    )


def hot_keys(links: DataFrame, types: DataFrame, contig_share: float = 0.04, type_share: float = 0.10) -> DataFrame:
    """``(key_name, key_value)``: contigs and types on at least the given share of the stored rows."""
    from ploidlake.functions.ids import clean_label

    n_links, n_types = links.count(), types.count()
    named = types.select("contig_id", clean_label("contig_type").alias("contig_type"))
    ends = links.select(F.explode(F.array_distinct(F.array("ctg_i", "ctg_j"))).alias("contig_id"))
    contigs = keyed_totals(ends, "contig_id", {}, match=named).filter(F.col("n_rows") >= contig_share * n_links - 1e-9)
    kinds = keyed_totals(named.select("contig_type"), "contig_type", {}).filter(F.col("n_rows") >= type_share * n_types - 1e-9)
    return contigs.select(F.lit("contig_id").alias("key_name"), F.col("contig_id").alias("key_value")).unionByName(
        kinds.select(F.lit("contig_type").alias("key_name"), F.col("contig_type").alias("key_value"))
    )
