"""Sources mixed to target shares of tokens, by pivotal dependent rounding.

Each document of a source is wanted c times, c = share * total / tokens of the source, at most as often as it may be
repeated. The whole part of c is fixed; the fraction is a probability per document. Two documents of similar size play: one
gives mass to the other at random until one of them is 0 or 1, so every document keeps its expected copies and the sum never
changes. Blocks of documents play on their own and leave one open document per source at most; what is left open plays on in
a reduction tree of blocks, and one last document per source is drawn. Random numbers are hashes of document and round, and
equal rows are told apart by their number among themselves: a task that runs again, or rows in other partitions, give the
same answer.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ploidlake.functions.ids import clean_label
from ploidlake.runtime import Stages

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokenizer cuts a text into pieces before merging (fixed value of the vocabulary).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Characters encoded at once; longer texts are cut where a piece begins in any case.
STRETCH = 1 << 16
#: Documents that play as one block, and blocks that meet at a time.
BLOCK = 10_000
FAN_IN = 64
#: Rows that a task gathers before it plays, and equal rows numbered together.
BUFFER = 100_000
#: Most rows of the table of targets, which is planned on the driver.
MAX_SOURCES = 100_000
_ROUNDED = "id bigint, source string, tokens bigint, tie bigint, block bigint, p double"


def token_counts(spark: SparkSession, path: str = TOKENIZER, pattern: str = PATTERN):
    """An Arrow function from texts to their token counts; null for null. The vocabulary goes to every executor as a file."""
    spark.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[-1]

    def count(texts):
        import base64
        import re

        import pyarrow as pa
        import tiktoken
        from pyspark import SparkFiles

        kept = count.__dict__
        if "encoding" not in kept:
            with open(SparkFiles.get(name), "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
            kept["encoding"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encode = kept["encoding"].encode_ordinary
        cut = re.compile(r"(?<=[^\W\d_])(?= [^\W\d_])")

        def size(t):
            if len(t) <= STRETCH:
                return len(encode(t))
            total, start = 0, 0
            while start < len(t):
                m = cut.search(t, start + STRETCH) if start + STRETCH < len(t) else None
                end = m.start() if m else len(t)
                total += len(encode(t[start:end]))
                start = end
            return total

        return pa.array([None if t is None else size(t) for t in texts.to_pylist()], pa.int64())

    return F.arrow_udf(count, "bigint")


def sized(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``(doc_id, source, tokens)`` of rows with a source (lower case, no outer blanks); a null text has 0 tokens."""
    named = documents.select("doc_id", clean_label("source").alias("source"), "text").filter("source is not null")
    return named.select("doc_id", "source", F.coalesce(token_counts(documents.sparkSession, path)("text"), F.lit(0)).alias("tokens"))


def plan(sizes: DataFrame, targets: DataFrame, exact_shares: bool = False) -> list[dict]:
    """One entry per row of ``targets``: source as spelled there, its tokens, tokens wanted, copies per document.

    The total is that of the listed sources' tokens; sources short of it give all they may. With ``exact_shares`` it
    shrinks until no source that has tokens and may give any is short, which leaves out more of the others. Null shares
    and repeats count as 0; sources without documents have 0 tokens; of several rows for a source the first by spelling
    counts.
    """
    rows = targets.select("source", clean_label("source").alias("key"), "target_share", "max_repeats").filter("key is not null").orderBy("source").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = list({r.key: r for r in reversed(rows)}.values())[::-1]
    have = {r.source: r for r in sizes.join(targets.select(clean_label("source").alias("source")).distinct(), "source", "left_semi").groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).collect()}  # <= rows of targets
    total = sum(r.tokens for r in have.values())
    if exact_shares:
        total = min([total, *(r.max_repeats * have[r.key].tokens / r.target_share for r in rows if r.key in have and have[r.key].tokens and r.target_share and r.max_repeats)])
    out = []
    for r in rows:
        tokens, share, most = (have[r.key].tokens if r.key in have else 0), r.target_share or 0.0, r.max_repeats or 0
        wanted = share * total
        out.append({"source": r.source, "key": r.key, "target_share": share, "max_repeats": most, "docs": have[r.key].docs if r.key in have else 0, "tokens": tokens, "wanted": wanted, "short": tokens * most < wanted, "copies": min(wanted / tokens, float(most)) if tokens else 0.0})
    return out


def _play(seed: int, last: bool):
    """mapInArrow over rows sorted by ``block, source, tokens, id, tie``: plays inside each block and source.

    Rows whose ``p`` became 0 or 1 are settled; at most one per block and source is not. With ``last`` it is drawn.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        u = np.uint64

        def uniform(h, salt):
            with np.errstate(over="ignore"):
                x = h.astype(u) + u((salt * 0x9E3779B97F4A7C15 + seed) % (1 << 64))
                x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
                x ^= x >> u(31)
            return (x >> u(11)).astype(float) / float(1 << 53)

        def settle(p, h):
            open_ = np.flatnonzero((p > 0) & (p < 1))
            step = 0
            while len(open_) > 1:
                step += 1
                pairs = len(open_) // 2
                a, b = open_[: 2 * pairs : 2], open_[1 : 2 * pairs : 2]
                pa_, pb = p[a], p[b]
                s, r = pa_ + pb, uniform(h[a], step)
                low = s < 1
                a_wins = np.where(low, r * s < pa_, r * (2 - s) < 1 - pb)
                more = np.where(low, s, 1.0)
                less = np.where(low, 0.0, s - 1)
                na, nb = np.where(a_wins, more, less), np.where(a_wins, less, more)
                for x in (na, nb):
                    x[x < 1e-9] = 0
                    x[x > 1 - 1e-9] = 1
                p[a], p[b] = na, nb
                rest = open_[2 * pairs :]
                both = np.sort(np.concatenate([a, b]))
                open_ = np.concatenate([both[(p[both] > 0) & (p[both] < 1)], rest])
            if last and len(open_):
                p[open_] = (uniform(h[open_], 0) < p[open_]).astype(float)

        def done(t):
            t = t.combine_chunks()
            p = t["p"].to_numpy().copy()
            block, tie = t["block"].to_numpy(), t["tie"].to_numpy().view(np.uint64)
            source = np.asarray(t["source"].combine_chunks().dictionary_encode().indices)
            begin = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (source[1:] != source[:-1])))
            for i, j in zip(begin, np.append(begin[1:], len(p)), strict=True):
                part = p[i:j]
                settle(part, tie[i:j])
            return t.set_column(t.column_names.index("p"), "p", pa.array(p)).to_batches()

        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= BUFFER:
                t = pa.Table.from_batches(held)
                same = np.flatnonzero((t["block"].to_numpy() != t["block"][-1].as_py()) | pc.not_equal(t["source"], t["source"][-1]).to_numpy())
                cut = int(same[-1]) + 1 if len(same) else 0
                if cut:
                    yield from done(t.slice(0, cut))
                held, size = t.slice(cut).to_batches(), t.num_rows - cut
        if size:
            yield from done(pa.Table.from_batches(held))

    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows ``doc_id, source, tokens, ...`` with ``nth``, the number among equal rows; very many equal ones in portions."""
    once = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    few = once.filter(F.col("n") <= BUFFER).withColumn("from", F.lit(0).cast("bigint"))
    many = once.filter(F.col("n") > BUFFER).withColumn("from", F.explode(F.expr(f"sequence(0L, n - 1, {BUFFER}L)"))).repartition("doc_id", "from")
    return few.unionByName(many).withColumn("nth", F.explode(F.expr(f"sequence(`from`, least(n, `from` + {BUFFER}) - 1)"))).drop("n", "from")


def mix(sizes: DataFrame, planned: list[dict], seed: int = 17, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """``(doc_id, source, tokens, copies)``: rows of the listed sources, and how often each is taken.

    ``copies`` is the whole part or one more of what the plan has; their sum over a source is within one of its plan. It
    depends on the rows and ``seed`` alone. Repeated rows are rows of their own. Without documents or targets there are no
    rows.
    """
    spark = sizes.sparkSession
    stages = Stages(spark, "mix")
    rates = [(x["key"], x["source"], int(x["copies"]), float(x["copies"] - int(x["copies"]))) for x in planned]
    rate = F.broadcast(spark.createDataFrame(rates, "source string, spelled string, base int, p double"))  # <= MAX_SOURCES rows
    rows = sizes.join(rate, "source")
    blocks = max(1, -(-sum(x["docs"] for x in planned) // block))
    # The hash that deals blocks is another one than the tie, which the random numbers come from.
    told = _numbered(rows.select("doc_id", "source", "tokens", "p"))
    tie = F.xxhash64("doc_id", "tokens", "source", "nth")
    play = told.select(F.col("doc_id").alias("id"), "source", "tokens", tie.alias("tie"), F.pmod(F.xxhash64(F.lit("block"), "doc_id", "tokens", "source", "nth"), F.lit(blocks)).alias("block"), "p")
    order = ["block", "source", "tokens", "id", "tie"]
    fair = spark.conf.get("spark.sql.shuffle.partitions")
    played = stages.write(play.repartition(min(blocks, max(1, int(fair))) if blocks < int(fair) else int(fair), "block").sortWithinPartitions(*order).mapInArrow(_play(seed, blocks == 1), _ROUNDED))
    settled = [played.filter("p = 0 or p = 1")]
    left = played.filter("p > 0 and p < 1")
    while blocks > 1:
        blocks = -(-blocks // fan_in)
        seed += 1
        up = left.withColumn("block", F.floor(F.col("block") / fan_in).cast("bigint"))
        played = stages.write(up.repartition("block").sortWithinPartitions(*order).mapInArrow(_play(seed, blocks == 1), _ROUNDED))
        settled.append(played.filter("p = 0 or p = 1"))
        left = played.filter("p > 0 and p < 1")
    every = settled[0]
    for s in settled[1:]:
        every = every.unionByName(s)
    return every.join(rate.drop("p"), "source").select(F.col("id").alias("doc_id"), F.col("spelled").alias("source"), "tokens", (F.col("base") + F.col("p").cast("int")).alias("copies"))


def _ready(documents: DataFrame, path: str) -> DataFrame:
    return Stages(documents.sparkSession, "sizes").write(sized(documents, path))


def mixture(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, exact_shares: bool = False) -> DataFrame:
    """``(doc_id, source, tokens, copies)`` of the mixture: as large as the listed sources, or as ``exact_shares`` allow."""
    sizes = _ready(documents, path)
    return mix(sizes, plan(sizes, targets, exact_shares))


def shares(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, exact_shares: bool = False) -> DataFrame:
    """A row per row of targets: what the source has and gives, and the share it reaches.

    ``(source, target_share, max_repeats, source_tokens, wanted_tokens, mixed_tokens, left_out_tokens, reached_share,
    max_copies)``. ``left_out_tokens``: those of documents not taken once. Where sources fall short, the mixture is smaller
    than wanted and the others' shares are larger; with ``exact_shares`` it shrinks instead.
    """
    spark = documents.sparkSession
    sizes = _ready(documents, path)
    planned = plan(sizes, targets, exact_shares)
    unused = F.sum(F.when(F.col("copies") == 0, F.col("tokens")).otherwise(0))
    got = mix(sizes, planned).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), unused.alias("left_out_tokens"), F.max("copies").alias("max_copies"))
    got = Stages(spark, "shares").write(got)
    rows = [(x["source"], float(x["target_share"]), int(x["max_repeats"]), int(x["tokens"]), float(x["wanted"])) for x in planned]
    table = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, source_tokens bigint, wanted_tokens double")
    total = got.agg(F.sum("mixed_tokens")).first()[0] or 0
    none = {c: F.coalesce(c, F.lit(0)) for c in ("mixed_tokens", "left_out_tokens", "max_copies")}
    joined = table.join(got, "source", "left").withColumns(none).withColumn("reached_share", F.expr(f"mixed_tokens / nullif({total}D, 0D)"))
    return joined.select("source", "target_share", "max_repeats", "source_tokens", "wanted_tokens", "mixed_tokens", "left_out_tokens", "reached_share", "max_copies")


def short_sources(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """``(source)``: sources whose tokens, repeated as often as they may be, are less than their share of all tokens.

    Read off the mixture that takes the corpus total: the sources whose every document is taken as often as it may be and
    that yet stay below what is wanted.
    """
    spark = documents.sparkSession
    sizes = _ready(documents, path)
    planned = plan(sizes, targets)
    got = mix(sizes, planned).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed"), F.min(F.when(F.col("tokens") > 0, F.col("copies"))).alias("fewest"))
    wanted = spark.createDataFrame([(x["source"], float(x["wanted"]), int(x["max_repeats"])) for x in planned], "source string, wanted double, most int")
    joined = wanted.join(got, "source", "left")
    return joined.filter((F.coalesce("mixed", F.lit(0)) < F.col("wanted")) & (F.coalesce("fewest", F.col("most")) >= F.col("most"))).select("source")
