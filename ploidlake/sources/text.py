"""Readers of the text formats that aligners, assemblers and scaffolders write.

Each is a lazy scan: records are split by Spark's text reader and parsed by expressions, so files split across tasks and
unused columns are never parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ploidlake import schemas
from ploidlake.functions.scalar import site_count


def fasta(spark: SparkSession, path: str, upper: bool = True, min_length: int = 0) -> DataFrame:
    """``(contig_id, seq, length)``; the id is the header's first word. Of an id's repeats the last in the file counts."""
    records = spark.read.text(path, lineSep="\n>").filter(F.length(F.btrim("value", F.lit(" \n\r\t"))) > 0)
    lines = F.split(F.regexp_replace("value", "^>", ""), "\r?\n")
    seq = F.regexp_replace(F.array_join(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), ""), r"\s", "")
    rows = records.select(F.regexp_extract(F.get(lines, F.lit(0)), r"^\s*(\S+)", 1).alias("contig_id"), (F.upper(seq) if upper else seq).alias("seq"), F.monotonically_increasing_id().alias("at"))
    rows = rows.filter("contig_id <> ''").groupBy("contig_id").agg(F.max_by("seq", "at").alias("seq"))
    return rows.withColumn("length", F.length("seq").cast("bigint")).filter(F.col("length") >= min_length)


def contig_table(sequences: DataFrame, motif: str = "GATC") -> DataFrame:
    """``(contig_id, length, re_sites)`` without the sequences."""
    return sequences.select("contig_id", "length", site_count(F.col("seq"), motif).alias("re_sites"))


def _columns(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(F.length(F.btrim("value", F.lit(" \t\r"))) > 0).select(F.split(F.regexp_replace("value", r"[\r\n]+$", ""), "\t").alias("c"), F.col("value"), F.monotonically_increasing_id().alias("line_no"))


def _num(i: int, kind: str = "bigint") -> Column:
    return F.get("c", F.lit(i)).try_cast(kind)


def paf(spark: SparkSession, path: str) -> DataFrame:
    """Alignments; ``tp`` and ``cg`` tags are found by name. ``line_no`` rises with the place in each file."""
    rows = _columns(spark, path)
    text = {0: "query_id", 4: "strand", 5: "target_id"}
    nums = {1: "query_len", 2: "query_start", 3: "query_end", 6: "target_len", 7: "target_start", 8: "target_end", 9: "match_len", 10: "block_len"}
    cols = [F.get("c", F.lit(i)).alias(text[i]) if i in text else _num(i).alias(nums[i]) for i in range(11)]

    def tag(name: str) -> Column:
        return F.get(F.filter("c", lambda x: x.startswith(name)), F.lit(0))

    return rows.select(*cols, _num(11, "int").alias("mapq"), tag("tp:A:").alias("tp"), tag("cg:Z:").alias("cigar"), "line_no")


def delta(spark: SparkSession, path: str, keep_self: bool = False) -> DataFrame:
    """Alignments of a delta file; ``*_start`` and ``*_end`` are half-open, a reverse query has strand ``-``.

    A record is all a contig pair has, so files split between pairs and no header is carried along. Hits of a contig on
    itself are left out unless ``keep_self``; lists of indels are skipped; ``match_len`` is the block less its errors.
    """
    records = spark.read.text(path, lineSep=">")
    lines = F.transform(F.split("value", "\n"), lambda x: F.split(F.btrim(x, F.lit(" \r\t")), r"\s+"))
    parsed = records.select(lines.alias("l"), F.get(lines, F.lit(0)).alias("h")).filter(F.size("h") == 4)
    rows = parsed.select("h", F.explode(F.filter("l", lambda x: F.size(x) == 7)).alias("c"))
    names = rows.select(F.get("h", F.lit(1)).alias("query_id"), F.get("h", F.lit(3)).try_cast("bigint").alias("query_len"), F.get("h", F.lit(0)).alias("target_id"), F.get("h", F.lit(2)).try_cast("bigint").alias("target_len"), "c")
    a, b, q, r, errors = (_num(i) for i in range(5))
    length = F.greatest(a, b) - F.least(a, b) + 1
    found = names.select(
        "query_id", "query_len", (F.least(q, r) - 1).alias("query_start"), F.greatest(q, r).alias("query_end"), F.when((a <= b) == (q <= r), "+").otherwise("-").alias("strand"),
        "target_id", "target_len", (F.least(a, b) - 1).alias("target_start"), F.greatest(a, b).alias("target_end"), (length - errors).alias("match_len"), length.alias("block_len"),
    )
    return found if keep_self else found.filter("query_id <> target_id")


def gfa(spark: SparkSession, path: str) -> DataFrame:
    """Sequences of the segment lines."""
    return _columns(spark, path).filter(F.get("c", F.lit(0)) == "S").select(F.get("c", F.lit(1)).alias("contig_id"), F.get("c", F.lit(2)).alias("seq"))


def sam_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Read pairs from SAM text, places 0-based; ``=`` stands for the record's own contig, ``*`` for none."""
    rows = _columns(spark, path).filter(~F.col("value").startswith("@"))
    ref, mref = F.nullif(F.get("c", F.lit(2)), F.lit("*")), F.get("c", F.lit(6))
    return rows.select(
        F.get("c", F.lit(0)).alias("read_name"), _num(1, "int").alias("flag"), ref.alias("ref"), (_num(3) - 1).alias("pos"), F.when(mref == "=", ref).when(mref != "*", mref).alias("mref"), (_num(7) - 1).alias("mpos")
    )


def depth_windows(spark: SparkSession, path: str) -> DataFrame:
    """Depth windows, with or without a ``#`` header, plain or gzipped."""
    return spark.read.csv(path, sep="\t", schema=schemas.DEPTH, comment="#")


def contig_types(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.CONTIG_TYPES, header=True)


def distances(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.DISTANCES)


def links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.LINKS)


def allelic_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(chrom, bin_start, bin_end, unitig)`` of a ragged table of bins."""
    return _columns(spark, path).select(F.get("c", F.lit(0)).alias("chrom"), _num(1).alias("bin_start"), _num(2).alias("bin_end"), F.explode(F.slice("c", F.lit(4), F.size("c"))).alias("unitig")).filter("unitig <> ''")


def clusters(spark: SparkSession, path: str, with_count: bool = True) -> DataFrame:
    """``(group_name, pos, contig_id)`` of lines ``group [count] ids...``; ids are parted by blanks or tabs."""
    words = F.split(F.btrim("value"), r"\s+")
    rows = spark.read.text(path).filter(F.length(F.btrim("value")) > 0).select(F.get(words, F.lit(0)).alias("group_name"), words.alias("w")).filter(~F.col("group_name").startswith("#"))
    first = 3 if with_count else 2
    return rows.select("group_name", F.posexplode(F.slice("w", F.lit(first), F.size("w"))).alias("pos", "contig_id"))


def clm(spark: SparkSession, path: str) -> DataFrame:
    """``(ctg_i, dir_i, ctg_j, dir_j, n, distances)`` of orientation lines."""
    c = _columns(spark, path)
    names = F.split(F.get("c", F.lit(0)), r"\s+")
    a, b = F.get(names, F.lit(0)), F.get(names, F.lit(1))

    def cut(x: Column) -> tuple[Column, Column]:
        return F.substring(x, F.lit(1), F.length(x) - 1), F.right(x, F.lit(1))

    return c.select(cut(a)[0].alias("ctg_i"), cut(a)[1].alias("dir_i"), cut(b)[0].alias("ctg_j"), cut(b)[1].alias("dir_j"), _num(1).alias("n"), F.transform(F.split(F.get("c", F.lit(2)), r"\s+"), lambda x: x.cast("bigint")).alias("distances"))
