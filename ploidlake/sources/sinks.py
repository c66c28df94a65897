"""Writers of the formats that downstream tools read. Parquet is the format between steps; these are for export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fasta(sequences: DataFrame, path: str, longer_than: int = 0, by: str | None = None, prefix: str = "") -> None:
    """Sequences longer than ``longer_than``; with ``by`` a folder for each value of that column."""
    rows = sequences.filter(F.length("seq") > longer_than)
    text = F.concat(F.lit(">" + prefix), "contig_id", F.lit("\n"), "seq").alias("value")
    (rows.select(by, text).write.partitionBy(by) if by else rows.select(text).write).text(path)


def without_sequence(wanted: DataFrame, sequences: DataFrame) -> DataFrame:
    """``(contig_id)``: ids that are to be written but have no sequence."""
    return wanted.select("contig_id").distinct().join(sequences.select("contig_id"), "contig_id", "left_anti")


def _ids(df: DataFrame, keys: list[str], ids: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(ids)).alias("ids"))


def allelic_rows(table: DataFrame, path: str, size: int) -> None:
    """Lines ``chrom, start, end, unitigs...``; a bin has as many unitigs as copies at most, so its line is short."""
    rows = _ids(table, ["chrom", "bin_start"], "unitig")
    rows.select(F.concat_ws("\t", "chrom", F.col("bin_start").cast("string"), (F.col("bin_start") + size).cast("string"), F.array_join("ids", "\t")).alias("value")).write.text(path)


def clusters(membership: DataFrame, path: str, with_count: bool = True) -> None:
    """Lines ``group, count, ids`` with ids sorted. A line lists its whole group, as the format asks."""
    rows = _ids(membership.select("group_name", "contig_id").distinct(), ["group_name"], "contig_id")
    count = [F.size("ids").cast("string")] if with_count else []
    rows.select(F.concat_ws("\t", "group_name", *count, F.array_join("ids", " ")).alias("value")).write.text(path)


def group_members(membership: DataFrame, contigs: DataFrame, path: str) -> None:
    """A folder per group with lines ``contig, sites, length``."""
    rows = membership.join(contigs, "contig_id").select("group_name", F.concat_ws("\t", "contig_id", F.col("re_sites").cast("string"), F.col("length").cast("string")).alias("value"))
    rows.write.partitionBy("group_name").text(path)


def clm(orientations: DataFrame, path: str, by: str | None = None) -> None:
    text = F.concat_ws("\t", F.concat_ws(" ", "name_i", "name_j"), F.col("n").cast("string"), "distances").alias("value")
    (orientations.select(by, text).write.partitionBy(by) if by else orientations.select(text).write).text(path)


def links(counts: DataFrame, path: str) -> None:
    counts.select("ctg_i", "ctg_j", "links").write.csv(path, sep="\t")


def read_names(group_reads: DataFrame, path: str) -> None:
    """A folder per group with one read name a line."""
    group_reads.select("group_name", F.col("read").alias("value")).write.partitionBy("group_name").text(path)


def side_by_side(groups: DataFrame, path: str, n: int) -> None:
    """Lines with the k-th member of each of ``n`` groups, blank where a group has ended."""
    wide = groups.groupBy("chrom", "pos").pivot("group_no", list(range(1, n + 1))).agg(F.first("contig_id"))
    wide.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), *[F.coalesce(F.col(str(k)), F.lit("")) for k in range(1, n + 1)]).alias("value")).write.text(path)


def table(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.csv(path, sep="\t", header=header)
