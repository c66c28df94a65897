"""Read depth: mean per contig, dosage classes, histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ploidlake.functions.scalar import dosage_class
from ploidlake.params import SCHEMES


def valid_windows(depth_win: DataFrame) -> DataFrame:
    """``(contig_id, win_start, depth)``: each window once; null, negative, NaN and infinite depths are void."""
    d = F.col("depth")
    good = depth_win.filter(F.col("contig_id").isNotNull() & d.isNotNull() & ~F.isnan(d) & (d >= 0) & (d < float("inf")))
    return good.groupBy("contig_id", "win_start").agg(F.max("depth").alias("depth"))


def mean_depth(windows: DataFrame) -> DataFrame:
    """``(contig_id, average_depth)``; sums are exact decimals, so the order of rows is no matter."""
    total = F.sum(F.round("depth", 6).cast("decimal(24,6)")).cast("double")
    return windows.groupBy("contig_id").agg((total / F.count("depth")).alias("average_depth"))


def classify(means: DataFrame, scheme: str = "base28") -> DataFrame:
    return means.withColumn("contig_type", dosage_class(F.col("average_depth"), SCHEMES[scheme]))


def histogram(windows: DataFrame) -> DataFrame:
    """``(depth, windows)`` with depths rounded half to even."""
    return windows.groupBy(F.rint("depth").cast("bigint").alias("depth")).agg(F.count(F.lit(1)).alias("windows"))
