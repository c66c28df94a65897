"""Column functions of the alignment, sequence and link operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ploidlake.params import LINK_WEIGHT, MULTIPLICITY

#: SAM flag bits: any of them drops a record.
NOT_PRIMARY = 256 + 512 + 1024 + 2048
NOT_PAIRED_PRIMARY = 4 + 8 + 256 + 1024 + 2048


def is_primary(tp: Column) -> Column:
    """Not a secondary alignment: the tag's last letter is not S (a missing tag counts as primary)."""
    return F.coalesce(F.substring(tp, -1, 1) != "S", F.lit(True))


def cigar_matches(cigar: Column) -> Column:
    """Sum of the lengths before ``M``; null for null."""
    return F.aggregate(F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+)M"), F.lit(1)), lambda x: x.cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: a + b)


def site_count(seq: Column, motif: str) -> Column:
    """Non-overlapping occurrences of a motif, plus one."""
    return (F.floor((F.length(seq) - F.length(F.replace(seq, F.lit(motif), F.lit("")))) / F.lit(len(motif))) + 1).cast("bigint")


def flank_sequence(seq: Column, flank: int | None) -> Column:
    """First and last ``flank`` characters joined, at most half the sequence each; the whole one without flank or halves."""
    if not flank:
        return seq
    half = F.least(F.lit(flank), F.floor(F.length(seq) / 2)).cast("int")
    return F.when(half == 0, seq).otherwise(F.concat(F.substring(seq, F.lit(1), half), F.right(seq, half)))


def in_flank(coord: Column, length: Column, flank: int | None) -> Column:
    """Whether a 1-based coordinate lies in the first or last ``flank`` positions; all do without flank."""
    return F.lit(True) if not flank else (coord <= flank) | (coord > length - flank)


def half_of(coord: Column, length: Column) -> Column:
    """``T`` beyond the middle of the contig, else ``H``."""
    return F.when(2 * coord > length, "T").otherwise("H")


def orientation_distances(a: Column, len_a: Column, b: Column, len_b: Column) -> Column:
    """Distances of two 0-based places for the orientations ++, +-, -+, --."""
    return F.array(len_a - a + b, len_a - a + len_b - b, a + b, a + len_b - b)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def dosage_class(depth: Column, limits: list[tuple[float, str]]) -> Column:
    """The first class whose lower limit the depth (rounded to 2 decimals) reaches; ``other`` below all, null for null."""
    d = F.round(depth, 2)
    out = F.when(d.isNull(), F.lit(None).cast("string"))
    for limit, name in limits:
        out = out.when(d >= limit, name)
    return out.otherwise("other")


def _by_type(kind: Column, values: dict, default) -> Column:
    out = F.lit(default)
    for name, v in values.items():
        out = F.when(kind == name, F.lit(v)).otherwise(out)
    return out


def multiplicity(kind: Column) -> Column:
    return _by_type(kind, MULTIPLICITY, 1)


def link_weight(kind: Column) -> Column:
    return _by_type(kind, LINK_WEIGHT, 1.0)


def flags_clear(flag: Column, mask: int) -> Column:
    return flag.bitwiseAND(F.lit(mask)) == 0


def r_squared(x: Column, y: Column) -> Column:
    """Squared correlation of a group: 0 where x or y is constant, null for fewer than two points."""
    return F.when(F.count(F.when(x.isNotNull() & y.isNotNull(), 1)) < 2, F.lit(None).cast("double")).when((F.min(x) == F.max(x)) | (F.min(y) == F.max(y)), 0.0).otherwise(F.regr_r2(y.cast("double"), x.cast("double")))
