"""Tunables of the reference operators, with the defaults they run with."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Redundancy:
    """Contig against contig: when the shorter contig of a pair is redundant."""

    min_match: int = 200
    min_query: int = 100_000
    ratio_long: float = 0.05
    ratio_short: float = 0.1
    either_ratio: float = 0.1  # of either side, where lengths are taken as query and target
    min_r2: float = 0.2
    point_match: int = 5000  # alignments with more matches make points
    margin: float = 0.05
    inside: float = 0.75
    max_distance: float = 0.15
    lis_coverage: float = 0.2


@dataclass(frozen=True)
class Segments:
    """Unitig against reference: runs of neighbouring alignments."""

    min_match: int = 200
    min_query: int = 1000
    gap: int = 500_000
    min_ratio: float = 0.05
    min_rows: int = 5
    max_distance: int = 3_000_000
    min_length: int = 1_000_000


@dataclass(frozen=True)
class Bins:
    """Reference bins and the unitigs kept in each."""

    size: int = 100_000
    chromosomes: int = 12
    min_match: int = 1000
    min_query: int = 100_000
    top_n: int = 4
    search_range: int = 20
    ploidy: int = 4


@dataclass(frozen=True)
class Links:
    flank: int | None = 500_000
    clm_min: int = 2
    min_single: int = 5
    allelic_signal: int = 100
    max_overlap: float = 0.2


@dataclass(frozen=True)
class Reads:
    seed: int = 100
    fractions: dict[str, float] = field(default_factory=lambda: {"haplotig": 1.0, "diplotig": 1 / 2, "triplotig": 1 / 3, "tetraplotig": 1 / 4})


#: Copies of a contig by dosage type; all other types count as one.
MULTIPLICITY = {"haplotig": 1, "diplotig": 2, "triplotig": 3, "tetraplotig": 4}
#: Weights of the optional link adjustment by type.
LINK_WEIGHT = {"haplotig": 1.0, "diplotig": 0.5, "triplotig": 0.333, "tetraplotig": 0.25}
#: Lower limits of the dosage classes by scheme: (limit, class), the first class that the depth reaches from the top.
SCHEMES = {
    "base28": [(126.0, "replotig"), (98.0, "tetraplotig"), (70.0, "triplotig"), (42.0, "diplotig"), (14.0, "haplotig")],
    "documented": [(132.0, "replotig"), (103.0, "tetraplotig"), (74.0, "triplotig"), (45.0, "diplotig"), (15.0, "haplotig")],
    "hexaploid": [(209.0, "replotig"), (177.0, "hexaplotig"), (145.0, "pentaplotig"), (113.0, "tetraplotig"), (81.0, "triplotig"), (49.0, "diplotig"), (17.0, "haplotig")],
    "hexaploid21": [(137.0, "replotig"), (116.0, "hexaplotig"), (95.0, "pentaplotig"), (74.0, "tetraplotig"), (53.0, "triplotig"), (32.0, "diplotig"), (11.0, "haplotig")],
}


def scheme_from_base(base: float, classes: tuple[str, ...] = ("haplotig", "diplotig", "triplotig", "tetraplotig", "replotig")) -> list[tuple[float, str]]:
    """Limits half a base below each multiple of the one-copy depth."""
    return [((k + 0.5) * base, c) for k, c in reversed(list(enumerate(classes)))]
