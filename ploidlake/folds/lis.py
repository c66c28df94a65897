"""Longest increasing or decreasing runs of one contig pair's alignments, and how the two sequences join."""

from __future__ import annotations

from bisect import bisect_left


def longest_run(points: list[tuple[int, int]], falling: bool = False) -> list[int]:
    """Places in ``points`` of a longest run that rises in both coordinates (or falls in y), strictly in y."""
    sign = -1 if falling else 1
    order = sorted(range(len(points)), key=lambda i: (points[i][0], sign * points[i][1], i))
    tops: list[int] = []
    ends: list[int] = []
    before: dict[int, int | None] = {}
    for i in order:
        y = sign * points[i][1]
        k = bisect_left(tops, y)
        before[i] = ends[k - 1] if k else None
        tops[k : k + 1], ends[k : k + 1] = [y], [i]
    run, i = [], ends[-1] if ends else None
    while i is not None:
        run.append(i)
        i = before[i]
    return run[::-1]


def r_squared(points: list[tuple[int, int]]) -> float:
    """Squared correlation; 0 for fewer than two points or a constant coordinate."""
    n = len(points)
    if n < 2:
        return 0.0
    mx, my = sum(x for x, _ in points) / n, sum(y for _, y in points) / n
    xx, yy = sum((x - mx) ** 2 for x, _ in points), sum((y - my) ** 2 for _, y in points)
    return sum((x - mx) * (y - my) for x, y in points) ** 2 / (xx * yy) if xx and yy else 0.0


def join_plan(rows: list[tuple[int, int, int, int]], short_len: int, long_len: int, min_r2: float, min_coverage: float) -> dict | None:
    """How a pair joins, from rows ``(short_start, short_end, long_start, long_end)``; None if they aren't collinear enough.

    ``falling`` says that the long sequence is to be reverse-complemented first. ``short_first``: short[:cut_short] +
    long[cut_long:], else long[:cut_long] + short[cut_short:].
    """
    points = [(r[0], r[2]) for r in rows]
    rise, fall = longest_run(points), longest_run(points, falling=True)
    falling = len(fall) > len(rise)
    run = fall if falling else rise
    coverage, r2 = (len(run) / len(rows) if rows else 0.0), r_squared([points[i] for i in run])
    if coverage < min_coverage or r2 < min_r2:
        return None
    ss, se, ls, le = (list(c) for c in zip(*[rows[i] for i in run], strict=True))
    if falling:  # starts turn over; ends are taken from the new starts, which gives the old ends back
        ls = [long_len - e for e in le]
        le = [long_len - s for s in ls]
    short_head = 2 * sum(ss) < short_len * len(ss)
    long_head = 2 * sum(ls) < long_len * len(ls)
    short_first = long_head
    return {
        "falling": falling, "run": len(run), "coverage": coverage, "r2": r2, "short_first": short_first,
        "cut_short": max(se) if short_first else min(ss), "cut_long": max(le) if short_first else min(ls),
        "short_end": "head" if short_head else "tail", "long_end": "head" if long_head else "tail",
    }
