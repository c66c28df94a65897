import datetime as dt
import decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ploidlake.operators import intervals
from ploidlake.operators.intervals import alignment_periods, periods_and_gaps


def brute(items):
    out = []
    for key in {k for k, s, e in items if k is not None and s is not None and e is not None and e > s}:
        spans = sorted((s, e) for k, s, e in items if k == key and s is not None and e is not None and e > s)
        periods = [list(spans[0])]
        for s, e in spans[1:]:
            if s <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], e)
            else:
                periods.append([s, e])
        out += [(key, "period", s, e) for s, e in periods]
        out += [(key, "gap", a[1], b[0]) for a, b in zip(periods, periods[1:], strict=False)]
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(-60, 60)), st.one_of(st.none(), st.integers(-60, 90))), max_size=40), st.sampled_from([4, 16, 1000]))
def test_equals_brute_force_with_any_tile(spark, items, tile):
    df = spark.createDataFrame(items, "k string, s bigint, e bigint").repartition(5)
    assert rows(periods_and_gaps(df, ["k"], "s", "e", tile=tile, fan_in=2)) == brute(items)


def test_touching_nested_disjoint_and_long_over_many_tiles(spark):
    items = [("a", 0, 10), ("a", 10, 20), ("a", 12, 15), ("a", 30, 900), ("a", 40, 50), ("a", 905, 906), ("a", 30, 900), ("b", -9_000_000_000_000, 9_000_000_000_000), ("b", 5, 6)]
    df = spark.createDataFrame([(*x, 1, "x") for x in items], "k string, s bigint, e bigint, tile int, span_kind string")
    assert rows(periods_and_gaps(df, ["k"], "s", "e", tile=8, fan_in=2)) == brute(items)


def test_many_partial_lists_merge_in_a_tree(spark):
    items = [("hot", i * 3, i * 3 + 2 + i % 2) for i in range(2000)]
    df = spark.createDataFrame(items, "k string, s bigint, e bigint").repartition(40)
    assert rows(periods_and_gaps(df, ["k"], "s", "e", tile=1000, fan_in=3)) == brute(items)


def test_empty_and_ids_that_are_none(spark):
    schema = "query_id string, target_id string, target_start bigint, target_end bigint, extra string"
    assert alignment_periods(spark.createDataFrame([], schema)).count() == 0
    got = alignment_periods(spark.createDataFrame([(" q\t", "t", 0, 5, None), ("q", "t ", 7, 9, None), ("q", "*", 1, 2, None), (None, "t", 1, 2, None), ("q", "t", 9, 9, None), ("q", "t", 20, 10, None)], schema))
    assert rows(got) == [("q", "t", "gap", 5, 7), ("q", "t", "period", 0, 5), ("q", "t", "period", 7, 9)]


def test_sixty_four_partitions_enter_the_tree(spark, monkeypatch):
    levels = []
    made = intervals._merger
    monkeypatch.setattr(intervals, "_merger", lambda keys, lists, hold_last: levels.append((lists, hold_last)) or made(keys, lists, hold_last))
    items = [("hot", i * 3, i * 3 + 2 + i % 2) for i in range(3000)] + [(f"k{i % 50}", i, i + 5) for i in range(500)]
    df = spark.createDataFrame(items, "k string, s bigint, e bigint").repartition(64)
    assert rows(periods_and_gaps(df, ["k"], "s", "e")) == brute(items)
    assert levels.count((True, False)) >= 1


def test_lists_merge_without_a_sort():
    import numpy as np

    class NoSort:
        def __getattr__(self, name):
            assert "sort" not in name or name == "searchsorted"
            return getattr(np, name)

    lists = [[(0, 2), (5, 9)], [(2, 3), (20, 30)], [(8, 21)], [], [(1, 2)], [(40, 41), (50, 60)]]
    group = np.array([1, 1, 1, 2, 2, 3])
    flat = [x for held in lists for x in held]
    offsets = np.append(0, np.cumsum([len(held) for held in lists]))
    for kind in (np.int64, np.float64):
        off, s, e = intervals._interleave(NoSort(), group, offsets, np.array([a for a, _ in flat], kind), np.array([b for _, b in flat], kind))
        assert list(off) == [0, 2, 3, 5] and list(zip(s, e, strict=True)) == [(0, 3), (5, 30), (1, 2), (40, 41), (50, 60)]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def moment(n):  # over the hour that Berlin skips in spring
    return dt.datetime(2024, 3, 31, 1, 0, 0, 7) + dt.timedelta(minutes=20 * n)


@pytest.mark.parametrize(
    ("kind", "value"),
    [("double", lambda n: n / 7), ("float", lambda n: n / 4), ("int", int), ("decimal(9,3)", lambda n: decimal.Decimal(n) / 8), ("date", day), ("timestamp_ntz", moment), ("timestamp", lambda n: moment(n).replace(tzinfo=dt.UTC))],
)
def test_coordinates_keep_their_type(spark, kind, value):
    spans = [("a", 2, 7), ("a", 9, 15), ("a", 15, 16), ("a", 20, 35), ("a", 22, 23), ("a", 5, 5), ("b", -40, 400), ("b", 3, 4), ("a", -9, -8)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.createDataFrame([(k, value(s), value(e)) for k, s, e in spans] + [("c", None, value(1)), ("c", value(1), None)], f"k string, s {kind}, e {kind}")
        for tile in (None, 3, 4_000_000_000):
            got = periods_and_gaps(df, ["k"], "s", "e", tile=tile)
            assert got.schema["span_start"].dataType.simpleString() == kind
            strip = lambda t: t.astimezone(dt.UTC) if kind == "timestamp" else t
            assert sorted((k, x, strip(s), strip(e)) for k, x, s, e in got.collect()) == sorted((k, x, value(s), value(e)) for k, x, s, e in brute(spans))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_fractions_nan_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("a", 0.2, 0.7), ("a", 0.9, 1.5), ("a", 2.0, 3.5), ("a", nan, 9.0), ("a", 1.0, nan), ("b", -inf, 0.5), ("b", 0.25, inf)], "k string, s double, e double")
    assert rows(periods_and_gaps(df, ["k"], "s", "e")) == sorted([("a", "period", 0.2, 0.7), ("a", "gap", 0.7, 0.9), ("a", "period", 0.9, 1.5), ("a", "gap", 1.5, 2.0), ("a", "period", 2.0, 3.5), ("b", "period", -inf, inf)], key=repr)
    with pytest.raises(TypeError):
        periods_and_gaps(spark.createDataFrame([], "k string, s string, e string"), ["k"], "s", "e")
