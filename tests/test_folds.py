import itertools
import random

from ploidlake.folds.genotype import Dealer
from ploidlake.folds.lis import join_plan, longest_run, r_squared


def thin_rows(rows: list[list[str]], copies: dict[str, int], length: dict[str, int], ploidy: int, exempt: set[int]) -> list[list[str] | None]:
    """Rows that hold more copies than ``ploidy`` are dropped (None) or lose unitigs.

    A row (outside ``exempt``) goes if whatever it has beyond the row before also stands in the row after. Otherwise unitigs
    kept by an earlier row leave, shortest first, until the copies fit or none is left. Neighbours are the rows as given.
    """
    kept: set[str] = set()
    out: list[list[str] | None] = []
    for k, row in enumerate(rows):
        total = sum(copies[u] for u in row)
        if total > ploidy and k not in exempt:
            before = rows[k - 1] if k else []
            after = rows[k + 1] if k + 1 < len(rows) else []
            if set(row) - set(before) <= set(after):
                out.append(None)
                continue
        leave: set[str] = set()
        for u in sorted((u for u in row if u in kept), key=lambda u: (length[u], u)):
            if total <= ploidy:
                break
            leave.add(u)
            total -= copies[u]
        rest = sorted(set(row) - leave)
        kept.update(rest)
        out.append(rest)
    return out


def thin(rows, copies=None, length=None, exempt=()):
    ids = {u for r in rows for u in r}
    return thin_rows(rows, {u: (copies or {}).get(u, 1) for u in ids}, {u: (length or {}).get(u, 10) for u in ids}, 4, set(exempt))


def test_row_at_the_limit_stays():
    assert thin([["a"], ["a", "b", "c", "d"], ["d"]]) == [["a"], ["a", "b", "c", "d"], ["d"]]


def test_overfull_row_without_new_ids_is_dropped_unless_exempt():
    rows = [["a", "b"], ["a", "b"], ["b"]]
    assert thin(rows, {"a": 3, "b": 2}, exempt={0, 2})[1] is None
    assert thin(rows, {"a": 3, "b": 2}, {"a": 5, "b": 9}, exempt={0, 1, 2})[1] == ["b"]  # shortest seen id leaves


def test_row_whose_new_ids_all_come_again_is_dropped_and_not_seen():
    rows = [["a"], ["a", "b", "c", "d", "e"], ["b", "c", "d", "e", "f"], ["g"]]
    got = thin(rows, exempt={0, 3})
    assert got[1] is None and got[2] == ["b", "c", "d", "e", "f"]


def dealer(copies=None, links=None, sites=None, ratio=0.0, compat=True, signal=100):
    links = {k: v for (a, b), n in (links or {}).items() for k, v in (((a, b), n), ((b, a), n))}

    class Copies(dict):
        def __missing__(self, key):
            return 1

    linked = {a for a, _ in links}
    return Dealer(4, Copies(copies or {}), sites or {}, links, lambda a, b: ratio, linked, signal, 0.2, compat)


KINDS = {"d": "diplotig", "t": "triplotig", "q": "tetraplotig"}
COPIES = {"d": 2, "t": 3, "q": 4}


def first(row):
    d = dealer(COPIES)
    d.first_row(row, {u: KINDS.get(u, "haplotig") for u in row})
    return d.groups


def test_first_row_cases():
    assert first(["a", "d", "b"]) == [["d"], ["d"], ["a"], ["b"]]
    assert first(["a", "t"]) == [["t"], ["t"], ["t"], ["a"]]
    assert first(["q"]) == [["q"]] * 4
    assert first(["a", "b", "c", "d"]) == [["a"], ["b"], ["c"], ["d"]]
    assert first(["a", "b"]) == [["a"], ["b"], [], []]
    assert first(["a", "d"]) == [[], [], [], []]


def test_known_unitig_goes_on_in_its_group():
    d = dealer()
    d.groups = [["a"], ["b"], ["c"], ["e"]]
    d.next_row(["a"])
    assert d.groups == [["a", "a"], ["b"], ["c"], ["e"]]


def test_new_unitig_goes_to_the_densest_free_group():
    d = dealer(links={("b", "x"): 30, ("c", "x"): 20}, sites={"b": 10, "b2": 10, "c": 2, "c2": 2})
    d.groups = [["a", "a2"], ["b", "b2"], ["c", "c2"], ["e", "e2"]]
    d.next_row(["x"])
    assert d.groups[2] == ["c", "c2", "x"]


def test_seed_without_links_is_replaced():
    d = dealer()
    d.groups = [["a", "a"], ["b", "z"], ["c", "y"], ["e", "w"]]
    d.next_row(["x"])
    assert d.groups[0] == ["x", "x"]


def test_equal_groups_are_one_with_compat_and_two_without():
    for compat, want in ((True, [["q", "q"], ["q"], ["q"], ["q"]]), (False, [["q", "q"]] * 4)):
        d = dealer(COPIES, compat=compat)
        d.groups = [["q"] for _ in range(4)]
        d.next_row(["q"])
        got = d.groups
        assert (got == want) or (compat and len(got[0]) >= 2)


def test_partner_with_a_stronger_link_is_followed():
    links = {("x", "p"): 300, ("x", "a"): 200}
    for compat, group in ((False, 1), (True, 1)):
        d = dealer(links=links, compat=compat)
        d.groups = [["a", "a1"], ["p", "p1"], ["c", "c1"], ["e", "e1"]]
        d.next_row(["p", "x"])  # the partner stands before the id: both ways agree
        assert d.groups[group][-1] == "x"
    for compat, want in ((False, True), (True, False)):
        d = dealer(links={("x", "p"): 300, ("x", "a"): 200}, compat=compat)
        d.groups = [["a", "a1"], ["p", "p1"], ["c", "c1"], ["e", "e1"]]
        d.next_row(["x", "p"])  # after the id, compat looks one place too early
        assert ("x" in d.groups[1]) is want


def test_no_free_group_drops_or_fills_an_empty_one():
    d = dealer()
    d.groups = [["a"], ["b"], ["c"], ["e"]]
    d.next_row(["a", "b", "c", "e", "x"])
    assert not any("x" in g for g in d.groups)


def brute_run(points, falling):
    best = 0
    for n in range(len(points), 0, -1):
        for c in itertools.combinations(sorted(points, key=lambda p: (p[0], -p[1] if falling else p[1])), n):
            ys = [-p[1] if falling else p[1] for p in c]
            if all(a < b for a, b in zip(ys, ys[1:], strict=False)):
                return n
    return best


def test_longest_run_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(60):
        pts = [(rnd.randrange(8), rnd.randrange(8)) for _ in range(rnd.randrange(1, 8))]
        for falling in (False, True):
            run = longest_run(pts, falling)
            assert len(run) == brute_run(pts, falling)
            ys = [pts[i][1] for i in run]
            assert all((a > b) if falling else (a < b) for a, b in zip(ys, ys[1:], strict=False))


def test_r_squared():
    assert r_squared([(1, 1)]) == 0 and r_squared([(1, 1), (1, 5)]) == 0 and r_squared([(1, 2), (5, 2)]) == 0
    assert abs(r_squared([(1, 3), (2, 5), (3, 7)]) - 1) < 1e-12


def test_four_ways_to_join():
    def plan(ss, ls, falling=False):
        rows = [(ss + 10 * i, ss + 10 * i + 5, (ls - 10 * i if falling else ls + 10 * i), (ls - 10 * i if falling else ls + 10 * i) + 5) for i in range(5)]
        return join_plan(rows, 1000, 2000, 0.2, 0.2)

    a = plan(0, 1900)  # short head on long tail: long[:cut] + short[cut:]
    assert (a["short_end"], a["long_end"], a["short_first"], a["cut_long"], a["cut_short"]) == ("head", "tail", False, 1900, 0)
    b = plan(900, 0)
    assert (b["short_end"], b["long_end"], b["short_first"], b["cut_short"], b["cut_long"]) == ("tail", "head", True, 945, 45)
    assert plan(0, 0)["short_first"] and not plan(900, 1900)["short_first"]
    f = plan(0, 1900, falling=True)  # turned over, the long one's tail is its head
    assert f["falling"] and f["long_end"] == "head" and f["cut_long"] == 1905
    assert join_plan([(0, 5, 0, 5)], 100, 200, 0.2, 0.2) is None
