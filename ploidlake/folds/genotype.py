"""Dealing the unitigs of one chromosome's bins to haplotype groups, bin by bin."""

from __future__ import annotations

from collections.abc import Callable, Mapping


class Dealer:
    """The groups and what is known about unitigs. ``compat``: two equal groups are taken for the first of them, and the
    strongest partner is read from the row that still has the unitig itself, as existing results assume."""

    def __init__(self, ploidy: int, copies: Mapping[str, int], sites: Mapping[str, int], links: Mapping[tuple[str, str], int], ratio: Callable[[str, str], float], linked: set[str], signal: int, overlap: float, compat: bool):
        self.groups: list[list[str]] = [[] for _ in range(ploidy)]
        self.copies, self.sites, self.links, self.ratio, self.linked = copies, sites, links, ratio, linked
        self.signal, self.overlap, self.compat = signal, overlap, compat

    def place(self, g: int) -> int:
        """Number of a group: with ``compat`` that of the first group with equal content."""
        return self.groups.index(self.groups[g]) if self.compat else g

    def link(self, a: str, b: str) -> int:
        return self.links.get((a, b), 0)

    def first_row(self, row: list[str], kinds: Mapping[str, str]) -> None:
        many = [u for u in row if self.copies[u] > 1]
        n = len(self.groups)
        if len(many) == 1 and sum(self.copies[u] for u in row) == n and len(row) == n + 1 - self.copies[many[0]] and all(kinds[u] == "haplotig" for u in row if u not in many):
            order = many * self.copies[many[0]] + [u for u in row if u not in many]
        elif len(row) == n:
            order = row
        elif not many:
            for i, u in enumerate(row):
                self.groups[i % n].append(u)
            return
        else:
            return
        for g, u in zip(self.groups, order, strict=True):
            g.append(u)

    def next_row(self, row: list[str]) -> None:
        settled: set[str] = set()
        busy: set[int] = set()
        for again in (False, True):  # known unitigs go on in their groups; a second time for those whose groups were busy
            for u in row:
                if again and u in settled:
                    continue
                for g in range(len(self.groups)):
                    if u in self.groups[g] and (again or self.place(g) not in busy):
                        self.groups[g].append(u)
                        settled.add(u)
                        busy.add(self.place(g))
        for u in row:
            if u not in settled and not self.beside_partner(u, row, settled):
                self.by_density(u, busy)

    def beside_partner(self, u: str, row: list[str], settled: set[str]) -> bool:
        """Follow a partner of the row whose link is stronger than any to the groups, if the two hardly overlap."""
        others = [x for x in row if x != u]
        to_row = [self.link(u, x) for x in others]
        strongest = max(to_row, default=0)
        to_groups = max((self.link(x, u) for g in self.groups for x in g), default=0)
        if not strongest >= to_groups > self.signal:
            return False
        k = to_row.index(strongest)
        if self.ratio(u, others[k]) >= self.overlap or self.ratio(others[k], u) >= self.overlap:
            return False
        partner = row[k] if self.compat else others[k]
        for g in self.groups:
            if partner in g:
                g.append(u)
                settled.add(u)
        return True

    def by_density(self, u: str, busy: set[int]) -> None:
        free = [g for g in range(len(self.groups)) if g not in busy]
        if not free:
            empty = next((g for g in self.groups if not g), None)
            if empty is not None:
                empty.append(u)
            return
        # Where each free group's additions go: with compat to the first unused group of equal content.
        goes, used = {}, set()
        for g in free:
            goes[g] = next(k for k in range(len(self.groups)) if k not in used and (self.groups[k] == self.groups[g] if self.compat else k == g))
            used.add(goes[g])

        def density(g: int) -> float:
            links = sum(self.link(x, u) for x in self.groups[g])
            return links / sum(self.sites.get(x, 1) for x in self.groups[g]) if links else 0.0

        chosen = sorted(free, key=density, reverse=True)[: self.copies[u]]
        for g in chosen:
            group = self.groups[g]
            if len(set(group)) == 1:
                seed = group[-1]
                if not self.link(seed, u) and seed not in self.linked:
                    group[:] = [u] * len(group)
                else:
                    group.append(u)
            else:
                self.groups[goes[g]].append(u)
            busy.add(goes[g])


def deal_chromosome(left, right, ploidy: int, signal: int, overlap: float, compat: bool):
    import pandas as pd

    cols = ["chrom", "group_no", "pos", "contig_id"]
    if not len(left):
        return pd.DataFrame(columns=cols)
    left = left.sort_values(["row_no", "unitig"])
    chrom = left["chrom"].iloc[0]
    links = {(a, b): int(n) for a, b, n in zip(right["contig_id"], right["other"], right["links"], strict=True) if n == n and n is not None}
    ratios = {(a, b): r for a, b, r in zip(right["contig_id"], right["other"], right["ratio"], strict=True) if r == r and r is not None}
    copies, kinds = dict(zip(left["unitig"], left["copies"], strict=True)), dict(zip(left["unitig"], left["contig_type"], strict=True))
    sites = dict(zip(left["unitig"], left["re_sites"], strict=True))
    dealer = Dealer(ploidy, copies, sites, links, lambda a, b: ratios.get((a, b), 0.0), set(left.loc[left["has_links"], "unitig"]), signal, overlap, compat)
    for k, row in enumerate(left.groupby("row_no", sort=True)["unitig"].agg(list)):
        dealer.next_row(row) if k else dealer.first_row(row, kinds)
    flat = [(chrom, n + 1, i, u) for n, g in enumerate(dealer.groups) for i, u in enumerate(g)]
    return pd.DataFrame(flat, columns=cols)
