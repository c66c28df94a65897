"""Operators of the training-data problems against brute force, with the cases each docstring states."""

import math
import random
import re
import unicodedata

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from oracle import check
from pyspark.sql import functions as F

from ploidlake.llm import components, cooccur, digests, leakage, mixing, queries, readability, topn

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, data, name):
    check(spark, data, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql_runs(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0


# -- 2 ---------------------------------------------------------------------------------------------------------------


def union_find(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return sorted((x, root(x)) for x in up)


@FEW
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 25)), st.integers(0, 25)), max_size=25))
def test_groups_equal_union_find(spark, pairs):
    df = spark.createDataFrame([(a, b, 0, "x") for a, b in pairs], "a bigint, b bigint, v int, u string")
    assert rows(components.hash_to_min(df, "a", "b")) == sorted(union_find(pairs), key=repr)


def test_long_chain_star_and_repeats(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 2400)] + [(5, 4)] * 3 + [(7777, 7777)]
    random.Random(0).shuffle(pairs)
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert rows(components.hash_to_min(df, "a", "b")) == sorted(union_find(pairs), key=repr)


def test_very_large_sets_are_not_one_task(spark, monkeypatch):
    monkeypatch.setattr(components, "BIG_SETS", 10**9)  # limit falls to its floor of 1000 rows
    pairs = [(0, i) for i in range(1, 3000)]
    assert components.hash_to_min(spark.createDataFrame(pairs, "a bigint, b bigint"), "a", "b").filter("group = 0").count() == 3000


@settings(FEW, max_examples=3)
@given(st.lists(st.tuples(st.one_of(st.none(), st.text("aBé𝄞 ", max_size=2)), st.text("aBé𝄞 ", max_size=2)), max_size=20))
def test_groups_of_texts_equal_union_find(spark, pairs):
    df = spark.createDataFrame([(a, b, 1) for a, b in pairs], "v string, code string, name int")
    got = [tuple(r) for r in components.hash_to_min(df, "v", "code").collect()]
    assert sorted(got) == sorted(union_find(pairs))


def test_components_of_any_size_settle(spark, monkeypatch):
    """One that fills most rows, finished early and late, beside chains that are finished at other times."""
    monkeypatch.setattr(components, "BIG_SETS", 10**9)  # all with more than 1000 rows are looked up by broadcast
    star = [(0, i) for i in range(1, 1500)]
    late = star + [(1499 + i, 1500 + i) for i in range(40)]
    chains = [(10_000 * k + i, 10_000 * k + i + 1) for k in range(1, 6) for i in range(k * k)]
    for pairs in (star + chains, late + chains):
        assert rows(components.hash_to_min(spark.createDataFrame(pairs, "a bigint, b bigint"), "a", "b")) == sorted(union_find(pairs), key=repr)


def test_no_pairs_no_groups(spark):
    assert components.hash_to_min(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


# -- 4 ---------------------------------------------------------------------------------------------------------------


def best(items, n):
    once = {}
    for g, i, s, t in items:
        if g is not None and i is not None and s is not None:
            place = (-(-math.inf if s != s else s), t is None, t or 0)
            once[(g, i)] = min(once.get((g, i), place), place)
    out = []
    for g in {g for g, _ in once}:
        mine = sorted((*place, i) for (q, i), place in once.items() if q == g)
        out += [(g, i, k + 1) for k, (*_, i) in enumerate(mine[:n])]
    return sorted(out, key=repr)


def test_an_item_counts_by_one_of_its_rows(spark):
    df = spark.createDataFrame([("a", 1, 9, 50), ("a", 1, 3, 0), ("a", 2, 9, 10)], "g string, i bigint, s bigint, t bigint")
    assert rows(topn.top_n(df, "g", "s", [("t", True)], "i", 1)) == [("a", 2, 1)]


def test_filled_groups_leave_before_ranking_and_nothing_whole_is_written(spark, monkeypatch):
    written = []
    write = topn.Stages.write

    def counted(self, df):
        back = write(self, df)
        written.append((df, back.count()))
        return back

    monkeypatch.setattr(topn.Stages, "write", counted)
    df = spark.range(4000).selectExpr("id % 100 as g", "id as i", "(id * 7919) % 1000 as s")
    got = topn.top_n(df, "g", "s", [], "i", 2)
    assert got.count() == 200 and all(n <= 200 for _, n in written)
    plan = written[-1][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.index("row_number") < plan.index("LeftAnti")  # plans print from the last step down


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 30)), st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 3))), max_size=60), st.integers(1, 4))
def test_top_n_equals_brute_force(spark, items, n):
    df = spark.createDataFrame([(*x, 1, 2) for x in items], "rank string, i bigint, s bigint, t bigint, taken int, band int")
    assert rows(topn.top_n(df, "rank", "s", [("t", True)], "i", n)) == best(items, n)


def test_top_n_with_a_hot_group_and_all_scores_equal(spark):
    rnd = random.Random(4)
    items = [("hot", i, 5, rnd.randrange(50)) for i in range(900)] + [(f"g{i % 40}", i, i % 7, None) for i in range(900, 1500)]
    df = spark.createDataFrame(items * 2, "g string, i bigint, s bigint, t bigint")
    assert rows(topn.top_n(df, "g", "s", [("t", True)], "i", 3)) == best(items, 3)


def test_top_n_of_nothing_and_nan(spark):
    assert topn.top_n(spark.createDataFrame([], "g string, i bigint, s double"), "g", "s", [], "i", 3).count() == 0
    df = spark.createDataFrame([("a", 1, math.nan), ("a", 2, -1.0), ("a", 3, 4.0)], "g string, i bigint, s double")
    assert rows(topn.top_n(df, "g", "s", [], "i", 2)) == [("a", 2, 2), ("a", 3, 1)]


# -- 5 ---------------------------------------------------------------------------------------------------------------


def rank_error(values, p, x):
    goal = p * len(values) / 100
    return max(0, sum(v < x for v in values) - goal, goal - sum(v <= x for v in values)) / len(values)


def test_percentiles_stay_within_the_bound(spark):
    rnd = random.Random(9)
    sets = {"hot": [rnd.lognormvariate(0, 2) for _ in range(20_000)], "ties": [1.0] * 300 + [2.0] * 20, "one": [4.0], "two": [1.0, 9.0], "wild": [(-1) ** i * 10.0 ** (i % 30) for i in range(700)]}
    items = [(k, v, "x") for k, vs in sets.items() for v in vs] + [("hot", None, "x"), ("hot", math.nan, "x"), ("none", None, "x"), (None, 1.0, "x"), ("one", math.inf, "x")]
    df = spark.createDataFrame(items, "k string, v double, x string").repartition(7)
    got = digests.percentiles(df, "k", "v", [1, 50, 90, 99]).collect()
    assert len(got) == 4 * len(sets)
    for r in got:
        vs = sets[r.k]
        assert r.n == len(vs)
        assert abs(rank_error(vs, r.percent, r.estimate) - r.rank_error) < 1e-9
        assert r.rank_error <= digests.MAX_ERROR + 0.5 / r.n + 1e-9
    assert {r.estimate for r in got if r.k == "one"} == {4.0}


def test_a_tight_bound_makes_digests_finer(spark):
    rnd = random.Random(1)
    vs = [rnd.random() ** 8 for _ in range(5000)]
    df = spark.createDataFrame([("a", v) for v in vs], "k string, v double")
    got = digests.percentiles(df, "k", "v", [50, 90], max_error=0.0005, delta=6).collect()
    assert len(got) == 2 and all(rank_error(vs, r.percent, r.estimate) <= 0.0005 + 0.5 / 5000 + 1e-9 for r in got)


def test_digests_of_days_combine(spark):
    rnd = random.Random(2)
    items = [("a", d, rnd.gauss(d, 1)) for d in range(5) for _ in range(800)]
    df = spark.createDataFrame(items, "k string, day int, v double")
    days = digests.digests(df, ["k", "day"], "v")
    assert days.count() == 5
    one = digests.merge(days.drop("day"), ["k"])
    r = one.first()
    assert one.count() == 1 and abs(sum(r.weights) - 4000) < 1e-6 and len(r.means) <= digests.DELTA
    est = {r.percent: r.estimate for r in digests.estimates(one, ["k"], [10, 50, 90]).collect()}
    assert all(rank_error([v for *_, v in items], p, x) < 0.01 for p, x in est.items())
    assert rows(digests.percentiles(spark.createDataFrame([], "k string, v double"), "k", "v", [50])) == []


# -- 6 ---------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("heavy", "chunk"), [(256, 64), (4, 3), (1, 2), (10_000, 64)])
def test_pairs_equal_brute_force(spark, heavy, chunk):
    rnd = random.Random(7)
    baskets = {f"b{i}": {f"i{int(rnd.paretovariate(0.7)) % 40:02d}" for _ in range(rnd.randrange(1, 6))} for i in range(150)}
    baskets["big"] = {f"i{k:02d}" for k in range(30)}
    items = [(b, i, 1) for b, s in baskets.items() for i in s]
    df = spark.createDataFrame(items + items[:40] + [(None, "i01", 1), ("b1", None, 1)], "name string, item string, h int").repartition(5)
    got = {(r.item_i, r.item_j): (r.shared, r.n_i, r.n_j, r.baskets) for r in cooccur.pair_counts(df, "name", "item", heavy=heavy, chunk=chunk).collect()}
    names = sorted({i for s in baskets.values() for i in s})
    n = {i: sum(i in s for s in baskets.values()) for i in names}
    want = {(a, b): (k, n[a], n[b], len(baskets)) for a in names for b in names if a < b and (k := sum(a in s and b in s for s in baskets.values()))}
    assert got == want
    some = cooccur.pair_counts(df, "name", "item", min_shared=5, heavy=heavy, chunk=chunk)
    assert {(r.item_i, r.item_j): r.shared for r in some.collect()} == {k: v[0] for k, v in want.items() if v[0] >= 5}

@pytest.mark.parametrize(("share", "per"), [(1, 2), (1000, 2), (3, 5)])
def test_pairs_of_a_basket_with_a_third_of_all_rows(spark, monkeypatch, share, per):
    """Its chunks meet in the cells of a grid, with its size broadcast (1000) or joined (1, 3): each pair once."""
    monkeypatch.setattr(cooccur, "HOT_BASKETS", share)
    monkeypatch.setattr(cooccur, "CELL", 3)
    rng = random.Random(share)
    whole = [("whole", f"i{k}") for k in range(150)]
    rest = [(f"b{rng.randrange(60)}", f"i{min(int(rng.expovariate(0.02)), 149)}") for _ in range(300)]
    want = {}
    baskets = {}
    for b, i in whole + rest:
        baskets.setdefault(b, set()).add(i)
    for held in baskets.values():
        for i in held:
            for j in held:
                if i < j:
                    want[i, j] = want.get((i, j), 0) + 1
    df = spark.createDataFrame(whole + rest, "b string, i string")
    got = cooccur.pair_counts(df, "b", "i", heavy=30, chunk=per)
    found = [(r.item_i, r.item_j, r.shared) for r in got.collect()]
    assert len(found) == len(want)
    assert {(i, j): n for i, j, n in found} == want


def test_bit_matrices_over_many_batches(spark, monkeypatch):
    monkeypatch.setattr(cooccur, "MATRIX", 50)
    items = [(b, f"i{k}") for b in range(400) for k in range(5) if (b * 7 + k * 3) % 4]
    got = {(r.item_i, r.item_j): r.shared for r in cooccur.pair_counts(spark.createDataFrame(items, "b bigint, i string"), "b", "i").collect()}
    sets = {}
    for b, i in items:
        sets.setdefault(i, set()).add(b)
    assert got == {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}


def test_no_baskets(spark):
    assert cooccur.pair_counts(spark.createDataFrame([], "b string, i string"), "b", "i").count() == 0


# -- 7 ---------------------------------------------------------------------------------------------------------------

WORDS = "the a river town house finds sells cuts with joy 12 7 km Anna Bob near old".split()


def plain(text):
    return re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", re.sub("[​-‍﻿­]", "", text)).lower())


def test_exact_windows_equal_brute_force(spark, monkeypatch):
    rnd = random.Random(3)
    items = [(i, " ".join(rnd.choices(WORDS, k=rnd.randrange(8, 30)))) for i in range(12)]
    docs = []
    for d in range(60):
        ws = rnd.choices(WORDS, k=rnd.randrange(0, 40))
        if d % 3 == 0:
            src = items[rnd.randrange(12)][1].split()
            k = rnd.randrange(max(1, len(src) - 13))
            ws += src[k : k + rnd.choice([12, 13, 15])]
        t = " ".join(ws)
        docs.append((d, t.upper() if d % 2 else t.replace("river", "ri­ver").replace("12", "１２")))
    want = set()
    grams = {}
    for i, t in items:
        for k in range(len(plain(t)) - 12):
            grams.setdefault(tuple(plain(t)[k : k + 13]), set()).add(i)
    for d, t in docs:
        for k in range(len(plain(t)) - 12):
            want |= {(d, i) for i in grams.get(tuple(plain(t)[k : k + 13]), ())}
    ds = spark.createDataFrame([*docs, (99, None), (None, items[0][1]), (100, "")], "doc_id bigint, text string")
    its = spark.createDataFrame([(i, "s", t, None) for i, t in items] + [(50, "s", None, None), (None, "s", docs[0][1], None)], "item_id bigint, suite string, item_text string, id string")
    for bits, stretch in ((leakage.MAX_BITS, leakage.STRETCH), (1 << 10, 60)):  # a filter that lets few windows pass, and one that lets nearly all, with texts in stretches
        monkeypatch.setattr(leakage, "MAX_BITS", bits)
        monkeypatch.setattr(leakage, "STRETCH", stretch)
        for exact in (True, False):
            got = leakage.matches(ds, its, "doc_id", "text", "item_id", "item_text", exact=exact).filter("exact_windows > 0")
            assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want


def test_every_window_is_whole_in_a_stretch(monkeypatch):
    monkeypatch.setattr(leakage, "STRETCH", 50)
    rnd = random.Random(5)
    for text in (" ".join(rnd.choices([*WORDS, "—", "ri\u00adv\u200ber", "x" * 70], k=300)), "y" * 500, "", "a b"):
        parts = [t for held in leakage._portions(iter([(1, text)]), 5) for _, t in held]
        whole, pieces = plain(text), [plain(t) for t in parts]
        assert {tuple(whole[k : k + 5]) for k in range(len(whole) - 4)} == {tuple(p[k : k + 5]) for p in pieces for k in range(len(p) - 4)}
        assert text[:1] == "y" or all(len(t) < 1000 for t in parts)


ITEM = "A merchant in the old harbour buys 12 crates from Anna and sells 5 crates to Anna before the evening bell rings twice"


def kinds(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "s", ITEM)], "item_id bigint, suite string, item_text string")
    return [r.kind for r in leakage.leaks(docs, items).collect()]


def test_reparameterised_texts_are_found_and_inconsistent_slots_are_not(spark):
    assert kinds(spark, "Well. " + ITEM) == ["exact"]
    assert kinds(spark, ITEM.replace("12", "31").replace("5 ", "9 ")) == ["reparameterised"]
    assert kinds(spark, ITEM.replace("Anna", "Zelda")) == ["reparameterised"]
    middle = "old harbour buys 12 crates from Anna and sells 5 crates to Anna"
    assert kinds(spark, middle.replace("12", "8").replace("from Anna", "from Zelda").replace("to Anna", "to Bertil")) == []
    assert kinds(spark, middle.replace("buys", "steals")) == []


HAND = [  # language, item, the same with other parameters, another meaning
    ("en", "On Monday the tailor in Dover sold 14 metres of blue cloth to Harriet, who paid 33 pounds and carried it home to Whitby before dark.",
     "On Monday the tailor in Leeds sold 27 metres of blue cloth to Gloria, who paid 41 pounds and carried it home to Barnsley before dark.",
     "On Monday the farmer in Dover hid 14 metres of blue rope for Harriet, who stole 33 pounds and dragged it home to Whitby before noon."),
    ("de", "Der alte Gärtner pflanzt in Bremen vier Bäume für Annegret und gießt die jungen Rosen an der Mauer jeden Abend mit 12 Litern Wasser aus dem Brunnen.",
     "Der alte Gärtner pflanzt in Kassel sieben Bäume für Roswitha und gießt die jungen Rosen an der Mauer jeden Abend mit 30 Litern Wasser aus dem Brunnen.",
     "Der alte Richter pflanzt in Bremen vier Zäune für Annegret und gießt die jungen Hunde an der Brücke jeden Morgen mit 12 Litern Suppe aus dem Kessel."),
    ("fr", "Le vieux boulanger de Nantes prépare 25 pains pour Élodie et garde les trois plus beaux dans un panier près de la porte de son jardin.",
     "Le vieux boulanger de Rennes prépare 60 pains pour Margaux et garde les quatre plus beaux dans un panier près de la porte de son jardin.",
     "Le vieux chasseur de Nantes prépare 25 pièges pour Élodie et cache les trois plus gros dans un fossé près de la route de son village."),
    ("es", "La maestra de Toledo reparte 18 libros entre los niños y Marta lee con calma dos cuentos antes de salir al patio con la clase entera.",
     "La maestra de Huelva reparte 44 libros entre los niños y Lucía lee con calma tres cuentos antes de salir al patio con la clase entera.",
     "La maestra de Toledo esconde 18 premios entre los árboles y Marta busca con prisa dos monedas antes de salir al bosque con la clase entera."),
]


def test_own_passages_in_four_languages(spark):
    items = spark.createDataFrame([(k, "s", lang, t) for k, (lang, t, *_) in enumerate(HAND)], "item_id bigint, suite string, lang string, item_text string")
    docs = spark.createDataFrame([(10 * kind + k, lang.upper(), ts[kind]) for k, (lang, *ts) in enumerate(HAND) for kind in range(3)], "doc_id bigint, lang string, text string")
    got = {(r.doc_id, r.item_id, r.kind) for r in leakage.leaks(docs, items).collect()}
    assert got == {(k, k, "exact") for k in range(4)} | {(10 + k, k, "reparameterised") for k in range(4)}


def test_german_nouns_are_no_names(spark):
    item = "Der Kaufmann stellt den Korb vor das Haus, und die Tochter trägt das Brot auf den Markt in der Stadt"
    other = "Der Soldat stellt den Eimer vor das Schiff, und die Gräfin trägt das Schwert auf den Turm in der Wüste"
    items = spark.createDataFrame([(1, "s", "de", item)], "item_id bigint, suite string, lang string, item_text string")
    docs = spark.createDataFrame([(1, "de", other)], "doc_id bigint, lang string, text string")
    assert leakage.leaks(docs, items).count() == 0


PLACES = re.compile(r"\b(in|beside|neben|à|devant|en|ante) ([A-Z]\w+)")
NOUNS = {"en": r"\b([Tt]he) (\w+)", "de": r"\b([Dd](?:er|ie|as|en)) ([A-ZÄÖÜ]\w+)", "fr": r"\b([Ll][ea]) (\w+)", "es": r"\b([Ee]l|[Ll]a) (\w+)"}


def test_items_of_the_tables_with_other_parameters_and_with_other_words(spark, data):
    """Every item once with other numbers and places, and once with other nouns, among the documents."""
    rnd = random.Random(12)
    items = [r for r in spark.read.parquet(f"{data}/eval_items.parquet").collect() if r.lang in NOUNS and len(plain(r.item_text)) >= 13]
    nouns = {x: sorted({m[1] for r in items if r.lang == x for m in re.findall(p, r.item_text)}) for x, p in NOUNS.items()}
    docs = []
    for r in items:
        seen = {}
        text = PLACES.sub(lambda m: m[1] + " " + seen.setdefault(m[2], f"Q{''.join(rnd.choices('aeiou', k=2))}{m[2][::-1].lower()}"), r.item_text)  # noqa: B023
        docs.append((10**9 + r.item_id, r.lang, re.sub(r"\d+", lambda m: str(int(m[0]) + 7), text)))
        docs.append((2 * 10**9 + r.item_id, r.lang, re.sub(NOUNS[r.lang], lambda m: m[1] + " " + rnd.choice([n for n in nouns[r.lang] if n != m[2]]), r.item_text)))  # noqa: B023
    corpus = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang", "text").unionByName(spark.createDataFrame(docs, "doc_id bigint, lang string, text string"))
    got = leakage.leaks(corpus, spark.read.parquet(f"{data}/eval_items.parquet")).filter("doc_id >= 1000000000").collect()
    lang = {r.item_id: r.lang for r in items}
    for x in NOUNS:
        n = sum(v == x for v in lang.values())
        right = {r.doc_id - 10**9 for r in got if r.doc_id < 2 * 10**9 and r.doc_id - 10**9 == r.item_id and lang[r.item_id] == x}
        wrong = {(r.doc_id, r.item_id) for r in got if r.doc_id > 2 * 10**9 and lang[r.doc_id - 2 * 10**9] == x}
        print(x, "items", n, "recall", len(right) / n, "precision", len(right) / max(1, len(right) + len(wrong)))
        assert len(right) >= 0.9 * n and len(wrong) <= 0.05 * n


def test_very_long_text_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000 + ITEM + " word" * 5)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "s", ITEM)], "item_id bigint, suite string, item_text string")
    assert rows(leakage.leaked_passages(docs, items)) == [(1, 7)]
    assert leakage.leaked_passages(docs, items.limit(0)).count() == 0
    assert leakage.leaked_passages(docs.limit(0), items).count() == 0


# -- 8 ---------------------------------------------------------------------------------------------------------------


def sizes(spark, counts):
    return spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(counts)], "doc_id bigint, source string, tokens bigint")


TARGETS = "source string, target_share double, max_repeats int, extra int"


def test_token_counts_are_the_tokenizers(spark):
    import base64

    import tiktoken

    with open(mixing.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    enc = tiktoken.Encoding("t", pat_str=r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks=ranks, special_tokens={})
    texts = ["", "It's a río — 12 km.  \n\n x", None, "a" * 2000, " ".join(["It's word, 12"] * 12_000), "<|endoftext|>", " \t " * 30]
    df = spark.createDataFrame([(i, " S ", t) for i, t in enumerate(texts)] + [(9, None, "x"), (10, "  ", "x")], "doc_id bigint, source string, text string")
    assert rows(mixing.sized(df)) == sorted(((i, "s", len(enc.encode_ordinary(t)) if t else 0) for i, t in enumerate(texts)), key=repr)


def test_sums_and_limits_of_the_mixture(spark):
    rnd = random.Random(6)
    s = sizes(spark, [(rnd.choice("aaaaab"), rnd.randrange(0, 200)) for _ in range(3000)] + [("other", 50)])
    t = spark.createDataFrame([("A ", 0.6, 2, 1), ("b", 0.3, 3, 1), ("none", 0.1, 4, 1)], TARGETS)
    planned = mixing.plan(s, t)
    for block, fan in ((100_000, 64), (100, 3)):  # one block, and a tree of four levels
        got = mixing.mix(s, planned, block=block, fan_in=fan).collect()
        assert len(got) == s.filter("source in ('a', 'b')").count()
        for p in planned[:2]:
            mine = [r for r in got if r.source == p["source"]]
            assert abs(sum(r.copies for r in mine) - p["copies"] * len(mine)) <= 1
            assert {r.copies for r in mine} <= {int(p["copies"]), int(p["copies"]) + 1} and max(r.copies for r in mine) <= p["max_repeats"]
            assert abs(sum(r.copies * r.tokens for r in mine) - min(p["wanted"], p["tokens"] * p["max_repeats"])) <= 0.02 * p["wanted"]
    assert [p["short"] for p in planned] == [False, False, True] or [p["short"] for p in planned] == [False, True, True]


def test_copies_depend_on_the_rows_alone(spark, monkeypatch):
    docs = [(i % 700, "a" if i % 3 else "b", 10 + i % 5) for i in range(1500)] + [(1, "a", 10)] * 300
    planned = [{"key": k, "source": k, "copies": c, "docs": 1800} for k, c in (("a", 0.37), ("b", 1.6))]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint")

    def copies(df):
        return rows(mixing.mix(df, planned, block=100, fan_in=4))

    want = copies(df.coalesce(1))
    assert len(want) == 1800 and copies(df.repartition(7)) == want
    monkeypatch.setattr(mixing, "BUFFER", 70)  # equal rows in portions, blocks over several buffers
    assert copies(df.orderBy(df.tokens.desc())) == want


def test_sources_that_may_give_nothing_dont_empty_the_mixture(spark):
    s = sizes(spark, [("a", 100), ("b", 100), ("c", 100)])
    t = spark.createDataFrame([("a", 0.5, 3, 1), ("b", 0.25, 0, 1), ("c", 0.25, None, 1)], TARGETS)
    assert [x["copies"] for x in mixing.plan(s, t, True)] == [1.5, 0.0, 0.0]


def test_each_document_keeps_its_chance(spark):
    s = sizes(spark, [("a", 10)] * 40)
    planned = [{"key": "a", "source": "a", "copies": 0.3, "docs": 40}]
    taken = [0] * 40
    for seed in range(30):
        for r in mixing.mix(s, planned, seed=seed).collect():
            taken[r.doc_id] += r.copies
    assert sum(taken) == 30 * 12 and all(1 <= x <= 20 for x in taken)


def test_short_sources_and_shares(spark):
    docs = spark.createDataFrame([(i, f" {'BIG' if i % 10 else 'small'} ", "one two three four " * 5) for i in range(400)] + [(900, None, "x"), (901, "empty", None)], "doc_id bigint, source string, text string")
    t = spark.createDataFrame([("Big", 0.5, 1, 1), ("small", 0.3, 2, 1), ("empty", 0.1, 9, 1), ("Nobody", 0.1, 9, 1), ("zero", None, None, 1)], TARGETS)
    assert rows(mixing.short_sources(docs, t)) == [("Nobody",), ("empty",), ("small",)]
    got = {r.source: r for r in mixing.shares(docs, t).collect()}
    assert got["Big"].mixed_tokens + got["Big"].left_out_tokens == got["Big"].source_tokens and abs(got["Big"].mixed_tokens / got["Big"].wanted_tokens - 1) < 0.02
    assert got["small"].mixed_tokens == 2 * got["small"].source_tokens and got["small"].left_out_tokens == 0
    got = {r.source: r for r in mixing.shares(docs, t, exact_shares=True).collect()}
    assert abs(got["Big"].reached_share / got["small"].reached_share - 5 / 3) < 0.15 and got["small"].max_copies == 2
    assert mixing.short_sources(docs, t.limit(0)).count() == 0
    assert rows(mixing.short_sources(docs.limit(0), t)) == []
    assert mixing.mixture(docs.limit(0), t).count() == 0


# -- 9 ---------------------------------------------------------------------------------------------------------------


def counts(spark, *texts):
    df = spark.createDataFrame([(i, t, "EN ", 0) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, f int")
    return readability.reading_levels(df, "doc_id", "text", "lang").orderBy("doc_id").collect()


def test_words_and_sentences(spark):
    got = counts(spark, "One two. Three four? five! Six… Seven", "e.g. this.   Next — word. 12 go", None, "", " ... !", "No end")
    assert [(r.n_words, r.n_sentences) for r in got] == [(7, 4), (6, 2), (0, 0), (0, 0), (0, 0), (2, 1)]
    assert got[0].n_chars == 27 and got[2].grade is None and got[0].lang == "en"


def test_formulas(spark):
    r = counts(spark, "The cat sat on the mat. The dog ran to the transformation.")[0]
    assert (r.n_words, r.n_sentences, r.n_syllables, r.n_polysyllables) == (12, 2, 15, 1)
    assert abs(r.flesch_kincaid - (0.39 * 6 + 11.8 * 15 / 12 - 15.59)) < 1e-9
    assert abs(r.ari - (4.71 * r.n_chars / 12 + 0.5 * 6 - 21.43)) < 1e-9
    made = sorted(r[g] for g, of in readability.GRADES.items() if of in ("en", None))
    assert len(made) == 7 and abs(r.grade - made[3]) < 1e-9
    assert all(r[g] is None for g, of in readability.GRADES.items() if of not in ("en", None))


def test_formulas_have_the_constants_of_their_language(spark):
    text = "Der Mond scheint hell. Die Verantwortung der Gesellschaft wächst mit jeder neuen Veränderung weiter."
    df = spark.createDataFrame([(k, text, x) for k, x in enumerate(["de-DE", "fr", "ES", "xx", None])], "doc_id int, text string, lang string")
    got = {r.lang: r for r in readability.reading_levels(df, "doc_id", "text", "lang").collect()}
    r = got["de"]
    w, s, poly, long, mono, syl = r.n_words, r.n_sentences, r.n_polysyllables, r.n_long, r.n_monosyllables, r.n_syllables
    assert (w, s) == (14, 2) and syl == 25 and poly == 3
    assert abs(r.wiener_1 - (0.1935 * 100 * poly / w + 0.1672 * w / s + 0.1297 * 100 * long / w - 0.0327 * 100 * mono / w - 0.875)) < 1e-9
    for ease, grade in ((95, 4.5), (90, 5), (65, 8), (40, 14), (-15, 19)):
        assert abs(spark.range(1).select(readability._grade(F.lit(float(ease))).alias("g")).first().g - grade) < 1e-9
    for lang, own in (("de", 7), ("fr", 3), ("es", 5), ("xx", 2), (None, 2)):
        made = sorted(got[lang][g] for g in readability.GRADES if got[lang][g] is not None)
        assert len(made) == own and abs(got[lang].grade - (made[(own - 1) // 2] + made[own // 2]) / 2) < 1e-9


def test_very_long_text_and_no_rows(spark):
    r = counts(spark, "Word after word goes on. " * 100_000)[0]
    assert (r.n_words, r.n_sentences) == (500_000, 100_000)
    assert counts(spark) == []
