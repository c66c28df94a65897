"""Evaluation texts inside training texts, by template canonicalisation.

Words are normalised, and numbers, units and names become typed placeholders, so that a passage and its re-parameterised
twin have one template. Windows of ``WINDOW`` words are hash-joined on their templates; then the slots are compared: literal
words must agree, and two slots hold the same value in one text exactly where they do in the other. Equal values everywhere
make the match exact.

A window has up to two templates. The first knows digits and the units after them. It depends on the lower-case words
alone, so equal passages always meet, however they are cased. The second also takes number words and capitalised words for
slots, except common words that begin a sentence; this is too generous, as German nouns and some beginnings of sentences
are no names. Therefore names that a match exchanges are held against the corpus, in the language of the item: a word more
often seen in lower case is no name, nor is a German word that often follows an article. This evidence is counted for the
words in question only, over all documents and items.

A window with few literal words is no proof by its template: with fewer than ``RICH`` the join also asks which slots are
equal among themselves, with fewer than ``POOR`` all words must be.

What of the items every task holds is a bit filter of bounded size; what passes it is joined exactly.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ploidlake.functions.ids import clean_label
from ploidlake.operators.skew import lookup
from ploidlake.runtime import Stages

WINDOW = 13
#: Literal words with which a template is enough, and with which equality of slots is asked for, too.
RICH, POOR = 7, 4
#: Bits of the filter per wanted key, and at most (32 MB at each task). With more keys it lets more pass, and nothing is lost.
BITS_PER_KEY, MAX_BITS = 32, 1 << 28
#: Share of a German word's capitalised places behind an article from which on it is a noun and no name.
NOUN_SHARE = 0.2
#: Share of capitalised words above which a text's case says nothing.
SHOUTING = 0.6
#: Texts handled together, by number and by characters; longer texts are handled in stretches that overlap.
TEXTS, STRETCH = 256, 1 << 21
_LITERAL, _NUMBER, _UNIT, _NAME = range(4)
_WINDOWS = "id bigint, key bigint, words string, kinds string"

# -- fixed values: words by kind, in English, German, French and Spanish ---------------------------------------------

#: Number words that are no other common word in one of the languages.
NUMBER_WORDS = frozenset(
    """two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen
    twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million
    zwei drei vier fünf sechs sieben acht neun zehn zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn
    zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen
    deux trois quatre cinq sept huit onze douze treize quatorze quinze vingt trente quarante cinquante soixante cents mille
    dos tres cuatro cinco seis siete ocho nueve diez trece catorce veinte treinta cuarenta cincuenta sesenta setenta ochenta
    noventa cien ciento millón millones""".split()
)
_PREFIXES = ["", "k", "m", "c", "d", "n", "h", "g", "t"]
_SHORT = ["m", "g", "l", "s", "w", "v", "a", "j", "b", "hz", "pa", "wh", "cal", "bar"]
_LONG_PREFIXES = ["", "kilo", "milli", "mili", "centi", "zenti", "deci", "mega", "giga", "micro", "nano"]
_LONG = """meter meters metern metre metres mètre mètres metro metros gram grams gramm gramme grammes gramo gramos liter liters litern
litre litres litro litros watt watts vatios volt volts byte bytes hertz joule joules second seconds sekunde sekunden seconde secondes
segundo segundos calories kalorien""".split()
#: Units of measure, of time and of money; a word is one only behind a number.
UNITS = frozenset(
    [p + u for p in _PREFIXES for u in _SHORT]
    + [p + u for p in _LONG_PREFIXES for u in _LONG]
    + """min h ha mph kmh kg hour hours minute minutes day days week weeks month months year years stunde stunden minuten tag tage tagen woche
    wochen monat monate monaten jahr jahre jahren heure heures jour jours semaine semaines mois an ans année années hora horas minuto
    minutos día días semana semanas mes meses año años euro euros dollar dollars dólar dólares pound pounds pfund franc francs franken
    peso pesos cent cents percent prozent mile miles meile meilen milla millas foot feet inch inches yard yards acre acres hectare
    hectares hektar hectáreas ton tons tonne tonnes tonnen toneladas degree degrees grad degrés grados""".split()
)
#: Common words that begin sentences.
COMMON = frozenset(
    """a an the this that these those he she it we you they i in on at of for from to with by and but or if when while as what who
    how why where there here my your his her our their its one each every some many all no not
    der die das den dem des ein eine einen einem einer er sie es wir ihr ich im am an auf aus bei mit nach von zu zum zur und aber oder
    wenn als wie was wer wo da dann dort hier denn weil dieser diese dieses jeder jede jedes alle viele kein keine mein sein
    le la les l un une des du il elle on nous vous ils elles je ce cet cette ces dans sur à de pour par avec et mais ou si quand comme
    que qui où chaque tous toutes mon ma mes son sa ses leur
    el los las una unos unas yo tú él ella nosotros ellos este esta estos estas ese esa en con por para sin sobre del al y pero o
    cuando como qué quién dónde cada todos todas mi su sus""".split()
)
#: German words that stand before nouns.
ARTICLES = frozenset(
    """der die das den dem des ein eine einen einem einer eines kein keine keinen keinem keiner mein meine meinen meinem meiner dein deine
    sein seine seinen seinem seiner ihr ihre ihren ihrem ihrer unser unsere unseren euer eure dieser diese dieses diesen diesem jeder jede
    jedes jeden jedem jener jene welcher welche welches alle allen aller viel viele vielen vieler wenig wenige mehr manche mehrere einige
    einigen beide beiden im am zum zur vom beim ins ans""".split()
)
#: German words that end the reach of an article before them.
BREAKS = frozenset("an auf aus außer bei bis durch für gegen hinter in mit nach neben ohne seit trotz um unter von vor während wegen zu zwischen über und oder aber denn als wie".split())

_DROP = re.compile("[​-‍﻿­]")
_WORD = re.compile(r"[^\W_]+")
_BLANK = re.compile(r"\s")
#: What stands between blanks and holds a word, or more of them.
_PIECE = re.compile(r"\S*[^\W_]\S*")


class _Numbered(dict):
    """Words numbered in the order they come."""

    def __missing__(self, word):
        got = self[word] = len(self)
        return got


def _plane():
    """For each character of the basic plane: 1 letter or digit, 2 upper case, 4 end of a sentence; made once a task."""
    import numpy as np

    kept = _plane.__dict__
    if "table" not in kept:
        plane = [chr(k) for k in range(1 << 16)]
        kept["table"] = np.array([c.isalnum() + 2 * (c.isupper() or c.istitle()) + 4 * (c in ".!?…") for c in plane], np.uint8)
    return kept["table"]


def _traits(points):
    import numpy as np

    out = _plane()[np.minimum(points, 0xFFFF)]
    far = np.flatnonzero(points > 0xFFFF)
    for i in far:
        c = chr(points[i])
        out[i] = c.isalnum() + 2 * c.isupper()
    return out


def tokens(texts: list[str]) -> tuple:
    """Words of several texts: ``(words, text number, capitalised, first of a sentence)``, the last three as arrays.

    Zero-width characters and soft hyphens go, then NFKC and lower-casing; words are runs of letters and digits. A text whose
    length changes in lower case is taken as written in lower case.
    """
    import numpy as np

    plain = _DROP.sub("", "\0".join(t.replace("\0", " ") for t in texts))
    plain = unicodedata.normalize("NFKC", plain)
    low = plain.lower()
    if len(low) != len(plain):
        plain = "\0".join(t if len(t.lower()) == len(t) else t.lower() for t in plain.split("\0"))
        low = plain.lower()
    points = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32)
    traits = _traits(points)
    inside = (traits & 1).astype(bool)
    at = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    words = _WORD.findall(low)
    if len(words) != len(at):  # lower-casing moved a word's limits in some text: case is left out of account
        if len(texts) > 1:
            each = [tokens([t]) for t in texts]
            return [w for x in each for w in x[0]], np.repeat(np.arange(len(each)), [len(x[0]) for x in each]), np.concatenate([x[2] for x in each]), np.concatenate([x[3] for x in each])
        n = len(words)
        return words, np.zeros(n, int), np.zeros(n, bool), np.zeros(n, bool)
    text = np.cumsum(points == 0)[at] if len(at) else np.zeros(0, int)
    stops = np.cumsum((traits & 4) > 0)[at] if len(at) else text
    first = np.append(True, (text[1:] != text[:-1]) | (stops[1:] != stops[:-1]))[: len(at)]
    return words, text, (traits[at] & 2) > 0, first


def _portions(rows: Iterator[tuple], window: int) -> Iterator[list[tuple]]:
    """Pairs ``(label, text)`` in lists of bounded size.

    A text longer than ``STRETCH`` comes in stretches, cut at blanks; each begins ``window`` words before the last one
    ended, or more, so that every window is whole in one of them. Stretches of few words are longer.
    """
    held: list[tuple] = []
    size = 0
    for label, text in rows:
        start, span = 0, STRETCH
        while start < len(text):
            m = _BLANK.search(text, start + span) if start + span < len(text) else None
            end = m.start() if m else len(text)
            if m and len(list(islice(_PIECE.finditer(text, start, end), 2 * window))) < 2 * window:
                span *= 2
                continue
            held.append((label, text[start:end]))
            size += end - start
            if size >= STRETCH or len(held) >= TEXTS:
                yield held
                held, size = [], 0
            if not m:
                break
            back, last = 16 * window, []
            while len(last) <= window and back < 2 * (end - start):  # the first one may be cut
                last, back = [x.start() for x in _PIECE.finditer(text, max(start, end - back), end)], 2 * back
            start, span = last[-window], STRETCH
    if held:
        yield held


def _filter(keys: DataFrame, column: str):
    """A broadcast bit filter over the distinct bigints of a column: two bits for each, in at most ``MAX_BITS``."""
    import numpy as np

    keys = keys.select(F.col(column).alias("k"))
    bits = 1 << min(MAX_BITS.bit_length() - 1, max(10, (BITS_PER_KEY * keys.count()).bit_length()))
    low, high = F.col("k").bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned("k", 32).bitwiseAND(F.lit(bits - 1))
    each = keys.select(F.explode(F.array(low, high)).alias("b"))
    cells = each.groupBy(F.shiftright("b", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).toArrow()  # bits / 64 rows at most
    table = np.zeros(bits >> 6, np.int64)
    table[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint64))


def _passes(table, keys):
    """Which keys (uint64) may be among those of a filter."""
    import numpy as np

    u = np.uint64
    mask = u(len(table) * 64 - 1)
    out = np.zeros(len(keys), bool)
    maybe = np.arange(len(keys))
    for part in (lambda k: k & mask, lambda k: (k >> u(32)) & mask):
        b = part(keys[maybe])
        maybe = maybe[(table[b >> u(6)] >> (b & u(63))) & u(1) > 0]
    out[maybe] = True
    return out


def _windower(window: int, names: bool, probe):
    """mapInArrow over ``(id, text)``: the windows of each text with their join keys, each key and wording once a text.

    ``names``: with second templates; ``probe``: a broadcast filter of the keys wanted, or None for all.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        u = np.uint64
        wanted = None if probe is None else probe.value
        known: dict[str, tuple] = {}

        def traits(w):
            got = known.get(w)
            if got is None:
                if len(known) > 1 << 18:
                    known.clear()
                got = known[w] = (xxhash.xxh3_64_intdigest(w), any(c.isdigit() for c in w), w in UNITS, w in NUMBER_WORDS, w in COMMON)
            return got

        marks = np.array([xxhash.xxh3_64_intdigest(f"\0{k}") for k in range(4)], u)
        mult = u(0x9E3779B97F4A7C15)

        def mixed(h):
            h = h ^ (h >> u(29))
            h = h * u(0xBF58476D1CE4E5B9)
            return h ^ (h >> u(32))

        def rolled(h):
            n = len(h) - window + 1
            out = np.zeros(n, u)
            for k in range(window):
                out = out * mult + h[k : k + n]
            return mixed(out)

        def equalities(at, code, slot):
            """A hash of which slots of a window hold the same word, for windows that begin ``at``."""
            out = np.zeros(len(at), u)
            for i in range(0, len(at), 4096):
                span = at[i : i + 4096, None] + np.arange(window)
                words, slots = code[span], slot[span]
                same = (words[:, :, None] == words[:, None, :]) & slots[:, :, None] & slots[:, None, :]
                place = np.where(slots, same.argmax(axis=2) + 1, 0).astype(u)
                for k in range(window):
                    out[i : i + 4096] = out[i : i + 4096] * mult + place[:, k]
            return mixed(out)

        def windows(ids, texts):
            words, text, caps, first = tokens(texts)
            if len(words) < window:
                return None
            number = _Numbered()
            code = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            about = [traits(w) for w in number]
            exact = np.array([t[0] for t in about], u)[code]
            digits, unit, spelled, common = (np.array([t[k] for t in about], bool)[code] for k in range(1, 5))

            def kinds_of(is_number):
                kinds = np.where(is_number, _NUMBER, _LITERAL).astype(np.int8)
                kinds[1:][unit[1:] & is_number[:-1] & ~is_number[1:]] = _UNIT
                return kinds

            plain = kinds_of(digits)
            n = len(words) - window + 1
            whole = text[:n] == text[window - 1 :]
            ex = rolled(exact)
            found = []
            for second in (False, True) if names else (False,):
                kinds = plain
                if second:
                    kinds = kinds_of(digits | spelled)
                    kinds[(kinds == _LITERAL) & caps & ~(first & common)] = _NAME
                literals = np.convolve(kinds == _LITERAL, np.ones(window, int), "valid")
                key = rolled(np.where(kinds == _LITERAL, exact, marks[kinds]))
                between = np.flatnonzero((literals < RICH) & (literals >= POOR) & whole)
                if len(between):
                    key[between] = mixed(key[between] + equalities(between, code, kinds != _LITERAL))
                if second:
                    ok = whole & (literals >= POOR) & (np.convolve(kinds != plain, np.ones(window, int), "valid") > 0)
                    key = ~key
                else:
                    ok = whole
                    key = np.where(literals < POOR, ex ^ u(0x5555555555555555), key)
                hits = np.flatnonzero(ok)
                if wanted is not None:
                    hits = hits[_passes(wanted, key[hits])]
                if len(hits):
                    _, one = np.unique(np.stack([text[hits], ex[hits].view(np.int64)]), axis=1, return_index=True)
                    hits = hits[np.sort(one)]
                    found.append((hits, key[hits], kinds))
            if not found:
                return None
            out_ids, spans, marked = [], [], []
            for hits, _, kinds in found:
                out_ids += [ids[text[i]] for i in hits]
                spans += [" ".join(words[i : i + window]) for i in hits]
                marked += ["".join(map(str, kinds[i : i + window])) for i in hits]
            return pa.record_batch([pa.array(out_ids, pa.int64()), pa.array(np.concatenate([k for _, k, _ in found]).view(np.int64)), pa.array(spans, pa.string()), pa.array(marked, pa.string())], names=["id", "key", "words", "kinds"])

        with np.errstate(over="ignore"):
            for batch in batches:
                texts = ((i.as_py(), t.as_py()) for i, t in zip(batch.column(0), batch.column(1), strict=True) if i.is_valid and t.is_valid)
                for both in _portions(texts, window):
                    got = windows([i for i, _ in both], [t for _, t in both])
                    if got is not None:
                        yield got

    return run


def _hashed(batches: Iterator) -> Iterator:
    """Words to the hashes that filters hold."""
    import numpy as np
    import pyarrow as pa
    import xxhash

    for batch in batches:
        yield pa.record_batch([pa.array(np.array([xxhash.xxh3_64_intdigest(w) for w in batch.column(0).to_pylist()], np.uint64).view(np.int64))], names=["key"])


def _cases(probe):
    """mapInArrow over ``(lang, text)``: how often words of a filter are capitalised inside sentences, in lower case, and
    capitalised with a German article before them."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        wanted = probe.value
        for batch in batches:
            for both in _portions(((x.as_py(), t.as_py()) for x, t in zip(batch.column(0), batch.column(1), strict=True) if t.is_valid), 1):
                words, text, caps, first = tokens([t for _, t in both])
                if not words:
                    continue
                number = _Numbered()
                code = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                listed = list(number)
                share = np.bincount(text, weights=caps, minlength=len(both)) / np.maximum(1, np.bincount(text, minlength=len(both)))
                telling = ((share > 0) & (share < SHOUTING))[text]  # a text in one case says nothing about it
                asked = _passes(wanted, np.array([xxhash.xxh3_64_intdigest(w) for w in listed], np.uint64))[code] & telling
                article = np.array([w in ARTICLES for w in listed])[code]
                stops = np.array([w in BREAKS for w in listed])[code] | caps
                before = np.append(False, article[:-1]) & ~first
                before |= np.append([False, False], article[:-2])[: len(words)] & ~np.append(True, (stops | first)[:-1]) & ~first
                hits = np.flatnonzero(asked)
                if not len(hits):
                    continue
                langs = sorted({x or "" for x, _ in both})
                of = np.array([langs.index(x or "") for x, _ in both])[text[hits]]
                pair, back = np.unique(of * len(listed) + code[hits], return_inverse=True)
                sums = [np.bincount(back, weights=w[hits], minlength=len(pair)).astype(np.int64) for w in (caps & ~first, ~caps, caps & ~first & before)]
                yield pa.record_batch([pa.array([langs[p // len(listed)] for p in pair], pa.string()), pa.array([listed[p % len(listed)] for p in pair], pa.string()), *map(pa.array, sums)], names=["lang", "word", "upper", "lower", "noun"])

    return run


def _lang(column: str | None) -> Column:
    """A language code without region and case; empty for none."""
    return F.coalesce(F.substring_index(F.translate(clean_label(column), "_", "-"), "-", 1), F.lit("")) if column else F.lit("")


def _no_names(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """``(lang, word)`` of ``asked`` that ``texts(lang, text)`` show to be no names."""
    probe = _filter(asked.select("word").distinct().mapInArrow(_hashed, "key bigint"), "key")
    counted = texts.mapInArrow(_cases(probe), "lang string, word string, upper bigint, lower bigint, noun bigint").groupBy("lang", "word").agg(*[F.sum(c).alias(c) for c in ("upper", "lower", "noun")])
    none = counted.filter((F.col("lower") > F.col("upper")) | ((F.col("lang") == "de") & (F.col("noun") > NOUN_SHARE * F.col("upper"))))
    return asked.join(none, ["lang", "word"], "left_semi")


def matches(docs: DataFrame, items: DataFrame, doc_id: str, doc_text: str, item_id: str, item_text: str, doc_lang: str | None = None, item_lang: str | None = None, window: int = WINDOW, exact: bool = False) -> DataFrame:
    """``(doc_id, item_id, exact_windows, template_windows)`` for documents that share a window with an item.

    ``exact_windows``: distinct windows of ``window`` equal words; ``template_windows``: distinct windows that agree in the
    literal words and consistently in the slots (exact ones too). With ``exact`` second templates are left out and matches
    without an exact window with them. Null ids and texts and texts shorter than a window match nothing; rows that repeat
    an id add to it; texts are read whole; other columns are ignored; empty tables give no rows. Without language columns
    all texts are of one language, which isn't German.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "leakage")
    held = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text"), _lang(item_lang).alias("lang"))
    asked = stages.write(held.select("id", "text").mapInArrow(_windower(window, not exact, None), _WINDOWS).distinct())
    probe = _filter(asked.select("key").distinct(), "key")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(doc_text).alias("text"))
    found = stages.write(texts.mapInArrow(_windower(window, not exact, probe), _WINDOWS))
    # A window may be in a third of all documents: its rows are joined in shards.
    pairs = lookup(found, asked.select("key", F.col("id").alias("item"), F.col("words").alias("item_words"), F.col("kinds").alias("item_kinds")), "key")
    pairs = pairs.withColumns({"w": F.split("words", " "), "v": F.split("item_words", " "), "equal": F.col("words") == F.col("item_words")})
    steps = F.sequence(F.lit(0), F.lit(window - 1))

    def kind(i: Column) -> Column:
        return F.substring("kinds", i + 1, F.lit(1))

    literal = F.forall(steps, lambda i: (kind(i) != str(_LITERAL)) | (F.get("w", i) == F.get("v", i)))
    # Two slots agree in one text exactly where they do in the other: first places of equal words must be the same.
    slots = F.transform(steps, lambda i: F.array_position("w", F.get("w", i))) == F.transform(steps, lambda i: F.array_position("v", F.get("v", i)))
    fits = F.col("equal") | ((F.col("kinds") == F.col("item_kinds")) & literal & slots)
    judged = pairs.filter(fits)
    if exact:
        judged = judged.filter("equal")
    else:
        changed = F.flatten(F.transform(F.filter(steps, lambda i: (kind(i) == str(_NAME)) & (F.get("w", i) != F.get("v", i))), lambda i: F.array(F.get("w", i), F.get("v", i))))
        langs = held.groupBy(F.col("id").alias("item")).agg(F.min("lang").alias("lang"))
        judged = stages.write(judged.select("id", "item", "words", "equal", "item_words", F.array_distinct(changed).alias("changed")).join(langs, "item"))
        doubts = judged.filter("not equal and size(changed) > 0").select("id", "item", "words", "item_words", "lang", F.explode("changed").alias("word"))
        asked_words = stages.write(doubts.select("lang", "word").distinct())
        if not asked_words.isEmpty():
            everything = docs.select(_lang(doc_lang).alias("lang"), F.col(doc_text).alias("text")).unionByName(held.select("lang", "text"))
            none = stages.write(_no_names(asked_words, everything))  # written, so that its size is known where it is joined
            refuted = doubts.join(none, ["lang", "word"], "left_semi").select("id", "item", "words", "item_words").distinct()
            judged = judged.join(refuted, ["id", "item", "words", "item_words"], "left_anti")
    once = judged.groupBy("id", "item", "words").agg(F.max("equal").alias("equal"))
    got = once.groupBy("id", "item").agg(F.count_if("equal").alias("exact_windows"), F.count(F.lit(1)).alias("template_windows"))
    return got.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), "exact_windows", "template_windows")


def leaks(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, kind, exact_windows, template_windows)``; ``kind``: ``exact`` or ``reparameterised``.

    ``lang`` is read where the tables have it.
    """
    langs = ["lang" if "lang" in df.columns else None for df in (documents, eval_items)]
    found = matches(documents, eval_items, "doc_id", "text", "item_id", "item_text", *langs)
    return found.select("doc_id", "item_id", F.when(F.col("exact_windows") > 0, "exact").otherwise("reparameterised").alias("kind"), "exact_windows", "template_windows")


def leaked_passages(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """``(doc_id, item_id)`` with ``WINDOW`` words in a row in common."""
    return matches(documents, eval_items, "doc_id", "text", "item_id", "item_text", exact=True).select("doc_id", "item_id")


def leaked_items(documents: DataFrame, eval_items: DataFrame) -> DataFrame:
    """``(item_id, suite, docs_exact, docs_reparameterised)`` for every item that leaked."""
    per = leaks(documents, eval_items).groupBy("item_id").agg(F.count_if(F.col("kind") == "exact").alias("docs_exact"), F.count_if(F.col("kind") != "exact").alias("docs_reparameterised"))
    suites = eval_items.groupBy("item_id").agg(F.min("suite").alias("suite"))
    return per.join(suites, "item_id").select("item_id", "suite", "docs_exact", "docs_reparameterised")
