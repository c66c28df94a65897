"""Reading level: classic readability formulas over sentence length and syllables, combined by their median.

Words are the blank-separated pieces with a letter or digit; a sentence ends at ``.``, ``!``, ``?`` or ``…`` if blanks and
an upper-case letter follow, and at the end of the text. Syllables are counted by hyphenation-style rules: groups of vowels
are nuclei, some letters are no vowels where they stand, some vowel pairs split (hiatus), and some vowels are mute. Rules
exist for English, German, French and Spanish; other languages get the plain rule. A formula has the constants of its
language and is used for that language only; LIX and RIX, which ask for long words, serve all. Each text is seen whole, by
Arrow functions over a batch; rules run once for every distinct word of a batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ploidlake.functions.ids import clean_label

BLANK = r"[\s\p{Z}]"
SENTENCE_END = r"[.!?…]" + BLANK + r"+\p{Lu}"
WORD_CHAR = r"[\p{L}\p{N}]"


@dataclass(frozen=True)
class Rules:
    """How a language's words sound.

    ``nucleus`` matches one nucleus. ``silent`` letters are taken for consonants before that; ``split`` finds nuclei that
    are two, ``mute`` such that don't sound. ``words`` are exceptions with their syllables.
    """

    nucleus: str = "[aeiouyäöüáàâæéèêëíìîïóòôœúùûÿý]+"
    silent: str = "(?!)"
    split: str = "(?!)"
    mute: str = "(?!)"
    words: dict[str, int] = field(default_factory=dict)


def _count(words: dict[int, str]) -> dict[str, int]:
    return {w: n for n, ws in words.items() for w in ws.split()}


#: The rules by language.
RULES = {
    "en": Rules(
        nucleus="[aeiouyéèêïö]+",
        silent="(?<=[aeiou])y(?=[aeiou])|^y(?=[aeiou])|(?<=q)u(?=[aeiou])|(?<=g)u(?=[aeiy])",
        split="|".join(
            [
                r"(?<![ctslgn])ia(?!ge)|(?<=^g)ia|(?<=l)ia(?=b)|(?<=[ct])ia(?=t)|(?<=ni)a(?=[lc])|(?<=^c)ia|(?<=s)ia(?=s)",
                r"(?<![tscgxln])io|(?<=^l)io|(?<=t)io$|(?<=^s)io",
                r"iu(?!s$)|(?<=d)ius$|(?<=r)ius$",
                r"(?<=[djlcr])ie(?=t)|(?<=ni)et|(?<![tcsn])ie(?=n[tc])|(?<=^sc)ie(?=n)|(?<=cl)ie(?=n)|ie(?=st$)|(?<=[aeiouy][^aeiouy])ie(?=rs?$)|(?<=[^aeiouy]{2})ie(?=rs?$)",
                r"(?<=cr)ea(?=[t])|(?<=[rd])ea$|(?<=id)ea|(?<=^r)ea(?=ct|li)|(?<=th)ea(?=t)|(?<=lin)ea(?=r)|(?<=ucl)ea|(?<=rop)ea|(?<=rr)ea(?=l)|(?<=cer)ea",
                r"(?<!g)eo(?!p[lpa]|us)|(?<=^g)eo(?!r)|(?<=[ntr])eou",
                r"ua(?!de)|(?<!g)ue(?=n|l|t(?!te))|ui(?=n[^g]|n$|d$|ds$|ty|ci)|uo(?!y)",
                r"oe(?=m|t)|oing|oi(?=c(?:s|al|ally)?$)|oa(?=s[ie]s|lit)|ai(?=c$)|ao(?=s|t)",
                r"(?<![aeiou])ying|e(?=ing$)|ui(?=ng)|ii(?=ng)",
                r"(?<=[iae])s(?=ms?$)|th(?=ms?$)|(?<=[dst])n(?=['’]t)",
            ]
        ),
        mute="|".join(
            [
                r"(?<=[^aeiouy])e(?=\W*$)(?<![^aeiouy][lr]e)",
                r"(?<=[^aeiouytd])ed(?=\W*$)(?<![^aeiouyl][lr]ed)|(?<=j)ed(?=\W*$)",
                r"(?<=[^aeiouysxzcg])es(?=\W*$)(?<![^aeiouy][lr]es)(?<![cs]hes)",
                r"(?<=[aeiouy][^aeiouyl])e(?=(?:ly|ful|fully|less|ments?|ness|some|things?|where|work|times?|body|one|land|line|place|side|town|time|paper)\W*$)",
                r"(?<=[aeiouy]l)e(?=ly\W*$)",
            ]
        ),
        words=_count(
            {
                1: "eye eyes aches ache whole once twice",
                2: "people business every evening someone argue being cashier naked wicked naive persuade schedule soldier soldiers",
                3: "everything everyone parliament arguing beautiful element several tenement idea area recipe apostrophe coincide vegetable",
                4: "society variety anxiety february",
            }
        ),
    ),
    "de": Rules(
        nucleus="eau|ei|ie|au|eu|äu|ai|ey|ay|oi|ou|aa|ee|oo|[aeiouyäöüéèáà]",
        silent="(?<=q)u|^y(?=[aeiou])",
        split="|".join(
            [
                r"(?<=[aeiouyäöü][^aeiouyäöü])ie(?=n$)|(?<=[aeiouyäöü][^aeiouyäöü]{2})ie(?=n$)|(?<=[aeiouyäöü][^aeiouyäöü]{3})ie(?=n$)",
                r"(?<=fami[l])ie|(?<=[fl][oi]l)ie$|(?<=[lp]in)ie|(?<=ser)ie$|(?<=mater)ie|(?<=akt)ie|(?<=stud)ie(?=n?$)|(?<=präm)ie|(?<=ödi)e$",
                r"(?<=pat)ie(?=nt)|(?<=kl)ie(?=nt)|(?<=^or)ie(?=nt)|(?<=red)ie(?=n)|(?<=hyg)ie",
                r"eu(?=ms?$)|(?<=l)äu(?=m)|ee(?=n$)|(?<=^[gb])ee(?=h|nd|rd|rb)|(?<=^b)eu(?=r|n)|(?<=^b)ei(?=nh)|(?<=^g)ei(?=mpf|rrt)",
                r"(?<=^ath)ei|(?<=kr)ei(?=er)|(?<=prot)ei(?=n)|(?<=koff)ei|ai(?=k$)|(?<=ukr)ai|(?<=her)oi",
            ]
        ),
        words=_count({1: "team pfui hui wien", 2: "baby", 4: "familie"}),
    ),
    "fr": Rules(
        nucleus="[aeiouyàâäéèêëîïôöùûüœæ]+",
        silent="(?<=q)u|(?<=g)u(?=[eiyéèê])|(?<=[aeiouéè])y(?=[aeiouéèêâ])|^y(?=[aeiou])",
        split=r"é[aoiuéâôè]|é(?=e(?!s?$|nt$))|a[éè]|o[éè]|ou(?=er$|ez$|é)|[aoe]ï|oë|aë|ao(?!û|n$|ns$)|(?<=[bcdfgptv][rl])i(?=[aeoéèê][^s\W])|(?<=[bcdfgptv][rl])u(?=[aeéè](?!s?$))",
        mute=r"(?<=[^aeiouyàâäéèêëîïôöùûüœæ\W])(?:e|es)(?=\W*$)|(?<=[^aeiouyàâäéèêëîïôöùûüœæ\Wm])ent(?=\W*$)",
        words=_count(
            {
                1: "vent dent cent lent gent août aiment forment dorment viennent",
                2: "pays souvent content absent présent parent parents argent agent talent récent urgent patient serpent couvent torrent client nomment expriment estiment affirment confirment consomment",
                3: "différent accident président excellent violent évident innocent permanent continent équivalent adolescent paysan paysage fréquent",
                4: "intelligent indifférent",
            }
        ),
    ),
    "es": Rules(
        nucleus="[aeiouyáéíóúü]+",
        silent="(?<=q)u|(?<=g)u(?=[eiéí])|(?<=[aeiouáéíóú])y(?=[aeiouáéíóú])|^y(?=[aeiouáéíóú])",
        split="[aeoáéó](?=[aeoáéó])|[íú](?=[aeoiu])|[aeoiu](?=[íú])",
    ),
    "": Rules(),
}
#: The formulas and the languages they are made for; None for all.
GRADES = {
    "flesch_kincaid": "en", "fog": "en", "smog": "en", "coleman_liau": "en", "ari": "en", "wiener_1": "de", "wiener_2": "de", "wiener_3": "de", "wiener_4": "de", "amstad": "de",
    "kandel_moles": "fr", "fernandez_huerta": "es", "szigriszt": "es", "crawford": "es", "lix_grade": None, "rix_grade": None,
}
#: Flesch's steps of reading ease with the grades at their lower ends, and Anderson's limits of RIX for grades 2 to 13.
EASE_STEPS = [(90, 5), (80, 6), (70, 7), (60, 9), (50, 12), (30, 16), (0, 18)]
RIX_STEPS = [0.2, 0.5, 0.8, 1.3, 1.8, 2.4, 3.0, 3.7, 4.5, 5.3, 6.2, 7.2]
_FEATURES = "n_words bigint, n_sentences bigint, n_chars bigint, n_syllables bigint, n_long bigint, n_polysyllables bigint, n_monosyllables bigint"
#: Words whose syllables a task keeps in mind.
_KNOWN = 1 << 17


class Syllables:
    """Counts the syllables of lower-case words of one language, one at least; each run of digits counts as one."""

    def __init__(self, lang: str):
        r = RULES.get(lang, RULES[""])
        self.words = r.words
        self.nucleus, self.silent, self.split, self.mute = (re.compile(x) for x in (r.nucleus, r.silent, f"(?={r.split})", r.mute))
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > _KNOWN:
                self.known.clear()
            got = self.known[word] = self._count(word)
        return got

    def _count(self, word: str) -> int:
        bare = word.strip("\"'.,;:!?()[]«»„“”‚‘’…–-")
        if bare in self.words:
            return self.words[bare]
        parts = [p for p in re.split("[-–—/]", bare) if p]
        if len(parts) > 1:
            return max(1, sum(self.count(p) for p in parts if any(c.isalnum() for c in p)))
        bare = self.silent.sub("j", bare)
        n = len(self.nucleus.findall(bare)) + len(self.split.findall(bare)) + len(re.findall(r"\d+", bare))
        return max(1, n - len(self.mute.findall(bare)))


def syllables(word: str, lang: str = "") -> int:
    return Syllables(lang).count(word)


def _features(texts, langs):
    """Arrow arrays of texts and language codes to a struct array of counts."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = len(texts)
    texts = pc.fill_null(texts, "")
    ends = pc.count_substring_regex(texts, SENTENCE_END).to_numpy(zero_copy_only=False)
    pieces = pc.split_pattern_regex(texts, BLANK + "+")
    doc = np.repeat(np.arange(n), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
    coded = pc.list_flatten(pieces).dictionary_encode()
    words, code = coded.dictionary, np.asarray(coded.indices)
    chars = pc.count_substring_regex(words, WORD_CHAR).to_numpy(zero_copy_only=False)  # letters and digits of each distinct word
    real = chars[code] > 0
    doc, code = doc[real], code[real]
    lang_coded = pc.fill_null(langs, "").dictionary_encode()
    lang_of = np.asarray(lang_coded.indices)[doc] if n else np.zeros(0, int)
    names = lang_coded.dictionary.to_pylist()
    lower = pc.utf8_lower(words).to_pylist()
    both = code.astype(np.int64) * max(1, len(names)) + lang_of
    distinct, back = np.unique(both, return_inverse=True)
    kept = _features.__dict__.setdefault("rules", {})  # lives as long as the task
    for name in names:
        if name not in kept and name in RULES:
            kept[name] = Syllables(name)
    rules = [kept[name] if name in RULES else kept.setdefault("", Syllables("")) for name in names]
    heard = np.fromiter((rules[k % len(names)].count(lower[k // len(names)]) for k in distinct), np.int64, len(distinct))
    spoken = heard[back] if len(distinct) else np.zeros(0, np.int64)

    def per_doc(w):
        return np.bincount(doc, weights=w, minlength=n).astype(np.int64)

    counts = per_doc(np.ones(len(doc)))
    cols = [counts, np.where(counts > 0, ends + 1, 0), per_doc(chars[code]), per_doc(spoken), per_doc(chars[code] > 6), per_doc(spoken >= 3), per_doc(spoken == 1)]
    return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=[x.split()[0] for x in _FEATURES.split(", ")])


def _grade(ease: Column) -> Column:
    """School grade of a reading ease: straight lines through Flesch's steps, going on at both ends."""
    out = None
    for (high, a), (low, b) in reversed(list(zip(EASE_STEPS, EASE_STEPS[1:], strict=False))):
        line = F.lit(float(a)) + (high - ease) * ((b - a) / (high - low))
        out = line if out is None else F.when(ease >= low, line).otherwise(out)
    return F.when(ease >= EASE_STEPS[0][0], EASE_STEPS[0][1] + (EASE_STEPS[0][0] - ease) * 0.1).otherwise(out)


def reading_levels(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id, lang`` (cleaned), counts, a grade by each formula, ``grade`` (their median).

    Formulas of other languages are null. A null, empty or wordless text has counts 0 and null grades. ``lang`` is compared
    without case, blanks and region (``EN``, ``en-US`` are ``en``). Repeated rows give repeated results; very long texts are
    seen whole; other columns are ignored.
    """
    lang = F.substring_index(F.translate(clean_label(lang_col), "_", "-"), "-", 1) if lang_col else F.lit(None).cast("string")
    counted = F.arrow_udf(_features, f"struct<{_FEATURES.replace(' ', ':').replace(',:', ', ')}>")
    got = docs.select(F.col(id_col), lang.alias("lang"), counted(F.col(text_col), lang).alias("f")).select(id_col, "lang", "f.*")
    has = F.col("n_words") > 0
    w, s = F.col("n_words").cast("double"), F.col("n_sentences").cast("double")
    chars, syl, long, poly, mono = (F.col(c) for c in ("n_chars", "n_syllables", "n_long", "n_polysyllables", "n_monosyllables"))
    per_sentence, per_word = w / s, syl / w
    poly_share, long_share, mono_share = 100 * poly / w, 100 * long / w, 100 * mono / w
    formulas = {
        "flesch_kincaid": 0.39 * per_sentence + 11.8 * per_word - 15.59,
        "fog": 0.4 * (per_sentence + poly_share),
        "smog": 1.043 * F.sqrt(30 * poly / s) + 3.1291,
        "coleman_liau": 5.88 * chars / w - 29.6 * s / w - 15.8,
        "ari": 4.71 * chars / w + 0.5 * per_sentence - 21.43,
        "wiener_1": 0.1935 * poly_share + 0.1672 * per_sentence + 0.1297 * long_share - 0.0327 * mono_share - 0.875,
        "wiener_2": 0.2007 * poly_share + 0.1682 * per_sentence + 0.1373 * long_share - 2.779,
        "wiener_3": 0.2963 * poly_share + 0.1905 * per_sentence - 1.1144,
        "wiener_4": 0.2744 * poly_share + 0.2656 * per_sentence - 1.693,
        "amstad": _grade(180 - per_sentence - 58.5 * per_word),
        "kandel_moles": _grade(207 - 1.015 * per_sentence - 73.6 * per_word),
        "fernandez_huerta": _grade(206.84 - 60 * per_word - 1.02 * per_sentence),
        "szigriszt": _grade(206.835 - 62.3 * per_word - per_sentence),
        "crawford": -0.205 * 100 / per_sentence + 0.049 * 100 * per_word - 3.407,
        "lix_grade": (per_sentence + long_share - 10) / 4,  # straight line through the published steps of LIX
        "rix_grade": 1.0 + sum((F.when(long / s >= t, 1).otherwise(0) for t in RIX_STEPS), F.lit(0)),
    }
    got = got.withColumns({k: F.when(has if of is None else has & (F.col("lang") == of), formulas[k]) for k, of in GRADES.items()})
    got = got.withColumn("__g", F.sort_array(F.array_compact(F.array(*GRADES))))
    return got.withColumn("grade", F.when(has, F.expr("(__g[int((size(__g) - 1) div 2)] + __g[int(size(__g) div 2)]) / 2"))).drop("__g")


def demanding(docs: DataFrame, least_words: int = 20, words_per_sentence: float = 18, chars_per_word: float = 5.8) -> DataFrame:
    """``(doc_id)`` of texts with long sentences of long words."""
    r = reading_levels(docs, "doc_id", "text", "lang")
    return r.filter((F.col("n_words") >= least_words) & (F.col("n_words") >= words_per_sentence * F.col("n_sentences")) & (F.col("n_chars") >= chars_per_word * F.col("n_words"))).select("doc_id").distinct()


def level_profile(docs: DataFrame, band: int = 2) -> DataFrame:
    """``(lang, grade_from, docs, words)``: the corpus by language and grade band (``grade_from`` null without words)."""
    r = reading_levels(docs, "doc_id", "text", "lang").withColumn("grade_from", (F.floor(F.col("grade") / band) * band).cast("bigint"))
    return r.groupBy("lang", "grade_from").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_words").alias("words"))
