"""English text analysis as column expressions: tokens, stop words and the published Porter2 stemming rules.

A stemming step is one CASE over suffixes, longest first; each step binds its input once and hands its result to the next.
Everything runs in the JVM, no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import bind

# The common English stop-word list used by full-text configurations.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it "
    "its itself they them their theirs themselves what which who whom this that these those am is are was were be been "
    "being have has had having do does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most other some such no nor not only own same so "
    "than too very s t can will just don should now"
).split()

# Porter2 (English Snowball) rules as (suffix, replacement), longest suffix first within a step.
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
KEPT_AFTER_PLURAL = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
DERIVED_IN_R1 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"),
    ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"),
    ("fulli", "ful"),
    ("enci", "ence"), ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"),
    ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
ADJECTIVAL_IN_R1 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""),
    ("ical", "ic"), ("ness", ""), ("ful", ""),
)
DROPPED_IN_R2 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al",
    "er", "ic",
)

_V, _C = "[aeiouy]", "[^aeiouy]"
_R1 = rf"^(?:gener|commun|arsen|(?!gener|commun|arsen).*?{_V}{_C})"
_R2 = rf"{_R1}.*?{_V}{_C}"
_SHORT_END = rf"(?:{_C}{_V}[^aeiouywxY]|^{_V}{_C})$"


def _cut(c: Column, suffix: str, replacement: str) -> Column:
    return F.regexp_replace(c, suffix + "$", replacement)


def _by_suffix(c: Column, cases: list[tuple[str, Column, Column]]) -> Column:
    """First matching suffix decides; if its condition fails the word stays as it is."""
    chain = None
    for suffix, condition, result in cases:
        branch = F.when(condition, result).otherwise(c)
        matches = c.endswith(suffix)
        chain = F.when(matches, branch) if chain is None else chain.when(matches, branch)
    return chain.otherwise(c)


def _plural(c: Column) -> Column:
    yes = F.lit(True)
    short_ie = F.when(c.rlike("^..+ie[sd]$"), _cut(c, "ie[sd]", "i")).otherwise(_cut(c, "ie[sd]", "ie"))
    return _by_suffix(c, [
        ("sses", yes, _cut(c, "sses", "ss")), ("ied", yes, short_ie), ("ies", yes, short_ie),
        ("us", yes, c), ("ss", yes, c), ("s", c.rlike(f"{_V}.+s$"), _cut(c, "s", "")),
    ])


def _repair(c: Column) -> Column:
    """After removing -ed/-ing: restore a final e or undo a doubled consonant."""
    return (
        F.when(c.rlike("(?:at|bl|iz)$"), F.concat(c, F.lit("e")))
        .when(c.rlike(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), F.regexp_replace(c, ".$", ""))
        .when(c.rlike(_SHORT_END) & ~c.rlike(_R1 + "."), F.concat(c, F.lit("e")))
        .otherwise(c)
    )


def _has_vowel_before(c: Column, suffix: str) -> Column:
    return c.rlike(f"{_V}.*{suffix}$")


def _in(region: str, c: Column, suffix: str, before: str = "") -> Column:
    return c.rlike(f"{region}.*(?<={before}){suffix}$" if before else f"{region}.*{suffix}$")


def _past(c: Column) -> Column:
    cases = [("eedly", _in(_R1, c, "eedly"), _cut(c, "eedly", "ee"))]
    for suffix in ("ingly", "edly", "eed", "ing", "ed"):
        if suffix == "eed":
            cases.append((suffix, _in(_R1, c, suffix), _cut(c, suffix, "ee")))
        else:
            cases.append((suffix, _has_vowel_before(c, suffix), F.concat(F.lit("\u0001"), _cut(c, suffix, ""))))
    return _by_suffix(c, cases)


def _derived(c: Column) -> Column:
    before = {"ogi": "l", "li": "[cdeghkmnrt]"}
    return _by_suffix(c, [(s, _in(_R1, c, s, before.get(s, "")), _cut(c, s, r)) for s, r in DERIVED_IN_R1])


def _adjectival(c: Column) -> Column:
    return _by_suffix(
        c, [(s, _in(_R2 if s == "ative" else _R1, c, s), _cut(c, s, r)) for s, r in ADJECTIVAL_IN_R1]
    )


def _dropped(c: Column) -> Column:
    return _by_suffix(c, [(s, _in(_R2, c, s, "[st]" if s == "ion" else ""), _cut(c, s, "")) for s in DROPPED_IN_R2])


def _final(c: Column) -> Column:
    drop_e = _in(_R2, c, "e") | (_in(_R1, c, "e") & ~_cut(c, "e", "").rlike(_SHORT_END))
    return _by_suffix(c, [("e", drop_e, _cut(c, "e", "")), ("l", _in(_R2, c, "l", "l"), _cut(c, "l", ""))])


def _after_plural(word: Column) -> Column:
    past = bind(
        bind(word, _past),
        lambda c: F.when(c.startswith("\u0001"), bind(F.regexp_replace(c, "^\u0001", ""), _repair)).otherwise(c),
    )
    out = F.regexp_replace(past, f"(?<=.{_C})[yY]$", "i")
    for step in (_derived, _adjectival, _dropped, _final):
        out = bind(out, step)
    return out


def stem_word(term: Column) -> Column:
    """The stem of one lower-case word."""
    marked = F.regexp_replace(term, r"^y|(?<=[aeiouy])y", "Y")
    whole = F.create_map(*[F.lit(x) for pair in WHOLE_WORDS.items() for x in pair])
    stemmed = bind(bind(marked, _plural), lambda c: F.when(c.isin(*KEPT_AFTER_PLURAL), c).otherwise(_after_plural(c)))
    return (
        F.when(F.length(term) <= 2, term).when(term.isin(*WHOLE_WORDS), F.element_at(whole, term))
        .otherwise(F.translate(stemmed, "Y", "y"))
    )


def stem(df: DataFrame, term: str = "term") -> DataFrame:
    """Replace `term` by its stem."""
    return df.withColumn(term, stem_word(F.col(term)))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def positioned(text: Column, weight: float, stop_words: bool = True) -> Column:
    """array<struct<term, pos, weight>>; stop words are left out but still take a position."""
    placed = F.transform(
        tokens(text), lambda t, i: F.struct(t.alias("term"), (i + 1).alias("pos"), F.lit(weight).alias("weight"))
    )
    return F.filter(placed, lambda x: ~x.term.isin(*STOP_WORDS)) if stop_words else placed


def append_positions(first: Column, second: Column) -> Column:
    """Concatenate two positioned arrays, the second starting after the last kept position of the first."""
    shift = F.coalesce(F.array_max(F.transform(first, lambda x: x.pos)), F.lit(0))
    moved = F.transform(second, lambda x: F.struct(x.term.alias("term"), (x.pos + shift).alias("pos"), x.weight.alias("weight")))
    return F.concat(first, moved)
