"""English Snowball (Porter2) stemming of a token array, as one SQL expression.

Each step is a ``transform`` over the array of words, so a step's input is its
lambda variable and is evaluated once. Whether a suffix lies in one of the two
regions is asked of the part before it: region one starts after the first vowel
and consonant pair, region two after the next one. A word that is not to be
stemmed travels as an empty string.
"""

from __future__ import annotations

from shelfmark.functions.fixed_values import (
    STEM_EXCEPTIONS,
    STEM_STEP_2,
    STEM_STEP_3,
    STEM_STEP_4,
    STEM_STOPS_AFTER_PLURAL,
)
from shelfmark.functions.sqltext import let, raw

# Up to the first vowel and consonant pair. Possessive, so that long words take linear time.
_PAIR = "[^aeiouy]*+[aeiouy]++[^aeiouy]"
# Beginnings after which region one starts at once.
_SPECIAL = "gener|commun|arsen"
_START = f"(?:(?:{_SPECIAL})|(?!{_SPECIAL}){_PAIR})"
_REGION_1 = f"{_START}.*?"
_REGION_2 = f"{_START}{_PAIR}.*?"
# Ends in a short syllable. A capital Y stands for a consonant y.
_SHORT_END = "(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])"
_SHORT_WORD = "^(?:[^aeiouy]+[aeiouy][^aeiouywxY]|[aeiouy][^aeiouy])"


def _map(pairs: dict[str, str]) -> str:
    return "map(" + ", ".join(f"'{k}', '{v}'" for k, v in pairs.items()) + ")"


def _each(words: str, changed: str) -> str:
    return f"transform({words}, w -> {changed})"


def _cut(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _ends_like(suffixes) -> str:
    """A quick test by the last two letters, before a pattern is tried."""
    endings = ", ".join(f"'{e}'" for e in sorted({s[-2:] for s in suffixes}))
    return f"substr(w, -2) IN ({endings})"


def _replace_suffix(words: str, pairs: dict[str, str], conditions: dict[str, str]) -> str:
    """Replace the longest suffix of ``pairs`` if it lies in region one.

    ``conditions`` maps a suffix to a pattern the whole word has to match too.
    """
    suffix = "(" + "|".join(pairs) + ")$"
    extra = "".join(f" AND (s <> '{s}' OR w RLIKE {raw(p)})" for s, p in conditions.items())
    replaced = let(
        "s", f"regexp_extract(w, {raw(suffix)}, 1)",
        f"if(left(w, length(w) - length(s)) RLIKE {raw('^' + _REGION_1)}{extra}, "
        f"concat(left(w, length(w) - length(s)), element_at({_map(pairs)}, s)), w)",
    )
    return _each(words, f"if({_ends_like(pairs)} AND w RLIKE {raw(suffix)}, {replaced}, w)")


def stems_sql(tokens: str) -> str:
    """Stem every plain word of ``tokens``; other tokens pass unchanged."""
    unchanged = {w: w for w in STEM_STOPS_AFTER_PLURAL}
    plural = {w + "s": w for w in STEM_STOPS_AFTER_PLURAL}
    known = _map({**STEM_EXCEPTIONS, **unchanged, **plural})
    known_list = ", ".join(f"'{w}'" for w in {**STEM_EXCEPTIONS, **unchanged, **plural})
    # A y at the start or after a vowel is a consonant. Twice, as in "yyy".
    after_vowel = raw("([aeiouy])y")
    marked = (
        f"regexp_replace(regexp_replace(regexp_replace(w, '^y', 'Y'), {after_vowel}, '$1Y'), "
        f"{after_vowel}, '$1Y')"
    )
    t = _each(
        "tokens",
        f"CASE WHEN length(w) < 3 OR NOT w RLIKE {raw('^[\\p{L}]+$')} "
        f"OR w IN ({known_list}) THEN '' WHEN instr(w, 'y') > 0 THEN {marked} ELSE w END",
    )
    # Step 1a: plurals.
    t = _each(t, (
        f"CASE WHEN substr(w, -3) IN ('ied', 'ies') THEN if(length(w) > 4, {_cut(2)}, {_cut(1)}) "
        "WHEN substr(w, -1) <> 's' OR substr(w, -2) IN ('us', 'ss') THEN w "
        f"WHEN substr(w, -4) = 'sses' THEN {_cut(2)} "
        f"WHEN w RLIKE {raw('[aeiouy].+s$')} THEN {_cut(1)} ELSE w END"
    ))
    # Step 1b: past and participle endings; a "!" marks stems to repair.
    t = _each(t, (
        f"CASE WHEN NOT {_ends_like(('ed', 'ing', 'ly'))} "
        f"OR NOT w RLIKE {raw('(?:ed|ing)(?:ly)?$')} THEN w "
        f"WHEN w RLIKE {raw('eed(?:ly)?$')} THEN "
        f"regexp_replace(w, {raw(f'^({_REGION_1})eed(?:ly)?$')}, '$1ee') "
        f"ELSE regexp_replace(w, {raw('^(.*[aeiouy].*)(?:ed|ing)(?:ly)?$')}, '$1!') END"
    ))
    t = _each(t, (
        "CASE WHEN substr(w, -1) <> '!' THEN w "
        f"WHEN substr(w, -3) IN ('at!', 'bl!', 'iz!') OR w RLIKE {raw(_SHORT_WORD + '!$')} "
        f"THEN concat({_cut(1)}, 'e') "
        f"WHEN w RLIKE {raw('(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)!$')} THEN {_cut(2)} "
        f"ELSE {_cut(1)} END"
    ))
    # Step 1c.
    t = _each(t, f"if(substr(w, -1) IN ('y', 'Y') AND w RLIKE {raw('.[^aeiouy][yY]$')}, concat({_cut(1)}, 'i'), w)")
    t = _replace_suffix(t, STEM_STEP_2, {"ogi": "logi$", "li": "[cdeghkmnrt]li$"})
    t = _replace_suffix(t, STEM_STEP_3, {"ative": f"^{_REGION_2}ative$"})
    # Step 4. The look-behinds let only the longest of ement, ment, ent count.
    guarded = {"ment": "(?<!e)ment", "ent": "(?<!m)ent", "ion": "(?<=[st])ion"}
    removed = "|".join(guarded.get(s, s) for s in STEM_STEP_4)
    t = _each(t, (
        f"if({_ends_like(STEM_STEP_4)} AND w RLIKE {raw(f'(?:{removed})$')}, "
        f"regexp_replace(w, {raw(f'^({_REGION_2})(?:{removed})$')}, '$1'), w)"
    ))
    # Step 5, and a marked y back to a plain one.
    t = _each(t, (
        "CASE WHEN substr(w, -1) = 'e' THEN "
        f"if(w RLIKE {raw(f'^{_REGION_2}e$')} OR (w RLIKE {raw(f'^{_REGION_1}e$')} "
        f"AND NOT w RLIKE {raw(_SHORT_END + 'e$')}), {_cut(1)}, w) "
        f"WHEN substr(w, -2) = 'll' AND w RLIKE {raw(f'^{_REGION_2}l$')} THEN {_cut(1)} ELSE w END"
    ))
    chosen = (
        f"CASE WHEN s <> '' THEN replace(s, 'Y', 'y') WHEN t IN ({known_list}) "
        f"THEN element_at({known}, t) ELSE t END"
    )
    return let("tokens", tokens, f"zip_with(tokens, {t}, (t, s) -> {chosen})")
