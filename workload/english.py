"""English text analysis in SQL for DuckDB: runs, tokens, stop words, Porter2 stems.

Written from the published description of the algorithm, with regions as
positions, and independent of the library's own expressions.
"""

from __future__ import annotations

# Replacements of steps 2 and 3 and suffixes of step 4, as published.
STEP_2 = (
    "tional>tion enci>ence anci>ance abli>able entli>ent izer>ize ization>ize ational>ate ation>ate ator>ate alism>al "
    "aliti>al alli>al fulness>ful ousli>ous ousness>ous iveness>ive iviti>ive biliti>ble bli>ble ogi>og fulli>ful "
    "lessli>less li>"
)
STEP_3 = "tional>tion ational>ate alize>al icate>ic iciti>ic ical>ic ful> ness> ative>"
STEP_4 = "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion"
# Words with stems of their own.
SPECIAL = (
    "skis>ski skies>sky dying>die lying>lie tying>tie idly>idl gently>gentl ugly>ugli early>earli only>onli "
    "singly>singl sky>sky news>news howe>howe atlas>atlas cosmos>cosmos bias>bias andes>andes"
)
KEPT = "inning outing canning herring earring proceed exceed succeed"

_RUN = r"/?[\p{L}\p{N}]+(?:(?:[._-]*/[._-]*|_+|[-.@+])[\p{L}\p{N}]+)*"
_PAIR = "[^aeiouy]*[aeiouy]+[^aeiouy]"


def _special() -> dict[str, str]:
    pairs = dict(p.split(">") for p in SPECIAL.split())
    for w in KEPT.split():
        pairs[w] = pairs[f"{w}s"] = w
    return pairs


def _replaced(pairs: str) -> str:
    """The new ending for the suffix ``s``."""
    return "CASE s " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in (p.split(">") for p in pairs.split())) + " END"


def _ending(pairs: str) -> str:
    """The longest suffix that ``w`` ends in: the leftmost match that reaches the end."""
    return f"regexp_extract(w, '(?:{'|'.join(p.split('>')[0] for p in pairs.split())})$')"


def stems(source: str) -> str:
    """CTEs that end in ``stems(t, stem)`` for the distinct tokens ``t`` of table ``source``."""
    special = _special()
    listed = ", ".join(f"'{w}'" for w in special)
    cases = " ".join(f"WHEN '{w}' THEN '{s}'" for w, s in special.items())
    return rf"""
plain AS (
    SELECT t, regexp_replace(regexp_replace(regexp_replace(t, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g'),
        '([aeiouy])y', '\1Y', 'g') AS w
    FROM (SELECT DISTINCT t FROM {source}) WHERE length(t) >= 3 AND regexp_matches(t, '^[\p{{L}}]+$') AND t NOT IN ({listed})
), first_region AS (
    SELECT t, w, CASE WHEN regexp_matches(w, '^(?:gener|commun|arsen)')
            THEN length(regexp_extract(w, '^(?:gener|commun|arsen)'))
            WHEN regexp_matches(w, '^{_PAIR}') THEN length(regexp_extract(w, '^{_PAIR}'))
            ELSE length(w) END AS p1 FROM plain
), regions AS (
    SELECT t, w, p1, CASE WHEN regexp_matches(substr(w, p1 + 1), '^{_PAIR}')
        THEN p1 + length(regexp_extract(substr(w, p1 + 1), '^{_PAIR}')) ELSE length(w) END AS p2 FROM first_region
), step_1a AS (
    SELECT t, p1, p2, CASE WHEN right(w, 4) = 'sses' THEN left(w, -2)
        WHEN right(w, 3) IN ('ied', 'ies') THEN left(w, CASE WHEN length(w) > 4 THEN -2 ELSE -1 END)
        WHEN right(w, 2) IN ('us', 'ss') THEN w
        WHEN regexp_matches(w, '[aeiouy].+s$') THEN left(w, -1) ELSE w END AS w FROM regions
), step_1b AS (
    SELECT t, p1, p2, w, s, left(w, length(w) - length(s)) AS stem
    FROM (SELECT *, regexp_extract(w, '(?:eedly|eed|ingly|edly|ing|ed)$') AS s FROM step_1a)
), step_1c AS (
    SELECT t, p1, p2, CASE
        WHEN s = '' THEN w
        WHEN s IN ('eed', 'eedly') THEN CASE WHEN length(stem) >= p1 THEN stem || 'ee' ELSE w END
        WHEN NOT regexp_matches(stem, '[aeiouy]') THEN w
        WHEN right(stem, 2) IN ('at', 'bl', 'iz') THEN stem || 'e'
        WHEN regexp_matches(stem, '^(?:[^aeiouy]+[aeiouy][^aeiouywxY]|[aeiouy][^aeiouy])$') THEN stem || 'e'
        WHEN right(stem, 2) IN ('bb', 'dd', 'ff', 'gg', 'mm', 'nn', 'pp', 'rr', 'tt') THEN left(stem, -1)
        ELSE stem END AS w FROM step_1b
), step_2 AS (
    SELECT t, p1, p2, w, {_ending(STEP_2)} AS s
    FROM (SELECT t, p1, p2, CASE WHEN regexp_matches(w, '.[^aeiouy][yY]$') THEN left(w, -1) || 'i' ELSE w END AS w
          FROM step_1c)
), step_3 AS (
    SELECT t, p1, p2, w, {_ending(STEP_3)} AS s
    FROM (SELECT t, p1, p2, CASE WHEN s = '' OR length(w) - length(s) < p1 THEN w
              WHEN s = 'ogi' AND NOT regexp_matches(w, 'logi$') THEN w
              WHEN s = 'li' AND NOT regexp_matches(w, '[cdeghkmnrt]li$') THEN w
              ELSE left(w, length(w) - length(s)) || {_replaced(STEP_2)} END AS w FROM step_2)
), step_4 AS (
    SELECT t, p1, p2, w, {_ending(STEP_4.replace(' ', '> ') + '>')} AS s
    FROM (SELECT t, p1, p2, CASE WHEN s = '' OR length(w) - length(s) < p1 THEN w
              WHEN s = 'ative' AND length(w) - length(s) < p2 THEN w
              ELSE left(w, length(w) - length(s)) || {_replaced(STEP_3)} END AS w FROM step_3)
), step_5 AS (
    SELECT t, p1, p2, CASE WHEN s = '' OR length(w) - length(s) < p2 THEN w
        WHEN s = 'ion' AND NOT regexp_matches(w, '[st]ion$') THEN w
        ELSE left(w, length(w) - length(s)) END AS w FROM step_4
), stemmed AS (
    SELECT t, replace(CASE
        WHEN right(w, 1) = 'e' AND (length(w) - 1 >= p2 OR length(w) - 1 >= p1 AND NOT regexp_matches(
            w, '(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])e$')) THEN left(w, -1)
        WHEN right(w, 2) = 'll' AND length(w) - 1 >= p2 THEN left(w, -1) ELSE w END, 'Y', 'y') AS stem FROM step_5
), stems AS (
    SELECT t, stem FROM stemmed
    UNION ALL
    SELECT t, CASE t {cases} ELSE t END FROM (SELECT DISTINCT t FROM {source}) WHERE t NOT IN (SELECT t FROM plain)
)"""


def tokens(source: str, key: str, text: str) -> str:
    """A CTE ``tokens(key, t, pos)``: slash paths, addresses and dotted names whole, compounds with their parts."""
    return rf"""
tokens AS (
    SELECT {key}, unnest(found) AS t, generate_subscripts(found, 1) AS pos FROM (
        SELECT {key}, flatten(list_transform(regexp_extract_all(lower({text}), '{_RUN}'), lambda r:
            CASE WHEN contains(r, '/') OR contains(r, '@') OR NOT regexp_matches(r, '[_+-]') THEN [r]
            ELSE flatten(list_transform(string_split_regex(r, '[_+]+'), lambda k:
                CASE WHEN contains(k, '-') AND NOT contains(k, '.') THEN list_prepend(k, string_split(k, '-'))
                ELSE [k] END)) END)) AS found
        FROM {source}))"""


# The classes of markup-aware analysis, in the order in which they are tried.
_W = r"[\p{L}\p{N}]+"
_NAME = rf"{_W}(?:[._-]+{_W})*"
_HOST = r"(?:[a-z0-9][a-z0-9_-]*\.)+[a-z]{2,}(?::[0-9]+)?"
_IGNORED = (
    r"<(?:script|style)\b[^<>]*>(?s:.*?)(?:</(?:script|style)\b[^<>]*>|\z)|<!--(?s:.*?)(?:-->|\z)|<[/!?]?[a-z][^<>]*>"
    r"|&(?:#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]*);"
)
_ADDRESS = rf"{_HOST}/[!#-;=?-\[\]_a-z~]*|[a-z][a-z0-9]*://|{_W}(?:[._+-]{_W})*@{_W}(?:[.-]{_W})*"
_PATH = rf"/{_NAME}(?:[._-]*/[._-]*{_NAME})*|{_NAME}(?:[._-]*/[._-]*{_NAME})+"
_NUMBER = r"[-+][0-9]+(?:\.[0-9]+)?(?:e[-+]?[0-9]+)?|[0-9]+(?:\.[0-9]+)?e[-+][0-9]+"
_PLAIN = rf"{_W}(?:(?:_+|\.){_W}|-[0-9]*\p{{L}}[\p{{L}}\p{{N}}]*|-[0-9]+\.[0-9]*\p{{L}}[\p{{L}}\p{{N}}]*)*"


def markup_tokens(source: str, key: str, text: str) -> str:
    """A CTE ``tokens(key, t, pos)`` without tags and entities, URLs with host and path, numbers with signs."""
    classes = "|".join((_IGNORED, _ADDRESS, _PATH, _NUMBER, _PLAIN))
    return rf"""
tokens AS (
    SELECT {key}, unnest(found) AS t, generate_subscripts(found, 1) AS pos FROM (
        SELECT {key}, list_filter(flatten(list_transform(regexp_extract_all(lower({text}), '{classes}'), lambda r:
            CASE WHEN starts_with(r, '<') OR starts_with(r, '&') OR ends_with(r, '://') THEN []
            WHEN regexp_matches(r, '^{_HOST}/')
                THEN [r, left(r, strpos(r, '/') - 1), substr(r, strpos(r, '/'))]
            WHEN regexp_matches(r, '[/@]|^[-+]|^[0-9.]+e[-+]') THEN [r]
            ELSE flatten(list_transform(string_split_regex(r, '_+'), lambda k:
                CASE WHEN contains(k, '-') AND NOT contains(k, '.') THEN list_prepend(k, string_split(k, '-'))
                ELSE [k] END)) END)), lambda t: strlen(t) <= 2047) AS found
        FROM {source}))"""
