"""Text analysis and ranking as SQL expressions: lexemes, web queries, covers.

Shapes used throughout:

- lexemes: ``array<string>``; the element index is the word position, an empty
  string marks a stop word (it keeps its position, it is never matched).
- query: ``array<struct<alt, negated, phrase, terms, offsets>>``. Clauses with
  the same ``alt`` are and-ed, different ``alt`` values are or-ed.
- hits: ``array<struct<pos, term>>`` in position order, only query terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from shelfmark.functions.fixed_values import ENGLISH_STOP_WORDS
from shelfmark.functions.sqltext import let, raw, text_literal
from shelfmark.functions.stemming import stems_sql

QUERY_TYPE = (
    "array<struct<alt:int,negated:boolean,phrase:boolean,"
    "terms:array<string>,offsets:array<int>>>"
)

WORD = r"[\p{L}\p{N}]+"
# A run of words held together by single signs, underscores or slashes.
_RUN = (
    r"/?[\p{L}\p{N}]++(?:(?:[._-]*+/[._-]*+|_++|[-.@+])[\p{L}\p{N}]++)*+"
)
# Classes of the markup-aware analysis, tried in this order where a token may begin. All quantifiers are
# possessive, or lazy over single characters, so that no text takes more than linear time or a deep stack.
_W = r"[\p{L}\p{N}]++"
_HOST = r"(?:[a-z0-9][a-z0-9_-]*+\.)++[a-z]{2,}+(?::[0-9]++)?+"
_NAME = _W + r"(?:[._-]++" + _W + ")*+"
_CLASSES = "|".join((
    r"<(?:script|style)\b[^<>]*+>(?s:.*?)(?:</(?:script|style)\b[^<>]*+>|\z)",
    r"<!--(?s:.*?)(?:-->|\z)",
    r"<[/!?]?[a-z][^<>]*+>",
    r"&(?:#[0-9]++|#x[0-9a-f]++|[a-z][a-z0-9]*+);",
    _HOST + r"/[!#-;=?-\[\]_a-z~]*+",
    r"[a-z][a-z0-9]*+://",
    _W + r"(?:[._+-]" + _W + ")*+@" + _W + r"(?:[.-]" + _W + ")*+",
    "/" + _NAME + r"(?:[._-]*+/[._-]*+" + _NAME + ")*+",
    _NAME + r"(?:[._-]*+/[._-]*+" + _NAME + ")++",
    r"[-+][0-9]++(?:\.[0-9]++)?+(?:e[-+]?[0-9]++)?+",
    r"[0-9]++(?:\.[0-9]++)?+e[-+][0-9]++",
    _W + r"(?:(?:_++|\.)" + _W + r"|-[0-9]*+\p{L}[\p{L}\p{N}]*+|-[0-9]++\.[0-9]*+\p{L}[\p{L}\p{N}]*+)*+",
))
#: Longer words, in bytes, are not indexed.
LONGEST_WORD = 2047


@dataclass(frozen=True)
class Analyzer:
    """How text becomes lexemes. The default follows English text search."""

    stemmer: str = "porter2"  # or "none"
    path_mode: str = "whole"  # or "split": every run of letters and digits is a word
    stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS
    #: Tags, entities and protocols are no words, a URL is followed by its host and path, numbers keep their sign.
    markup: bool = False

    def __post_init__(self) -> None:
        if self.stemmer not in ("porter2", "none"):
            raise ValueError(f"unknown stemmer {self.stemmer!r}")
        if self.path_mode not in ("whole", "split"):
            raise ValueError(f"unknown path mode {self.path_mode!r}")
        if self.markup and self.path_mode != "whole":
            raise ValueError("markup is told apart where paths are whole")


ENGLISH = Analyzer()
PLAIN = Analyzer(stemmer="none", path_mode="split")
MARKUP = Analyzer(markup=True)


def tokens_sql(text: str, analyzer: Analyzer = ENGLISH) -> str:
    """Lower-cased tokens of ``text`` in order."""
    lowered = f"lower({text})"
    if analyzer.path_mode == "split":
        return f"regexp_extract_all({lowered}, {raw(WORD)}, 0)"
    if analyzer.markup:
        return _markup_tokens_sql(lowered)
    # A slash path, an address and a dotted name are one token each. Underscores
    # separate. A hyphenated compound is followed by its parts.
    runs = f"regexp_extract_all({lowered}, {raw(_RUN)}, 0)"
    parts = (
        "transform(split(r, '[_+]+'), "
        "k -> if(instr(k, '-') > 0 AND instr(k, '.') = 0, concat(array(k), split(k, '-')), array(k)))"
    )
    return (
        f"flatten(transform({runs}, r -> CASE WHEN instr(r, '/') > 0 OR instr(r, '@') > 0 "
        f"OR NOT r RLIKE '[_+-]' THEN array(r) ELSE flatten({parts}) END))"
    )


def _markup_tokens_sql(lowered: str) -> str:
    """Tokens of a text with markup, by the class of each match.

    A tag ends at the first ``>``; what lies in a script or style element goes with
    it. A hyphen before digits alone is the sign of a number.
    """
    compound = "if(instr(k, '-') > 0 AND instr(k, '.') = 0, concat(array(k), split(k, '-')), array(k))"
    url = "array(r, regexp_extract(r, '^[^/]+', 0), regexp_extract(r, '/.*$', 0))"
    by_class = (
        "CASE WHEN r RLIKE '^[<&]' OR endswith(r, '://') THEN cast(array() AS array<string>) "
        f"WHEN r RLIKE {raw('^' + _HOST + '/')} THEN {url} "
        f"WHEN r RLIKE {raw(r'[/@]|^[-+]|^[0-9.]++e[-+]')} THEN array(r) "
        f"ELSE flatten(transform(split(r, '_+'), k -> {compound})) END"
    )
    return (
        f"filter(flatten(transform(regexp_extract_all({lowered}, {raw(_CLASSES)}, 0), r -> {by_class})), "
        f"t -> octet_length(t) <= {LONGEST_WORD})"
    )


def lexemes_sql(text: str, analyzer: Analyzer = ENGLISH) -> str:
    """The position-ordered lexemes of ``text``; NULL text gives NULL."""
    tokens = tokens_sql(text, analyzer)
    if analyzer.stop_words:
        stops = ", ".join(text_literal(w) for w in analyzer.stop_words)
        tokens = f"transform({tokens}, t -> if(t IN ({stops}), '', t))"
    return stems_sql(tokens) if analyzer.stemmer == "porter2" else tokens


def positions_sql(lexemes: str) -> str:
    """``array<struct<term, positions>>``: every word of ``lexemes`` with its positions in order.

    Words are sorted with their positions, and the array is cut where the word changes.
    """
    words = (
        f"sort_array(filter(transform({lexemes}, (t, i) -> named_struct('term', t, 'pos', i + 1)), w -> w.term <> ''))"
    )
    begins = (
        "filter(transform(words, (w, i) -> if(i > 0 AND get(words, i - 1).term = w.term, -1, i)), i -> i >= 0)"
    )
    cut = "slice(words, b + 1, coalesce(get(begins, k + 1), size(words)) - b)"
    return let("words", words, let("begins", begins, (
        "transform(begins, (b, k) -> named_struct('term', get(words, b).term, "
        f"'positions', transform({cut}, w -> w.pos)))"
    )))


def web_query_sql(text: str, analyzer: Analyzer = ENGLISH) -> str:
    """Clauses of a web-style query: words, ``or``, ``-word``, ``"a phrase"``.

    A word of several lexemes, such as ``get_user_name``, is a phrase of them.
    """
    pieces = f"""regexp_extract_all(coalesce({text}, ''), r'-?"[^"]*"?|[^\\s"]+', 0)"""
    numbered = (
        f"aggregate({pieces}, named_struct('alt', 0, 'parts', "
        "cast(array() AS array<struct<alt:int,part:string>>)), "
        "(a, p) -> if(lower(p) = 'or', named_struct('alt', a.alt + 1, 'parts', a.parts), "
        "named_struct('alt', a.alt, 'parts', "
        "concat(a.parts, array(named_struct('alt', a.alt, 'part', p))))), a -> a.parts)"
    )
    analysed = (
        f"transform({numbered}, p -> named_struct('alt', p.alt, "
        "'negated', p.part LIKE '-_%', 'quoted', instr(p.part, '\"') > 0, 'words', "
        f"filter(transform({lexemes_sql('p.part', analyzer)}, "
        "(t, i) -> named_struct('term', t, 'at', i)), t -> t.term <> '')))"
    )

    def clause(words: str, phrase: str) -> str:
        return (
            f"named_struct('alt', c.alt, 'negated', c.negated, 'phrase', {phrase}, "
            f"'terms', transform({words}, w -> w.term), "
            f"'offsets', transform({words}, w -> w.at - element_at({words}, 1).at))"
        )

    return (
        f"flatten(transform(filter({analysed}, c -> size(c.words) > 0), c -> "
        f"array({clause('c.words', 'c.quoted OR size(c.words) > 1')})))"
    )


def query_terms_sql(query: str) -> str:
    return f"array_distinct(flatten(transform({query}, c -> c.terms)))"


def _alternatives(query: str) -> str:
    return f"array_distinct(transform({query}, c -> c.alt))"


def can_match_sql(lexemes: str, query: str) -> str:
    """Cheap necessary condition: some alternative has all its wanted terms."""
    wanted = (
        f"exists({_alternatives(query)}, alt -> forall({query}, c -> c.alt <> alt OR c.negated "
        "OR forall(c.terms, t -> array_contains(words, t))))"
    )
    # Bound once, in case the lexemes are computed and not stored.
    return let("words", lexemes, wanted)


def hits_sql(lexemes: str, query: str) -> str:
    """Positions of the query terms in ``lexemes``."""
    return (
        f"filter(transform({lexemes}, (t, i) -> named_struct('pos', i + 1, 'term', t)), "
        f"h -> array_contains({query_terms_sql(query)}, h.term))"
    )


# A start is packed as position * PACK + number of hits up to it.
_PACK = "4294967296L"


def evaluate_sql(hits: str, query: str) -> str:
    """``struct<matched boolean, score double>`` of a document's hits.

    The score is the cover density: every minimal cover adds 0.1 / (1 + noise),
    noise being the positions inside the cover that are not hits. One pass over
    the hits keeps, per clause, the latest start of an occurrence; a cover ends
    where the earliest of these starts moves forward. Where one alternative of
    several excludes a word, an excluded one between covers matters as well: see
    ``_with_exclusions``.
    """
    lookback = "slice(hits, greatest(x.i - element_at(c.offsets, -1), 1), element_at(c.offsets, -1) + 1)"
    lookback_first = "greatest(x.i - element_at(c.offsets, -1), 1)"
    phrase_found = (
        f"forall(arrays_zip(c.terms, c.offsets), z -> exists({lookback}, "
        "g -> g.pos = x.pos - (element_at(c.offsets, -1) - z.offsets) AND g.term = z.terms))"
    )
    phrase_start = (
        f"(x.pos - element_at(c.offsets, -1)) * {_PACK} + {lookback_first} - 1 + "
        f"array_position(transform({lookback}, g -> g.pos), x.pos - element_at(c.offsets, -1))"
    )
    all_found = "forall(c.terms, t -> exists(hits, g -> g.term = t))"
    occurrence = (
        "CASE WHEN element_at(c.terms, -1) <> x.term THEN element_at(a.seen, k + 1).start "
        f"WHEN size(c.terms) = 1 THEN x.pos * {_PACK} + x.i "
        f"WHEN c.phrase AND {phrase_found} THEN {phrase_start} "
        f"WHEN NOT c.phrase AND {all_found} THEN x.pos * {_PACK} + x.i "
        "ELSE element_at(a.seen, k + 1).start END"
    )
    seen_now = (
        f"transform({query}, (c, k) -> named_struct('alt', c.alt, 'negated', c.negated, "
        f"'start', {occurrence}))"
    )
    earliest = "array_min(transform(filter(seen, s -> s.alt = alt AND NOT s.negated), s -> s.start))"
    def best(otherwise: str) -> str:
        """The latest start of a window that ends here and satisfies the query, 0 if none does."""
        return (
            f"coalesce(array_max(transform({_alternatives('seen')}, alt -> "
            + let(
                "m", f"coalesce({earliest}, {otherwise})",
                "if(exists(seen, s -> s.alt = alt AND s.negated AND s.start > 0 AND s.start >= m), 0L, m)",
            )
            + ")), 0L)"
        )

    noise = f"((x.pos - b div {_PACK}) - (x.i - b % {_PACK}))"
    merge = let(
        "seen", seen_now,
        let(
            "b", best("0L"),
            "named_struct('seen', seen, 'best', greatest(b, a.best), 'score', "
            f"a.score + if(b > a.best, 0.1D / (1 + {noise}), 0.0D))",
        ),
    )
    matched = (
        f"exists({_alternatives('a.seen')}, alt -> "
        "forall(a.seen, s -> s.alt <> alt OR (s.start > 0) <> s.negated))"
    )
    numbered = (
        "transform(hits, (h, i) -> named_struct('pos', cast(h.pos AS bigint), 'term', h.term, "
        "'i', cast(i + 1 AS bigint)))"
    )
    unseen = f"transform({query}, c -> named_struct('alt', c.alt, 'negated', c.negated, 'start', 0L))"
    fold = (
        f"aggregate({numbered}, named_struct('seen', {unseen}, 'best', 0L, 'score', 0.0D), "
        f"(a, x) -> {merge}, a -> named_struct('matched', {matched}, 'score', a.score))"
    )
    # Where a window that ends at a hit starts at the latest, of all hits.
    starts = (
        f"aggregate({numbered}, named_struct('seen', {unseen}, {_EMPTY}), "
        "(a, x) -> " + let("seen", seen_now, let(
            "b", best(f"x.pos * {_PACK} + x.i"), f"named_struct('seen', seen, {_appended('b')})")) + ", "
        f"a -> named_struct('matched', {matched}, 'all', {_GATHERED}))"
    )
    several = f"(exists({query}, c -> c.negated) AND size({_alternatives(query)}) > 1)"
    # Bound once: the fold looks back into the hits.
    return let("hits", hits, f"if({several}, {_with_exclusions(starts, numbered, query)}, {fold})")


# Arrays that a fold appends to, in chunks, so that long ones aren't copied for each value.
_EMPTY = "'done', cast(array() AS array<array<bigint>>), 'chunk', cast(array() AS array<bigint>)"
_GATHERED = "concat(flatten(a.done), a.chunk)"


def _appended(value: str) -> str:
    return (
        "'done', if(size(a.chunk) = 256, concat(a.done, array(a.chunk)), a.done), "
        f"'chunk', if(size(a.chunk) = 256, array({value}), concat(a.chunk, array({value})))"
    )


def _with_exclusions(starts: str, numbered: str, query: str) -> str:
    """Covers where an alternative that excludes is one of several.

    From each start, the next cover ends at the first hit up to which the query
    holds, whatever excluded words lie before the cover's own beginning; then it is
    cut at the front as far as the query holds still, and the search goes on behind
    its beginning. The ends are found in a pass from the last hit to the first,
    which keeps per clause the end of its next occurrence. Without an end nothing
    further counts.
    """
    never = "9223372036854775807L"
    ahead = "slice(hits, cast(x.i AS int), element_at(c.offsets, -1) + 1)"
    found = (
        f"forall(arrays_zip(c.terms, c.offsets), z -> exists({ahead}, "
        "g -> g.pos = x.pos + z.offsets AND g.term = z.terms))"
    )
    end = (
        f"x.i - 1 + array_position(transform({ahead}, g -> cast(g.pos AS bigint)), "
        "x.pos + element_at(c.offsets, -1))"
    )
    next_ends = (
        f"transform({query}, (c, k) -> named_struct('alt', c.alt, 'negated', c.negated, 'stop', "
        f"CASE WHEN element_at(c.terms, 1) = x.term AND {found} THEN {end} ELSE element_at(a.seen, k + 1).stop END))"
    )

    def stops(negated: str) -> str:
        return f"transform(filter(seen, s -> s.alt = alt AND {negated}), s -> s.stop)"

    satisfied = let(
        "m", f"coalesce(array_max({stops('NOT s.negated')}), x.i)",
        f"if(coalesce(array_min({stops('s.negated')}), {never}) > m, m, {never})",
    )
    ends = (
        f"reverse(aggregate(reverse({numbered}), named_struct('seen', transform({query}, c -> "
        f"named_struct('alt', c.alt, 'negated', c.negated, 'stop', {never})), {_EMPTY}), (a, x) -> "
        + let("seen", next_ends, "named_struct('seen', seen, " + _appended(
            f"array_min(transform({_alternatives('seen')}, alt -> {satisfied}))") + ")")
        + f", a -> {_GATHERED}))"
    )
    cover = let(
        "q", "cast(element_at(ends, cast(x.i AS int)) AS int)",
        let(
            "p", "element_at(starts.all, q)",
            f"named_struct('next', p % {_PACK} + 1, 'score', a.score + 0.1D / (1 + "
            f"(element_at(hits, q).pos - p div {_PACK}) - (q - p % {_PACK})))",
        ),
    )
    return let("starts", starts, let("ends", ends, (
        f"aggregate({numbered}, named_struct('next', 1L, 'score', 0.0D), (a, x) -> "
        f"CASE WHEN x.i <> a.next THEN a WHEN element_at(ends, cast(x.i AS int)) = {never} "
        f"THEN named_struct('next', {never}, 'score', a.score) ELSE {cover} END, "
        "a -> named_struct('matched', starts.matched, 'score', a.score))"
    )))


def query_literal(query) -> str:
    """A parsed query (rows of ``QUERY_TYPE``) as a SQL literal."""
    def clause(c) -> str:
        terms = ", ".join(text_literal(t) for t in c["terms"])
        offsets = ", ".join(str(o) for o in c["offsets"])
        return (
            f"named_struct('alt', {c['alt']}, 'negated', {str(c['negated']).lower()}, "
            f"'phrase', {str(c['phrase']).lower()}, 'terms', array({terms}), "
            f"'offsets', array({offsets}))"
        )

    if not query:
        return f"cast(array() AS {QUERY_TYPE})"
    return "array(" + ", ".join(clause(c) for c in query) + ")"
