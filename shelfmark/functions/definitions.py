"""Finding function definitions in one Python file's text, as a SQL expression.

A file is one row, so everything here stays inside the row: literals and
comments are masked by equally long filler, then one fold over the lines
collects the definitions. No shuffle is needed before they are exploded.
"""

from __future__ import annotations

from shelfmark.functions.sqltext import let, raw

# Tokens that tile a text: literals, comments, and what lies between. Possessive
# quantifiers keep long literals off the matcher's stack.
_PY_TOKENS = "|".join(
    (
        r'\"\"\"[^\"\\]*+(?:(?:\\[\s\S]|\"(?!\"\"))[^\"\\]*+)*+\"\"\"',
        r"\x27\x27\x27[^\x27\\]*+(?:(?:\\[\s\S]|\x27(?!\x27\x27))[^\x27\\]*+)*+\x27\x27\x27",
        r"\"[^\"\\\n]*+(?:\\[\s\S][^\"\\\n]*+)*+\"",
        r"\x27[^\x27\\\n]*+(?:\\[\s\S][^\x27\\\n]*+)*+\x27",
        r"#[^\n]*+",
        r"[^\"\x27#]++",
        r"[\"\x27]",
    )
)


def masked_sql(text: str, tokens: str) -> str:
    """``text`` with comments blanked and each literal as S + filler (U+0001).

    Lengths and line ends are kept, so positions hold for the original text.
    """
    def fill(with_: str) -> str:
        """Every line of token ``m`` as filler of its length."""
        return (
            f"if(instr(m, '\\n') = 0, repeat({with_}, length(m)), array_join(transform("
            f"split(m, '\\n', -1), l -> repeat({with_}, length(l))), '\\n'))"
        )

    mask = (
        f"CASE WHEN left(m, 1) = '#' THEN {fill("' '")} "
        f"WHEN length(m) > 1 AND left(m, 1) IN ('\"', '\\'') "
        f"THEN concat('S', substr({fill('char(1)')}, 2)) ELSE m END"
    )
    return (
        f"array_join(transform(regexp_extract_all({text}, {raw(tokens)}, 0), m -> {mask}), '')"
    )


def _brackets(text: str) -> str:
    return f"regexp_replace({text}, {raw('[^()\\[\\]{}]++')}, '')"


def _balance(brackets: str, opening: str, closing: str, others: str = "") -> str:
    """Opening minus closing signs in a text of brackets only."""
    return (
        f"(length(translate({brackets}, '{closing}{others}', '')) "
        f"- length(translate({brackets}, '{opening}{others}', '')))"
    )


def python_definitions_sql(text: str) -> str:
    """Top-level functions and direct methods of top-level classes."""
    name = raw(r"^[ \t]*(?:async[ \t]+)?def[ \t]+([\p{L}_][\p{L}\p{N}_]*)")
    features = (
        f"filter(transform(split({masked_sql(text, _PY_TOKENS)}, '\\n', -1), (l, i) -> named_struct("
        "'n', i + 1, "
        "'cut', length(trim(TRAILING concat(' \\t\\r', char(12)) FROM l)), "
        "'indent', length(l) - length(trim(LEADING ' \\t' FROM l)), "
        "'inside', left(l, 1) = char(1), "
        f"'delta', {let('b', _brackets('l'), _balance('b', '([{', ')]}'))}, "
        "'joined', substr(l, -1) = '\\\\' OR substr(l, -2) = '\\\\\\r', "
        f"'name', if(instr(l, 'def') > 0, regexp_extract(l, {name}, 1), ''), "
        f"'class', left(l, 5) = 'class' AND l RLIKE {raw('^class\\b')})), f -> f.cut > 0)"
    )
    open_type = "struct<name:string,line:int,col:int>"
    found_type = "struct<name:string,line:int,col:int,last:int,cut:int>"

    def state(depth, joined, cls, opened, done, last="f.n", cut="f.cut") -> str:
        return (
            f"named_struct('depth', {depth}, 'joined', {joined}, 'cls', {cls}, "
            f"'opened', {opened}, 'done', {done}, 'last', {last}, 'cut', {cut})"
        )

    finished = (
        "concat(a.done, array(named_struct('name', a.opened.name, 'line', a.opened.line, "
        "'col', a.opened.col, 'last', a.last, 'cut', a.cut)))"
    )
    # cls: 0 outside a class body, -1 before its first line, else its indent.
    cls = "CASE WHEN f.indent = 0 THEN if(f.class, -1, 0) WHEN a.cls = -1 THEN f.indent ELSE a.cls END"
    ends = "(a.opened IS NOT NULL AND f.indent <= a.opened.col)"
    starts = f"(f.name <> '' AND (f.indent = 0 OR f.indent = {cls}))"
    opened = (
        f"CASE WHEN {starts} THEN named_struct('name', f.name, 'line', f.n, 'col', f.indent) "
        f"WHEN {ends} THEN cast(NULL AS {open_type}) ELSE a.opened END"
    )
    merge = (
        "if(a.depth > 0 OR a.joined OR f.inside, "
        + state("greatest(a.depth + f.delta, 0)", "f.joined", "a.cls", "a.opened", "a.done")
        + ", "
        + state(
            "greatest(f.delta, 0)", "f.joined", cls, opened, f"if({ends}, {finished}, a.done)"
        )
        + ")"
    )
    start = state(
        "0", "false", "0", f"cast(NULL AS {open_type})",
        f"cast(array() AS array<{found_type}>)", "0", "0",
    )
    found = (
        f"aggregate({features}, {start}, (a, f) -> {merge}, "
        f"a -> if(a.opened IS NULL, a.done, {finished}))"
    )
    joined = "array_join(slice(lines, d.line, d.last - d.line + 1), '\\n')"
    body = (
        f"substr({joined}, d.col + 1, "
        f"length({joined}) - d.col - (length(element_at(lines, d.last)) - d.cut))"
    )
    return let(
        "lines", f"split({text}, '\\n', -1)",
        _with_bodies(
            f"transform({found}, d -> named_struct('name', d.name, 'start_line', d.line, "
            f"'end_line', d.last, 'body', {body}))"
        ),
    )


def _with_bodies(found: str) -> str:
    """Add signature and checksum to structs that hold a body."""
    first_line = f"regexp_replace(substring_index(d.body, '\\n', 1), {raw('\\s+$')}, '')"
    return (
        f"transform({found}, d -> named_struct('name', d.name, 'signature', {first_line}, "
        "'start_line', d.start_line, 'end_line', d.end_line, 'body', d.body, "
        "'checksum', sha2(d.body, 256)))"
    )
