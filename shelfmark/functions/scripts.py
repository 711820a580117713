"""Finding definitions in one JavaScript or TypeScript file, in one pass over its text.

The scan keeps the *head*: what stands at the present level since the last
statement ended, with everything inside brackets left out, so that the patterns
which tell definitions apart see short, flat text however long arguments,
decorators or literals are.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import functions as F, types as T

_TOKEN = re.compile(
    r"""//[^\n]*|/\*.*?(?:\*/|\Z)|"(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|[`()\[\]{};/]""", re.S
)
#: Text of a template literal, up to its end or to an expression in it.
_TEMPLATE = re.compile(r"(?:[^`\\$]|\\.|\$(?!\{))*+(?:`|\$\{|\Z)", re.S)
_REGEX = re.compile(r"/(?![/*])(?:[^/\\\n\[]|\\.|\[(?:[^\]\\\n]|\\.)*+\])++/")
# A slash after one of these begins a regular expression; so does one after a condition.
_BEFORE_REGEX = frozenset("=(,:;!&|?{}[+*%~^<>-")
_KEYWORDS_BEFORE_REGEX = frozenset(
    "return case typeof instanceof in of delete void do else throw yield await new".split())
_CONDITIONS = frozenset("if while for with".split())

_NAME = r"[^\W\d$][\w$]*|\$[\w$]*"
_DECORATORS = r"(?:@[\w.$]+(?:\(\))?\s*+)*+"
_FUNCTION = re.compile(rf"\s*((?:async\s+)?function\s+)({_NAME})\s*(?:<[^;(]*>\s*)?\(\)[^;]*\Z")
_CLASS = re.compile(rf"\s*{_DECORATORS}class\b[^;=]*\Z")
_METHOD = re.compile(
    rf"\s*({_DECORATORS})((?:(?:static|async|get|set|public|private|protected|override|readonly)\s+)*+(?:\*\s*)?)"
    rf"(#?(?:{_NAME})|S\x01|\[\]|\d[\w.]*)\??\s*(?:<[^(]*>\s*)?\(\)\s*(?::(?:[^=;]|=>)*)?\Z"
)
#: What may not stand before a statement: an operator or a keyword that goes on.
_UNFINISHED = re.compile(
    r"(?:[=(,\[:?&|+*/%<>!~^.-]|\b(?:export|default|return|new|await|typeof|void|declare|"
    r"abstract|extends|in|of|throw|yield))\s*\Z"
)
#: A brace after these opens a type literal, not a body.
_TYPE_BRACE = re.compile(r"(?:[:|&<,]|\b(?:extends|is|keyof|readonly))\s*\Z")


class _Head:
    """Flat text since the last reset, and where its chunks stand in the source."""

    def __init__(self, at: int):
        self.chunks: list[str] = []
        self.flat: list[int] = [0]
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.at = at

    def add(self, text: str, start: int, end: int) -> None:
        # Of blanks, only the first between two words counts.
        if text and not (text.isspace() and (not self.chunks or self.chunks[-1].endswith("\n"))):
            self.chunks.append(text)
            self.flat.append(self.flat[-1] + len(text))
            self.starts.append(start)
            self.ends.append(end)

    def tail(self) -> str:
        """The last characters; enough for a keyword and the blanks after it."""
        out = ""
        for chunk in reversed(self.chunks):
            out = chunk + out
            if out.strip():
                break
        return out

    def start_of(self, at: int) -> int:
        i = min(bisect_right(self.flat, at) - 1, len(self.starts) - 1)
        return self.starts[i] + at - self.flat[i]

    def end_of(self, at: int) -> int:
        i = bisect_left(self.flat, at) - 1
        return self.ends[i] if at == self.flat[i + 1] else self.starts[i] + at - self.flat[i]


_LINE_START = re.compile(r"^(?=[^\S\n]*\S)", re.M)


def _line_starts(flat: str) -> list[int]:
    """Where lines begin that aren't blank."""
    return [m.start() for m in _LINE_START.finditer(flat)]


def _nearest(pattern: re.Pattern, flat: str) -> re.Match | None:
    """The match to the end of ``flat`` from the last line start that has one."""
    for at in reversed(_line_starts(flat)):
        if found := pattern.match(flat, at):
            return found
    return None


def _method(flat: str) -> re.Match | None:
    """A method's head, with the decorators on the lines before it."""
    best = None
    for at in reversed(_line_starts(flat)):
        found = _METHOD.match(flat, at)
        if best is None:
            best = found
        elif found and found.start(3) == best.start(3):
            best = found
        elif flat[at:best.start(1)].strip():
            break
    return best


class _Before:
    """What stands before a place in the source, comments left out: a sign, a word, or a literal."""

    def __init__(self):
        self.last = ""
        self.rounds: list[bool] = []  # of each open round bracket: does it hold a condition?

    def see_text(self, text: str, start: int, end: int) -> None:
        """Take note of source between two tokens."""
        while end > start and text[end - 1].isspace():
            end -= 1
        if end == start:
            return
        at = end
        while at > start and (text[at - 1].isalnum() or text[at - 1] in "_$"):
            at -= 1
        member = at > start and text[at - 1] == "."
        self.last = text[end - 1] if at == end else "." if member else text[at:end]

    def see_sign(self, sign: str) -> None:
        if sign == "(":
            self.rounds.append(self.last in _CONDITIONS)
        elif sign == ")" and self.rounds and self.rounds.pop():
            sign = ";"  # a statement follows
        self.last = sign

    def may_begin_regex(self) -> bool:
        return not self.last or self.last in _BEFORE_REGEX or self.last in _KEYWORDS_BEFORE_REGEX


def script_definitions(text: str, language: str) -> list[dict]:
    """Root function declarations and methods of root classes, in source order."""
    lines = [m.start() for m in re.finditer("\n", text)]
    found: list[dict] = []
    depth = at = 0
    in_class = held = False
    opened: tuple[int, str, int] | None = None  # level, name, start
    head, before = _Head(0), _Before()
    templates: list[int] = []  # the levels of template literals in whose expressions we are

    def finish(end: int) -> None:
        _, name, start = opened
        body = text[start:end]
        found.append({
            "name": name, "signature": body.split("\n", 1)[0].rstrip(),
            "start_line": bisect_left(lines, start) + 1, "end_line": bisect_left(lines, end - 1) + 1,
            "body": body, "checksum": hashlib.sha256(body.encode()).hexdigest(),
        })

    while token := _TOKEN.search(text, at):
        start, end, sign = token.start(), token.end(), token.group()
        level = int(in_class)
        outside = opened is None and depth == level
        before.see_text(text, at, start)
        if outside:
            head.add(text[at:start], at, start)
        if sign == "/":
            literal = _REGEX.match(text, start) if before.may_begin_regex() else None
            end = literal.end() if literal else end
            before.last = "literal" if literal else "/"
            if outside:
                head.add("S\x01" if literal else "/", start, end)
        elif sign == "`" or sign == "}" and templates and depth - 1 == templates[-1]:
            end = _TEMPLATE.match(text, end).end()
            goes_on = text.endswith("${", start, end)
            if sign == "`":
                if outside:
                    head.add("S\x01", start, end)
                if goes_on:
                    templates.append(depth)
                    depth += 1
            elif not goes_on:
                depth = templates.pop()
            before.last = "{" if goes_on else "literal"
        elif sign[0] in "\"'":
            before.last = "literal"
            if outside:
                head.add("S\x01", start, end)
        elif sign[0] == "/":  # a comment; its line ends count
            if outside:
                head.add("\n" if "\n" in sign else " ", start, end)
        elif sign in "([":
            before.see_sign(sign)
            if outside:
                head.add(sign, start, end)
            depth += 1
        elif sign in ")]":
            before.see_sign(sign)
            depth = max(depth - 1, 0)
            if opened is None and depth == level:
                head.add(sign, start, end)
        elif sign == "{":
            before.see_sign(sign)
            if outside:
                flat = None
                if _TYPE_BRACE.search(head.tail()):
                    held = True
                    head.add(sign, start, end)
                else:
                    flat = "".join(head.chunks)
                if flat is not None and in_class:
                    if m := _method(flat):
                        begin = m.start(1) if language == "JavaScript" else m.end(1)
                        name = text[head.start_of(m.start(3)):head.end_of(m.end(3))]
                        opened = level, name, head.start_of(begin)
                elif flat is not None:
                    if (m := _nearest(_FUNCTION, flat)) and not _UNFINISHED.search(flat, 0, m.start()):
                        opened = level, text[head.start_of(m.start(2)):head.end_of(m.end(2))], head.start_of(m.start(1))
                    elif (m := _nearest(_CLASS, flat)) and not _UNFINISHED.search(flat, 0, m.start()):
                        in_class = True
                        head = _Head(end)
            depth += 1
        elif sign == "}":
            before.see_sign(sign)
            depth = max(depth - 1, 0)
            if opened is not None:
                if depth <= opened[0]:
                    finish(end)
                    opened, held, head = None, False, _Head(end)
            elif in_class and depth == 0:
                in_class, held, head = False, False, _Head(end)
            elif depth == level:
                if held:
                    head.add(sign, start, end)
                else:
                    head = _Head(end)
                held = False
        else:  # a semicolon
            before.see_sign(sign)
            if outside:
                head = _Head(end)
        at = end
    return found


_TEXT, _LINE = T.StringType(), T.IntegerType()
_DEFINITIONS = T.ArrayType(T.StructType([
    T.StructField("name", _TEXT), T.StructField("signature", _TEXT), T.StructField("start_line", _LINE),
    T.StructField("end_line", _LINE), T.StructField("body", _TEXT), T.StructField("checksum", _TEXT),
]))


@F.udf(_DEFINITIONS, useArrow=False)
def script_definitions_of(text: str | None, language: str) -> list[dict]:
    """Definitions of a file; null texts, as of other languages, have none.

    Not in Arrow batches: one of 10,000 files holds all their texts and definitions
    at once, while rows go by the hundred.
    """
    return [] if text is None else script_definitions(text, language)
