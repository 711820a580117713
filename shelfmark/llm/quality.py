"""Quality rules as a short-circuit cascade.

Rules share the features of a text, each computed when first asked for. On a
sample, every rule's cost and the texts it rejects are measured; the cascade then
runs the rule first that rejects most per cost among what is left, and so on. A
text leaves the cascade at its first rejection. The order changes the time, not
the verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from copy import copy
from dataclasses import dataclass
from functools import cached_property
from operator import eq

from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.frames import append_columns

WINDOW = 5
#: Texts that costs are measured on: about this many, at most twice.
SAMPLE = 1000
_SYMBOLS = b"#*$%&|<>"
_NO_SYMBOL = bytes(b for b in range(256) if b not in _SYMBOLS)


class Features:
    """Counts over one whole text; words are runs without ASCII white space."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        return len(joined) - (0 if joined.isascii() else len(joined) - len(joined.decode()))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data.translate(None, _NO_SYMBOL))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [line for line in self.data.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows that occur twice or more, the first occurrence included."""
        w = self.words
        windows = list(zip(*(w[i:] for i in range(WINDOW))))
        if len(set(windows)) == len(windows):
            return 0
        often = {g for g, n in Counter(windows).items() if n > 1}
        total = done = 0
        for i, g in enumerate(windows):
            if g in often:
                total += i + WINDOW - max(i, done)
                done = i + WINDOW
        return total

    @cached_property
    def n_stutter(self) -> int:
        """Words equal to the one before."""
        return sum(map(eq, self.words, self.words[1:]))

    @cached_property
    def letters(self) -> int:
        return sum(map(str.isalpha, self.text))

    @cached_property
    def capitals(self) -> int:
        return sum(map(str.isupper, self.text))

    @cached_property
    def longest_word(self) -> int:
        return max(map(len, self.words), default=0)

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


def _base_counts(f: Features) -> tuple[int, ...]:
    return f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], bool]


#: Each rule rejects a kind of text that is no prose.
RULES = (
    Rule("symbols", lambda f: 10 * f.n_symbols > 3 * f.n_words),
    Rule("duplicate_lines", lambda f: 2 * f.n_dup_lines > len(f.lines)),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 15 * f.n_words),
    Rule("letters", lambda f: 10 * f.letters < 4 * f.word_chars),
    Rule("capitals", lambda f: 2 * f.capitals > f.letters),
    Rule("stutter", lambda f: 10 * f.n_stutter > 3 * f.n_words),
    Rule("giant_word", lambda f: f.longest_word > 1000),
)


def cascade_order(
    outcomes: list[tuple[tuple[float, bool], ...]], shared: list[dict[str, float]] | None = None
) -> list[int]:
    """Rule numbers by rejections per cost among the texts that the rules before let through.

    ``outcomes`` has, for each sampled text, cost and verdict of every rule;
    ``shared`` what each feature that a rule asks for is worth of its mean cost. A
    feature costs nothing once a rule before has made it. Rules that reject nothing
    more follow, cheapest first.
    """
    if not outcomes:
        return []
    left, rest, order = list(outcomes), list(range(len(outcomes[0]))), []
    mean = [sum(o[r][0] for o in outcomes) / len(outcomes) for r in rest]
    asked = [dict(s) for s in shared] if shared else [{} for _ in rest]
    while rest:
        def worth(r):
            return (sum(o[r][1] for o in left) / (mean[r] * max(1, len(left)) or 1e-12), -mean[r], -r)

        best = max(rest, key=worth)
        order.append(best)
        rest.remove(best)
        left = [o for o in left if not o[best][1]]
        made = set(asked[best])
        for r in rest:
            mean[r] -= sum(asked[r].pop(name) for name in made & set(asked[r]))
            mean[r] = max(mean[r], 0.0)
    return order


def measure(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text: str = "text",
            sample: int = SAMPLE) -> list[int]:
    """The order of ``rules`` by their measured cost and rejections on a sample of ``docs``.

    The sample is drawn by a hash of the id; of it only costs and verdicts reach
    the driver. Texts that fail the base test never come to a rule and don't count;
    base counts are made for every text, so rules have them for nothing. Without a
    text the given order stands.
    """
    n = docs.select(id_col).count()
    drawn = docs.select(F.col(text).alias("text"), F.xxhash64(F.col(id_col)).alias("h")).where(
        F.shiftrightunsigned("h", 32).cast("double") < min(1.0, sample / max(1, n)) * float(1 << 32)
    ).limit(2 * sample)

    def start():
        def one(value):
            base = Features(value)
            if base.base_failed:
                return None
            _base_counts(base)
            out = []
            for rule in rules:
                features = copy(base)  # so that no rule lives on another's work
                began = time.perf_counter()
                rejected = bool(rule.rejects(features))
                cost = time.perf_counter() - began
                asked = []
                for name in sorted(set(vars(features)) - set(vars(base))):
                    again = copy(base)
                    began = time.perf_counter()
                    getattr(again, name)
                    asked.append((name, time.perf_counter() - began))
                out.append((cost, rejected, asked))
            return out

        return lambda texts: [[one(t) for t in texts]]

    kinds = "outcome array<struct<cost:double,rejected:boolean,asked:array<struct<name:string,cost:double>>>>"
    seen = append_columns(drawn, "text", start, kinds).where("outcome IS NOT NULL").select("outcome").collect()
    outcomes = [tuple((o["cost"], o["rejected"]) for o in r["outcome"]) for r in seen]
    shared: list[dict[str, float]] = [{} for _ in rules]
    for r in seen:
        for of_rule, o in zip(shared, r["outcome"]):
            for name, cost in o["asked"]:
                of_rule[name] = of_rule.get(name, 0.0) + cost / len(seen)
    return cascade_order(outcomes, shared) or list(range(len(rules)))


VERDICT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, rejected_by string, rules_run int"
)


def judge(docs: DataFrame, order: list[int], rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with the base counts of each whole text and the cascade's verdict.

    A null or empty text has zero counts and fails the base test. ``rejected_by``
    is the rule that ended the cascade (null if kept, ``base`` if it never
    began), ``rules_run`` how many were run. Repeated rows stay, an empty table
    gives an empty result. Columns of ``docs`` that bear these names are replaced.
    """
    names = [rules[i].name for i in order]

    def start():
        tests = [rules[i].rejects for i in order]

        def one(value):
            f = Features(value)
            counts = (*_base_counts(f), f.base_failed)
            if f.base_failed:
                return (*counts, False, "base", 0)
            for number, rejects in enumerate(tests):
                if rejects(f):
                    return (*counts, False, names[number], number + 1)
            return (*counts, True, None, len(tests))

        return lambda texts: list(zip(*map(one, texts))) if texts else [[]] * 9

    return append_columns(docs, text, start, VERDICT)
