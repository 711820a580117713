"""Personal data: exact base patterns, and a skip-chain conditional random field.

The field's nodes are the tokens of a text that hold a digit or an ``@``; other
tokens are ordinary by definition. Neighbouring nodes share a chain potential.
Nodes that repeat a token, or write the same digits in another way, share a
skip potential, however far apart they stand. Tokens inside base matches are
observed. Loopy message passing settles the others, so that a mention which the
patterns miss takes the label of its repetitions, and vice versa.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.frames import append_columns, unused

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
#: Documents that the field is learned from, as drawn by a hash of the id: about this many, at most twice.
SAMPLE = 4000
ROUNDS = 12
#: Belief from which a token that no pattern found is reported.
SURE = 0.9

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its start only: later starts match no more, and take long.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EVIDENCE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^ \t-\r]+")
_CORE_START = re.compile(r"[0-9A-Za-z+(]")
_CORE_END = re.compile(r"[0-9A-Za-z)][^0-9A-Za-z)]*\Z")
_NOT_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``kind, start, end`` of the base patterns, by kind as listed, then start."""
    spans = [("email", s, e) for s, e in _emails(text)]
    if not _EVIDENCE.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGITS.sub("", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_NOT_DIGITS.sub("", m.group())) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


@dataclass
class Graph:
    """Nodes of one text: where they stand, what they look like, what is known of them."""

    starts: list[int]
    ends: list[int]
    shapes: list[tuple]
    known: np.ndarray  # index of the label, or -1
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def _shape(core: str, digits: str) -> tuple:
    """Observable features of a token, each a small number."""
    letters = sum(c.isalpha() for c in core)
    return (
        int(np.searchsorted((1, 3, 4, 7, 8, 10, 16, 20), len(digits), "right")),
        min(core.count("."), 4),
        0 if not letters else 1 if letters < len(digits) else 2,
        int("@" in core), int(core[:1] == "+"), int("(" in core or ")" in core), int("-" in core),
    )


def graph_of(text: str, spans: list[tuple[str, int, int]]) -> Graph:
    """Nodes and edges of ``text``. Repetitions are linked each to the next one."""
    graph = Graph([], [], [], np.empty(0, np.int64), [], [])
    latest: dict[str, int] = {}
    position, last_position = -1, -2
    for token in _TOKEN.finditer(text):
        position += 1
        word = token.group()
        if not _EVIDENCE.search(word):
            continue
        first, last = _CORE_START.search(word), _CORE_END.search(word)
        start, end = token.span()
        if first and last and first.start() <= last.start():
            start, end = start + first.start(), start + last.start() + 1
        core = text[start:end]
        digits = _NOT_DIGITS.sub("", core)
        node = len(graph.starts)
        graph.starts.append(start)
        graph.ends.append(end)
        graph.shapes.append(_shape(core, digits))
        if last_position == position - 1:
            graph.chain.append((node - 1, node))
        last_position = position
        for key in {core.lower(), digits} if len(digits) >= 6 else {core.lower()}:
            if key in latest:
                graph.skip.append((latest[key], node))
            latest[key] = node
    known = np.full(len(graph.starts), -1)
    starts = np.array(graph.starts)
    ends = np.array(graph.ends)
    for kind, start, end in reversed(spans):  # of overlapping matches the kind listed first counts
        first = int(np.searchsorted(ends, start, "right"))
        last = int(np.searchsorted(starts, end, "left"))
        known[first:last] = LABELS.index(kind)
    graph.known = known
    return graph


@dataclass
class Field:
    """Weights of shapes (feature by label), and the chain and skip potentials (label by label)."""

    shape: dict[tuple[int, int], np.ndarray]
    bias: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def evidence(self, shapes: list[tuple]) -> np.ndarray:
        none = np.zeros(len(LABELS))
        of = {s: self.bias + sum(self.shape.get(f, none) for f in enumerate(s)) for s in set(shapes)}
        return np.array([of[s] for s in shapes]).reshape(-1, len(LABELS))

    def beliefs(self, graph: Graph) -> np.ndarray:
        """Marginals of each node by loopy sum-product message passing."""
        scores = self.evidence(graph.shapes)
        observed = graph.known >= 0
        scores[observed] = -50.0
        scores[observed, graph.known[observed]] = 0.0
        edges = np.array([*graph.chain, *graph.skip], np.int64).reshape(-1, 2)
        if not len(edges):
            return _softmax(scores)
        forward = np.concatenate([
            np.repeat(self.chain[None], len(graph.chain), 0), np.repeat(self.skip[None], len(graph.skip), 0)
        ])
        sender = np.concatenate([edges[:, 0], edges[:, 1]])
        receiver = np.concatenate([edges[:, 1], edges[:, 0]])
        potentials = np.concatenate([forward, forward.transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(sender), len(LABELS)))
        for _ in range(ROUNDS):
            total = scores.copy()
            np.add.at(total, receiver, messages)
            outgoing = total[sender] - messages[reverse]
            new = np.logaddexp.reduce(outgoing[:, :, None] + potentials, axis=1)
            new -= new.max(axis=1, keepdims=True)
            new = 0.5 * messages + 0.5 * new
            moved = np.abs(new - messages).max()
            messages = new
            if moved < 1e-4:
                break
        total = scores.copy()
        np.add.at(total, receiver, messages)
        return _softmax(total)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _learn(nodes: Counter, chain: Counter, skip: Counter) -> Field:
    """Weights from counts: softmax regression for shapes, log-odds for label pairs."""
    n = len(LABELS)
    shapes = sorted({s for s, _ in nodes})
    features = sorted({f for s in shapes for f in enumerate(s)})
    column = {f: i for i, f in enumerate(features)}
    x = np.zeros((len(shapes), len(features) + 1))
    x[:, -1] = 1
    y = np.zeros((len(shapes), n))
    for i, s in enumerate(shapes):
        x[i, [column[f] for f in enumerate(s)]] = 1
        y[i] = [nodes[s, label] for label in range(n)]
    weights = np.zeros((x.shape[1], n))
    weight = y.sum(axis=1, keepdims=True)
    scale = max(1.0, weight.sum())
    velocity = np.zeros_like(weights)
    for _ in range(3000 if len(shapes) else 0):
        gradient = x.T @ (y - weight * _softmax(x @ weights)) / scale - 1e-4 * weights
        velocity = 0.9 * velocity + gradient
        weights += 0.5 * velocity

    def pairs(counts: Counter) -> np.ndarray:
        table = np.eye(n) * 4 + 1.0  # equal labels are the more likely ones until seen otherwise
        for (a, b), c in counts.items():
            table[a, b] += c
        table /= table.sum()
        odds = np.log(table / (table.sum(1, keepdims=True) * table.sum(0, keepdims=True)))
        return np.clip(odds, -4, 4)

    skip_table = pairs(skip)
    return Field(
        {f: weights[i] for f, i in column.items()}, weights[-1], pairs(chain), (skip_table + skip_table.T) / 2
    )


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """Learn the field from base matches in a sample of ``docs``.

    The sample is drawn by a hash of the id: about ``sample`` texts, twice as many
    at most. Tokens are counted where they are; only counts of shapes and label
    pairs reach the driver, and their number does not depend on the data's size.
    """
    known = docs.where(F.col(text).isNotNull())
    n = known.count()
    share = min(1.0, sample / max(1, n))
    drawn = known.select(F.col(text).alias("text"), F.xxhash64(F.col(id_col)).alias("h")).where(
        F.shiftrightunsigned("h", 32).cast("double") < share * float(1 << 32)
    ).limit(2 * sample)

    def start():
        def batch(texts):
            out = []
            for t in texts:
                graph = graph_of(t, base_spans(t))
                label = np.maximum(graph.known, 0).tolist()
                out.append(
                    [("n", ",".join(map(str, s)), k, 0) for s, k in zip(graph.shapes, label)]
                    + [("c", "", label[a], label[b]) for a, b in graph.chain]
                    + [("s", "", label[a], label[b]) for a, b in graph.skip]
                )
            return [out]
        return batch

    seen = append_columns(drawn, "text", start, "seen array<struct<what:string,shape:string,a:int,b:int>>")
    counts = seen.select(F.explode("seen").alias("s")).groupBy("s.what", "s.shape", "s.a", "s.b").count().collect()
    nodes, chain, skip = Counter(), Counter(), Counter()
    for r in counts:
        if r["what"] == "n":
            nodes[tuple(map(int, r["shape"].split(","))), r["a"]] += r["count"]
        else:
            (chain if r["what"] == "c" else skip)[r["a"], r["b"]] += r["count"]
    return _learn(nodes, chain, skip)


def spans_of(text: str | None, field: Field) -> list[tuple[str, int, int, bool]]:
    """``kind, start, end, base`` of all personal data, by kind as listed, then start."""
    text = text or ""
    base = base_spans(text)
    found = [(*s, True) for s in base]
    if not _EVIDENCE.search(text):
        return found
    graph = graph_of(text, base)
    if (graph.known < 0).any():
        beliefs = field.beliefs(graph)
        best = beliefs.argmax(axis=1)
        new = (graph.known < 0) & (best > 0) & (beliefs.max(axis=1) >= SURE)
        chained = {b for _, b in graph.chain}
        added: list[list] = []
        for node in np.flatnonzero(new).tolist():
            if added and node in chained and added[-1][3] == node - 1 and added[-1][0] == best[node]:
                added[-1][2:] = [graph.ends[node], node]
            else:
                added.append([best[node], graph.starts[node], graph.ends[node], node])
        found += [(LABELS[k], s, e, False) for k, s, e, _ in added]
        found.sort(key=lambda f: (KINDS.index(f[0]), f[1]))
    return found


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def with_spans(docs: DataFrame, field: Field, text: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with column ``name``: the personal data in each whole text.

    Spans count code points, the end is exclusive; a null or empty text has none.
    A column of ``docs`` that bears the name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def start():
        known = shared.value
        return lambda texts: [[spans_of(t, known) for t in texts]]

    return append_columns(docs, text, start, f"`{name}` {SPANS}")


def masked(text: str | None, field: Field) -> str | None:
    """``text`` with its personal data replaced by ``[KIND]``; overlapping spans are one."""
    spans = sorted((s, e, k) for k, s, e, _ in spans_of(text, field))
    if not spans:
        return text
    out, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text`` and the new length in ``n_chars``.

    The field is learned from the given rows. A null text stays null and keeps its
    length; so does a text without personal data. Columns keep their order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, text=text))

    def start():
        field = shared.value
        return lambda texts: [[masked(t, field) for t in texts]]

    before = unused(docs, "before")
    changed = append_columns(docs.withColumn(before, F.col(text)), before, start, f"`{text}` string")
    length = F.when(F.col(text) != F.col(before), F.length(text).cast("long")).otherwise(F.col(n_chars))
    return changed.withColumn(n_chars, length).select(*docs.columns)
