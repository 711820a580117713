"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words that may be near lie in one block: of two words whose longer one has ``N``
letters, an edit behind the first ``N div 2`` letters leaves these equal, an edit
among them leaves all later letters equal. Each word is therefore dealt to the
block of its first half and the block of its second half, for its own length and
for the next one. A block with too many letters is cut the same way between its
shared beginning and its shared end, until no more than one letter is left open;
such a block can't hold more words than there are letters.

Within a block a bitset over its words is kept for every (position, letter). A
recurrence walks a word's open letters once: the set of words equal so far and the
sets of words with one replaced or one missing letter so far are brought forward
together, for all words of the block in each operation. The index is read at the
same position for replaced letters and one position earlier for missing ones.
Pairs are found from their longer word, so a letter too many is the same pair
seen from the other side.
"""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.frames import written

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is this many times as frequent as its variant.
RATIO = 10
#: Open letters of a block from which it is cut.
CELLS = 32_768
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
#: Rows of a result batch.
_ROWS = 10_000

Alter = Callable[[str, str], str]


def vocabulary(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", alter: Alter | None = None,
    least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """``word, n``: the words of all whole texts with their numbers of occurrences.

    A word is a maximal run of ``[A-Za-zÀ-ÿ]`` with A-Z in lower case, of at
    least ``least_letters`` code points and ``least_count`` occurrences. ``alter``
    gets the id as text (a null id is empty) and the run and gives the word. Texts
    may be null, empty or repeated; a task counts each batch before rows move.
    """
    run = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_letters)
    key, body = F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(run.findall(value or "")).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if alter is not None:
                        word = alter(name or "", word)
                    if len(word) >= least_letters:
                        counts[word] += n
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    counted = docs.select(key, body).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _blocks(words: DataFrame) -> DataFrame:
    """``word, n, longest, head, tail``: each word in its first blocks.

    ``longest`` is the length of the longer word of the pairs sought; the words of
    a block share their first ``head`` and last ``tail`` letters.
    """
    size = F.length("word")

    def halves(longest: Column) -> list[Column]:
        half = F.floor(longest / 2).cast("int")
        return [F.struct(longest.alias("longest"), head.alias("head"), tail.alias("tail"))
                for head, tail in ((half, F.lit(0)), (F.lit(0), longest - half))]

    return words.select("word", "n", F.explode(F.array(*halves(size), *halves(size + 1))).alias("b")).select(
        "word", "n", "b.longest", "b.head", "b.tail")


def _keyed(rows: DataFrame) -> DataFrame:
    ends = F.expr("left(word, head)"), F.expr("right(word, tail)")
    return rows.withColumn("key", F.xxhash64("longest", "head", "tail", *ends))


_OPEN = "longest - head - tail"


def bounded_blocks(words: DataFrame, cells: int = CELLS) -> DataFrame:
    """``key, word, n, longest, head, tail`` in blocks of at most ``cells`` open letters, or one letter wide.

    Only blocks beyond the bound are cut, each into one that shares more of the
    beginning and one that shares more of the end, and again as long as there are
    any. Blocks are weighed by partial sums, so a very large one gathers nowhere.
    """
    parts, rows = [], _keyed(_blocks(words))
    while True:
        large = written(
            rows.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.expr(_OPEN)).alias("w"),
                                    F.max(F.expr(_OPEN)).alias("wide"))
            .where((F.col("c") > 1) & (F.col("w") > cells) & (F.col("wide") > 1)).select("key")
        )
        if large.isEmpty():
            parts.append(rows)
            return reduce(DataFrame.unionByName, parts)
        parts.append(rows.join(large, "key", "left_anti"))
        half = f"cast(floor(({_OPEN}) / 2) as int)"
        cut = F.expr(f"""explode(array(
            named_struct('head', head + {half}, 'tail', tail),
            named_struct('head', head, 'tail', tail + ({_OPEN}) - {half})))""")
        rows = written(_keyed(
            rows.join(large, "key", "left_semi").select("word", "n", "longest", cut.alias("b"))
            .select("word", "n", "longest", "b.head", "b.tail")
        ))


class PositionIndex:
    """Bitsets of a block's words per (position, letter), over the open positions."""

    def __init__(self, words: list[str], longest: int, head: int, tail: int):
        self.start, self.end = head, longest - tail
        self.at: dict[int, dict[str, int]] = {p: defaultdict(int) for p in range(self.start, self.end)}
        self.whole = (1 << len(words)) - 1
        self.long = 0
        for i, word in enumerate(words):
            bit = 1 << i
            if len(word) == longest:
                self.long |= bit
            for p in range(self.start, min(self.end, len(word))):
                self.at[p][word[p]] |= bit

    def near(self, word: str) -> tuple[int, int]:
        """The words that have one letter of ``word`` replaced, and those that lack one.

        A missing letter counts in the one block where the first difference lies.
        """
        equal, replaced, missing, before = self.whole, 0, 0, {}
        for p in range(self.start, self.end):
            here, letter = self.at[p], word[p]
            missing = missing & before.get(letter, 0) | equal
            match = here.get(letter, 0)
            kept = equal & match
            replaced = replaced & match | equal ^ kept
            equal, before = kept, here
        return replaced & self.long, missing & ~equal & ~self.long


def _members(bits: int) -> Iterator[int]:
    while bits:
        lowest = bits & -bits
        yield lowest.bit_length() - 1
        bits ^= lowest


def near_words(block: list[tuple[str, int]], longest: int, head: int, tail: int) -> Iterator[tuple]:
    """``word, n_near, best, best_n`` of the words of a block that have near words in it.

    ``best`` is the near word with the largest n, then the first in code-point order.
    """
    block = sorted(block, key=lambda r: (-r[1], r[0]))
    index = PositionIndex([w for w, _ in block], longest, head, tail)
    counts = [0] * len(block)
    best = [len(block)] * len(block)

    def meet(i: int, j: int) -> None:
        counts[i] += 1
        best[i] = min(best[i], j)

    for i, (word, _) in enumerate(block):
        if len(word) == longest:
            replaced, missing = index.near(word)
            for j in _members(replaced):
                meet(i, j)
            for j in _members(missing):
                meet(i, j)
                meet(j, i)
    for i, n_near in enumerate(counts):
        if n_near:
            yield (block[i][0], n_near, *block[best[i]])


_NEAR = "word string, n_near long, best string, best_n long"


def _near_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    kinds = dict(zip(("word", "n_near", "best", "best_n"), (pa.string(), pa.int64(), pa.string(), pa.int64())))
    found: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * len(kinds)
        return pa.RecordBatch.from_pydict({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), columns)})

    for _, run in groupby(rows, key=itemgetter(0)):
        run = list(run)
        if len(run) == 1:
            continue
        blocks = defaultdict(list)  # several only where hashes of keys are equal
        for _, word, n, longest, head, tail in run:
            blocks[longest, head, tail, word[:head], word[len(word) - tail:]].append((word, n))
        for (longest, head, tail, _, _), block in blocks.items():
            if len(block) > 1:
                found.extend(near_words(block, longest, head, tail))
        if len(found) >= _ROWS:
            yield out()
            found.clear()
    yield out()


def variants(words: DataFrame, ratio: int = RATIO, cells: int = CELLS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each row of ``words (word, n)``, whose words differ.

    Two words are near if they differ by one inserted, deleted or replaced code
    point. ``form`` is the near word of largest ``n`` (ties: the first in code-point
    order) where that is at least ``ratio`` times the word's; else null. ``root`` is
    reached by following forms to the last; the word itself where there is none.
    Null words go; an empty table gives an empty result.
    """
    words = words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n"))
    dealt = bounded_blocks(words, cells).select("key", "word", "n", "longest", "head", "tail")
    near = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_near_in_blocks, _NEAR)
    # One grouping joins the blocks' results with the words.
    none = F.lit(None)
    both = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("string").alias("best"),
                        none.cast("long").alias("best_n")).unionByName(near.withColumn("n", none.cast("long")))
    least = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("word"))))
    summed = both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), least.alias("best"))
    chosen = -F.col("best.m") >= ratio * F.col("n")
    found = written(summed.select(
        "word", "n", "n_near", F.when(chosen, F.col("best.word")).alias("form"),
        F.when(chosen, -F.col("best.m")).alias("form_n"),
    ))
    roots = follow(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def follow(links: DataFrame) -> DataFrame:
    """``word, root``: each link of ``links (word, root)`` followed to the last word of its chain.

    Every round doubles the steps taken. Chains of forms are short, since ``n``
    grows with each step by the ratio. A word has links from at most as many words
    as one edit can make of it, so no key of the join is large.
    """
    links = written(links)
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(links.join(ahead, "root", "left").select("word", "root", "next"))
        links = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next IS NOT NULL").isEmpty():
            return links


def group_spellings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", alter: Alter | None = None) -> DataFrame:
    """``variants`` of the ``vocabulary`` of whole texts; see both.

    Null and empty texts have no word, very long ones are read whole, repeated
    rows count as often as they occur, an empty table gives an empty result and
    other columns are not looked at.
    """
    return variants(written(vocabulary(docs, text, doc_id, alter)))
