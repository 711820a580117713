"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is contained in a document if at least ``CONTAINMENT`` of its
distinct word shingles occur there. Items are partitioned by their number of
shingles. The signature of an item is its smallest shingle hashes (a bottom-k
MinHash sketch), and each partition has the smallest k with which a containing
document can't miss the whole signature: of ``n`` shingles at most
``n - ceil(CONTAINMENT * n)`` may be absent, so one more finds every document,
however long it is. Candidates are verified by the exact containment.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from itertools import islice

import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.frames import append_columns, put_by, unused, written

SHINGLE = 5
CONTAINMENT = 0.8
#: Test items that are held in memory at once, by the size of their text.
BLOCK_BYTES = 16 << 20
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str], width: int):
    """The word shingles of ``words`` in order, as tuples."""
    return zip(*(islice(words, i, None) for i in range(width)))


def _rank(shingle: tuple) -> int:
    return xxhash.xxh64_intdigest(" ".join(shingle))


def needed(n: int, containment: float = CONTAINMENT) -> int:
    """Shingles of ``n`` that a containing document has at least."""
    return max(1, math.ceil(containment * n - 1e-9))


class Searcher:
    """The signatures of a block of test items ``(id, text, copies)``, by partitions of equal size.

    An item of fewer than ``SHINGLE`` words is one shingle, its whole word
    sequence; an item without words is found nowhere.
    """

    def __init__(self, items: list[tuple], containment: float = CONTAINMENT, width: int = SHINGLE):
        self.containment = containment
        self.items: list[tuple[object, int, frozenset, int]] = []
        #: shingle width -> shingle -> items with it in their signature
        self.signatures: dict[int, dict[tuple, list[int]]] = {}
        partitions: dict[int, list[int]] = {}
        for item_id, text, copies in items:
            words = words_of(text)
            if words:
                own = min(width, len(words))
                shingles = frozenset(shingles_of(words, own))
                partitions.setdefault(len(shingles), []).append(len(self.items))
                self.items.append((item_id, own, shingles, copies))
        for size, members in partitions.items():
            k = size - needed(size, containment) + 1
            for at in members:
                _, own, shingles, _ = self.items[at]
                for shingle in sorted(shingles, key=_rank)[:k]:
                    self.signatures.setdefault(own, {}).setdefault(shingle, []).append(at)
        self.keys = {own: frozenset(found) for own, found in self.signatures.items()}

    def search(self, text: str | None) -> list[tuple]:
        """``(item, shingles, shared)`` of each item that ``text`` contains, exactly."""
        if not self.keys:
            return []
        words = words_of(text)
        out = []
        for own, keys in self.keys.items():
            hits = keys.intersection(shingles_of(words, own))
            if not hits:
                continue
            present = set(shingles_of(words, own))
            for at in {at for hit in hits for at in self.signatures[own][hit]}:
                item_id, _, shingles, copies = self.items[at]
                shared = len(shingles & present)
                if shared >= needed(len(shingles), self.containment):
                    out += [(item_id, len(shingles), shared)] * copies
        return sorted(out, key=lambda f: (f[0] is not None, f[0]))


def _blocks(benchmark: DataFrame, item: str, text: str) -> list[DataFrame]:
    """Different items as ``item, text, copies`` in blocks of about ``BLOCK_BYTES``, dealt by a hash.

    Repeated rows are one item with a count, so that no block grows by them.
    """
    items = benchmark.groupBy(F.col(item).alias("item"), F.col(text).alias("text")).agg(F.count("*").alias("copies"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, math.ceil((size[0] + 64 * size[1]) / BLOCK_BYTES))
    dealt = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    return [items.where(dealt == i) if blocks > 1 else items for i in range(blocks)]


def _searched(docs: DataFrame, text: str, kind: str, items, containment: float) -> DataFrame:
    """``docs`` with ``leaks``: what a broadcast block of items finds in each text."""
    def start():
        search = Searcher(items.value, containment).search
        return lambda texts: [[search(t) for t in texts]]

    return append_columns(docs, text, start, f"leaks {kind}")


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """``docs`` with ``leaks``: the items that each whole text contains.

    ``leaks`` is an array of ``item, n_shingles, n_shared`` ordered by item. It is
    empty for null, empty or unaffected texts, and for all if there are no items;
    an empty table stays empty. Repeated items are each listed, repeated documents
    stay. A column of ``docs`` named ``leaks`` is replaced.

    A test set of one block meets every document where it is. A larger one is
    searched block by block: each job holds one block, writes the few texts that
    contain an item, by digest, and releases the block. What was found then joins
    the documents, which go over the network only if Spark can't broadcast it.
    """
    kind = f"array<struct<item:{benchmark.schema[item_id].dataType.simpleString()},n_shingles:int,n_shared:int>>"
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, item_id, item_text)
    given = docs.drop("leaks")
    if len(blocks) == 1:
        return _searched(given, text, kind, context.broadcast([tuple(r) for r in blocks[0].collect()]), containment)
    digest = unused(given, "digest")
    texts = given.select(F.sha2(F.col(text), 256).alias(digest), F.col(text).alias("text"))
    parts = []
    for block in blocks:
        items = context.broadcast([tuple(r) for r in block.collect()])
        found = _searched(texts, "text", kind, items, containment).where(F.size("leaks") > 0)
        # Equal texts contain the same.
        parts.append(written(found.select(digest, "leaks").dropDuplicates([digest])))
        items.destroy()
    leaks = reduce(DataFrame.union, parts).groupBy(digest).agg(
        F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    return (
        given.withColumn(digest, F.sha2(F.col(text), 256)).join(leaks, digest, "left").drop(digest)
        .withColumn("leaks", F.coalesce("leaks", F.array().cast(kind)))
    )


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 item_id: str = "item_id") -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` for each contained item."""
    found = with_leaks(docs.select(id_col, text), benchmark, text, item_id)
    return found.select(id_col, F.explode("leaks").alias("leak")).select(
        id_col, F.col("leak.item").alias(item_id), F.col("leak.n_shingles").alias("n_shingles"),
        F.col("leak.n_shared").alias("n_shared"),
        (F.col("leak.n_shared") / F.col("leak.n_shingles")).alias("containment"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that contain no item; all columns as they are."""
    others, aside = put_by(docs, "leaks")
    kept = with_leaks(others, benchmark, text).where(F.size("leaks") == 0).drop("leaks")
    return kept.withColumnsRenamed(aside).select(*docs.columns)
