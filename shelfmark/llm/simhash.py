"""SimHash near-duplicates: fingerprints, and a self-join of their binary trie.

Two fingerprints are linked if they differ in at most three bits. Cut into four
blocks of 16 bits, such a pair agrees on a whole block, so the tries of the
fingerprints that share a block value hold every link. A trie with more than
``GROUP_LIMIT`` leaves is cut again by 12-bit parts of the other 48 bits, and if
that is still too large, by pairs of slots, so that no task meets an unbounded
group. Within a group, pairs of trie nodes are walked down together; a pair is
dropped as soon as its prefixes differ in more bits than allowed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.llm.components import connected_components
from shelfmark.llm.frames import append_columns, unused, written

BITS = 64
SHINGLE = 3
BUDGET = 3
SEED = 42
#: Leaves of a trie that one task joins at once.
GROUP_LIMIT = 2000
#: Pairs of leaves that groups joined in one go may have together.
CHUNK_PAIRS = 4_000_000
#: Hashes whose bits are unpacked at once.
HASHES = 1 << 16


def fingerprint_of(text: str | None) -> int:
    """The SimHash of the 3-word shingles of ``text``, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
        n = len(words) - SHINGLE + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, HASHES):
        part = hashes[at : at + HASHES]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the SimHash of column ``text`` as a long column ``name``.

    A null, empty or blank text has fingerprint zero.
    """
    return append_columns(
        docs, text, lambda: lambda texts: [[fingerprint_of(t) for t in texts]], f"`{name}` bigint"
    )


def _pairs_within(order: np.ndarray, first: np.ndarray, last: np.ndarray, budget: int):
    """Index pairs of fingerprints within ``budget`` bits, for each range of ``order``.

    ``order`` holds unsigned fingerprints, ascending within each range, which is
    one trie. The frontier holds pairs of nodes, each a range of leaves below the
    same depth, and the bits by which their prefixes differ.
    """
    a0, a1 = first, last
    b0, b1 = first, last
    spent = np.zeros(len(first), np.int8)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for bit in range(BITS - 1, -2, -1):  # below bit 0 only leaves are left
        alone = (a1 - a0 == 1) & (b1 - b0 == 1)
        if alone.any():  # two leaves: the rest of their paths in one step
            i, j = a0[alone], b0[alone]
            near = np.bitwise_count(order[i] ^ order[j]) <= budget
            keep = near & (i != j)
            found.append((i[keep], j[keep]))
            a0, a1, b0, b1, spent = (x[~alone] for x in (a0, a1, b0, b1, spent))
        if not len(a0):
            break
        ones = np.concatenate(([0], np.cumsum((order >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        more = spent + 1
        cross = ~same  # within one node, 0-1 and 1-0 are the same pairs
        parts = [
            (a0, am, b0, bm, spent), (am, a1, bm, b1, spent), (a0, am, bm, b1, more),
            (am[cross], a1[cross], b0[cross], bm[cross], more[cross]),
        ]
        a0, a1, b0, b1, spent = (np.concatenate(x) for x in zip(*parts))
        live = (a1 > a0) & (b1 > b0) & (spent <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        a0, a1, b0, b1, spent = (x[live] for x in (a0, a1, b0, b1, spent))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index of each index's component."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        open_ = root[left] != root[right]
        left, right = left[open_], right[open_]
    return root


def _join_sorted(keys: np.ndarray, prints: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(fingerprint, representative)`` of all groups in the arrays."""
    unsigned = prints.view(np.uint64)
    order = np.lexsort((unsigned, keys))
    keys, unsigned = keys[order], unsigned[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    last = np.append(first[1:], len(keys))
    large = last - first > 1
    first, last = first[large], last[large]
    left, right = [], []
    cost = np.cumsum((last - first).astype(np.int64) ** 2)
    at = 0
    while at < len(first):
        done = cost[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(cost, done + CHUNK_PAIRS, "right")))
        i, j = _pairs_within(unsigned, first[at:to], last[at:to], budget)
        root = _roots(len(unsigned), i, j)
        moved = np.flatnonzero(root != np.arange(len(root)))
        left.append(unsigned[moved].view(np.int64))
        right.append(unsigned[root[moved]].view(np.int64))
        at = to
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _trie_join(budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints = np.empty(0, np.int64), np.empty(0, np.int64)

        def links(keys, prints):
            a, b = _join_sorted(keys, prints, budget)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            keys = np.concatenate((keys, batch.column(0).to_numpy(zero_copy_only=False)))
            prints = np.concatenate((prints, batch.column(1).to_numpy(zero_copy_only=False)))
            if len(keys) and keys[0] != keys[-1]:  # the last group may go on in the next batch
                cut = int(np.searchsorted(keys, keys[-1]))
                yield links(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
        if len(keys):
            yield links(keys, prints)

    return run


def _block(i: int) -> Column:
    return F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))


def _grouped(prints: DataFrame, limit: int) -> DataFrame:
    """``key, fp``: each fingerprint under the keys of the tries that it joins."""
    # Level 1: one of four 16-bit blocks agrees. At most 4 * 65,536 keys exist, so
    # the table of the large ones is bounded and may be broadcast.
    blocks = prints.select("fp", F.explode(F.array(*[
        F.shiftleft(F.lit(i).cast("long"), 16).bitwiseOR(_block(i)) for i in range(4)
    ])).alias("block"))
    large = blocks.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    blocks = blocks.join(F.broadcast(large), "block", "left")
    small_groups = blocks.where("n is null").select(F.col("block").alias("key"), "fp")
    # Level 2: of the other 48 bits, one of four 12-bit parts agrees too.
    which = F.shiftrightunsigned("block", 16)
    others = [F.when(which == i, F.concat_ws("", *[
        F.lpad(F.bin(_block(j)), 16, "0") for j in range(4) if j != i
    ])) for i in range(4)]
    parts = blocks.where("n is not null").select(
        "fp", "block", F.coalesce(*others).alias("bits")
    ).select("fp", F.explode(F.array(*[
        F.xxhash64("block", F.lit(j), F.substring("bits", 1 + 12 * j, 12)) for j in range(4)
    ])).alias("part"))
    # Level 3: a part that is still too large is cut into slots, and every pair of slots meets.
    sizes = parts.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > limit)
    parts = parts.join(sizes, "part", "left")
    slots = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    own = F.pmod(F.xxhash64("fp"), slots).cast("int")
    pairs = parts.where("n is not null").select("fp", "part", slots.alias("slots"), own.alias("own")).select(
        "fp", "part", "own", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("other")
    ).select(F.xxhash64("part", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    return small_groups.union(
        parts.where("n is null").select(F.col("part").alias("key"), "fp")
    ).union(pairs)


def link_fingerprints(prints: DataFrame, budget: int = BUDGET, limit: int = GROUP_LIMIT) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints ``fp`` within ``budget`` bits.

    Not every close pair is listed, but a group keeps a path between each of them.
    ``budget`` is at most three.
    """
    if budget > BUDGET:
        raise ValueError("blocks guarantee links of at most three differing bits")
    grouped = _grouped(prints, limit)
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        grouped.repartition(partitions, "key").sortWithinPartitions("key")
        .mapInArrow(_trie_join(budget), "a bigint, b bigint")
    )


def _labelled(docs: DataFrame, id_col: str, text: str, limit: int) -> DataFrame:
    """``id_col, fp, digest, component, component_id`` for every row of ``docs``; the digest is the text's."""
    given = docs.select(id_col, text)
    digest = unused(given, "digest")
    prints = written(with_fingerprint(given.withColumn(digest, F.xxhash64(text)), text, "fp").select(
        id_col, "fp", F.col(digest).alias("digest")))
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("least"))
    groups = connected_components(link_fingerprints(distinct.select("fp"), limit=limit))
    joined = distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = joined.join(named, "component").select("fp", "component", "component_id")
    return prints.join(labels, "fp").select(id_col, "fp", "digest", "component", "component_id")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = GROUP_LIMIT
) -> DataFrame:
    """``id_col, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that is reached over links of at most
    three bits, its own included. Rows with a null, empty or blank text have
    fingerprint zero and are linked like others. Rows with a null id have a
    component, whose id is null only if all its ids are. Repeated rows stay. An
    empty table gives an empty result; other columns are not read.
    """
    return _labelled(docs, id_col, text, limit).select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate group of ``docs``, all columns.

    The row with the smallest id stays; of rows of the group sharing that id, the
    one whose text sorts first (null first). Different texts under one id are
    rows of their own groups. Rows without an id go: nothing could refer to them.
    """
    digest, component, rank = (unused(docs, n) for n in ("digest", "component", "rank"))
    firsts = written(_labelled(docs, id_col, text, GROUP_LIMIT).where(F.col(id_col) == F.col("component_id")).select(
        id_col, F.col("digest").alias(digest), F.col("component").alias(component)
    ).distinct())
    marked = docs.withColumn(digest, F.xxhash64(text))
    # Groups whose smallest id has several texts are few: only there are whole texts compared.
    of_several = firsts.groupBy(component).agg(F.count("*").alias(rank)).where(F.col(rank) > 1)
    several = written(firsts.join(of_several.select(component), component))
    winners = firsts.select(id_col, digest)
    if not several.isEmpty():
        first = F.min(F.struct(F.col(text).isNotNull(), F.col(text), F.col(id_col).alias("id"), F.col(digest).alias("digest")))
        chosen = marked.join(several, [id_col, digest]).groupBy(component).agg(first.alias(rank))
        winners = firsts.join(several.select(component), component, "left_anti").select(id_col, digest).union(
            chosen.select(f"{rank}.id", f"{rank}.digest"))
    # Repeated rows lie together after the join already.
    order = Window.partitionBy(id_col, digest).orderBy(digest)
    return (
        marked.join(winners, [id_col, digest])
        .withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
        .select(*docs.columns)
    )
