"""Whitening of embeddings by their leading principal components.

Sums, the covariance of centred vectors and the check of the result are partial
sums of each task, added up by Spark; what reaches the driver are numbers of a
vector's or a matrix's size, whatever the number of rows. The covariance is
decomposed there (see ``eigen``), and mean and components go to all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm import eigen
from shelfmark.llm.frames import append_columns, unused

COMPONENTS = 8
#: Entries become whole numbers: ``floor(SCALE * c) + OFFSET``.
SCALE, OFFSET = 1024, 100_000
#: Entries beyond this are set to it, so that all whole numbers are exact in doubles.
_LARGEST = float(1 << 53)
#: Eigenvalues of no more than this share of the trace are zero within rounding.
ZERO = 1e-13


def complete(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(
        ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))


def whole_numbers(vectors: list, size: int) -> np.ndarray:
    """One row of whole numbers for each vector, as doubles; missing entries at the end count as 0."""
    if all(len(v) == size for v in vectors):
        entries = np.array(vectors, dtype=np.float64).reshape(len(vectors), size)
    else:
        entries = np.zeros((len(vectors), size))
        for row, v in zip(entries, vectors):
            row[:len(v)] = v
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * entries), -_LARGEST, _LARGEST) + OFFSET


def _summed(vectors: DataFrame, partial: Callable[[list], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``vectors (vector)`` of the numbers that ``partial`` gives for a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(batch.column(0).to_pylist())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int64()), pa.array(total.astype(np.float64))], ["i", "v"])

    added = vectors.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    return np.array([r["v"] for r in sorted(added.collect())])


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: of ``n`` vectors the sums, and of each component direction, eigenvalue and share."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    values: np.ndarray
    explained: tuple[float, ...]

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Rows projected on the components and divided by their deviation; zero where that is zero."""
        spread = np.sqrt(np.maximum(self.values, 0.0))
        own = np.where(spread > 0, 1.0 / np.where(spread > 0, spread, 1.0), 0.0)
        return self.centred(x) @ (self.directions * own[:, None]).T

    def deviations(self, x: np.ndarray) -> list[Decimal | None]:
        """The exact sum of ``(n * x - S) ** 2`` of each row; None beyond 38 digits."""
        if not len(x):
            return []
        largest = max(self.n * np.abs(x).max(initial=0.0), 1.0) + max(map(abs, self.sums), default=0)
        if largest ** 2 * len(self.sums) < 2.0 ** 62:
            off = self.n * x.astype(np.int64) - np.array(self.sums, dtype=np.int64)
            return [Decimal(int(v)) for v in (off * off).sum(axis=1)]
        found = (sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums)) for row in x)
        return [Decimal(v) if v < 10 ** 38 else None for v in found]


def fit(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Mean, and the leading components of the covariance, of all complete vectors of ``table``.

    Four aggregations over the table's vectors: their greatest length and number,
    the sums, and the covariance. The covariance is taken of ``x - S / n`` with
    divisor ``n``. Components whose variance is zero have the value 0. Without a
    complete vector there is no component.
    """
    vectors = table.where(complete(F.col(vector))).select(F.col(vector).alias("vector"))
    n, size = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    if not n or not size:
        return Whitening(n, (0,) * size, np.zeros((0, size)), np.zeros(0), ())
    # The sums are exact: whole numbers in two parts of 27 bits each.
    def sums(rows: list) -> np.ndarray:
        x = whole_numbers(rows, size)
        high = np.floor(x / (1 << 27))
        return np.concatenate([high.sum(axis=0), (x - high * (1 << 27)).sum(axis=0)])

    parts = [int(v) for v in _summed(vectors, sums)]
    totals = tuple((h << 27) + low for h, low in zip(parts[:size], parts[size:]))
    mean = np.array([s / n for s in totals])

    def products(rows: list) -> np.ndarray:
        y = whole_numbers(rows, size) - mean
        return (y.T @ y)[np.triu_indices(size)]

    covariance = np.zeros((size, size))
    covariance[np.triu_indices(size)] = _summed(vectors, products) / n
    covariance += np.triu(covariance, 1).T
    values, directions = eigen.leading(covariance, min(components, size))
    trace = float(np.trace(covariance))
    values = np.where(values > ZERO * trace, values, 0.0)
    explained = tuple(float(v) / trace if trace > 0 else 0.0 for v in values)
    return Whitening(n, totals, directions, values, explained)


def identity_error(table: DataFrame, fitted: Whitening, vector: str = "embedding") -> float:
    """The largest entry of the covariance of all whitened rows minus the identity.

    Components of no variance are left out. 0 where there is nothing to measure.
    """
    some = np.nonzero(fitted.values > 0)[0]
    if not len(some):
        return 0.0
    vectors = table.where(complete(F.col(vector))).select(F.col(vector).alias("vector"))
    size, k = len(fitted.sums), len(some)

    def products(rows: list) -> np.ndarray:
        z = fitted.whiten(whole_numbers(rows, size))[:, some]
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = _summed(vectors, products) / fitted.n
    mean, second = sums[:k], sums[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(table: DataFrame, fitted: Whitening, vector: str = "embedding") -> DataFrame:
    """The rows of ``table`` with a complete vector, with ``whitened array<double>`` and ``deviation decimal(38,0)``.

    Rows whose vector is null or holds a null or non-finite entry go; repeated rows
    stay, an empty table gives an empty result. Vectors shorter than the longest
    one fitted count as filled up with 0; entries of huge size are cut to 2**53
    once scaled. A deviation of more than 38 digits is null. Columns of ``table``
    that bear these names are replaced.
    """
    size, source = len(fitted.sums), unused(table, "vector")

    def start():
        def batch(rows: list) -> list[list]:
            x = whole_numbers(rows, size)
            return [fitted.whiten(x).tolist(), fitted.deviations(x)]

        return batch

    given = table.where(complete(F.col(vector))).withColumn(source, F.col(vector))
    return append_columns(given, source, start, "whitened array<double>, deviation decimal(38,0)", keep_source=False)
