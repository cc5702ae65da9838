"""Vector codes: codebooks per part of a vector, nearest entries by the equal-average search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.storage import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components up to this and parts up to LONGEST keep every sum of squares exact in doubles and 64 bits.
LARGEST, LONGEST = 2**20, 2**10
#: Rows searched together, and entries looked at per step on either side.
GROUP, STEP = 512, 16
#: Per-label sums up to this many rows are broadcast; beyond, the join is salted.
BROADCAST_LABELS, SLOTS = 200_000, 16


class EqualAverage:
    """Exact nearest entries of one codebook, ties to the lower index.

    Entries lie in order of their component sum. For vectors of d components the
    squared gap of two sums is at most d times their squared distance, so the
    search goes outward from a part's own sum and a side ends where the gap,
    squared and divided by d, strictly exceeds the best distance. Rows with sums
    next to each other go outward together, STEP entries at a time.
    """

    def __init__(self, entries: np.ndarray):
        totals = entries.sum(axis=1)
        self.order = np.argsort(totals, kind="stable")
        self.totals, self.entries = totals[self.order], entries[self.order].astype(np.float64)
        self.squares = (self.entries**2).sum(axis=1)
        self.looked_at = 0

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance of each row."""
        found, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        totals = rows.sum(axis=1)
        order = np.argsort(totals, kind="stable")
        for start in range(0, len(rows), GROUP):
            own = order[start : start + GROUP]
            found[own], best[own] = self._group(rows[own], totals[own])
        return found, best

    def _group(self, rows: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, d = rows.shape
        values, squares = rows.astype(np.float64), (rows.astype(np.float64) ** 2).sum(axis=1)
        best = np.full(n, 2**62 // max(d, 1), np.int64)
        index = np.full(n, len(self.order), np.int64)
        low = high = int(np.searchsorted(self.totals, totals[n // 2]))

        def look(a: int, b: int) -> None:
            away = squares[:, None] - 2 * (values @ self.entries[a:b].T) + self.squares[a:b]  # whole numbers, exact
            nearest = away.min(axis=1)
            numbers = np.where(away == nearest[:, None], self.order[a:b], len(self.order)).min(axis=1)
            nearest = nearest.astype(np.int64)
            better = (nearest < best) | ((nearest == best) & (numbers < index))
            best[better], index[better] = nearest[better], numbers[better]
            self.looked_at += n * (b - a)

        def ended(gap: np.ndarray) -> bool:
            """Whether no row can find anything at this gap or a larger one on the same side."""
            return bool(((gap > 0) & (gap * gap > d * best)).all())

        left = right = True
        while left or right:
            if left := left and low > 0 and not ended(totals - self.totals[low - 1]):
                look(max(0, low - STEP), low)
                low = max(0, low - STEP)
            if right := right and high < len(self.order) and not ended(self.totals[high] - totals):
                look(high, min(len(self.order), high + STEP))
                high = min(len(self.order), high + STEP)
        return index, best


def kept_vectors(frame: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, vector, label) of rows whose vector is there, not empty, and all finite."""
    rows = frame.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where((F.size("vector") > 0) & finite)


def _whole(batch: pa.Array, parts: int, width: int | None = None) -> np.ndarray:
    """Integer components of a batch of vectors: (rows, parts, part length)."""
    lengths = np.diff(batch.offsets.to_numpy())
    if len(lengths) and (lengths.min() != lengths.max() or lengths[0] % parts or (width or lengths[0]) != lengths[0]):
        raise ValueError(f"vectors need one length, a multiple of {parts}")
    own = np.floor(SCALE * batch.flatten().to_numpy(zero_copy_only=False))
    if own.size and (np.abs(own).max() > LARGEST or len(own) // len(lengths) // parts > LONGEST):
        raise ValueError(f"components beyond {LARGEST / SCALE:g} or parts beyond {LONGEST} components are not coded")
    return own.astype(np.int64).reshape(len(lengths), parts, -1)


def train_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, part length) of ``kept_vectors`` after some rounds.

    They start as the parts of the rows with the smallest vec_ids (null ones last,
    equal ones by their vector); with fewer rows than ``entries`` a codebook has
    one entry a row. Tasks send sums and counts per entry and component; the
    driver sees these sums alone, whose number the parameters fix.
    """
    first = vectors.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    seeds = pa.array([row.vector for row in first], pa.list_(pa.float64()))
    books = np.ascontiguousarray(_whole(seeds, parts).transpose(1, 0, 2))
    _, count, width = books.shape

    def summed(books: np.ndarray):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searches = [EqualAverage(book) for book in books]
            sums = np.zeros((parts, count, width + 1), np.int64)  # the last place counts
            for batch in batches:
                rows = _whole(batch.column(0), parts, parts * width)
                for part, search in enumerate(searches):
                    index, _ = search.nearest(rows[:, part])
                    order = np.argsort(index, kind="stable")
                    used, starts = np.unique(index[order], return_index=True)
                    if len(used):
                        sums[part, used, :width] += np.add.reduceat(rows[order, part], starts)
                        sums[part, used, width] += np.diff([*starts, len(order)])
            slots = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(sums.ravel()[slots])], names=["slot", "total"])

        return work

    for _ in range(rounds):
        sums = np.zeros(parts * count * (width + 1), np.int64)
        totals = vectors.select("vector").mapInArrow(summed(books), "slot long, total long")
        for slot, total in totals.groupBy("slot").agg(F.sum("total")).collect():
            sums[slot] = total
        sums = sums.reshape(parts, count, width + 1)
        used = sums[:, :, width] > 0
        books[used] = sums[used][:, :width] // sums[used][:, width:]
    return books


def code_vectors(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of ``kept_vectors`` under given codebooks."""
    parts = len(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [EqualAverage(book) for book in books]
        for batch in batches:
            rows = _whole(batch.column(1), parts)
            found = [search.nearest(rows[:, part]) for part, search in enumerate(searches)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            codes = [codes[k : k + 2 * parts] for k in range(0, len(codes), 2 * parts)]
            error = sum(away for _, away in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("vec_id", "vector", "label").mapInArrow(work, f"vec_id long, label {kind}, code string, error long")


def vector_codes(frame: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes of all vectors: (vec_id, code, error, label_error, codebooks_sha256).

    Null and empty vectors and vectors with null or non-finite components have no
    row. A null vec_id is kept and never a seed before others; repeated rows are
    each coded and counted. Ties of distance go to the lower index. Null labels are
    one label. Empty table: no rows. Other columns are left out, whatever their names.
    Vectors of different lengths, and components beyond LARGEST / SCALE, raise an error.
    """
    if entries > 256:
        raise ValueError("a code has one byte a part")
    vectors = kept_vectors(frame)
    books = train_codebooks(vectors, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stored(code_vectors(vectors, books), "vector-codes")
    sums = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    on = coded["label"].eqNullSafe(sums["label"])
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    else:  # a label may hold a third of all rows
        coded = coded.withColumn("slot", F.pmod(F.xxhash64("vec_id"), F.lit(SLOTS)))
        sums = sums.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1)).cast("array<long>")))
        on = coded["label"].eqNullSafe(sums["label"]) & (coded["slot"] == sums["slot"])
    joined = coded.join(sums, on)
    return joined.select(coded["vec_id"], "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
