"""Best-fit packing of tokenised documents into sequences by bin completion."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.storage import stored
from gaugeline.llm.subword import encoder

SEQUENCE = 2048
END_ID = 0
#: Pieces of one length that are numbered in one group.
GROUP_PIECES = 4096
#: Branches that the search may open; it bounds work on the histogram, not the rows packed.
SEARCH_NODES = 4000
#: Fillings tried per branch, and the largest number of documents in an enumerated filling.
BRANCHES, DEPTH = 3, 4


def cut_documents(
    docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID, tokenizer: str | None = None
) -> DataFrame:
    """Pieces of at most ``size`` tokens: (doc_id, piece, start, length, ids_crc32).

    Each row of ``docs`` is a document of its own, repeated rows too; a null text
    is empty and gives a piece with the end id alone. A null doc_id is kept.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            rows: list[tuple] = []
            for at in range(0, len(names), 128):
                for name, ids in zip(names[at : at + 128], ids_of.encode(texts.slice(at, 128).to_pylist())):
                    ids += end
                    for start in range(0, len(ids), 4 * size):
                        part = ids[start : start + 4 * size]
                        rows.append((name, start // (4 * size), start // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), kind) for column, kind in zip(zip(*rows), TYPES)] if rows else [pa.array([], kind) for kind in TYPES],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def undominated_fillings(count: np.ndarray, room: int, depth: int = DEPTH, keep: int = BRANCHES) -> list[list[int]]:
    """The best fillings of ``room`` with lengths that are left, fullest and coarsest first.

    A filling is dropped if a single length at least as long as it fits too: by
    exchange, whatever follows the smaller one can follow the larger.
    """
    lengths = np.flatnonzero(count[: room + 1])
    if not len(lengths):
        return [[]]
    best: list[tuple[int, list[int]]] = [(int(lengths[-1]), [int(lengths[-1])])]
    have = np.zeros(room + 1, np.int64)
    have[lengths] = lengths
    floor = np.maximum.accumulate(have)  # the longest length that fits into a room

    def grow(taken: list[int], left: int) -> None:
        """Complete ``taken`` by descending lengths, the last one by best fit."""
        top = min(taken[-1], left) if taken else left
        options = lengths[lengths <= top]
        options = options[options * (depth - len(taken)) >= min(left, top) // 2][::-1][:64]
        firsts = [int(x) for x in options if count[x] > taken.count(int(x))]
        for first in firsts:
            rest = left - first
            last = int(floor[min(rest, first)]) if rest > 0 else 0
            filling = [*taken, first] + ([last] if last else [])
            if last and count[last] <= filling[:-1].count(last):
                filling.pop()
            best.append((sum(filling), filling))
            if sum(filling) == room:
                return

    grow([], room)
    if max(s for s, _ in best) < room:
        for _, filling in sorted(best, key=lambda x: -x[0])[:8]:
            for size in range(1, min(len(filling), depth - 2) + 1):
                grow(filling[:size], room - sum(filling[:size]))
    seen, out = set(), []
    for total, filling in sorted(best, key=lambda x: (-x[0], len(x[1]))):
        key = tuple(sorted(filling, reverse=True))
        left = room - total
        while (more := int(floor[left]) if left > 0 else 0) and count[more] > key.count(more):  # never leave room that a document fits
            key, left = tuple(sorted((*key, more), reverse=True)), left - more
        if key not in seen and not (len(key) > 1 and sum(key) < best[0][0]):
            seen.add(key)
            out.append(list(key))
        if len(out) == keep:
            break
    return out


def best_fit_filling(count: np.ndarray, room: int) -> list[int]:
    """The longest length that fits, again and again."""
    out, left = [], dict()
    while room > 0:
        lengths = np.flatnonzero(count[: room + 1])
        lengths = [int(x) for x in lengths[::-1][:64] if count[x] > left.get(int(x), 0)]
        if not lengths:
            break
        out.append(lengths[0])
        left[lengths[0]] = left.get(lengths[0], 0) + 1
        room -= lengths[0]
    return out


def waste_bound(count: np.ndarray, size: int) -> int:
    """No packing has fewer sequences: by the sum of lengths and by lengths that cannot share one."""
    n = np.arange(len(count), dtype=np.int64)
    total = int((n * count).sum())
    best = -(-total // size)
    for small in range(1, size // 2 + 1, 16):
        large = int(count[size - small + 1 :].sum())
        half = int(count[size // 2 + 1 : size - small + 1].sum())
        middle = slice(small, size // 2 + 1)
        spare = half * size - int((n * count)[size // 2 + 1 : size - small + 1].sum())
        best = max(best, large + half + max(0, -(-(int((n * count)[middle].sum()) - spare) // size)))
    return best


def pack_lengths(
    count: np.ndarray, size: int = SEQUENCE, nodes: int = SEARCH_NODES
) -> list[tuple[int, list[int]]]:
    """Fillings with their multiplicities for ``count[length]`` documents of each length.

    Bin completion over the histogram: the longest length left is completed by
    an undominated filling as often as the counts allow, so the work depends on
    the number of lengths and not on that of documents. Best fit gives the first
    incumbent; a branch ends when its waste leaves no way below the incumbent.
    """
    count = count.astype(np.int64)
    total, bound = int((np.arange(len(count)) * count).sum()), waste_bound(count, size)

    def step(left: np.ndarray, filling: list[int]) -> int:
        kinds, times = np.unique(filling, return_counts=True)
        often = int((left[kinds] // times).min())
        left[kinds] -= often * times
        return often

    def greedy(left: np.ndarray, fill) -> list[tuple[int, list[int]]]:
        out, left = [], left.copy()
        while len(some := np.flatnonzero(left)):
            top = int(some[-1])
            left[top] -= 1
            rest = fill(left, size - top)
            left[top] += 1
            out.append((step(left, [top, *rest]), [top, *rest]))
        return out

    bins = lambda plan: sum(often for often, _ in plan)
    best = greedy(count, best_fit_filling)
    if bins(best) > bound:
        best = min(best, greedy(count, lambda left, room: undominated_fillings(left, room)[0]), key=bins)
    stack, opened = [(count, [], 0, 0)], 0
    while stack and bins(best) > bound and opened < nodes:
        left, plan, used, waste = stack.pop()
        opened += 1
        some = np.flatnonzero(left)
        if not len(some):
            if used < bins(best):
                best = plan
            continue
        if waste > (bins(best) - 1) * size - total:
            continue
        top, options = int(some[-1]), []
        left = left.copy()
        left[top] -= 1
        fillings = undominated_fillings(left, size - top)
        left[top] += 1
        for rest in reversed(fillings):
            after = left.copy()
            often = step(after, [top, *rest])
            spare = often * (size - top - sum(rest))
            options.append((after, [*plan, (often, [top, *rest])], used + often, waste + spare))
        stack += options
    return best


def number_within(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds rank: pieces of one length are numbered from 0, in groups of bounded size."""
    parts = [max(1, -(-counts.get(n, 0) // GROUP_PIECES)) for n in range(1, max(counts) + 1)]
    groups = F.element_at(F.array(*map(F.lit, parts)), F.col("length").cast("int"))
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "start"), groups.cast("long")))
    sizes = salted.groupBy("length", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        salted.withColumn("place", F.row_number().over(within) - 1)
        .join(sizes, ["length", "part"])
        .withColumn("rank", F.col("base") + F.col("place"))
        .drop("part", "base", "place")
    )


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to pieces of 1 to ``size`` tokens; no row is lost.

    Pieces of one length are alike, so only their histogram (at most ``size``
    rows) reaches the driver. The plan made of it gives ranges of ranks within a
    length, bounded by the number of fillings, which tasks look up.
    """
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").agg(F.count("*")).collect()}
    if not counts:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    histogram = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    slots: dict[int, list[list[int]]] = {}
    used, first = dict.fromkeys(counts, 0), 0
    for often, filling in pack_lengths(histogram, size):
        place = 0
        for length in sorted(set(filling), reverse=True):
            times = filling.count(length)
            slots.setdefault(length, []).append([used[length], first, times, place])
            used[length] += often * times
            place += times * length
        first += often
    table = {length: np.array(rows, np.int64) for length, rows in slots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(k)).to_numpy() for k in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for own in np.unique(length):
                rows, at = table[int(own)], np.flatnonzero(length == own)
                row = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                ahead = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + ahead // row[:, 2]
                offset[at] = row[:, 3] + ahead % row[:, 2] * own
            kept = [c for n, c in zip(batch.schema.names, batch.columns) if n != "rank"]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ranked = number_within(pieces, counts)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank"]
    return ranked.mapInArrow(place, ", ".join([*kinds, "sequence_id long", "offset long"]))


def pack_documents(
    docs: DataFrame, size: int = SEQUENCE, end_id: int = END_ID, tokenizer: str | None = None
) -> DataFrame:
    """Pack every row of ``docs`` into sequences of at most ``size`` tokens.

    Null text: empty, one token. Repeated rows: packed each. Null doc_id: kept.
    Empty table: no rows. Columns besides doc_id and text are not read.
    """
    pieces = stored(cut_documents(docs, size, end_id, tokenizer), "pieces")
    return pack_pieces(pieces, size).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
