"""Near-duplicate embeddings by binary codes of random rotations, error bounds and exact checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.components import connected_components
from gaugeline.llm.storage import stored

COSINE = 0.95
#: Bits of the estimating code, and bits of a rotated number on the query's side.
CODE_BITS, QUERY_BITS = 256, 4
#: Standard deviations of the estimate's error that a pair may lie below the limit.
CONFIDENCE = 5.0
#: Chance at most that a pair at the limit shares no bucket.
MISS = 1e-6
#: Vectors of a bucket that are compared in one group with another such part.
PART_VECTORS = 256
PAIRS_AT_ONCE = 1 << 18


@lru_cache(maxsize=8)
def rotation(dimensions: int, out: int, seed: int) -> np.ndarray:
    """A matrix with orthonormal columns that turns vectors at random and carries them into ``out`` dimensions."""
    random = np.random.default_rng([seed, dimensions, out])
    return np.linalg.qr(random.standard_normal((max(out, dimensions), dimensions)))[0]


@dataclass(frozen=True)
class Plan:
    """How many bits a bucket's key has and how many keys a vector has, by the number of vectors."""

    bits: int
    bands: int

    @classmethod
    def of(cls, vectors: int, cosine: float = COSINE) -> Plan:
        bits = min(30, max(8, ceil(log2(max(vectors, 2)))))
        agree = (1 - acos(cosine) / pi) ** bits
        return cls(bits, ceil(log(MISS) / log(1 - agree)))


def _hyperplanes(dimensions: int, count: int) -> np.ndarray:
    """Rows of as many independent random rotations as give ``count`` of them."""
    turns = [rotation(dimensions, dimensions, 1000 + k).T for k in range(-(-count // dimensions))]
    return np.concatenate(turns)[:count]


def encode(vectors: np.ndarray, plan: Plan) -> tuple[np.ndarray, ...]:
    """Codes, correction factors, quantised queries with their steps, and bucket keys of unit vectors.

    The code is the sign of the rotated vector; its factor is the inner product
    of the vector with its own code, which makes estimates unbiased. The query
    side is the rotated vector in QUERY_BITS bits a number, with a fixed dither.
    """
    turned = vectors @ rotation(vectors.shape[1], CODE_BITS, 1).T
    wide = turned.shape[1]
    code = turned > 0
    factor = np.abs(turned).sum(axis=1) / np.sqrt(wide)
    levels = (1 << QUERY_BITS) - 1
    top = np.abs(turned).max(axis=1)
    step = 2 * top / levels
    dither = np.random.default_rng(3).random(wide)
    query = np.clip(np.floor((turned + top[:, None]) / step[:, None] + dither), 0, levels).astype(np.uint8)
    bits = vectors @ _hyperplanes(vectors.shape[1], plan.bits * plan.bands).T > 0
    weights = 1 << np.arange(plan.bits, dtype=np.int64)
    keys = bits.reshape(len(vectors), plan.bands, plan.bits) @ weights
    return code, factor, query, step, keys.astype(np.uint32)


def estimate(code: np.ndarray, factor: np.ndarray, query: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased inner products of coded with quantised unit vectors, pair by pair, and their error bounds."""
    wide = code.shape[1]
    levels = (1 << QUERY_BITS) - 1
    number = (query.astype(np.float32) - levels / 2) * step[:, None]
    inner = np.einsum("ij,ij->i", code * np.float32(2) - 1, number) / np.sqrt(wide)
    bound = CONFIDENCE * (np.sqrt(np.maximum(0, 1 - factor**2) / (wide - 1)) + step / np.sqrt(4)) / factor
    return inner / factor, bound


def read_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, content, vector): doubles as bytes and their name; both null for vectors that link with nothing."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                names, data = [], []
                for vec_id, row in zip(*(c.to_pylist() for c in part.columns)):
                    x = np.array(row, np.float64) if vec_id is not None and row and None not in row else np.zeros(0)
                    x = x + 0.0  # one kind of zero
                    good = len(x) and np.isfinite(x).all() and x.any()
                    data.append(x.tobytes() if good else None)
                    names.append(blake2b(data[-1], digest_size=16).digest() if good else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.binary()), pa.array(data, pa.binary())], names=["vec_id", "content", "vector"]
                )

    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(read, "vec_id long, content binary, vector binary")


def _unit(data: bytes) -> np.ndarray:
    x = np.frombuffer(data)
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def code_vectors(classes: DataFrame, plan: Plan) -> DataFrame:
    """(node, dimensions, code, factor, query, step, keys) of every class of equal vectors."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, units = batch.column(0).to_pylist(), [_unit(x) for x in batch.column(1).to_pylist()]
            for width in sorted({len(x) for x in units}):
                own = [k for k, x in enumerate(units) if len(x) == width]
                for at in range(0, len(own), 512):
                    some = own[at : at + 512]
                    codes, factor, query, step, keys = encode(np.array([units[k] for k in some]), plan)
                    nibbles = (query[:, ::2] << 4 | np.pad(query, ((0, 0), (0, query.shape[1] % 2)))[:, 1::2]) if QUERY_BITS == 4 else query
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([nodes[k] for k in some], pa.int64()),
                            pa.array([width] * len(some), pa.int32()),
                            pa.array([x.tobytes() for x in np.packbits(codes, axis=1)], pa.binary()),
                            pa.array(factor.astype(np.float32)),
                            pa.array([x.tobytes() for x in nibbles], pa.binary()),
                            pa.array(step.astype(np.float32)),
                            pa.array([x.tobytes() for x in keys], pa.binary()),
                            pa.array([x.tolist() for x in keys.astype(np.int64)], pa.list_(pa.int64())),
                        ],
                        names=["node", "dimensions", "code", "factor", "query", "step", "keys", "buckets"],
                    )

    return classes.select("node", "vector").mapInArrow(
        code,
        "node long, dimensions int, code binary, factor float, query binary, step float, keys binary, buckets array<long>",
    )


def _pairs_within(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of neighbouring groups of rows, a bounded number at a time."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    after = ends - np.arange(len(ends)) - 1
    cuts = np.searchsorted(np.cumsum(after), np.arange(0, after.sum() + PAIRS_AT_ONCE, PAIRS_AT_ONCE), "right")
    for low, high in zip(cuts[:-1], cuts[1:]):
        high = max(high, low)
        count = after[low:high]
        left = np.repeat(np.arange(low, high), count)
        right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + left + 1
        if len(left):
            yield left, right
    low = cuts[-1]
    count = after[low:]
    left = np.repeat(np.arange(low, len(after)), count)
    if len(left):
        yield left, np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + left + 1


def candidate_pairs(coded: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs (a, b) that share a bucket and whose estimate reaches the limit within its error bound.

    Buckets of one vector are left out before the codes are shuffled. A large
    bucket is cut into parts, and each pair of parts is a group of its own, so
    that no task holds a bucket. A pair is given by the first bucket it shares.
    """
    rows = coded.select("node", "dimensions", F.posexplode("buckets").alias("band", "bucket"))
    rows = rows.withColumn("key", F.xxhash64("dimensions", "band", "bucket")).select("node", "band", "key")
    sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / PART_VECTORS)
    shared = rows.join(sizes, "key").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    # Part p meets every part: the group of (p, q) is that of the smaller and the larger.
    spread = shared.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.withColumn("group", F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")))
    spread = spread.select("group", "band", "node", "part", (F.col("part") == F.col("other")).alias("same"))
    payload = coded.drop("buckets", "dimensions")
    full = spread.join(payload, "node").repartition("group").sortWithinPartitions("group", "node", "part")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if tail is not None:
                table = pa.concat_tables([tail, table]).combine_chunks()
            group = table.column("group").to_numpy()
            last = int(np.searchsorted(group != group[-1], False)) if len(group) and (group == group[-1]).all() else len(group) - int((group == group[-1])[::-1].argmin())
            tail = table.slice(last)
            if last:
                yield from settle(table.slice(0, last))
        if tail is not None and tail.num_rows:
            yield from settle(tail)

    def settle(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group, node, part, band = (table.column(k).to_numpy() for k in ("group", "node", "part", "band"))
        same = table.column("same").to_numpy()
        matrix = lambda name, kind: np.array([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        code, query, keys = matrix("code", np.uint8), matrix("query", np.uint8), matrix("keys", np.uint32)
        factor, step = table.column("factor").to_numpy(), table.column("step").to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(group)])))
        for left, right in _pairs_within(sizes):
            # A group of two different parts holds rows that met their own part elsewhere.
            wanted = (node[left] != node[right]) & ((part[left] != part[right]) | same[left] & same[right])
            left, right = left[wanted], right[wanted]
            for at in range(0, len(left), 1 << 15):
                i, j = left[at : at + (1 << 15)], right[at : at + (1 << 15)]
                unpacked = np.unpackbits(code[i], axis=1)
                number = np.empty((len(j), unpacked.shape[1]), np.uint8)
                number[:, ::2], number[:, 1::2] = query[j] >> 4, query[j] & 15
                value, bound = estimate(unpacked, factor[i], number, step[j])
                near = value + bound >= cosine
                i, j = i[near], j[near]
                first = np.argmax(keys[i] == keys[j], axis=1) == band[i]
                i, j = i[first], j[first]
                if len(i):
                    a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return full.mapInArrow(compare, "a long, b long")


def exact_links(pairs: DataFrame, classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The pairs whose cosine in double precision reaches the limit."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x), np.frombuffer(y)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                keep.append(len(x) == len(y) and bool(x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    vectors = classes.select("node", "vector")
    full = pairs.join(vectors.select(F.col("node").alias("a"), F.col("vector").alias("x")), "a").join(
        vectors.select(F.col("node").alias("b"), F.col("vector").alias("y")), "b"
    )
    return full.select("a", "b", "x", "y").mapInArrow(check, "a long, b long").distinct()


def near_vectors(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Equal vectors are one class with a count, never expanded into pairs. A
    vector that is null, empty, zero or holds a null or non-finite number links
    with nothing, nor does one of another length or without a vec_id (whose
    component is null). Repeated rows are vectors of their own, so each counts
    among the other's links. Kept: the smallest vec_id of each component.
    """
    rows = stored(read_vectors(table), "vectors")
    filled = rows.where(F.col("content").isNotNull())
    classes = filled.groupBy("content").agg(F.min("vec_id").alias("node"), F.count("*").alias("times"), F.any_value("vector").alias("vector"))
    classes = stored(classes, "vector-classes")
    plan = Plan.of(classes.count(), cosine)
    coded = stored(code_vectors(classes, plan), "codes")
    pairs = stored(candidate_pairs(coded, cosine), "candidates")
    links = stored(exact_links(pairs, classes, cosine), "vector-links")
    both = links.union(links.select("b", "a"))
    times = classes.select(F.col("node").alias("b"), "times")
    reached = both.join(times, "b").groupBy(F.col("a").alias("node")).agg(F.sum("times").alias("others"))
    found = (
        classes.select("content", "node", "times")
        .join(reached, "node", "left")
        .join(connected_components(links), "node", "left")
        .select(
            "content",
            (F.coalesce("others", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    out = rows.select("vec_id", "content").join(found, "content", "left")
    component = F.when(F.col("content").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
