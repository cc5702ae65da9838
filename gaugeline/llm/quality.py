"""Quality of whole texts: random-indexing word vectors, a two-layer network and a calibrated temperature."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.caches import forget
from gaugeline.llm.storage import stored

#: Words share this many hashed rows; the first ones stand for shapes of words and marks.
BUCKETS, SHAPES = 1 << 14, 64
#: Numbers in an index vector, and how many of them are 1 or -1.
DIMENSIONS, ONES = 64, 4
#: Neighbours on each side that make up a word's context.
REACH = 2
#: Labelled documents that the network is fitted on, by a hash of doc_id; a fifth of them calibrates.
FIT_DOCUMENTS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 3e-3, 1e-4
#: Numbers of a document beside its pooled vector.
EXTRA = 3
KEEP_FROM = 0.7
CACHE_CHUNKS = 300_000
TOKENS_AT_ONCE = 1 << 20

PIECES = re.compile(r"[^\W\d_]+|\d+|_+|[^\w\s]+")


def chunk_tokens(chunk: str) -> bytes:
    """Rows of the pieces of a chunk (a run without blanks), as little-endian 16-bit integers."""
    out = []
    for piece in PIECES.findall(chunk):
        if piece[0].isalpha():
            out.append(SHAPES + zlib.crc32(piece.lower().encode()) % (BUCKETS - SHAPES))
            if len(piece) > 1 and piece.isupper():
                out.append(0)
        elif piece[0].isdigit():
            out.append(1 + min(len(piece), 7))
        else:
            out.append(9 + zlib.crc32(piece[:3].encode()) % (SHAPES - 9))
    return np.array(out, "<u2").tobytes()


class Tokens:
    """Token rows of texts; a bounded number of chunks is kept."""

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def of(self, text: str | None) -> np.ndarray:
        known, chunks = self.known, (text or "").split()
        found = list(map(known.get, chunks))
        if None in found:
            if len(known) > CACHE_CHUNKS:
                known.clear()
            for k, x in enumerate(found):
                if x is None:
                    found[k] = known[chunks[k]] = chunk_tokens(chunks[k])
        return np.frombuffer(b"".join(found), "<u2")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero numbers of every row's fixed random vector."""
    random = np.random.default_rng(20240607)
    places = np.argsort(random.random((BUCKETS, DIMENSIONS)), axis=1)[:, :ONES]
    return places, random.integers(0, 2, (BUCKETS, ONES)) * 2 - 1


def context_sums(docs: DataFrame) -> np.ndarray:
    """For every row the sum of its neighbours' index vectors over all documents.

    Each task adds up a table of fixed size; the tables are summed as whole
    numbers, so that neither their order nor a repeated task changes the result.
    """
    names = [f"c{k}" for k in range(DIMENSIONS)]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tokens, (places, signs) = Tokens(), index_vectors()
        total, held, size = np.zeros(BUCKETS * DIMENSIONS), [], 0
        gap = np.full(REACH, BUCKETS, np.int64)  # no word reaches into the next document

        def flush() -> None:
            nonlocal held, size
            row = np.concatenate(held)
            held, size = [], 0
            for step in range(1, REACH + 1):
                left, right = row[:-step], row[step:]
                both = (left < BUCKETS) & (right < BUCKETS)
                left, right = left[both], right[both]
                for word, other in ((left, right), (right, left)):
                    at = word * DIMENSIONS
                    for k in range(ONES):
                        total[:] += np.bincount(at + places[other, k], signs[other, k], BUCKETS * DIMENSIONS)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(at, 256).to_pylist():
                    own = tokens.of(text).astype(np.int64)
                    held += [own, gap]
                    size += len(own)
                    if size >= TOKENS_AT_ONCE:
                        flush()
        if size:
            flush()
        table = total.reshape(BUCKETS, DIMENSIONS).astype(np.int64)
        some = np.flatnonzero(table.any(axis=1))
        for at in range(0, len(some), 2048):
            rows = some[at : at + 2048]
            yield pa.RecordBatch.from_arrays([pa.array(rows), *map(pa.array, np.ascontiguousarray(table[rows].T))], names=["bucket", *names])

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        add_up, ", ".join(["bucket long", *(f"{name} long" for name in names)])
    )
    sums = parts.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names])
    out = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    for row in sums.toLocalIterator():  # BUCKETS rows at most
        out[row[0]] = row[1:]
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """The index vector and the context vector of every row, each of length one."""
    places, signs = index_vectors()
    index = np.zeros((BUCKETS, DIMENSIONS))
    np.put_along_axis(index, places, signs, axis=1)
    context = np.sign(sums) * np.sqrt(np.abs(sums))
    both = [x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) for x in (index, context)]
    return np.hstack(both).astype(np.float32)


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The mean word vector of a document, its logarithmic length and the shares of repeated words."""
    width = vectors.shape[1]
    out = np.zeros(width + EXTRA, np.float32)
    for at in range(0, len(rows), 1 << 16):
        out[:width] += vectors[rows[at : at + (1 << 16)]].sum(axis=0)
    out[:width] /= max(len(rows), 1)
    kinds = np.count_nonzero(np.bincount(rows, minlength=1)) if len(rows) else 0
    out[width] = np.log1p(len(rows))
    out[width + 1] = np.mean(rows[1:] == rows[:-1]) if len(rows) > 1 else 0
    out[width + 2] = np.log1p(kinds)
    return out


@dataclass
class Network:
    """tanh layer, then a logit; the logit is divided by the temperature."""

    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = (x - self.centre) / self.scale
        return np.tanh(x @ self.first + self.first_bias) @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on four fifths of the rows, the temperature by a grid on the others.

    With labels of one kind only, or none, the score is their smoothed share.
    """
    width = x.shape[1]
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        zero = np.zeros((width, 1)), np.zeros(1), np.zeros(1)
        return Network(np.zeros(width), np.ones(width), *zero, float(np.log(share / (1 - share))))
    random = np.random.default_rng(7)
    order = random.permutation(len(y))
    check, fit = order[: len(y) // 5], order[len(y) // 5 :]
    net = Network(
        x[fit].mean(axis=0), x[fit].std(axis=0) + 1e-6, random.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN), 0.0,
    )
    scaled = (x - net.centre) / net.scale
    names = ("first", "first_bias", "second", "second_bias")
    moments, turn = {n: [0.0, 0.0] for n in names}, 0
    for _ in range(EPOCHS):
        for at in range(0, len(fit), BATCH):
            rows = fit[at : at + BATCH]
            inner = np.tanh(scaled[rows] @ net.first + net.first_bias)
            error = (1 / (1 + np.exp(-np.clip(inner @ net.second + net.second_bias, -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, net.second) * (1 - inner**2)
            steps = dict(zip(names, (scaled[rows].T @ back + DECAY * net.first, back.sum(axis=0), inner.T @ error + DECAY * net.second, error.sum())))
            turn += 1
            for name, step in steps.items():
                m, v = moments[name]
                m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step**2
                moments[name] = [m, v]
                update = RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
                setattr(net, name, getattr(net, name) - update)
        random.shuffle(fit)
    if len(check):
        logits = net.logits(x[check])
        net.temperature = min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logits / t, y[check]))
    return net


def fold(doc_id, of: int):
    """crc32 of doc_id as text, modulo ``of``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def fit_quality(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents and a network from a bounded sample of labelled ones.

    Labels are taken from rows whose doc_id's crc32 is not 2 modulo 4. A doc_id
    with several labels counts with the lowest; null labels and ids do not count.
    """
    vectors = word_vectors(context_sums(docs))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    known = stored(known, "all-labels")
    share = min(1.0, 1.2 * FIT_DOCUMENTS / max(1, known.count()))  # so that no task sends FIT_DOCUMENTS rows of its own
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = known.where(order < int(share * (1 << 30))).orderBy(order, "doc_id").limit(FIT_DOCUMENTS)
    known = F.broadcast(stored(known, "labels"))  # FIT_DOCUMENTS rows of two numbers at most

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tokens = Tokens()
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                rows += [pooled(tokens.of(x), vectors).tobytes() for x in batch.column(2).slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["doc_id", "quality", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(known, "doc_id").select("doc_id", "quality", "text").mapInArrow(pool, "doc_id long, quality int, x binary")
    rows = sorted({(r[0], bytes(r[2]), r[1]) for r in sample.collect()})
    width = vectors.shape[1] + EXTRA
    x = np.array([np.frombuffer(r[1], np.float32) for r in rows], np.float64).reshape(len(rows), width)
    return vectors, fit_network(x, np.array([r[2] for r in rows], np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows and columns of ``docs`` with score (0 to 1) and predicted (1 if score >= 0.7).

    The score is a function of the text alone. Null or empty text: the score of
    no words. Null doc_id: scored, never learned from. Repeated rows: equal
    scores. No usable labels: 0.5 for all. Columns named score or predicted are
    replaced.
    """
    vectors, net = fit_quality(docs, labels)
    kept = [name for name in docs.columns if name.lower() not in ("score", "predicted")]
    base = docs.select(*kept)
    at = [name.lower() for name in kept].index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tokens = Tokens()
        for batch in batches:
            scores = []
            for low in range(0, batch.num_rows, 256):
                texts = batch.column(at).slice(low, 256).to_pylist()
                scores.append(net.scores(np.array([pooled(tokens.of(x), vectors) for x in texts], np.float64)))
            found = np.concatenate(scores) if scores else np.zeros(0)
            columns = [*batch.columns, pa.array(found), pa.array((found >= KEEP_FROM).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "score", "predicted"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema]
    return base.mapInArrow(score, ", ".join([*kinds, "score double", "predicted int"]))
