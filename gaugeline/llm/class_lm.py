"""Class-based bigram model: exchange clustering of all words, smoothed scores and perplexity of whole texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.shingles import words_of
from gaugeline.llm.storage import stored

#: Words exchanged first, on the driver; until then every other word goes by the unit of its ending.
FREQUENT, ENDINGS = 1024, 256
#: Classes beside that of the end token.
CLASSES = 64
#: Classes of a word's right neighbours, then those of its left ones.
SIDE, SIDES = CLASSES + 1, 2 * (CLASSES + 1)
#: Sweeps over all other words end when one raises the likelihood by less, in nats a token.
LEAST_RISE = 1e-4
#: Words whose counts every task holds; counts of all others are joined.
HELD_WORDS = 1 << 18
#: Weight of the class distribution in each row of transitions.
SMOOTHING = 5.0
CACHE_WORDS = 400_000
TOKENS_AT_ONCE, WORDS_AT_ONCE = 1 << 21, 4096


def word_code(word: bytes) -> int:
    """63 bits for a word: a hash, and below it the unit of the word's last three bytes."""
    return (xxhash.xxh3_64_intdigest(word) >> 1) & ~(ENDINGS - 1) | zlib.crc32(word[-3:]) % ENDINGS


class WordCodes(dict):
    """Codes of words; a bounded number of them is kept."""

    def __missing__(self, word: bytes) -> int:
        code = word_code(word)
        if len(self) < CACHE_WORDS:
            self[word] = code
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def find(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of codes among sorted ones, -1 for others."""
    if not len(sorted_codes):
        return np.full(len(codes), -1)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.where(sorted_codes[at] == codes, at, -1)


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of doc_id as text, modulo ``of``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def encode_words(docs: DataFrame) -> DataFrame:
    """(row, doc_id, codes): the codes of all words as bytes, so that later passes split no text.

    A row's number is its place in the input, the same whenever a task is repeated.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, row = WordCodes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                own = [codes.of(words_of(text)).tobytes() for text in part.column(1).to_pylist()]
                rows = np.arange(row, row + len(own))
                row += len(own)
                yield pa.RecordBatch.from_arrays([pa.array(rows), part.column(0), pa.array(own, pa.binary())], names=["row", "doc_id", "codes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(texts.mapInArrow(encode, "row long, doc_id long, codes binary"), "coded")


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """A few million tokens at a time, whole texts, -1 before and after each."""
    end = np.array([-1])
    rows, size = [end], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for codes in batch.column(0).slice(at, 256).to_pylist():
                rows += [np.frombuffer(codes, np.int64), end]
                size += len(rows[-2]) + 1
                if size >= TOKENS_AT_ONCE:
                    yield np.concatenate(rows)
                    rows, size = [end], 0
    if size:
        yield np.concatenate(rows)


def count_words(coded: DataFrame) -> DataFrame:
    """(code, n) of all words; each task sums up a few million words at a time before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _portions(batches):
            codes, n = np.unique(row[row >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["code", "n"])

    return coded.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def count_pairs(coded: DataFrame, frequent: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """How often each unit follows each; the end token is the last unit and stands before a text too."""
    width = FREQUENT + ENDINGS + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * width, np.int64)
        for codes in _portions(batches):
            row = _units(codes, frequent, unit)
            total += np.bincount(row[:-1] * width + row[1:], minlength=width * width)
        some = np.flatnonzero(total)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    pairs = coded.select("codes").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # By first unit as two arrays, so that at most ``width`` rows of at most ``width`` numbers come back.
    rows = pairs.groupBy(F.floor(F.col("pair") / width).alias("first")).agg(
        F.collect_list(F.struct("pair", "n")).alias("cells")
    )
    out = np.zeros(width * width, np.int64)
    for row in rows.select("cells.pair", "cells.n").toLocalIterator():
        out[row[0]] = row[1]
    return out.reshape(width, width)


def _units(codes: np.ndarray, frequent: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Units of words: their own, or that of their ending; -1 is the end token."""
    at = find(frequent, codes)
    own = unit[at] if len(unit) else at
    return np.where(codes < 0, FREQUENT + ENDINGS, np.where(at >= 0, own, FREQUENT + (codes & (ENDINGS - 1))))


def _contexts(word: np.ndarray, key: np.ndarray, n: np.ndarray, words: int) -> pa.Array:
    """For each of so many words its (key, n) as bytes; the rows are sorted by word."""
    entries = key.astype(np.uint64) | n.astype(np.uint64) << np.uint64(8)
    offsets = 8 * np.searchsorted(word, np.arange(words + 1))
    return pa.Array.from_buffers(pa.binary(), words, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(entries)])


def _tables(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Where a group of words begins, and its table of counts by key."""
    for at in range(0, len(column), WORDS_AT_ONCE):
        rows = [b"".join(x) if isinstance(x, list) else x for x in column.slice(at, WORDS_AT_ONCE).to_pylist()]
        entries = np.frombuffer(b"".join(rows), np.uint64)
        word = np.repeat(np.arange(len(rows)), [len(x) // 8 for x in rows])
        cell = word * SIDES + (entries & np.uint64(255)).astype(np.int64)
        yield at, np.bincount(cell, (entries >> np.uint64(8)).astype(np.float64), len(rows) * SIDES).reshape(-1, SIDES)


def word_contexts(coded: DataFrame, frequent: np.ndarray, unit: np.ndarray, label: np.ndarray) -> DataFrame:
    """(code, n, context) of every word that is not frequent: how often it stands beside each class.

    Tasks sum up a few million words at a time and send a row for each word.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _portions(batches):
            units = _units(codes, frequent, unit)
            kind, at = label[units], np.flatnonzero((units >= FREQUENT) & (codes >= 0))
            words, word = np.unique(codes[at], return_inverse=True)
            cell = np.concatenate((word * SIDES + kind[at + 1], word * SIDES + SIDE + kind[at - 1]))
            cell, n = np.unique(cell, return_counts=True)
            found = pa.RecordBatch.from_arrays([pa.array(words), _contexts(cell // SIDES, cell % SIDES, n, len(words))], names=["code", "context"])
            for low in range(0, len(words), 1 << 16):
                yield found.slice(low, 1 << 16)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, table in _tables(batch.column(1)):
                word, key = np.nonzero(table)
                n = table[:, :SIDE].sum(axis=1).astype(np.int64)
                columns = [batch.column(0).slice(at, len(table)), pa.array(n), _contexts(word, key, table[word, key].astype(np.int64), len(table))]
                yield pa.RecordBatch.from_arrays(columns, names=["code", "n", "context"])

    parts = coded.select("codes").mapInArrow(collect, "code long, context binary")
    whole = parts.groupBy("code").agg(F.collect_list("context").alias("contexts"))
    return stored(whole.mapInArrow(merge, "code long, n long, context binary"), "contexts")


def _likelihood(table: np.ndarray) -> float:
    """Of the neighbours' classes on both sides given a word's class, as far as it depends on the words' classes."""
    return sum(float(_entropy(t).sum() - _entropy(t.sum(axis=1)).sum()) for t in (table[:, :SIDE], table[:, SIDE:]))


def _weights(table: np.ndarray) -> np.ndarray:
    """By key and class, the log share of a class of neighbours on its side; a class without words has that of all."""
    out = np.empty((SIDES, CLASSES))
    for side in (slice(0, SIDE), slice(SIDE, SIDES)):
        own, share = table[:CLASSES, side], (table[:, side].sum(axis=0) + 1) / (table[:, side].sum() + SIDE)
        out[side] = np.log((own + share) / (own.sum(axis=1, keepdims=True) + 1)).T
    return out


def exchange_rest(contexts: DataFrame, fixed: np.ndarray, start: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """Exchange all words of ``contexts`` until a sweep does not raise the likelihood any more.

    In a sweep every word moves to the class whose neighbours explain its own
    neighbours best; then the classes' tables are added up anew. ``fixed`` has
    the frequent words' share of the tables, ``start`` the tables by endings.
    Gives the weights that the last words moved by and the tables they led to.
    """
    best, moved_by, table = _likelihood(start), None, start
    least = LEAST_RISE * max(1.0, start[:, :SIDE].sum())
    while True:
        weights = _weights(table)

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((SIDE, SIDES))
            for batch in batches:
                for _, own in _tables(batch.column(0)):
                    np.add.at(total, np.argmax(own @ weights, axis=1), own)  # noqa: B023
            cell = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.ravel()[cell].astype(np.int64))], names=["cell", "n"])

        sums = contexts.select("context").mapInArrow(move, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        new = fixed.copy()
        for cell, n in sums.collect():  # SIDE * SIDES rows at most
            new.ravel()[cell] += n
        rise = _likelihood(new) - best
        if rise > 0:
            best, moved_by, table = best + rise, weights, new
        if rise < least:
            return moved_by, table


def exchanged(contexts: DataFrame, weights: np.ndarray | None, ending_class: np.ndarray) -> DataFrame:
    """(code, count, class) of all words of ``contexts``; without weights by their endings."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = ending_class[batch.column(0).to_numpy() & (ENDINGS - 1)]
            if weights is not None:
                kinds = np.concatenate([np.argmax(own @ weights, axis=1) for _, own in _tables(batch.column(2))] or [kinds])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kinds.astype(np.int32))], names=["code", "count", "class"])

    return stored(contexts.mapInArrow(choose, "code long, count long, class int"), "words")


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange_classes(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each unit: units move to the class that gains most likelihood until none moves.

    The last unit (the end token) keeps the last class for itself. Gains are
    exact changes of sum N(c, d) log N(c, d) - sum N(c) log N(c) over both sides.
    Each move raises that sum by more than rounding can, so the sweeps end.
    """
    width = len(pairs)
    pairs = pairs.astype(np.float64)
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-weight[:-1], kind="stable")
    label = np.zeros(width, np.int64)
    label[order] = np.arange(width - 1) % classes
    label[-1] = classes
    hot = np.zeros((width, classes + 1))
    hot[np.arange(width), label] = 1
    table = hot.T @ pairs @ hot
    rows, columns = table.sum(axis=1), table.sum(axis=0)
    least = 1e-9 + 1e-14 * float(_entropy(pairs.sum()))
    moved = 1
    while moved:
        moved = 0
        for unit in order:
            if not weight[unit]:
                continue
            out = np.bincount(label, pairs[unit], classes + 1)
            into = np.bincount(label, pairs[:, unit], classes + 1)
            loop, old = pairs[unit, unit], label[unit]
            out[old] -= loop
            into[old] -= loop
            table[old] -= out
            table[:, old] -= into
            table[old, old] -= loop
            right, left = out.sum() + loop, into.sum() + loop
            rows[old] -= right
            columns[old] -= left
            gain = (_entropy(table + out[None, :]) - _entropy(table)).sum(axis=1) + (_entropy(table + into[:, None]) - _entropy(table)).sum(axis=0)
            own = np.diagonal(table)
            gain += _entropy(own + out + into + loop) - _entropy(own + out) - _entropy(own + into) + _entropy(own)
            gain -= _entropy(rows + right) - _entropy(rows) + _entropy(columns + left) - _entropy(columns)
            new = int(np.argmax(gain[:-1]))
            if gain[new] <= gain[old] + least:
                new = old
            moved += new != old
            label[unit] = new
            table[new] += out
            table[:, new] += into
            table[new, new] += loop
            rows[new] += right
            columns[new] += left
    return label


@dataclass
class ClassModel:
    """What scoring needs in every task, of bounded size, and counts and classes of all other words as a table."""

    words: DataFrame
    held: np.ndarray
    held_counts: np.ndarray
    held_class: np.ndarray
    frequent: np.ndarray
    frequent_class: np.ndarray
    ending_class: np.ndarray
    transitions: np.ndarray
    class_size: np.ndarray
    tokens: int
    kinds: int
    ends: int


def _most_common(counts: DataFrame) -> DataFrame:
    """The words above the lowest step of counts that HELD_WORDS words at most lie above.

    Steps are sixteenths of a doubling, so that some hundred sizes tell it and
    no task sends its own candidates to the driver.
    """
    step = F.floor(F.log2("n") * 16)
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    total, lowest = 0, None
    for own, size in sizes:
        total += size
        if total > HELD_WORDS:
            break
        lowest = own
    return counts.where(F.lit(False) if lowest is None else step >= lowest)


def fit_class_model(train: DataFrame) -> ClassModel:
    """Counts, classes and transitions from all rows of ``train``; repeated rows count again."""
    return fit_codes(encode_words(train))


def fit_codes(coded: DataFrame) -> ClassModel:
    """The model of texts given as codes.

    The most frequent words and the endings are exchanged on the driver, then
    every other word by its own neighbours on Spark. Neighbours count by their
    unit's class; a transition leads from that to a word's own class.
    """
    counts = stored(count_words(coded), "word-counts")
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    ends = coded.count()
    top = _most_common(counts).collect()  # HELD_WORDS rows of two numbers at most
    codes, n = (np.array([r[k] for r in top], np.int64) for k in (0, 1))
    order = np.argsort(codes)
    held, held_counts = codes[order], n[order]
    rank = np.empty(len(held), np.int64)
    rank[np.lexsort((held, -held_counts))] = np.arange(len(held))
    frequent, unit = held[rank < FREQUENT], rank[rank < FREQUENT]
    pairs = count_pairs(coded, frequent, unit)
    label = exchange_classes(pairs)
    ending_class = label[FREQUENT:-1]
    hot = np.zeros((len(label), SIDE))
    hot[np.arange(len(label)), label] = 1
    known = hot.copy()
    known[FREQUENT:-1] = 0
    fixed, start = (np.hstack((own.T @ pairs @ hot, own.T @ pairs.T @ hot)) for own in (known, hot))
    contexts = word_contexts(coded, frequent, unit, label)
    weights, table = exchange_rest(contexts, fixed, start)
    words = exchanged(contexts, weights, ending_class)
    held_class = np.zeros(len(held), np.int64)
    held_class[rank < FREQUENT] = label[unit]
    if len(held):  # what is not frequent among the held words, HELD_WORDS rows at most
        others = words.where(F.col("count") >= int(held_counts.min())).select("code", "class").collect()
        held_class[find(held, np.array([r[0] for r in others], np.int64))] = [r[1] for r in others]
    words_in, found_in = np.zeros(SIDE), np.zeros(SIDE)
    for kind, own, found in words.groupBy("class").agg(F.count("*"), F.sum("count")).collect():  # CLASSES rows at most
        words_in[kind], found_in[kind] = own, found
    np.add.at(words_in, label[unit], 1)
    np.add.at(found_in, label[unit], held_counts[rank < FREQUENT])
    found_in[CLASSES] = ends
    seen = table[:, SIDE:].T  # by the class before
    share = (found_in + 1) / (found_in + 1).sum()
    transitions = (seen + SMOOTHING * share) / (seen.sum(axis=1, keepdims=True) + SMOOTHING)
    return ClassModel(
        words, held, held_counts, held_class, frequent, label[unit], ending_class, np.log10(transitions),
        np.log10(found_in + 0.5 * (words_in + 1)), int(total) + ends, int(kinds) + (ends > 0), ends,
    )


def score_texts(docs: DataFrame, model: ClassModel) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, base_score, score and perplexity."""
    return score_codes(encode_words(docs), model)


def score_codes(coded: DataFrame, model: ClassModel) -> DataFrame:
    """Scores of texts given as codes.

    A task knows counts and classes of the held words. Other words leave it once
    per document and class before them, and meet their counts and classes in a join;
    such a word is rarer than every held one, so no key of that join is hot.
    """
    held, held_class, ending_class = model.held, model.held_class, model.ending_class
    frequent, frequent_class = model.frequent, model.frequent_class
    held_log = np.log10(model.held_counts + 0.5)
    weight, ends = model.transitions - model.class_size * (np.arange(SIDE) < CLASSES), model.ends
    base = float(np.log10(model.tokens + 0.5 * (model.kinds + 1)))
    names = ["code", "row", "doc_id", "n", "before", "known", "base_score", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, columns, heads = batch.slice(at, 256), [[], [], [], []], []
                for row, doc_id, codes in zip(*(c.to_pylist() for c in part.columns)):
                    codes = np.frombuffer(codes, np.int64)
                    place, own = find(held, codes), find(frequent, codes)
                    before = np.full(len(codes) + 1, CLASSES)
                    before[1:] = ending_class[codes & (ENDINGS - 1)]
                    before[1:][own >= 0] = frequent_class[own[own >= 0]]
                    there = place >= 0
                    known = place[there]
                    emitted, tokens = float(held_log[known].sum()), len(codes) + 1
                    # The end token has a class of its own, so its class says it all.
                    gained = float(weight[before[:-1][there], held_class[known]].sum() + weight[before[-1], CLASSES]) + emitted
                    heads.append((-1 - row, row, doc_id, tokens, None, len(known) + (ends > 0), emitted + float(np.log10(ends + 0.5)) - tokens * base, gained))
                    pair = np.stack((codes[~there], before[:-1][~there]))
                    pair, times = np.unique(pair, axis=1, return_counts=True) if pair.size else (pair, np.zeros(0, np.int64))
                    for column, values in zip(columns, (pair[0], np.full(len(times), row), times, pair[1])):
                        column.append(values)
                arrays = list(map(list, zip(*heads)))
                kinds = [pa.int64()] * 6 + [pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, kinds)], names=names)
                codes, rows, times, before = map(np.concatenate, columns)
                blank, numbers = pa.nulls(len(codes), pa.int64()), pa.nulls(len(codes), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(rows), blank, pa.array(times), pa.array(before), blank, numbers, numbers], names=names)

    parts = coded.select("row", "doc_id", "codes").mapInArrow(
        score, "code long, row long, doc_id long, n long, before long, known long, base_score double, score double"
    )
    spark = coded.sparkSession
    table = [(k, c, float(weight[k, c])) for k in range(SIDE) for c in range(CLASSES)]
    gains = F.broadcast(spark.createDataFrame(table, "before long, class int, gain double"))
    by_ending = F.element_at(F.array(*(F.lit(int(x)) for x in ending_class)), (F.col("code").bitwiseAND(ENDINGS - 1) + 1).cast("int"))
    joined = parts.join(model.words, "code", "left").withColumn("class", F.coalesce("class", by_ending)).join(gains, ["before", "class"], "left")
    word = F.col("code") >= 0
    log = F.when(word, F.col("n") * F.log10(F.coalesce("count", F.lit(0)) + 0.5))
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(~word, F.col("n"))).alias("n_tokens"),
        (F.max("known") + F.coalesce(F.sum(F.when(word & F.col("count").isNotNull(), F.col("n"))), F.lit(0))).alias("n_known"),
        (F.max("base_score") + F.coalesce(F.sum(log), F.lit(0.0))).alias("base_score"),
        (F.max("score") + F.coalesce(F.sum(log + F.col("n") * F.col("gain")), F.lit(0.0))).alias("score"),
    )
    return summed.drop("row").withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def class_scores(docs: DataFrame) -> DataFrame:
    """Score all rows of ``docs`` by a model of those whose doc_id's crc32 is not 1 modulo 5.

    Null or empty text: the end token alone. Null doc_id: learned from and scored.
    Repeated rows: each counts and each is scored. No rows to learn from: every
    token is unknown. Words are told apart by 63-bit codes. Columns besides
    doc_id and text are not read.
    """
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False))
    coded = encode_words(docs)
    model = fit_codes(coded.where(~held_out))
    scored = score_codes(coded, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "perplexity",
    )
