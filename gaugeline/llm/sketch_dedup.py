"""Near-duplicate documents by fast similarity sketches, banding and exact checks."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.caches import forget
from gaugeline.llm.components import connected_components
from gaugeline.llm.phrases import Signature
from gaugeline.llm.shingles import WordCodes, mixed, shingle_codes, words_of
from gaugeline.llm.storage import stored

#: A pair at the limit of 0.8 agrees in a band of 5 with 0.33 and misses all 32 bands in 3 of a million cases.
BANDS, BAND_ROWS = 32, 5
PERCENT = 80
#: Words in a shingle: of the pipeline's stage, and of the registered query.
STAGE_WIDTH, WIDTH = 5, 2
#: Documents up to which a signature tells most others apart.
SIGNATURE_NODES = 2**25
#: Stand-ins for doc_ids that stand at several texts begin here.
STAND_IN = 2**62
#: Rounds of pivots before what they leave open is compared in chunks.
PIVOT_ROUNDS = 6
#: Chunk visits, in multiples of the bucket rows, up to which no further round of pivots is worthwhile.
VISIT_FACTOR = 4
#: Sets that a task indexes at a time, and sets that visit such a chunk in one task.
CHUNK_SETS, CHUNK_VISITS = 512, 4096
#: Codes of all sets of such a chunk together, and codes that a visiting set meets in it at a time.
CHUNK_CODES, MEETINGS = 1 << 21, 1 << 20


def similarity_sketch(codes: np.ndarray, size: int = BANDS * BAND_ROWS) -> np.ndarray:
    """One 64-bit value for each of ``size`` bins, every bin filled.

    Round i throws each code into a random bin, with i before a random fraction
    as its value; a bin keeps the smallest value. After ``size`` rounds, round
    size + k puts all codes into bin k, so that no bin stays empty. Later rounds
    cannot lower a filled bin, so rounds may be taken several at a time. Two
    sets agree in a bin with a chance equal to their similarity, and the sum of
    agreements is concentrated like that of independent samples.
    """
    sketch = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    done, goal = 0, size * (np.log(size) + 1.5)
    while done < size and sketch.max() == np.iinfo(np.uint64).max:
        rounds = int(min(size - done, max(1, goal // len(codes))))
        number = np.arange(done, done + rounds, dtype=np.uint64)[:, None]
        value = mixed(codes[None, :] + mixed(number + np.uint64(0x9E3779B97F4A7C15))).ravel()
        bins = ((value >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        value = (value & np.uint64(0xFFFFFFFF)) | np.repeat(number.ravel() << np.uint64(32), len(codes))
        np.minimum.at(sketch, bins.astype(np.intp), value)
        done += rounds
    for k in np.flatnonzero(sketch == np.iinfo(np.uint64).max).tolist():
        number = np.uint64(size + k)
        value = mixed(codes + mixed(np.array([number + np.uint64(0x9E3779B97F4A7C15)])))
        sketch[k] = (value & np.uint64(0xFFFFFFFF)).min() | (number << np.uint64(32))
    return sketch


def band_keys(sketch: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key for each band of a sketch."""
    bands = sketch.reshape(-1, rows)
    key = np.arange(len(bands), dtype=np.uint64)
    for column in bands.T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def sketch_documents(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, content, bands): content names the set; both are null for an empty set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        codes = WordCodes()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, contents, bands = [], [], []
                for text in part.column(1).to_pylist():
                    own = shingle_codes(words_of(text), codes, width)
                    sizes.append(len(own))
                    if len(own):
                        contents.append(blake2b(own.tobytes(), digest_size=16).digest())
                        bands.append(band_keys(similarity_sketch(own)).view(np.int64))
                    else:
                        contents.append(None)
                        bands.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(contents, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "content", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        sketch, "doc_id long, n_shingles long, content binary, bands array<long>"
    )


def shingle_sets(nodes: DataFrame, docs: DataFrame, width: int = WIDTH, several: int = 0) -> DataFrame:
    """(node, codes) of at least the documents named by ``nodes`` (node), the codes as bytes.

    Texts are not shuffled: each task tells by a signature of fixed size whether a
    document is wanted. A few others pass it; where ``several``, the most there can
    be, would fill it, they are taken out by a join of the sets.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(Signature.of(nodes.select(F.col("node").alias("w1")), 1))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        codes = WordCodes()
        for batch in batches:
            ids = batch.column(0)
            known = wanted.value.has(mixed(ids.fill_null(0).to_numpy().view(np.uint64))) & ids.is_valid().to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256).filter(pa.array(known[at : at + 256]))
                own = [shingle_codes(words_of(x), codes, width).tobytes() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.binary())], names=["node", "codes"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(sets, "node long, codes binary")
    if several > SIGNATURE_NODES:
        found = found.join(nodes, "node", "left_semi")
    return stored(found, "sets")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch of sets, a few of them in Python's own form at a time."""
    for at in range(0, batch.num_rows, 256):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of doc_ids whose full shingle sets reach the similarity.

    b should be the side that many pairs share: its rows meet their sets last,
    in a sort-merge join whose hot keys Spark splits.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(_rows(batch.select([2, 3]))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep[k] = 100 * common >= percent * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["a", "b"])

    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("codes").alias("x")), "a")
    full = first.join(sets.select(F.col("node").alias("b"), F.col("codes").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


class SetIndex:
    """Sets of a chunk by their codes; counts what a set has in common with each of them."""

    def __init__(self, nodes: list[int], sets: list[np.ndarray]):
        self.nodes, self.sizes = nodes, np.array([len(x) for x in sets])
        codes, owners = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(codes, kind="stable")
        codes, self.owners = codes[order], owners[order]
        self.starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        self.codes = codes[self.starts]
        self.counts = np.diff(np.concatenate((self.starts, [len(codes)])))

    def similar(self, own: np.ndarray, percent: int) -> list[int]:
        """Nodes of the chunk whose sets reach the similarity with ``own``."""
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at = at[self.codes[at] == own]
        common = np.zeros(len(self.nodes), np.int64)
        upto = np.cumsum(self.counts[at])
        for part in np.split(at, np.searchsorted(upto, np.arange(MEETINGS, upto[-1] if len(at) else 0, MEETINGS))):
            count = self.counts[part]
            places = np.repeat(self.starts[part] - np.cumsum(count) + count, count) + np.arange(count.sum())
            common += np.bincount(self.owners[places], minlength=len(self.nodes))
        good = 100 * common >= percent * (len(own) + self.sizes - common)
        return [self.nodes[k] for k in np.flatnonzero(good)]


def chunk_links(open_rows: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that tie together what pivots left apart in buckets (key, node, n_shingles, component, main).

    The nodes outside their buckets' main components are dealt to chunks of
    bounded size by that component. Every node of such a bucket visits the
    chunks its bucket has nodes in; its full set is compared with all sets of
    the chunk at once. A task gives only links between components that it has
    not tied together yet, at most one for each node it sees.
    """
    outside = open_rows.where(F.col("component") != F.col("main"))
    sizes = outside.select("main", "node", "n_shingles").distinct().groupBy("main")
    sizes = sizes.agg(F.ceil(F.greatest(F.count("*") / CHUNK_SETS, F.sum("n_shingles") / CHUNK_CODES)).alias("parts"))
    dealt = outside.join(sizes, "main").withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    dealt = stored(dealt.select("key", "node", "component", F.xxhash64("main", "part").alias("chunk")), "chunks")
    visits = open_rows.select("key", "node", "component").join(dealt.select("key", "chunk").distinct(), "key")
    visits = stored(visits.select("chunk", "node", "component").distinct(), "visits")
    splits = visits.groupBy("chunk").agg(F.ceil(F.count("*") / CHUNK_VISITS).alias("splits"))
    held = dealt.select("chunk", "node", "component").distinct().join(splits, "chunk")
    held = held.select("chunk", "node", "component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("splits") - 1)).alias("split"), F.lit(True).alias("held"))
    come = visits.join(splits, "chunk").select(
        "chunk", "node", "component", F.pmod(F.xxhash64("node"), F.col("splits")).alias("split"), F.lit(False).alias("held")
    )
    rows = held.union(come).join(sets, "node")
    unit = F.xxhash64("chunk", "split").alias("unit")
    rows = rows.select(unit, "held", "node", "component", "codes").repartition("unit").sortWithinPartitions("unit", F.desc("held"), "node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        unit, index, up, of, nodes, sets = None, None, {}, {}, [], []

        def root(component: int) -> int:
            while (above := up.get(component, component)) != component:
                component = above
            return component

        for batch in batches:
            links: list[tuple[int, int]] = []
            for own_unit, own_held, node, component, codes in _rows(batch):
                codes = np.frombuffer(codes, np.uint64)
                if own_unit != unit:
                    unit, index, up, of, nodes, sets = own_unit, None, {}, {}, [], []
                if own_held:
                    nodes.append(node)
                    sets.append(codes)
                    of[node] = component
                    continue
                index = index or SetIndex(nodes, sets)
                for other in index.similar(codes, percent):
                    a, b = root(component), root(of[other])
                    if a != b:
                        up[max(a, b)] = min(a, b)
                        links.append((node, other))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return rows.mapInArrow(compare, "a long, b long").distinct()


def find_links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(node, component) of all classes (node, n_shingles, bands) that are linked with another.

    Members of a bucket are compared with one pivot, the member that shares
    most buckets with others, instead of with each other. That ties a group of
    copies together in a round. Where a bucket still has several components,
    pairs across them are open: they get further pivots while there are very
    many, and are then compared in chunks, so that no link between components
    is lost. All comparisons are of full sets.
    """
    rows = classes.select("node", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    buckets = stored(rows.join(shared, "key").select("key", "node", "size"), "buckets")
    degree = buckets.groupBy("node").agg(F.sum("size").alias("degree"))
    known = classes.select("node", "n_shingles")
    buckets = stored(buckets.drop("size").join(degree.join(known, "node"), "node"), "buckets-ranked")
    bucket_rows = buckets.count()
    sets = shingle_sets(buckets.select("node").distinct(), docs, width, bucket_rows)  # one pass over the texts
    empty = docs.sparkSession.createDataFrame([], "a long, b long")
    links, tested, found = empty, empty, docs.sparkSession.createDataFrame([], "node long, component long")
    open_rows = buckets.withColumn("component", F.col("node"))
    for turn in range(PIVOT_ROUNDS + 1):
        if turn:
            # Buckets with several components; the rows outside a bucket's main one still need partners.
            labelled = buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
            parts = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
            main = parts.groupBy("key").agg(
                F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("k"), F.sum("n").alias("m")
            )
            main = stored(main.where("k > 1").select("key", "m", F.col("top.component").alias("main"), F.col("top.n").alias("most")), "main")
            visits = main.agg(F.coalesce(F.sum(F.col("m") * F.ceil((F.col("m") - F.col("most")) / CHUNK_SETS)), F.lit(0))).first()[0]
            if not visits:
                break
            open_rows = stored(labelled.join(main.select("key", "main"), "key"), "open")
            if visits <= VISIT_FACTOR * bucket_rows or turn == PIVOT_ROUNDS:
                fresh = stored(chunk_links(open_rows, sets, percent), "chunk-links")
                if not fresh.isEmpty():
                    found = connected_components(links.union(fresh))
                break
        candidates = open_rows
        if turn:  # a node that was a pivot has met all of its bucket
            candidates = open_rows.where(F.col("component") != F.col("main"))
            candidates = candidates.join(tested.select(F.col("b").alias("node")).distinct(), "node", "left_anti")
        top = candidates.groupBy("key").agg(F.max(F.struct("degree", -F.col("node"), "node", "n_shingles", "component")).alias("top"))
        pivots = top.select("key", F.col("top.node").alias("b"), F.col("top.n_shingles").alias("n_b"), F.col("top.component").alias("component_b"))
        pairs = open_rows.join(pivots, "key").where(
            (F.col("component") != F.col("component_b"))
            & (100 * F.least("n_shingles", "n_b") >= percent * F.greatest("n_shingles", "n_b"))
        )
        pairs = pairs.select(F.col("node").alias("a"), "b").distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti") if turn else pairs, "pairs")
        tested = tested.union(pairs)
        fresh = stored(confirmed(pairs, sets, percent), "confirmed")
        if not fresh.isEmpty():
            links = links.union(fresh)
            found = connected_components(links)
    return found


def near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Shingles of ``width`` lower-cased (A-Z) words, a shorter text being one; a pair
    is linked if 100 * intersection >= percent * union on the full sets. Rows of
    equal sets are one class, whatever their number. Null or empty text: no
    shingles, linked with nothing, kept. Null doc_id: component_id null, linked
    with nothing, kept. Repeated rows: equal results, and all of them kept or none;
    a doc_id at different texts is one document. Ties: the smallest doc_id is kept.
    Texts of any length are taken whole. Empty table: no rows. Other columns play
    no part, whatever their names.
    """
    sketches = stored(sketch_documents(docs, width), "sketches")
    filled = sketches.where(F.col("content").isNotNull() & F.col("doc_id").isNotNull())
    classes = filled.groupBy("content").agg(
        F.min("doc_id").alias("node"), F.max("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands")
    )
    classes = stored(classes, "classes")
    found = find_links(classes, docs, percent, width)
    named = classes.select("content", "node").join(found, "node", "left")
    named = named.select("content", F.coalesce("component", "node").alias("component_id"))
    ids = sketches.select("doc_id", "n_shingles", "content")
    result = ids.join(named, "content", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("content").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def remove_near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = STAGE_WIDTH) -> DataFrame:
    """One row of each group stays, all columns; rows without words or without a doc_id stay.

    Decided by doc_id and text, so that a text is only lost where a copy of it, near
    or exact, stays: a doc_id that stands at several texts keeps its name for the
    first of them by digest and has stand-ins, 64-bit hashes, for the others. Of equal
    rows with a doc_id one stays. Ties: the smallest doc_id stays, a stand-in last.
    Empty table: no rows. Columns may have any names.
    """
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    whole = docs.select(key.alias("key"), text.alias("text"), digest.alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    first = whole.groupBy("key").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).where("first < last")
    several = stored(first.select("key", "first"), "ids-of-several-texts")
    stand_in = F.lit(STAND_IN) + F.shiftrightunsigned(F.xxhash64("key", "digest"), 2)
    named = whole.join(several, "key", "left").select(
        F.when(F.col("digest") > F.col("first"), stand_in).otherwise(F.col("key")).alias("doc_id"), "text", "whole"
    )
    result = stored(near_duplicates(named.select("doc_id", "text"), percent, width), "near-duplicates")
    lost = result.where(~F.col("kept")).select("doc_id").distinct()
    twice = result.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    single = named.join(lost.union(twice), "doc_id", "left_anti")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    repeated = named.join(twice, "doc_id", "left_semi").withColumn("turn", turn).where("turn = 1")
    return single.select("whole.*").unionByName(repeated.select("whole.*"))
