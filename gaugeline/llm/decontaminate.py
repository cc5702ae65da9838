"""Benchmark decontamination: word windows of test items found in training documents, in SQL functions only."""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.storage import stored

WINDOW = 10
#: What stands between words: ASCII without digits and letters, after lower-casing A-Z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a document that are looked at in one row.
BLOCK_WORDS = 4096
#: Bounds of the broadcast hash set; a larger benchmark is taken in several parts.
SET_ROWS, SET_BYTES = 200_000, 32 << 20


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; null has none."""
    lowered = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(lowered, BETWEEN), ""), F.array().cast("array<string>"))


def count_words(text: Column) -> Column:
    """How many words ``words_of`` finds, without making lower case."""
    parts = F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.coalesce(F.size(F.array_remove(parts, "")), F.lit(0)).cast("long")


def _spot(words: Column, at: Column, n) -> Column:
    return F.slice(words, at + 1, n)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def item_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item, n, words, code) of every window; an item shorter than n words is one window.

    Items without words or without an id have none; a repeated row adds none.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("all"))
    items = items.where(F.col("item").isNotNull() & (F.size("all") > 0)).withColumn("n", F.least(F.lit(n), F.size("all")))
    starts = F.sequence(F.lit(0), F.size("all") - F.col("n"))
    return (
        items.select("item", "n", "all", F.explode(starts).alias("at"))
        .select("item", "n", F.array_join(_spot(F.col("all"), F.col("at"), F.col("n")), " ").alias("window"))
        .distinct()
        .withColumn("code", F.xxhash64(_hashes(F.split("window", " "))))
    )


def _with_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row_key, whole): whole holds all columns, whatever their names.

    The key keeps rows apart that share a doc_id but not a text.
    """
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    return docs.select(doc_id, text, F.xxhash64(doc_id, text).alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))


def find_windows(docs: DataFrame, windows: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, row_key, start, end, window) wherever a window stands in a document.

    The distinct windows are broadcast in parts of bounded rows and bytes; each
    part scans all documents. A scan cuts documents into overlapping blocks,
    joins the hash of each n words and compares the words of the hits.
    """
    distinct = stored(windows.select("n", "window", "code").distinct(), "windows")
    size = distinct.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window") + 48), F.lit(0))).first()
    parts = max(1, -(-size[0] // SET_ROWS), -(-size[1] // SET_BYTES))
    lengths = sorted(r[0] for r in distinct.select("n").distinct().collect())  # n rows at most
    keyed = _with_key(docs).select("doc_id", "row_key", words_of(F.col("text")).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(BLOCK_WORDS))
    # The outer forms keep Spark from adding filters that compute the arrays a second time.
    blocks = (
        keyed.select("doc_id", "row_key", "all", F.explode_outer(starts).alias("block"))
        .select("doc_id", "row_key", "block", _spot(F.col("all"), F.col("block"), BLOCK_WORDS + n - 1).alias("words"))
        .withColumn("hashes", _hashes(F.col("words")))
    )
    found = []
    for part in range(parts):
        for length in lengths:
            wanted = distinct.where((F.col("n") == length) & (F.pmod("code", F.lit(parts)) == part))
            wanted = F.broadcast(wanted.select("code", "window"))
            last = F.least(F.lit(BLOCK_WORDS - 1), F.size("hashes") - length)
            codes = F.when(
                F.size("hashes") >= length,
                F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(_spot(F.col("hashes"), i, length))),  # noqa: B023
            )
            scanned = blocks.select("doc_id", "row_key", "block", "words", codes.alias("codes")).select(
                "doc_id", "row_key", "block", "words", F.posexplode_outer("codes").alias("at", "code")
            )
            own = F.array_join(_spot(F.col("words"), F.col("at"), length), " ")
            # Two one-sided comparisons: an equality would become a join key, made for every window.
            hits = scanned.join(wanted, "code").where(F.startswith(own, F.col("window")) & F.startswith(F.col("window"), own))
            start = F.col("block") + F.col("at")
            found.append(hits.select("doc_id", "row_key", start.alias("start"), (start + length).alias("end"), "window"))
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, row_key long, start int, end int, window string")
    return reduce(DataFrame.unionByName, found)


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["row_key"].eqNullSafe(b["row_key"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, row_key, n_words, spans, n_hit, n_items, items_sha256, contaminated.

    Null or empty text: no words, not contaminated, the digest of an empty list.
    Repeated rows get equal results, each its own. A null doc_id is kept. An
    empty benchmark or one without words hits nothing. Spans are the hits'
    (start, end) in words, by start.
    """
    windows = stored(item_windows(benchmark, n), "item-windows")
    hits = stored(find_windows(docs, windows, n).distinct(), "hits")
    spans = hits.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    items = (
        hits.select("doc_id", "row_key", "window").distinct()
        .join(windows.select("window", "item"), "window")
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(a["to"], x["start"]))).alias("n"),
            F.greatest(a["to"], x["end"]).alias("to"),
        ),
    )["n"]
    found = spans.join(items, _same(spans, items)).select(
        spans["doc_id"], spans["row_key"], "spans", covered.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("digest"),
    )
    rows = _with_key(docs).select("doc_id", "row_key", count_words(F.col("text")).alias("n_words"))
    return rows.join(found, _same(rows, found), "left").select(
        rows["doc_id"], rows["row_key"], "n_words", "spans",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no window of the benchmark."""
    windows = stored(item_windows(benchmark, n), "item-windows")
    hit = stored(find_windows(docs, windows, n).select("doc_id", "row_key").distinct(), "hit-rows")
    keyed = _with_key(docs)
    return keyed.join(hit, _same(keyed, hit), "left_anti").select("whole.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """All rows of ``docs``; hit words, each with what follows it up to the next word, are cut from the text."""
    found = contamination(docs, benchmark, n).where("contaminated").select("doc_id", "row_key", "spans").distinct()
    keyed = _with_key(docs)
    head = F.regexp_extract("text", r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    parts = F.expr(r"regexp_extract_all(text, r'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*', 0)")
    clean = F.filter(parts, lambda _, i: ~F.exists("spans", lambda x: (x["start"] <= i) & (i < x["end"])))
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.concat(head, F.array_join(clean, "")))
    both = keyed.join(found, _same(keyed, found), "left").withColumn("cleaned", text)
    return both.select(*[F.col("cleaned").alias(c) if c == "text" else F.col(f"whole.`{c}`") for c in docs.columns])
