"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm.bpe_paths import round_trip_digests
from gaugeline.llm.class_lm import class_scores
from gaugeline.llm.code_dedup import near_vectors
from gaugeline.llm.decontaminate import contamination
from gaugeline.llm.equal_average import ROUNDS, vector_codes
from gaugeline.llm.html_text import extract_text
from gaugeline.llm.packing import pack_documents
from gaugeline.llm.phrases import top_collocations
from gaugeline.llm.quality import fold, quality_scores
from gaugeline.llm.sketch_dedup import near_duplicates
from gaugeline.llm.token_files import token_offsets
from gaugeline.llm.tool_calls import link_conversations
from gaugeline.llm.warc import archive_round_trip


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_class_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document under the class-based model."""
    return class_scores(table(spark, folder, "documents"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near copies among all documents."""
    return near_duplicates(table(spark, folder, "documents"))


def op3_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn that calls or answers, linked, checked, ordered and serialised."""
    return link_conversations(table(spark, folder, "conversations"))


def op4_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and groups among all embeddings."""
    return near_vectors(table(spark, folder, "embeddings"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score of every document."""
    scored = quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's record, read back from Zstandard archives."""
    found = archive_round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("row_key", "spans")


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, folder, "pages"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return pack_documents(table(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place and checksum, read back from the token-id files."""
    return token_offsets(table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of every language."""
    return top_collocations(table(spark, folder, "documents"))


def op12_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids by dynamic programming, and the text they decode to, as digests."""
    return round_trip_digests(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding's code, its error and its label's."""
    return vector_codes(table(spark, folder, "embeddings"))


def build_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f) and name != "open"}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def _codebook_sql() -> str:
    """Plain assignment against every entry, one pair of steps a round."""
    steps = [r"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(v) // 4) AS part, (i - 1) % (len(v) // 4) AS pos, v[i] AS c
  FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256),
book0 AS MATERIALIZED (SELECT part, entry, pos, c FROM parts JOIN seeds USING (vec_id))"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT vec_id, p.part, entry, CAST(sum((p.c - b.c) * (p.c - b.c)) AS BIGINT) AS d
    FROM parts p JOIN book{k} b ON p.part = b.part AND p.pos = b.pos GROUP BY 1, 2, 3)
  GROUP BY 1, 2)""")
        if k < ROUNDS:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CASE WHEN n IS NULL THEN b.c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{k} b LEFT JOIN (
    SELECT part, entry, pos, CAST(sum(c) AS BIGINT) AS s, count(*) AS n
    FROM near{k} JOIN parts USING (vec_id, part) GROUP BY 1, 2, 3) USING (part, entry, pos))""")
    steps.append(f"""
codes AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(c, ',' ORDER BY part, entry, pos)) FROM book{ROUNDS}) AS codebooks_sha256
FROM codes JOIN kept USING (vec_id)""")
    return ",".join(steps[:-1]) + "," + steps[-1]


ORACLES: dict[str, str] = {
    "op13_vector_codes": _codebook_sql(),
    "op11_collocations": r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (
  SELECT lang, m, w[i:i + m - 1] AS p
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, range(1, 5) AS lengths(m) WHERE len(w) >= m)),
freq AS MATERIALIZED (SELECT lang, m, p, count(*) AS a FROM spans GROUP BY 1, 2, 3),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM freq WHERE m = 1 GROUP BY 1),
frequent AS MATERIALIZED (SELECT * FROM freq WHERE a >= 30),
cuts AS (
  SELECT lang, m, p, a, k, p[1:k] AS x, p[k + 1:] AS y
  FROM (SELECT *, unnest(range(1, m)) AS k FROM frequent WHERE m > 1)),
scored AS (
  SELECT c.lang, c.m, c.p, c.a, c.k, x.a AS l, y.a AS r, CAST((2000000::HUGEINT * c.a) // (x.a + y.a) AS BIGINT) AS score
  FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.p = c.x JOIN frequent y ON y.lang = c.lang AND y.p = c.y),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, p[i:i + s - 1] AS part
  FROM (SELECT lang, a, p, m, s, unnest(range(1, m - s + 2)) AS i FROM frequent, range(2, 4) AS sizes(s) WHERE s < m)),
held AS (SELECT lang, part, max(a) AS longer FROM inner_parts GROUP BY 1, 2),
kept AS (
  SELECT w.*, array_to_string(w.p, ' ') AS phrase
  FROM weakest w LEFT JOIN held h ON h.lang = w.lang AND h.part = w.p
  WHERE h.longer IS NULL OR 100 * h.longer < 80 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000""",
    "op2_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN w
      ELSE list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2]) END) AS s
    FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
pairs AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * i >= 80 * (p.n + q.n - i)),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
  doc_id <= coalesce(y, doc_id) AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)""",
    "op4_near_vectors": r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x AS vec_id, min(y) AS y FROM reach GROUP BY 1),
degrees AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
  vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN degrees USING (vec_id) LEFT JOIN lowest USING (vec_id)""",
    "op3_tool_calls": r"""
WITH calls AS (
  SELECT conv_id, 'turn-' || turn AS call_id, turn, text FROM conversations WHERE role = 'user'),
answers AS (
  SELECT conv_id, 'turn-' || (turn - 1) AS call_id, turn, text FROM conversations WHERE role = 'assistant'),
linked AS (
  SELECT c.conv_id, c.call_id, c.turn, 'reply' AS name,
    row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn) - 1 AS position,
    CASE WHEN a.turn IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
    CASE WHEN c.turn >= 2 AND NOT EXISTS (
      SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2) THEN 'unknown need' ELSE '' END AS problems,
    '{"arguments":{"text":' || CAST(to_json(c.text) AS VARCHAR) || ',"turn":' || c.turn || '},"id":"' || c.call_id
      || '","name":"reply"' || CASE WHEN a.text IS NULL THEN '' ELSE ',"result":' || CAST(to_json(a.text) AS VARCHAR) END
      || '}' AS json
  FROM calls c LEFT JOIN answers a USING (conv_id, call_id))
SELECT conv_id, call_id, turn, name, position, status, problems, problems = '' AS valid, json FROM linked
UNION ALL
SELECT conv_id, call_id, turn, NULL, NULL, 'orphan', '', false,
  '{"id":"' || call_id || '","result":' || CAST(to_json(text) AS VARCHAR) || '}'
FROM answers a WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = a.conv_id AND c.call_id = a.call_id)""",
    "op7_benchmark_decontamination": r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, 2 + greatest(len(w) - 10, 0))) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
spots AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w
  FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT DISTINCT doc_id, i, s.n, item
  FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM spots) s
  JOIN windows USING (n, win)),
places AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT doc_id, i, unnest(range(0, n)) AS k FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
