from pathlib import Path

import brute
import duckdb
import pytest
from small import documents, sentence  # noqa: F401

import compare
import corpus_pipeline
from gaugeline.llm.catalogue import ORACLES, build_queries
from gaugeline.llm.quality import quality_scores

FOLDER = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not FOLDER.exists(), reason="needs the generated tables")


@needs_tables
def test_stages_equal_a_plain_round(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = quality_scores(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    texts = {r.doc_id: r.text for r in scored.collect() if r.predicted}
    texts = {k: texts[k] for k, (_, _, kept) in brute.near_duplicates(texts, width=5).items() if kept}
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {k: texts[k] for k, row in brute.contamination(texts, items).items() if not row[-1]}
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, str(FOLDER))
        assert frame.columns == docs.columns
    assert {r.doc_id: r.text for r in frame.collect()} == texts
    assert 0 < len(texts) < docs.count()
    packed = corpus_pipeline.run(spark, str(FOLDER)).collect()
    assert {r.doc_id for r in packed} == set(texts)
    assert len({(r.doc_id, r.piece) for r in packed}) == len(packed)


def test_stages_of_an_empty_table(spark, documents, tmp_path):  # noqa: F811
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = documents([])
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.count() == 0


def test_a_text_goes_only_where_a_copy_stays(spark, documents):  # noqa: F811
    a, b, c = (sentence(seed, 80) for seed in (1, 2, 3))
    rows = [(3, b), (7, a), (7, b), (7, c), (9, c), (8, None), (None, a), (8, ""), (5, b), (7, a)]
    left = corpus_pipeline.keep_distinct(spark, documents(rows), "").collect()
    by_text = {}
    for row in left:
        by_text.setdefault(row.text, []).append(row.doc_id)
    assert {a, b, c, None, ""} >= set(by_text) >= {a, b, c}
    assert by_text[b] == [3] and len(by_text[c]) == 1 and sorted(by_text[a], key=str) == [7, None]
    assert 1 <= len([row for row in left if not row.text]) <= 2


def test_stages_with_nulls_and_repeated_ids(spark, documents, tmp_path):  # noqa: F811
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, sentence(5, 30)), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, sentence(1)), (1, sentence(1)), (2, sentence(2)), (2, sentence(5, 30)), (None, sentence(3)), (4, None), (None, None), (5, "")]
    frame = documents(rows)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        frame = stage(spark, frame, str(tmp_path))
    left = [(r.doc_id, r.text) for r in frame.collect()]
    assert sorted(map(repr, left)) == sorted(map(repr, [r for r in rows[1:] if r[1] != sentence(5, 30)]))
    assert corpus_pipeline.pack(spark, frame, "").count() == len(left)
    assert set(corpus_pipeline.keep_quality(spark, documents(rows), str(tmp_path)).columns) == set(frame.columns)


@needs_tables
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    cursor = database.execute(ORACLES[name])
    columns = [part[0] for part in cursor.description]
    frame = build_queries()[name](spark, str(FOLDER))
    assert sorted(frame.columns) == sorted(columns)
    assert compare.table(frame.columns, frame.collect()) == compare.table(columns, cursor.fetchall())
