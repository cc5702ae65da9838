import brute
from small import by, documents, sentence  # noqa: F401

from gaugeline.llm.decontaminate import contamination, remove_contaminated, remove_spans

COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
SCHEMA = "item_id long, text string"
ITEMS = [
    (1, sentence(1, 25)), (2, sentence(2, 12).upper()), (30, sentence(1, 25)), (4, "Short one"), (5, "..."), (6, None), (7, "wölf"),
    (8, sentence(8, 10)), (8, sentence(9, 10)), (8, sentence(9, 10)), (None, sentence(10, 15)),
]


def texts():
    out = {k: sentence(100 + k, 80) for k in range(8)}
    out[10] = f"{sentence(50, 20)}, {sentence(1, 25)}! {sentence(51, 20)}"
    out[11] = sentence(2, 12).replace(" ", "--") + " tail"
    out[12] = "a SHORT, one and short one"
    out[13] = "Short  one short" + " wölf" * 3 + " WÖLF Wölf"
    out[14] = " ".join(sentence(1, 25).split()[3:12])  # nine words of an item
    out[15] = " ".join(sentence(1, 25).split()[3:13])
    out[16], out[17], out[18] = None, "", "!!!"
    out[19] = sentence(8, 10) + " " + sentence(8, 10) + " " + sentence(9, 10)
    out[20] = " ".join([sentence(60, 4090), sentence(1, 25), sentence(61, 9000), sentence(2, 12), "short one"])  # over block ends
    out[21] = sentence(10, 15)
    out[22] = "ſhort one Κόσμος ΣΑΣ"
    return out


def test_hits_equal_brute_force(spark, documents):  # noqa: F811
    bench = spark.createDataFrame(ITEMS, SCHEMA)
    found = contamination(documents(texts().items()), bench)
    assert by(found, "doc_id", *COLUMNS) == brute.contamination(texts(), [i for i in ITEMS if i[0] is not None])


def test_a_benchmark_in_parts(spark, documents, monkeypatch):  # noqa: F811
    monkeypatch.setattr("gaugeline.llm.decontaminate.SET_ROWS", 7)
    bench = spark.createDataFrame(ITEMS[:3], SCHEMA)
    found = contamination(documents(texts().items()), bench)
    assert by(found, "doc_id", *COLUMNS) == brute.contamination(texts(), ITEMS[:3])


def test_empty_tables_and_repeated_rows(spark, documents):  # noqa: F811
    bench = spark.createDataFrame(ITEMS, SCHEMA)
    assert contamination(documents([]), bench).count() == 0
    clean = contamination(documents([(1, "short one")]), spark.createDataFrame([], SCHEMA)).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in clean] == [(2, 0, False)]
    rows = contamination(documents([(1, "short one"), (1, "short one"), (1, "other"), (None, "short one"), (None, None)]), bench)
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in rows.collect()) == [(0, 0, 0), (0, 2, 2), (1, 1, 0), (1, 2, 2), (1, 2, 2)]


def test_documents_or_spans_are_removed(spark, documents):  # noqa: F811
    bench = spark.createDataFrame(ITEMS, SCHEMA)
    docs = documents([(1, "Keep this."), (2, "Cut a (Short, one) here!"), (None, None), (3, "short one")])
    docs = docs.withColumnsRenamed({"lang": "row_key", "source": "spans", "n_chars": "whole"})
    kept = remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1]
    cut = remove_spans(docs, bench)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Keep this.", 2: "Cut a (here!", None: None, 3: ""}


def test_the_main_path_is_native(spark, documents):  # noqa: F811
    plan = contamination(documents([(1, "a")]), spark.createDataFrame(ITEMS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
