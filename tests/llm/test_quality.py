import zlib

import numpy as np
import pytest
from small import documents, sentence  # noqa: F401

from gaugeline.llm.quality import BUCKETS, Tokens, context_sums, fit_network, index_vectors, quality_scores

LABELS = "doc_id long, quality int, toxic int"


def texts():
    out = {}
    for k in range(160):
        text = sentence(k, 40 + k % 30)
        out[k] = text if k % 3 else " ".join(f"{w}{'***' if k % 2 else '!!'}".upper() for w in text.split())
    return out


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in texts()], LABELS)


def test_held_out_documents_are_told_apart(documents, labels):  # noqa: F811
    rows = texts() | {900: None, 901: "", 902: "x" * 100_000, 903: "word " * 50_000}
    found = {r.doc_id: r for r in quality_scores(documents(rows.items()), labels).collect()}
    assert len(found) == len(rows)
    held = [k for k in texts() if zlib.crc32(str(k).encode()) % 4 == 2]
    assert np.mean([found[k].predicted == int(k % 3 > 0) for k in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())
    assert found[900].score == found[901].score


def test_scores_depend_on_nothing_but_the_text(documents, labels):  # noqa: F811
    rows = list(texts().items()) + [(None, texts()[1]), (5000, texts()[1])]
    first = {r.doc_id: r.score for r in quality_scores(documents(rows), labels).collect()}
    again = {r.doc_id: r.score for r in quality_scores(documents(rows[::-1]).repartition(5), labels).collect()}
    assert first == again
    assert first[None] == first[5000] == first[1]


def test_labels_of_the_held_out_fold_are_not_used(documents, labels, spark):  # noqa: F811
    rows = documents(texts().items())
    turned = [(k, int(k % 3 > 0) if zlib.crc32(str(k).encode()) % 4 != 2 else int(k % 3 == 0), 1) for k in texts()]
    a, b = ({r.doc_id: r.score for r in quality_scores(rows, x).collect()} for x in (labels, spark.createDataFrame(turned, LABELS)))
    assert a == b


def test_no_labels_empty_tables_and_other_columns(documents, labels, spark):  # noqa: F811
    none = quality_scores(documents([(1, "a b")]), spark.createDataFrame([], LABELS)).collect()
    assert none[0].score == pytest.approx(0.5)
    assert quality_scores(documents([]), labels).count() == 0
    odd = documents([(1, "a b"), (1, "a b")]).withColumnsRenamed({"lang": "score", "source": "quality", "n_chars": "x"})
    rows = quality_scores(odd, spark.createDataFrame([(1, None, 0), (None, 1, 0), (1, 1, 0), (1, 1, 0)], LABELS))
    assert rows.columns == ["doc_id", "text", "quality", "x", "score", "predicted"]
    assert rows.count() == 2


def test_context_sums_equal_a_plain_count(documents):  # noqa: F811
    rows = ["a b c a", "b", "", None, "c c d e f a b"]
    places, signs = index_vectors()
    want, tokens = np.zeros((BUCKETS, places.max() + 1), np.int64), Tokens()
    for text in rows:
        own = tokens.of(text)
        for i, word in enumerate(own):
            for j in range(max(0, i - 2), min(len(own), i + 3)):
                if i != j:
                    want[word, places[own[j]]] += signs[own[j]]
    found = context_sums(documents(list(enumerate(rows))).repartition(3))
    assert (found[:, : want.shape[1]] == want).all()


def test_temperature_makes_scores_fit_their_shares():
    random = np.random.default_rng(3)
    x = random.standard_normal((4000, 12))
    chance = 1 / (1 + np.exp(-1.5 * x[:, 0]))
    y = (random.random(4000) < chance).astype(float)
    scores = fit_network(x, y).scores(x)
    for low in (0.1, 0.3, 0.5, 0.7):
        inside = (scores >= low) & (scores < low + 0.2)
        assert abs(y[inside].mean() - scores[inside].mean()) < 0.08
