import math
import zlib
from collections import Counter

import numpy as np
import pytest
from small import documents, sentence  # noqa: F401

from gaugeline.llm.class_lm import class_scores, exchange_classes, fit_class_model, word_code


def words(text):
    return (text or "").encode().lower().split()


def texts():
    out = {}
    for k in range(120):  # two kinds of documents with words of their own
        out[k] = " ".join(f"{'ab'[k % 2]}{w}" for w in sentence(k, 50, 30).split())
    return out | {500: None, 501: "", 502: "Never Seen w1", 503: "x" * 5000, 504: " ".join(f"u{j}" for j in range(3000))}


@pytest.fixture(scope="module")
def found(documents):  # noqa: F811
    return {r.doc_id: r for r in class_scores(documents(texts().items())).collect()}


def test_base_scores_equal_brute_force(found):
    counts = Counter()
    held = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in texts()}
    for k, text in texts().items():
        if not held[k]:
            counts.update([*words(text), None])
    total, kinds = sum(counts.values()), len(counts)
    for k, text in texts().items():
        own = [*words(text), None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        row = found[k]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[k], len(own), sum(counts[w] > 0 for w in own), total)
        assert row.base_score == pytest.approx(base)


def test_classes_make_held_out_texts_likelier(found):
    held = [r for r in found.values() if r.held_out and r.doc_id < 500]
    assert len(held) > 5
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in held)


def test_a_model_is_a_distribution(documents):  # noqa: F811
    model = fit_class_model(documents([(k, text) for k, text in texts().items() if k < 40]))
    assert np.allclose((10.0**model.transitions).sum(axis=1), 1)
    # Words of a class and one unknown word share its whole mass.
    mass = Counter()
    for log_count, kind in zip(np.log10(model.held_counts + 0.5), model.held_class):
        mass[kind] += 10 ** (log_count - model.class_size[kind])
    for kind, total in mass.items():
        assert total + 0.5 / 10 ** model.class_size[kind] == pytest.approx(1)


def test_exchange_finds_the_planted_classes():
    random = np.random.default_rng(5)
    kind = random.integers(0, 3, 30)
    follow = np.array([[0, 9, 1], [1, 0, 9], [9, 1, 0]])
    pairs = random.poisson(follow[kind][:, kind] * 3)
    pairs = np.pad(pairs, ((0, 1), (0, 1)), constant_values=1)
    label = exchange_classes(pairs, classes=3)
    assert label[-1] == 3
    assert len({(a, b) for a, b in zip(kind, label[:-1])}) == 3


def test_no_unit_would_still_move():
    random = np.random.default_rng(4)
    pairs = np.pad(random.poisson(random.gamma(0.3, 3, (120, 120))), ((0, 1), (0, 1)), constant_values=1)

    def likelihood(label):
        hot = np.eye(9)[label]
        table = hot.T @ pairs @ hot
        sides = (table, -table.sum(axis=0), -table.sum(axis=1))
        return sum(float((x * np.log(np.maximum(abs(x), 1))).sum()) for x in sides)

    label = exchange_classes(pairs, classes=8)
    best = likelihood(label)
    for unit in range(120):
        for kind in range(8):
            other = label.copy()
            other[unit] = kind
            assert likelihood(other) <= best + 1e-6


def test_empty_tables_and_repeated_rows(documents):  # noqa: F811
    assert class_scores(documents([])).count() == 0
    same = documents([(0, "a b"), (0, "a b"), (None, "a b"), (None, None)]).withColumnsRenamed({"lang": "code", "source": "row"})
    rows = class_scores(same).collect()
    assert len(rows) == 4
    assert {r.train_tokens for r in rows} == {3 + 3 + 3 + 1}
    only_held = class_scores(documents([(k, "a") for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 1]))
    assert {(r.n_known, r.train_tokens) for r in only_held.collect()} == {(0, 0)}


def test_codes_are_63_bits_and_keep_the_ending():
    assert 0 <= word_code(b"reading") < 1 << 63
    assert word_code(b"reading") % 256 == word_code(b"ing") % 256


def test_words_beyond_the_frequent_ones_have_classes_of_their_own(documents):  # noqa: F811
    chance = np.random.default_rng(2)
    rows = []
    for k in range(160):  # two kinds of documents; the rare words of both end alike
        own = [f"f{2 * x + k % 2}" for x in chance.integers(0, 512, 150)]
        rare = [f"r{2 * x + k % 2}xyz" for x in chance.integers(0, 100, 10)]
        rows.append((k, " ".join(word for at, word in enumerate(own) for word in ([word, rare[at // 15]] if at % 15 == 7 else [word]))))
    model = fit_class_model(documents(rows))
    kinds = dict(zip(model.held.tolist(), model.held_class.tolist()))
    found = [{kinds[c] for j in range(k, 200, 2) if (c := word_code(f"r{j}xyz".encode())) in kinds} for k in (0, 1)]
    assert found[0] and found[1] and not found[0] & found[1]
