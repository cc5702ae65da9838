import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from small import by, documents, sentence  # noqa: F401

from gaugeline.llm.components import connected_components
from gaugeline.llm.shingles import WordCodes, shingle_codes, words_of
from gaugeline.llm.sketch_dedup import (
    BAND_ROWS,
    BANDS,
    near_duplicates,
    remove_near_duplicates,
    similarity_sketch,
)

COLUMNS = ("n_shingles", "component_id", "kept")


@given(st.integers(1, 3000), st.integers(0, 10**6))
@settings(max_examples=40, deadline=None)
def test_every_bin_is_filled(size, seed):
    codes = np.unique(np.random.default_rng(seed).integers(0, 2**63, size).astype(np.uint64))
    sketch = similarity_sketch(codes)
    assert len(sketch) == BANDS * BAND_ROWS
    assert (sketch < np.iinfo(np.uint64).max).all()
    assert (similarity_sketch(codes[::-1]) == sketch).all()


@pytest.mark.parametrize("size", [3, 40, 700])
def test_agreement_estimates_similarity(size):
    random_ = np.random.default_rng(size)
    found = []
    for _ in range(60):
        codes = random_.integers(0, 2**63, 2 * size).astype(np.uint64)
        a, b = codes[: size + size // 2], codes[size // 2 :]
        found.append((similarity_sketch(np.sort(a)) == similarity_sketch(np.sort(b))).mean())
    assert abs(np.mean(found) - 0.5) < 0.05  # size of 2 * size codes are common


def edited(text, seed, share):
    chance = random.Random(seed)
    return " ".join(f"x{chance.randrange(10**6)}" if chance.random() < share else w for w in text.split())


def test_groups_equal_brute_force(documents):  # noqa: F811
    texts, k = {}, 0
    for base in range(12):
        text = sentence(base, words=120)
        for copy in range(12):
            texts[1000 - k] = text if copy < 3 else edited(text, k, 0.01 * copy)
            k += 1
    texts |= {2000: None, 2001: "", 2002: " \n", 2003: "One", 2004: "oNE", 2005: "É", 2006: "é", 2007: "two words", 2008: "two Words"}
    assert by(near_duplicates(documents(texts.items())), "doc_id", *COLUMNS) == brute.near_duplicates(texts)


def test_a_chain_is_one_group_though_its_ends_differ(documents):  # noqa: F811
    words = sentence(1, words=200, vocabulary=10**6).split()
    texts = {100 - k: " ".join(words[: 200 - 8 * k] + [f"y{j}" for j in range(8 * k)]) for k in range(20)}
    want = brute.near_duplicates(texts)
    assert {component for _, component, _ in want.values()} == {81}
    assert by(near_duplicates(documents(texts.items())), "doc_id", *COLUMNS) == want


def test_copies_tied_only_by_their_model(documents):  # noqa: F811
    base = sentence(5, words=150, vocabulary=10**6)
    texts = {k: edited(base, k, 0.05) for k in range(60)} | {77: base}
    assert by(near_duplicates(documents(texts.items())), "doc_id", *COLUMNS) == brute.near_duplicates(texts)


def test_very_long_texts_empty_tables_and_repeated_rows(documents):  # noqa: F811
    long = sentence(3, words=60_000, vocabulary=10**5)
    rows = [(1, long), (2, long + " more"), (3, "a b c"), (3, "a b c"), (None, "a b c"), (None, None)]
    found = near_duplicates(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 1, 3: 3, None: None}
    assert sum(r.kept for r in found) == 5
    assert near_duplicates(documents([])).count() == 0


def test_one_row_of_a_group_stays_with_all_columns(documents):  # noqa: F811
    rows = [(5, "a b c d"), (4, "A b c d"), (4, "A b c d"), (9, "other words"), (None, "a b c d"), (7, None)]
    docs = documents(rows).withColumnsRenamed({"lang": "key", "source": "whole", "n_chars": "turn"})
    kept = remove_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.where("text is not null").collect()) == [(0, "a b c d"), (4, "A b c d"), (9, "other words")]
    assert kept.where("doc_id = 7").count() == 1


def test_components_of_paths_stars_and_cycles(spark):
    chance = random.Random(4)
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    links += [(b, a) for a, b in links[::3]] + [(chance.randrange(400, 460), chance.randrange(400, 460)) for _ in range(40)]
    groups = brute.Sets({n for link in links for n in link})
    for a, b in links:
        groups.join(a, b)
    want = {n: groups.find(n) for a, b in links if a != b for n in (a, b)}
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_and_shingles():
    codes = WordCodes()
    assert words_of("A\x0bb\x1cC d é") == [b"a", "b\x1cc d".encode(), "é".encode()]
    assert len(shingle_codes(words_of("a b a b a"), codes)) == 2
    assert len(shingle_codes(words_of("a"), codes)) == 1
    assert len(shingle_codes([], codes)) == 0


@pytest.mark.parametrize("most", [0, 2**25])
def test_sets_of_wanted_documents_with_and_without_the_join(spark, documents, monkeypatch, most):  # noqa: F811
    monkeypatch.setattr("gaugeline.llm.sketch_dedup.SIGNATURE_NODES", most)
    texts = {k: sentence(k % 7, 80) + (f" more{k}" if k % 2 else "") for k in range(40)} | {100: None, 101: sentence(50)}
    rows = by(near_duplicates(documents([*texts.items(), (None, sentence(1, 80))])).where("doc_id IS NOT NULL"), "doc_id", *COLUMNS)
    assert rows == brute.near_duplicates(texts)
