import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from small import documents  # noqa: F401

from gaugeline.llm.packing import best_fit_filling, pack_documents, pack_lengths, undominated_fillings, waste_bound
from gaugeline.llm.subword import ChunkEncoder, default_tokenizer


def histogram(lengths, size):
    return np.bincount(lengths, minlength=size + 1)


@given(st.lists(st.integers(1, 20), max_size=60))
@settings(max_examples=60, deadline=None)
def test_a_plan_uses_every_document_once(lengths):
    plan = pack_lengths(histogram(lengths, 20), 20)
    used = [x for often, filling in plan for x in filling * often]
    assert sorted(used) == sorted(lengths)
    assert all(sum(filling) <= 20 for _, filling in plan)


def fewest(lengths, size):
    """Exact answer by trying every sequence for every document."""
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= lengths[at]:
                rooms[k] -= lengths[at]
                place(at + 1, rooms)
                rooms[k] += lengths[at]
        place(at + 1, [*rooms, size - lengths[at]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best


@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
@settings(max_examples=60, deadline=None)
def test_the_search_is_close_to_the_fewest(lengths):
    plan = pack_lengths(histogram(lengths, 12), 12)
    exact = fewest(lengths, 12)
    assert waste_bound(histogram(lengths, 12), 12) <= exact
    assert exact <= sum(often for often, _ in plan) <= exact + 1


def test_completion_beats_best_fit():
    # Best fit puts 6 beside 4 first; 4+3+3 and 6+2+2 waste nothing.
    lengths = [6, 4, 3, 3, 2, 2]
    assert sum(often for often, _ in pack_lengths(histogram(lengths, 10), 10)) == 2
    assert best_fit_filling(histogram([4, 3, 3], 10), 4) == [4]
    assert undominated_fillings(histogram([4, 3, 2, 2], 10), 4)[0] == [4]


@pytest.fixture(scope="module")
def tokens():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(default_tokenizer())
    return lambda text: whole.encode(text, add_special_tokens=False).ids


ODD = [
    "", " ", "\n\n", "A  b\tc\r\nd", "it's 1st. x'll 'LL", "naïve Ünï ñandú É́ é", "日本語 кириллица", "<|endoftext|> a<|STARTOFTEXT|>b",
    "a b c\x1cd", "***!!! a.b,c 12ab", "İstanbul ΑΣ", "🙂🙂 x", "ªº µ × ÷", "z" * 3000,
]


def test_cached_chunks_give_the_tokenizers_ids(tokens):
    own = ChunkEncoder(limit=5)
    for _ in range(2):
        for text, ids in zip(ODD, own.encode(ODD)):
            assert np.frombuffer(ids, "<u4").tolist() == tokens(text), text


def check_packed(rows, texts, tokens, size):
    pieces = {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append(row)
    for doc_id, text in texts.items():
        ids = np.array(tokens(text or "") + [0], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [
            (k, k * size, min(size, len(ids) - k * size)) for k in range(-(-len(ids) // size))
        ]
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append(row)
    for own in sequences.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= size
    return len(sequences)


def test_documents_are_packed_whole(documents, tokens):  # noqa: F811
    texts = {k: text for k, text in enumerate([*ODD, None, *(f"word {k} " * (k % 7) for k in range(60))])}
    rows = pack_documents(documents(texts.items()), size=32).collect()
    used = check_packed(rows, texts, tokens, 32)
    assert used >= -(-sum(r.length for r in rows) // 32)


def test_empty_tables_repeated_rows_and_other_columns(spark, documents):  # noqa: F811
    assert pack_documents(documents([])).count() == 0
    same = documents([(1, "a b"), (1, "a b"), (None, None)]).withColumnRenamed("lang", "rank").withColumnRenamed("source", "part")
    rows = pack_documents(same).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 3), (False, 3), (True, 1)]
    assert len({r.sequence_id for r in rows}) == 1
