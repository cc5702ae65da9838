"""Ids by dynamic programming against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from small import documents  # noqa: F401

from gaugeline.llm.bpe_paths import MergeRules, PathEncoder, decode_ids, encode_texts, round_trip_digests
from gaugeline.llm.subword import default_tokenizer

ODD = [
    "", " ", "\n\n", "A  b\tc\r\nd", "it's 1st. x'll 'LL", "naïve Ünï ñandú É́ é", "日本語 кириллица", "<|endoftext|> a<|STARTOFTEXT|>b",
    "a b c\x1cd", "***!!! a.b,c 12ab", "İstanbul ΑΣ", "🙂🙂 x", "ªº µ × ÷", "z" * 30_000, "a\0b", "x<|endoftext|><|startoftext|>y", "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def own():
    return PathEncoder(limit=1000)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_odd_texts_equal_the_library(library, own):
    for text in ODD:
        ids, back = expected(library, text)
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text[:40]
        assert own.decode(own.encode(text)) == back


def test_random_texts_equal_the_library(library, own):
    source = random.Random(12)
    for _ in range(5000):
        text = "".join(source.choice("aabbcee thinr' éßıİΣς12!.́漢\t\n<|>") for _ in range(source.randrange(40)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == expected(library, text)[0], text


def merged(symbols, merges):
    """BPE as defined: the lowest merge first, of equal ones the leftmost."""
    symbols = list(symbols)
    while True:
        found = [(merges.index((a, b)), k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if (a, b) in merges]
        if not found:
            return symbols
        _, k = min(found)
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]


def test_borders_and_every_prefix_equal_plain_merging():
    letters, merges = "ab", [("a", "a"), ("aa", "a"), ("a", "b"), ("aa", "ab"), ("b", "b"), ("ab", "bb"), ("aaa", "aaa"), ("b", "a")]
    names = [*letters, *dict.fromkeys(a + b for a, b in merges)]
    rules = MergeRules({name: k for k, name in enumerate(names)}, merges, "</w>")
    reachable = {name for name in names if merged(name, merges) == [name]}
    assert {rules.names[k] for k in rules.reachable} == reachable
    for u in reachable:
        for v in reachable:
            left = merged(u + v, merges) == [u, v]
            assert (rules.first_merge(names.index(u), names.index(v)) is None) == left, (u, v)


def test_each_prefix_ends_with_its_own_last_token(own):
    word = "internationalisation"
    last = own.last_tokens(word)
    merges = {pair: rank for pair, rank in own.rules.rule.items()}
    single = {own.rules.shape[k]: k for k in own.rules.reachable}
    for end in range(1, len(word) + 1):
        ids = [single[c] for c in word[:end]]
        while found := [(merges[p], k) for k, p in enumerate(zip(ids, ids[1:])) if p in merges]:
            _, k = min(found)
            ids[k : k + 2] = [single[own.rules.shape[ids[k]] + own.rules.shape[ids[k + 1]]]]
        assert last[end] == ids[-1]


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError, match="order"):
        MergeRules({"a": 0, "aa": 1, "aaa": 2}, [("aa", "a"), ("a", "a")], "</w>")


def test_digests_of_documents(spark, documents, library):  # noqa: F811
    texts = dict(enumerate([*ODD, None]))
    rows = {r.doc_id: r for r in round_trip_digests(documents(texts.items())).collect()}
    assert len(rows) == len(texts)
    for doc_id, text in texts.items():
        ids, back = expected(library, text)
        row = rows[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_registered_query_on_a_whole_table(spark, library):
    from gaugeline.llm.catalogue import op12_bpe_round_trip

    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.ids_sha256 for r in op12_bpe_round_trip(spark, folder).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows == {k: hashlib.sha256(np.array(expected(library, v)[0], "<u4").tobytes()).hexdigest() for k, v in texts.items()}


def test_empty_tables_repeated_rows_nulls_and_other_columns(spark, documents, library):  # noqa: F811
    assert round_trip_digests(documents([])).count() == 0
    frame = documents([(1, "a b"), (1, "a b"), (1, "c"), (None, None)])
    frame = frame.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    encoded = encode_texts(frame)
    assert encoded.columns == ["doc_id", "ids"]
    assert sorted((r.doc_id or 0, bytes(r.ids)) for r in encoded.collect()) == sorted(
        (k, np.array(expected(library, t)[0], "<u4").tobytes()) for k, t in [(1, "a b"), (1, "a b"), (1, "c"), (0, "")]
    )
    texts = decode_ids(encoded.unionByName(encoded.limit(1).withColumn("ids", F.lit(None).cast("binary"))))
    assert sorted(r.text for r in texts.collect()) == ["", "", "a</w> b</w>", "a</w> b</w>", "c</w>"]
