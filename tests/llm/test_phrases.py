"""Collocations against plain counting of every window."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from gaugeline.llm.phrases import (
    BLOCK,
    CodedStream,
    Signature,
    WordCodes,
    blocks_of,
    folded,
    mine_phrases,
    phrase_hashes,
    proposed_windows,
    top_collocations,
    window_hashes,
)

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, word string, w1 long"


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", 2) for row in rows], SCHEMA).repartition(3)


def plain_counts(rows):
    counts = Counter()
    for _, text, lang in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts.update((lang or "und", *words[i : i + m]) for m in range(1, 5) for i in range(len(words) - m + 1))
    return counts


def plain_top(rows, top, min_count, held=80):
    counts = plain_counts(rows)
    found = {p: a for p, a in counts.items() if a >= min_count and len(p) > 2}
    inside = {}
    for p, a in found.items():
        for low in range(1, len(p)):
            for high in range(low + 2, len(p) + 1):
                if high - low < len(p) - 1:
                    key = (p[0], *p[low:high])
                    inside[key] = max(inside.get(key, 0), a)
    out = {}
    for p, a in found.items():
        if 100 * inside.get(p, -1) >= held * a:
            continue
        cuts = [(counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
        score, _, (left, right) = min((2000000 * a // sum(cut), k, cut) for k, cut in enumerate(cuts))
        out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right))
    n = Counter()
    for p, a in counts.items():
        if len(p) == 2:
            n[p[0]] += a
    return sorted(
        (lang, k + 1, text.decode(), -a, left, right, n[lang], -score)
        for lang, own in out.items()
        for k, (score, a, text, left, right) in enumerate(sorted(own)[:top])
    )


def corpus(seed, size=120):
    chance = random.Random(seed)
    fixed = ["new york city hall", "in spite of", "Der Hund", "a a a a a", "naïve café", "so on; and so on"]
    rows = []
    for k in range(size):
        parts = []
        for _ in range(chance.randrange(60)):
            parts.append(chance.choice(fixed) if chance.random() < 0.3 else f"w{int(chance.expovariate(0.2))}")
            parts.append(chance.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", "\x0b", "!?"]))
        rows.append((k, "".join(parts), chance.choice(["en", "de", None, "und"])))
    return rows


def result(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_top_phrases_equal_plain_counting(spark):
    rows = corpus(1) + [(900, None, "en"), (901, "", None), (902, " .. \n", "fr"), (3, corpus(1)[3][1], "en"), (None, "in spite of it", "en")]
    rows.append((903, "long winding road " * 30_000, "en"))
    want = plain_top(rows, 8, 8)
    assert len({row[0] for row in want}) == 3 and any(row[1] == 8 for row in want)
    assert result(top_collocations(table(spark, rows), top=8, min_count=8)) == want


@pytest.mark.parametrize("one_in, lowered", [(10**9, 0.6), (2, 3.0)])
def test_border_failures_are_expanded_until_nothing_is_open(spark, one_in, lowered):
    rows = corpus(2, 60)
    phrases, words = mine_phrases(table(spark, rows), min_count=6, one_in=one_in, lowered=lowered)
    spelled = {row.w1: (row.lang, row.word) for row in words.collect()}
    got = {(spelled[r[0]][0], *(spelled[w][1] for w in r[:4] if w)): r.n for r in phrases.collect()}
    assert got == {p: a for p, a in plain_counts(rows).items() if a >= 6}
    assert any(len(p) == 5 for p in got)


def test_every_word_is_counted_by_language(spark):
    rows = [(1, "en es de", "es"), (2, "en es de", "en"), (3, "es", "de")]
    _, words = mine_phrases(table(spark, rows), min_count=2)
    assert {(r.lang, r.word): r.n for r in words.collect()} == {(p[0], p[1]): a for p, a in plain_counts(rows).items() if len(p) == 2}


def test_empty_tables_and_rare_phrases_give_no_rows(spark):
    assert top_collocations(table(spark, [])).count() == 0
    assert top_collocations(table(spark, [(1, "a b a b", "en"), (2, None, None)])).count() == 0


def coded(texts, salt=0):
    """Codes of a stream of (text, lang) and the words they stand for."""
    stream, out = CodedStream(salt), []
    for text, lang in texts:
        for _ in stream.add(None if text is None else text.encode(), lang):
            out.append(stream.take())
    stream.encode()
    out.append(stream.take())
    rows = []
    for codes, checks, spelled in out:
        langs, words = spelled(np.flatnonzero(codes))
        told = iter(zip(langs.to_pylist(), words.to_pylist()))
        rows += [(int(a), int(b), *(next(told) if a else (None, None))) for a, b in zip(codes, checks)]
    return rows


def test_codes_name_words_of_a_language():
    rows = coded([("A\tb, Ünï  c\x0bD", "en"), (None, "en"), ("b a en de", "de"), ("de en", "en"), ("ab ba abab baba", "en")])
    assert [row[3] for row in rows] == ["a", "b", None, "Ünï", "c", None, "d", None, None, "b", "a", "en", "de", None, "de", "en", None, "ab", "ba", "abab", "baba", None]
    for lane in (0, 1):
        by_code = {}
        for row in rows:
            by_code.setdefault(row[lane], set()).add(row[2:])
        assert all(len(names) == 1 for names in by_code.values())
        assert len(by_code) == len({row[2:] for row in rows})
    assert rows == coded([("A\tb, Ünï  c\x0bD", "en"), (None, "en"), ("b a en de", "de"), ("de en", "en"), ("ab ba abab baba", "en")])
    assert rows[0][0] != coded([("a", "en")], salt=1)[0][0]


def test_long_words_and_texts_of_several_blocks():
    long = "X" * 70_000
    text = " ".join([long, "y" * 64, "y" * 65, "y" * 66, *(f"w{k}" for k in range(300_000)), long])
    names = {}
    data = folded(text.encode(), names)
    blocks = list(blocks_of(data))
    assert len(blocks) > 2 and b"".join(blocks) == data and max(map(len, blocks)) <= BLOCK
    assert len(names) == 3
    stream = CodedStream(0)
    seen, words = [], []
    for _ in stream.add(text.encode(), "en"):
        codes, _, spelled = stream.take()
        seen.append(codes[stream.overlap :])
    stream.encode()
    codes, _, spelled = stream.take()
    seen.append(codes[stream.overlap :])
    assert len(np.concatenate(seen)) == len(text.split()) + 1
    assert spelled(np.array([len(codes) - 2]))[1].to_pylist() == [long.lower()]
    assert seen[0][0] == codes[-2] and len(set(np.concatenate(seen).tolist())) == 300_005


def test_equal_words_have_equal_codes_wherever_they_stand():
    own = WordCodes(3)
    data = b"aa b aa\xffaa aa b\xff"
    codes = own.of(data, np.array([8, len(data)]), np.array([1, 2], np.uint64))[0]
    assert codes[0] == codes[2] != codes[4] == codes[5] and codes[1] != codes[6] and codes[3] == codes[7] == 0


def test_windows_of_codes():
    codes = np.array([5, 7, 0, 7, 5, 7, 9, 0], np.uint64)
    hashes = window_hashes(codes, 3)
    assert [len(x) for x in hashes] == [8, 7, 6]
    for start in range(6):
        own = phrase_hashes([codes[start + k : start + k + 1] for k in range(3)])
        assert [int(x[0]) for x in own] == [int(hashes[k][start]) for k in range(3)]

    def signature(*wanted):
        words = np.zeros(2**20, np.int64)
        for h in wanted:
            at = int(Signature.places(np.array([h], np.uint64))[0])
            words[at >> 6] |= np.int64(1) << np.int64(at & 63) if at & 63 < 63 else np.int64(-(2**63))
        return Signature(words)

    five, seven = hashes[0][0], hashes[0][1]
    counted = proposed_windows(codes, hashes, [signature(five, seven), signature(hashes[1][0])])
    assert counted[0].tolist() == [True, True, False, True, True, True, True, False]
    assert np.flatnonzero(counted[1]).tolist() == [0, 3, 4]  # 9 is not proposed
    assert np.flatnonzero(counted[2]).tolist() == []  # 7 5 is not proposed, so 7 5 7 is not on the border
