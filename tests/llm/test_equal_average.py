"""Vector codes against plain search over every entry."""

import hashlib

import numpy as np
import pytest

from gaugeline.llm.equal_average import EqualAverage, kept_vectors, train_codebooks, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, slot int, vector int"


def plain_nearest(rows, entries):
    away = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    return away.argmin(axis=1), away.min(axis=1)


def plain_codes(vectors, parts=4, entries=256, rounds=4):
    """Codes, errors and codebooks of a list of (vec_id, vector) as the method defines them."""
    kept = sorted(vectors, key=lambda v: (v[0] is None, v[0] or 0, v[1]))
    cut = np.array([[int(np.floor(1024 * x)) for x in v] for _, v in kept]).reshape(len(kept), parts, -1)
    books = [[row[part].tolist() for row in cut[:entries]] for part in range(parts)]
    for step in range(rounds + 1):
        found = [plain_nearest(cut[:, part], np.array(books[part])) for part in range(parts)]
        if step < rounds:
            for part in range(parts):
                for k in range(len(books[part])):
                    own = cut[found[part][0] == k, part]
                    if len(own):
                        books[part][k] = [int(s) // len(own) for s in own.sum(axis=0)]
    codes = ["".join(f"{found[part][0][i]:02x}" for part in range(parts)) for i in range(len(kept))]
    errors = [int(sum(found[part][1][i] for part in range(parts))) for i in range(len(kept))]
    digest = hashlib.sha256(",".join(str(x) for part in books for entry in part for x in entry).encode()).hexdigest()
    return [(v[0], code, error) for v, code, error in zip(kept, codes, errors)], digest


@pytest.mark.parametrize("d, spread", [(1, 3), (4, 5), (16, 300), (3, 2**20)])
def test_search_equals_every_entry(d, spread):
    chance = np.random.default_rng(d)
    entries = chance.integers(-spread, spread + 1, (200, d))
    rows = chance.integers(-spread, spread + 1, (1500, d))
    search = EqualAverage(entries)
    found, best = search.nearest(rows)
    index, away = plain_nearest(rows, entries)
    assert (found == index).all() and (best == away).all()


def test_search_leaves_out_far_entries():
    chance = np.random.default_rng(3)
    centres = np.arange(-100, 100)[:, None] * 1000 + chance.integers(-5, 6, (200, 8))
    rows = centres[chance.integers(0, 200, 3000)] + chance.integers(-20, 21, (3000, 8))
    search = EqualAverage(centres)
    found, best = search.nearest(rows)
    assert (found == plain_nearest(rows, centres)[0]).all()
    assert search.looked_at < 0.8 * 3000 * 200


def check(spark, rows, **settings):
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA).repartition(5)
    got = vector_codes(frame, **settings).collect()
    usable = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    want, digest = plain_codes([(r[0], r[1]) for r in usable], **settings)
    assert sorted((str(r.vec_id), r.code, r.error) for r in got) == sorted((str(a), b, c) for a, b, c in want)
    assert {r.codebooks_sha256 for r in got} == {digest}
    label = {r[0]: r[2] for r in usable}
    sums = {}
    for vec_id, _, error in want:
        sums[label[vec_id]] = sums.get(label[vec_id], 0) + error
    assert all(r.label_error == sums[label[r.vec_id]] for r in got)


def test_codes_nulls_ties_repeats_and_clashing_names(spark):
    chance = np.random.default_rng(7)
    rows = [(k, chance.normal(size=8).round(2).tolist(), int(k % 3) if k % 5 else None) for k in range(400)]
    rows += [(1, rows[1][1], 1), (None, rows[2][1], 2)]  # a repeated row, and one without an id
    rows += [(500, None, 0), (501, [], 0), (502, [1.0, None] * 4, 0), (503, [float("nan")] + [1.0] * 7, 0), (504, [float("inf")] + [0.0] * 7, 0)]
    rows += [(k, [0.5] * 8, 1) for k in range(600, 650)]  # ties
    check(spark, rows)
    check(spark, rows, parts=2, entries=7, rounds=2)


def test_fewer_rows_than_entries_and_empty_tables(spark):
    check(spark, [(1, [0.1, 0.2, -0.3, 0.4], 1), (2, [0.5, -0.5, 0.0, 1.0], None)])
    empty = spark.createDataFrame([], SCHEMA)
    assert vector_codes(empty).count() == 0
    assert train_codebooks(kept_vectors(empty)).size == 0


def test_many_labels_are_joined_by_slots(spark, monkeypatch):
    monkeypatch.setattr("gaugeline.llm.equal_average.BROADCAST_LABELS", 2)
    check(spark, [(k, [k / 7, 1.0, -k / 3, 0.5], k % 4 or None) for k in range(300)])


def test_vectors_it_cannot_code_raise(spark):
    for bad in ([1.0] * 6, [1.0] * 8 + [2.0**30] * 4):
        frame = spark.createDataFrame([(1, bad, 1, "", 1, 1)], SCHEMA)
        with pytest.raises(ValueError):
            vector_codes(frame).collect()
