import brute
import numpy as np
import pytest
from small import by

from gaugeline.llm.code_dedup import Plan, encode, estimate, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, vectors):
    return spark.createDataFrame([(k, v, 0) for k, v in vectors.items()], SCHEMA)


def groups(seed, bases=12, copies=14, dimensions=24):
    """Unit vectors around a few centres, from nearly equal to clearly different."""
    random = np.random.default_rng(seed)
    out = {}
    for _ in range(bases):
        base = random.standard_normal(dimensions)
        for k in range(copies):
            noise = random.standard_normal(dimensions)
            out[3 * len(out) + 5] = (base + 0.05 * k * noise).astype(np.float32).tolist()
    return out


def test_links_equal_brute_force(spark):
    vectors = groups(1)
    for k, same in ((1000, 5), (1001, 5), (1002, 8)):
        vectors[k] = list(vectors[same])
    vectors[1003] = [4 * x for x in vectors[5]]
    vectors |= {1: None, 2: [], 3: [0.0] * 24, 4: [None] + [1.0] * 23, 2000: [float("nan")] * 24, 2001: [float("inf")] + [0.0] * 23}
    vectors |= {2002: [1.0, 2.0], 2003: [1.0, 2.0], 2004: [1.0, 2.1], 2005: [5.0], 2006: [7.0], 2007: [-7.0]}
    assert by(near_vectors(table(spark, vectors)), "vec_id", "n_links", "component_id", "kept") == brute.near_vectors(vectors)


def test_a_large_group_in_parts(spark, monkeypatch):
    monkeypatch.setattr("gaugeline.llm.code_dedup.PART_VECTORS", 8)
    vectors = groups(2, bases=2, copies=60)
    vectors = {k: [x + (0.001 * k if n else 0) for n, x in enumerate(v)] for k, v in vectors.items()}
    assert by(near_vectors(table(spark, vectors)), "vec_id", "n_links", "component_id", "kept") == brute.near_vectors(vectors)


def test_empty_tables_null_ids_and_repeated_rows(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (None, [1.0, 0.0], 3)], SCHEMA).withColumnRenamed("label", "code")
    found = near_vectors(rows).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in found if r.vec_id) == [(1, 1, 1), (1, 1, 1)]
    assert [(r.n_links, r.component_id, r.kept) for r in found if r.vec_id is None] == [(0, None, True)]


@pytest.mark.parametrize("dimensions", [16, 64, 300])
def test_estimates_are_unbiased_and_within_their_bounds(dimensions):
    random = np.random.default_rng(dimensions)
    x = random.standard_normal((3000, dimensions))
    y = x + random.standard_normal((3000, dimensions)) * random.random((3000, 1))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    plan = Plan.of(3000)
    code, factor, *_ = encode(x, plan)
    *_, query, step, _ = encode(y, plan)
    value, bound = estimate(code, factor, query, step)
    exact = (x * y).sum(axis=1)
    assert abs((value - exact).mean()) < 0.01
    assert (np.abs(value - exact) <= bound).all()


def test_pairs_at_the_limit_share_a_bucket():
    random = np.random.default_rng(9)
    x = random.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = random.standard_normal((2000, 64))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    plan = Plan.of(100_000)
    assert (encode(x, plan)[4] == encode(y, plan)[4]).any(axis=1).all()
