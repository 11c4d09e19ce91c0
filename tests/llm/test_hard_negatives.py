"""Hard negatives against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, cell string, a string"


def plain(rows, is_anchor, positives=5, negatives=10):
    kept = {(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
            if None not in (i, v, label) and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, v in kept:
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, u)), j, other == label) for j, other, u in kept)
        for minus, j, _ in [s for s in scored if s[2] and s[1] != i][:positives]:
            inside = [s for s in scored if not s[2] and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:negatives]
            out += [(i, j, rank, n, -minus, -m) for rank, (m, n, _) in enumerate(inside, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "s", "c", "a") for i, v, label in rows], SCHEMA).repartition(3)


def clustered(seed, n=400, d=8, centres=12, noise=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    return [(i, (middle[i % centres] + noise * rng.normal(size=d)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


def check(spark, rows, every=20, **settings):
    got = hard_negatives.mine(frame(spark, rows), F.col("id") % every == 0, **settings)
    assert sorted(map(tuple, got.collect())) == plain(rows, lambda i: i % every == 0)
    return got


@pytest.mark.parametrize("settings", [{}, {"first_rows": 10, "growth": 2, "cell_rows": 4, "part_bytes": 2000}])
def test_equals_brute_force(spark, settings):
    rows = clustered(1)
    # equal vectors with and without the label, ties, and rows that take no part
    rows += [(500 + i, rows[7][1], i % 3) for i in range(60)]
    rows += [(600, None, 1), (601, [0.1, None] + [0.0] * 6, 1), (602, [float("nan")] + [0.0] * 6 + [1.0], 1),
             (603, rows[0][1], None), (None, rows[0][1], 1), (604, [], 1), (605, [0.0] * 8, 1), (606, [float("inf")] * 8, 1)]
    rows += rows[:25]
    # an id with several rows
    rows += [(40, rows[41][1], 2), (40, rows[43][1], 2), (40, rows[44][1], 1)]
    check(spark, rows, **settings)


def test_few_rows_and_odd_sizes(spark):
    check(spark, [(0, [0.5], 1), (1, [0.5], 1), (2, [0.3], 2), (20, [-0.5], 1), (3, [-0.2], 2)])
    check(spark, [(0, [0.5, 0.1], 1)])
    check(spark, [(0, [0.5, 0.1], 1), (1, [0.4, 0.1], 2)])
    empty = hard_negatives.mine(frame(spark, [(0, [0.5], 1)]).limit(0), F.col("id") % 2 == 0)
    assert empty.collect() == [] and empty.columns[0] == "anchor_id"
    with pytest.raises(Exception, match="differ in length"):
        check(spark, [(0, [0.5], 1), (1, [0.5, 0.2], 1)])


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(rng.integers(0, 1 << 21)) + 0.5, float(i % 3), 1.0], i % 3) for i in range(60)]
    check(spark, rows)
    with pytest.raises(Exception, match="too large"):
        check(spark, [(0, [1e300], 1), (1, [1.0], 2)])


def test_one_vector_for_a_third_of_all_rows(spark):
    rows = clustered(5, 300)
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(150)]
    check(spark, rows, every=50, cell_rows=8, part_bytes=4000, first_rows=16)


def test_bounds_hold_and_clusters_are_skipped(spark):
    rows = clustered(9, 3000, 16, 60)
    vectors = frame(spark, rows)
    mined, seen = hard_negatives.mine_with_visits(
        vectors, F.col("id") % 100 == 0, "vec_id", "label", "embedding", 256, 5, 10, 3, 9, cell_rows=16, first_rows=64, growth=4)
    assert sorted(map(tuple, mined.collect())) == plain(rows, lambda i: i % 100 == 0)
    share = {r.phase: r.s / len(rows) for r in seen.groupBy("phase").agg(F.avg("seen").alias("s")).collect()}
    assert share["positives"] < 0.35
    placed, index, _ = hard_negatives.build_index(
        hard_negatives.distinct_vectors(hard_negatives.prepare(vectors, "vec_id", "label", "embedding"), 10), 16)
    by_cell = {}
    for r in placed.collect():
        by_cell.setdefault(r.cell, []).append(np.frombuffer(r.vec))
    query = by_cell[min(by_cell)][0]
    last = math.inf
    visited = list(index.visits(query))
    assert len({c for c, *_ in visited}) == len(visited) == len(index.rows)
    for cell, bound, most, least in visited:
        assert bound <= last and most <= bound + 1e-6
        last = bound
        for x in by_cell.get(cell, []):
            assert least <= x @ query <= most
