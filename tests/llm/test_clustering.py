"""Clustering over zone maps against plain rounds over all vectors and centroids."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import types as T

from sluicebox.llm import clustering

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    # names that the operator uses itself
    T.StructField("z", T.StringType()), T.StructField("cluster", T.StringType()), T.StructField("key", T.IntegerType()),
])


def got(spark, rows, **options):
    df = clustering.cluster(spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], SCHEMA), **options)
    assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def expected(rows, dims, k, rounds=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    marked = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), z) for i, z in kept if i is not None)
    centroids = [z for _, z in marked[:k]]
    if not centroids:
        return []

    def assign():
        out = []
        for _, z in kept:
            out.append(min((sum((a - b) ** 2 for a, b in zip(z, c)), n) for n, c in enumerate(centroids)))
        return out

    for _ in range(rounds):
        near = assign()
        for n in range(len(centroids)):
            mine = [z for (_, z), (_, c) in zip(kept, near) if c == n]
            if mine:
                centroids[n] = [sum(column) // len(mine) for column in zip(*mine)]
    near = assign()
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((i, n, d, sum(e for e, m in near if m == n), sum(e for e, _ in near), sha[n]) for (i, _), (d, n) in zip(kept, near)),
        key=str,
    )


@pytest.mark.parametrize("dims,k,block_rows", [(4, 5, 8), (64, 16, 16), (3, 1, 4)])
def test_against_plain_rounds(spark, dims, k, block_rows):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(i % 7, 0.4, dims).astype(float).tolist()) for i in range(300)]
    assert got(spark, rows, dims=dims, k=k, block_rows=block_rows) == expected(rows, dims, k)


def test_ties_repeats_nulls_and_other_lengths(spark):
    same = [0.5, -0.5]
    rows = [(i, same) for i in range(40)] + [(1, [0.25, 0.0]), (1, [0.0, 0.25]), (None, [3.0, 3.0]), (50, None), (51, [1.0]),
            (52, [1.0, None]), (53, [1.0, float("nan")]), (54, [float("-inf"), 0.0]), (55, []), (56, [1.0, 2.0, 3.0])]
    rows += [(60 + i, [float(i % 2), 1.0]) for i in range(30)]
    for k in (1, 6, 200):
        assert got(spark, rows, dims=2, k=k, block_rows=4) == expected(rows, 2, k)


def test_large_components_are_exact_and_larger_ones_refused(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-2_000_000, 2_000_000, 8)).astype(float).tolist()) for i in range(60)]
    assert got(spark, rows, dims=8, k=6, block_rows=8) == expected(rows, 8, 6)
    with pytest.raises(Exception, match="no long holds"):
        got(spark, [(1, [3e38, 0.0])], dims=2)


def test_empty_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (None, [0.0] * 64)]) == []


def test_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2), (2, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = clustering.hilbert_keys(cells, bits)
        assert len({k.tobytes() for k in keys}) == len(cells)
        path = cells[np.lexsort(keys.T[::-1])]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_boxes_exclude_centroids_and_never_the_nearest():
    rng = np.random.default_rng(3)
    centres = rng.integers(-60, 60, (16, 64))
    z = centres[rng.integers(0, 16, 4096)] + rng.integers(-6, 7, (4096, 64))
    order = np.lexsort(clustering.hilbert_keys((z - z.min()) * 16 // (np.ptp(z) + 1), 4).T[::-1])
    met = []
    for k in range(0, len(z), 64):
        block = z[order[k : k + 64]].astype(np.int32)
        chosen = clustering.candidates(block.min(0), block.max(0), centres)
        nearest, distance = clustering.nearest(block, centres)
        assert set(nearest) <= set(chosen)
        again, same = clustering.nearest(block, centres[chosen])
        assert (chosen[again] == nearest).all() and (same == distance).all()
        met.append(len(chosen))
    # a block that lies in one group has one candidate; those across the curve's jumps have many
    assert np.median(met) == 1 and np.mean(met) <= 6
