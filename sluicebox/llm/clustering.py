"""Centroid clustering over zone maps of vectors in the order of a Hilbert curve.

Vectors are sorted along a Hilbert curve through all dimensions and cut into blocks, each with the least
and greatest value of every dimension, its box. Of two centroids, how much nearer one can be than the
other within a box is a sum over the dimensions, so a centroid that is farther than another one
everywhere in the box is none of the block's candidates. Vectors are compared with the candidates
of their block only, exactly, as matrices of integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sluicebox.llm.common import written

DIMS = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
BLOCK_ROWS = 256
# bits of each dimension that the curve tells apart
CURVE_BITS = 4
# greatest integer component: any squared distance fits a long
LARGEST = 1 << 27
# components up to this give sums of products that doubles hold exactly
EXACT_IN_DOUBLES = 1 << 21

_BLOCKS = "n int, ids array<bigint>, z binary, low binary, high binary"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """`vec_id, z` with components floor(scale * x) of vectors that have `dims` finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    doubles = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    scaled = doubles.where((F.size("x") == dims) & F.forall("x", finite)).withColumn(
        "z", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x))
    )
    too_large = F.exists("z", lambda z: (z > LARGEST) | (z < -LARGEST))
    return scaled.select("vec_id", F.when(
        too_large, F.raise_error(F.lit(f"a component beyond {LARGEST} gives distances that no long holds"))
    ).otherwise(F.col("z").cast("array<int>")).alias("z"))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of cell numbers below 2 ** bits, as rows of bytes in order.

    Axes are rotated and reflected level by level, then Gray-coded, and their bits interleaved.
    """
    axes = cells.T.astype(np.int64)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in axes:
            inverted = (axis & bit) != 0
            swapped = np.where(inverted, 0, (axes[0] ^ axis) & below)
            axes[0] ^= np.where(inverted, below, swapped)
            axis ^= swapped
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    flips = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    axes ^= flips
    levels = [(axes >> level) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(levels).T.astype(np.uint8), axis=1)


def _keyed(low: np.ndarray, high: np.ndarray, bits: int):
    """Rows with their place on the curve; cells divide what all vectors span."""

    def run(batches):
        for batch in batches:
            z = batch.column("z").flatten().to_numpy().reshape(batch.num_rows, len(low)).astype(np.int64)
            keys = hilbert_keys((z - low) * (1 << bits) // (high - low + 1), bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in z.astype(np.int32)], pa.binary()),
                 pa.array([k.tobytes() for k in keys], pa.binary())],
                names=["vec_id", "z", "key"],
            )

    return run


def _blocks(dims: int, block_rows: int):
    """Rows in order cut into blocks with their boxes; a block may hold rows of several batches."""

    def cut(ids: list, z: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([z.tobytes()], pa.binary()),
             pa.array([z.min(0).tobytes()], pa.binary()), pa.array([z.max(0).tobytes()], pa.binary())],
            names=["n", "ids", "z", "low", "high"],
        )

    def run(batches):
        ids, z = [], np.zeros((0, dims), np.int32)
        for batch in batches:
            ids = ids + batch.column("vec_id").to_pylist()
            z = np.concatenate([z, np.frombuffer(b"".join(batch.column("z").to_pylist()), np.int32).reshape(-1, dims)])
            whole = len(ids) // block_rows * block_rows
            for k in range(0, whole, block_rows):
                yield cut(ids[k : k + block_rows], z[k : k + block_rows])
            ids, z = ids[whole:], z[whole:]
        if ids:
            yield cut(ids, z)

    return run


def zone_maps(rows: DataFrame, dims: int, block_rows: int, bits: int) -> DataFrame:
    """Blocks of `vec_id, z` rows along the curve, written. Equal vectors are dealt over ranges by their
    place in the input, so a vector that many rows share does not end in one task."""
    span = rows.agg(*[f(F.col("z")[d]).alias(f"{name}{d}") for name, f in (("l", F.min), ("h", F.max)) for d in range(dims)]).first()
    low = np.array([span[f"l{d}"] or 0 for d in range(dims)], np.int64)
    high = np.array([span[f"h{d}"] or 0 for d in range(dims)], np.int64)
    keyed = written(rows.mapInArrow(_keyed(low, high, bits), "vec_id bigint, z binary, key binary"), "curve-keys")
    order = ["key", "_place"]
    placed = keyed.withColumn("_place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.select("vec_id", "z").mapInArrow(_blocks(dims, block_rows), _BLOCKS), "zone-maps")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that are nearest, or as near as another, somewhere in the box.

    d(p, c) - d(p, e) is linear in p, so its least value over a box is a sum over dimensions.
    """
    if len(centroids) == 1:
        return np.zeros(1, np.int64)
    apart = 2 * (centroids[None, :, :] - centroids[:, None, :])
    norms = (centroids * centroids).sum(1)
    least = np.where(apart > 0, apart * low, apart * high).sum(2) + norms[:, None] - norms[None, :]
    return np.flatnonzero(~(least > 0).any(1))


def nearest(z: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, ties to the smaller, and the squared distance."""
    kind = np.float64 if max(np.abs(z).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT_IN_DOUBLES else np.int64
    z, centroids = z.astype(kind), centroids.astype(kind)
    distances = (z * z).sum(1)[:, None] - 2 * (z @ centroids.T) + (centroids * centroids).sum(1)
    best = distances.argmin(1)
    return best, distances[np.arange(len(z)), best].astype(np.int64)


def _assigned(batches, centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, vectors, clusters and distances of each block."""
    dims = centroids.shape[1]
    for batch in batches:
        for ids, z, low, high in zip(*(batch.column(c).to_pylist() for c in ("ids", "z", "low", "high"))):
            z = np.frombuffer(z, np.int32).reshape(-1, dims)
            box = [np.frombuffer(b, np.int32).astype(np.int64) for b in (low, high)]
            chosen = candidates(*box, centroids)
            best, distance = nearest(z, centroids[chosen])
            yield ids, z, chosen[best], distance


def _sums(centroids: np.ndarray):
    """Of each cluster the number of a task's vectors and their sums, one row a cluster."""

    def run(batches):
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for _, z, clusters, _ in _assigned(batches, centroids):
            counts += np.bincount(clusters, minlength=len(centroids))
            np.add.at(sums, clusters, z)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(counts[met], pa.int64()), pa.array(list(sums[met]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    return run


def _labelled(centroids: np.ndarray):
    def run(batches):
        for ids, _, clusters, distances in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return run


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """Vectors of the `k` ids with the smallest SHA-256 of `1:<id>`, in that order."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.where(F.col("vec_id").isNotNull()).select(mark.alias("mark"), "z").orderBy("mark", "z").limit(k)
    return np.array([r["z"] for r in chosen.collect()], np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floor of its vectors' mean; one without vectors stays.

    Tasks sum what they read; the driver gets one number a centroid and dimension.
    """
    sums = blocks.mapInArrow(_sums(centroids), "cluster int, n bigint, sums array<bigint>")
    whole = sums.select("cluster", "n", F.posexplode("sums").alias("d", "x")).groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    )
    out = centroids.copy()
    for row in whole.collect():
        out[row["cluster"], row["d"]] = int(row["x"]) // row["n"]
    return out


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, k: int = CENTROIDS,
    rounds: int = ROUNDS, scale: int = SCALE, block_rows: int = BLOCK_ROWS, bits: int = CURVE_BITS,
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256` for each vector kept.

    The blocks are written once and read in every round; the centroids, `k` vectors, go with the tasks.

    Defined results: vectors that are null, of another length, or hold null, NaN or infinite components
    take no part; repeated rows are clustered each; rows without an id are clustered too but start no
    centroid; with fewer ids than `k` there are as many centroids, and without any no rows; a component
    beyond 2 ** 27 after scaling ends the job, because no long holds its distances; other columns are not read.
    """
    rows = integer_vectors(vectors, id_col, vector_col, dims, scale)
    centroids = first_centroids(rows, k)
    if not len(centroids):
        return _described(rows.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), {}, [])
    blocks = zone_maps(rows, dims, block_rows, bits)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    labelled = written(blocks.mapInArrow(_labelled(centroids), "vec_id bigint, cluster int, distance bigint"), "clusters")
    found = labelled.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return _described(labelled, {r["cluster"]: int(r["inertia"]) for r in found}, marks)


def _described(labelled: DataFrame, inertia: dict[int, int], marks: list[str]) -> DataFrame:
    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), F.col("cluster") + 1)

    return labelled.select(
        "vec_id", "cluster", "distance",
        of_cluster([inertia.get(c, 0) for c in range(len(marks))], "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"), of_cluster(marks, "string").alias("centroid_sha256"),
    )
