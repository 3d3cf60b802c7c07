"""Exact top-k by inner product over an impact-ordered index, score at a time.

Vectors are dealt into blocks. A block keeps, for each dimension, its vectors as postings in segments
of equal quantised value. For a query, a segment's impact is the least that its postings add to the
score, above the least that any segment of that dimension adds. Segments are processed by descending
impact into accumulators, which are lower bounds of the scores. What a vector can still gain is at
most the next impact of every dimension plus the quantisation error, so vectors whose accumulator
plus that falls below the k-th lower bound (or below the k-th exact score of earlier blocks) are
proven out. Processing stops when few vectors are left or no segment is; all that are left are
scored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sluicebox.llm.common import spread, written

LEVELS = 16
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
ROUNDS = 8

_INDEX = "block int, ids binary, z binary, order binary, starts binary, low binary, high binary"
_QUERIES = "query_block int, query_ids binary, query_z binary"


def _matrix(rows: pd.DataFrame, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, z in enumerate(rows["z"]):
        out[i, : len(z)] = z
    return out


def _index(dims: int, levels: int):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        z = np.ascontiguousarray(_matrix(rows, dims).T)
        order = np.empty(z.shape, np.uint32)
        starts = np.empty((dims, levels + 1), np.int64)
        low, high = np.zeros((dims, levels), np.int64), np.zeros((dims, levels), np.int64)
        for d in range(dims):
            least = z[d].min()
            width = (int(z[d].max()) - int(least)) // levels + 1
            level = (z[d] - least) // width
            order[d] = np.argsort(level, kind="stable")
            starts[d] = np.searchsorted(level[order[d]], np.arange(levels + 1))
            for n in range(levels):
                here = z[d][order[d, starts[d, n] : starts[d, n + 1]]]
                if len(here):
                    low[d, n], high[d, n] = here.min(), here.max()
        return pd.DataFrame({
            "block": [int(rows["block"].iloc[0])], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()],
            "z": [z.tobytes()], "order": [order.tobytes()], "starts": [starts.tobytes()],
            "low": [low.tobytes()], "high": [high.tobytes()],
        })

    return build


def _query_block(dims: int):
    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        return pd.DataFrame({
            "query_block": [int(rows["query_block"].iloc[0])],
            "query_ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "query_z": [_matrix(rows, dims).tobytes()],
        })

    return gather


class Block:
    """One block of the index."""

    def __init__(self, row, dims: int, levels: int):
        self.ids = np.frombuffer(row.ids, np.int64)
        n = len(self.ids)
        self.z = np.frombuffer(row.z, np.int64).reshape(dims, n)
        self.order = np.frombuffer(row.order, np.uint32).reshape(dims, n).astype(np.intp)
        self.starts = np.frombuffer(row.starts, np.int64).reshape(dims, levels + 1)
        self.low = np.frombuffer(row.low, np.int64).reshape(dims, levels)
        self.high = np.frombuffer(row.high, np.int64).reshape(dims, levels)
        self.filled = np.diff(self.starts, axis=1) > 0

    def search(self, query: np.ndarray, own: int, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of this block's members of the top k; `least` is a score that k other
        vectors are known to reach."""
        a, b = query[:, None] * self.low, query[:, None] * self.high
        lower = np.where(self.filled, np.minimum(a, b), np.iinfo(np.int64).max)
        base = np.where(self.filled.any(1), lower.min(1), 0)
        impact = np.where(self.filled, lower - base[:, None], 0)
        # what exact values can add to the lower bounds of their segments
        error = float(np.where(self.filled, np.maximum(a, b) - np.minimum(a, b), 0).max(1).sum())
        dims, levels = np.nonzero(self.filled)
        by_impact = np.argsort(-impact[dims, levels], kind="stable")
        dims, levels = dims[by_impact], levels[by_impact]
        impacts = impact[dims, levels]
        known = np.zeros(len(self.ids))
        upcoming = impact.max(1, initial=0)
        taken = np.zeros(len(query), np.int64)
        segments = self.filled.sum(1)
        per_dim = -np.sort(-np.where(self.filled, impact, -1), axis=1)
        # rows of the query's own id are no candidates, however many there are, and prove nothing
        others = np.nonzero(self.ids != own)[0]
        keep = others
        for first in range(0, len(dims), max(1, len(dims) // ROUNDS)):
            last = min(len(dims), first + max(1, len(dims) // ROUNDS))
            for d, n, value in zip(dims[first:last].tolist(), levels[first:last].tolist(), impacts[first:last].tolist()):
                if value:
                    known[self.order[d, self.starts[d, n] : self.starts[d, n + 1]]] += value
            taken += np.bincount(dims[first:last], minlength=len(query))
            done = taken >= segments
            upcoming = np.where(done, 0, per_dim[np.arange(len(query)), np.minimum(taken, per_dim.shape[1] - 1)])
            gain = float(upcoming.sum()) + error
            # sums of floats may be off by their rounding
            slack = 1.0 + 1e-9 * (np.abs(known).max(initial=0) + abs(float(base.sum())) + gain)
            reached = known[others]
            bound = float(np.partition(reached, len(reached) - k)[-k]) if len(reached) >= k > 0 else -np.inf
            bound = max(bound, least - float(base.sum()))
            keep = others[reached + gain + slack >= bound - slack]
            if len(keep) <= 4 * k:
                break
        scores = query @ self.z[:, keep]
        best = np.lexsort((self.ids[keep], -scores))[:k]
        return self.ids[keep][best], scores[best]


def _search(dims: int, levels: int, k: int):
    def search(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for row in blocks.itertuples():
            block = Block(row, dims, levels)
            for part in queries.itertuples():
                ids = np.frombuffer(part.query_ids, np.int64)
                z = np.frombuffer(part.query_z, np.int64).reshape(len(ids), dims)
                for own, query in zip(ids.tolist(), z):
                    near, scores = block.search(query, own, k, -np.inf)
                    found.append((np.full(len(near), own), near, scores))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    return search


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """`vec_id, z` with components floor(scale * x); rows without an id, a vector or finite components go."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    doubles = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    return doubles.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite)).select(
        "vec_id", F.transform("x", lambda x: F.floor(F.lit(float(scale)) * x)).alias("z")
    )


def top_k(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 10, scale: int = 1024, levels: int = LEVELS, block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """`query_id, rank, vec_id, score`: for each query row the k rows of `vectors` with the highest
    inner products of the integer vectors, ties to the smaller id, the query's own id left out.

    Each block of the index meets each block of queries in a task of its own, and gives k rows a
    query. Defined results: vectors that are null or hold null, NaN or infinite components take no
    part; a shorter vector counts as if filled up with zeros; repeated candidate rows are ranked
    each, a query asked twice is answered once; empty tables give no rows; other columns are not
    read.
    """
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    asked = integer_vectors(queries, id_col, vector_col, scale).dropDuplicates(["vec_id"])
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("z")).alias("dims")).first()
    n_asked = asked.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("z")).alias("dims")).first()
    dims = max(1, size["dims"] or 0, n_asked["dims"] or 0)
    blocks, query_blocks = -(-size["n"] // block_rows) or 1, -(-n_asked["n"] // query_rows) or 1
    index = written(
        rows.withColumn("block", spread("vec_id", over=blocks)).groupBy("block")
        .applyInPandas(_index(dims, levels), _INDEX), "impact-index",
    )
    gathered = written(
        asked.withColumn("query_block", spread("vec_id", over=query_blocks)).groupBy("query_block")
        .applyInPandas(_query_block(dims), _QUERIES), "impact-queries",
    )
    # a task for each pair of blocks, named by both numbers
    left = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = gathered.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("of_block"),
        F.col("query_block").alias("of_query_block"), "query_ids", "query_z",
    )
    found = (
        left.groupBy("block", "query_block").cogroup(right.groupBy("of_block", "of_query_block"))
        .applyInPandas(_search(dims, levels, k), "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
