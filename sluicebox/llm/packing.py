"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Best-fit decreasing sees a document's length only, so documents of one length are interchangeable.
The plan is therefore made on the histogram of lengths, which has at most `capacity` entries at any
scale: a segment tree over remaining capacities finds the tightest open bins, and the bins of one
remaining capacity take documents of one length many at a time. That gives exactly the bins that
placing the documents one by one would give. Each document then reads its place from its length and
its rank among the documents of that length, which are found in parallel.
"""

from __future__ import annotations

import json
import math
import zlib
from collections import defaultdict, deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sluicebox.llm.common import spread, written

_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def byte_level_encoding(path: str):
    """An encoder giving the ids of the byte-level vocabulary file; the file's merges are in the order
    of its ids, which is the rank form that `tiktoken` takes. Special strings give their own ids."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    # byte-level vocabularies write bytes as printable characters: the printable ones of Latin-1 as
    # they are, the others counted up from 256
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(letters[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _cut(path: str, capacity: int, end_id: int):
    def cut(batches):
        encoding = byte_level_encoding(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encoding.encode_to_numpy(text or "", allowed_special="all"), np.uint32(end_id)).astype("<u4")
                # the first piece takes the remainder, all others are full
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    rows.append((None if pd.isna(doc_id) else int(doc_id), piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    return cut


class OpenBins:
    """Open bins by remaining capacity, as intervals of bin numbers, under a segment tree."""

    def __init__(self, capacity: int):
        self.size = 1 << (capacity + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: dict[int, deque] = defaultdict(deque)

    def add(self, remaining: int, first: int, last: int) -> None:
        self.bins[remaining].append((first, last))
        self._change(remaining, last - first)

    def take(self, remaining: int, most: int) -> tuple[int, int]:
        """An interval of at most `most` bins with that remaining capacity."""
        first, last = self.bins[remaining].popleft()
        if last - first > most:
            self.bins[remaining].appendleft((first + most, last))
            last = first + most
        self._change(remaining, first - last)
        return first, last

    def _change(self, leaf: int, by: int) -> None:
        node = leaf + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest remaining capacity of an open bin that is at least `length`."""
        node = length + self.size
        if self.count[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """Best-fit decreasing on counts of lengths.

    For each length, runs (first rank, first bin, documents per bin, offset in the bin); the
    document of rank r in a run goes to bin `first bin + (r - first rank) // per bin`.
    """
    open_bins, new, runs = OpenBins(capacity), 0, {}
    for length in sorted(histogram, reverse=True):
        left, rank, runs[length] = histogram[length], 0, []
        while left:
            remaining = open_bins.tightest(length)
            if remaining is None:
                remaining = capacity
                per = capacity // length
                first, last = new, new + -(-left // per)
                new = last
            else:
                per = remaining // length
                first, last = open_bins.take(remaining, -(-left // per))
            runs[length].append((rank, first, per, capacity - remaining))
            placed = min(left, per * (last - first))
            full, rest = divmod(placed, per)
            if remaining - per * length:
                open_bins.add(remaining - per * length, first, first + full)
            if rest:
                open_bins.add(remaining - rest * length, first + full, first + full + 1)
            left, rank = left - placed, rank + placed
    return runs


def _placed(runs: dict[int, list[tuple[int, int, int, int]]]):
    arrays = {length: np.array(r, np.int64).T for length, r in runs.items()}

    def place(batches):
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length in np.unique(lengths):
                here = lengths == length
                starts, bins, per, at = arrays[int(length)]
                run = np.searchsorted(starts, ranks[here], "right") - 1
                nth = ranks[here] - starts[run]
                sequence[here] = bins[run] + nth // per[run]
                offset[here] = at[run] + nth % per[run] * length
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return place


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = 2048, end_id: int = 0,
) -> DataFrame:
    """`doc_id, piece, start, length, ids_crc32, sequence_id, offset`, a row per piece.

    A document's ids are those of the byte-level file `vocabulary` followed by `end_id`. A document
    longer than `capacity` is cut into pieces of `capacity`, the first of which takes the remainder.
    The driver holds the histogram of lengths and the plan, both bounded by `capacity` alone.
    Defined results: a null or empty text is one piece of the end id; a null id stays null; repeated
    rows are packed each; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = written(rows.mapInPandas(_cut(vocabulary, capacity, end_id), _PIECES), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # ranks within a length: groups of about the square root of all pieces, and sums over the groups
    groups = max(1, math.isqrt(sum(histogram.values())))
    pieces = pieces.withColumn("part", spread("doc_id", "piece", over=groups))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    ranked = (
        pieces.withColumn("nth", F.row_number().over(order) - 1).join(base, ["length", "part"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    )
    return ranked.mapInPandas(_placed(plan(histogram, capacity)), _PIECES + ", sequence_id bigint, offset bigint")
