"""Benchmark decontamination with an FM-index per shard of documents.

A shard is a stretch of documents that one task holds at a time. Its words, numbered by the words of
the benchmark, form one sequence (words that no item has are a separator), which is suffix-sorted
and kept as an FM-index: the Burrows-Wheeler transform in a wavelet matrix, and the positions of every
16th suffix. All phrases of the benchmark are searched backwards at once by wavelet ranks, their
occurrences are located by walking to sampled suffixes, and occurrences that touch are merged into
spans. No document leaves its task, so nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from sluicebox.llm.common import spread, written

WINDOW = 10
SHARD_WORDS = 1_000_000
SAMPLE = 16
BENCHMARK_BYTES = 16_000_000

# A word is a run of digits, letters and characters outside ASCII; capitals A-Z count as small.
_KEPT = bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(128, 256))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Vocabulary(dict):
    """Numbers from 1 of the benchmark's words; 0 for any other word."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Phrases:
    """The windows of the benchmark's items, numbered, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocabulary = Vocabulary()
        numbers: dict[tuple[int, ...], int] = {}
        owners: list[set[int]] = []
        self.items = sorted({i for i, _ in items})
        place = {i: n for n, i in enumerate(self.items)}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for k in range(len(ids) - size + 1 if ids else 0):
                number = numbers.setdefault(tuple(ids[k : k + size]), len(numbers))
                if number == len(owners):
                    owners.append(set())
                owners[number].add(place[item])
        self.lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
        # phrases right-aligned, so that the backward search begins in the last column
        self.phrases = np.zeros((len(numbers), window), np.int64)
        for n, phrase in enumerate(numbers):
            self.phrases[n, window - len(phrase) :] = phrase
        self.owner_starts = np.cumsum([0, *map(len, owners)])
        self.owners = np.array([i for o in owners for i in sorted(o)], np.int64)


def suffix_array(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Positions of the suffixes in order; the end of the sequence sorts before any symbol.

    One sort by as many symbols as a 64-bit key holds, then doubling of that depth over the suffixes
    whose order is still open.
    """
    n = len(symbols)
    depth = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    shifted = symbols.astype(np.int64) + 1
    for k in range(depth):
        key <<= bits
        if k < n:
            key[: n - k] |= shifted[k:]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    del key, ordered
    while True:
        # rows of groups with more than one suffix
        alone = fresh & np.concatenate([fresh[1:], [True]])
        rows = np.nonzero(~alone)[0]
        if not len(rows):
            return order
        at = order[rows]
        after = at + depth
        following = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        group = first[rows]
        sort = np.lexsort((following, group))
        at, following, group = at[sort], following[sort], group[sort]
        order[rows] = at
        split = np.concatenate([[True], (group[1:] != group[:-1]) | (following[1:] != following[:-1])])
        fresh[rows] = split
        first[rows] = np.maximum.accumulate(np.where(split, rows, 0))
        rank[at] = first[rows]
        depth *= 2


class FMIndex:
    """Backward search and location over a sequence of symbols."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        # an end mark that is smaller than any symbol makes the transform cyclic
        text = np.concatenate([symbols.astype(np.int64) + 1, [0]])
        self.n = len(text)
        self.bits = max(1, int(n_symbols + 1).bit_length())
        order = suffix_array(text, self.bits + 1)
        self.last = text[order - 1]
        counts = np.bincount(text, minlength=(1 << self.bits) + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # the wavelet matrix: by level, the number of ones before each row
        self.ones, self.zeros = [], []
        column = self.last
        for level in reversed(range(self.bits)):
            bit = (column >> level & 1).astype(bool)
            ones = np.zeros(self.n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(self.n - int(ones[-1]))
            column = np.concatenate([column[~bit], column[bit]])
        self.sampled = order % sample == 0
        self.sample_rank = np.zeros(self.n + 1, np.int32)
        np.cumsum(self.sampled, out=self.sample_rank[1:])
        self.samples = order[self.sampled]

    def rank(self, symbols: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each row."""
        start, end = np.zeros_like(rows), rows
        for k, level in enumerate(reversed(range(self.bits))):
            bit = (symbols >> level & 1).astype(bool)
            ones = self.ones[k]
            start = np.where(bit, self.zeros[k] + ones[start], start - ones[start])
            end = np.where(bit, self.zeros[k] + ones[end], end - ones[end])
        return end - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each phrase; a phrase is a row, right-aligned,
        zeros in front are no part of it."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in reversed(range(phrases.shape[1])):
            live = np.nonzero((phrases[:, column] > 0) & (low < high))[0]
            symbol = phrases[live, column] + 1
            low[live] = self.before[symbol] + self.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at these rows, by steps back to a sampled suffix."""
        out, rows = np.zeros(len(rows), np.int64), rows.copy()
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            found = self.sampled[rows[open_]]
            at = rows[open_[found]]
            out[open_[found]] = self.samples[self.sample_rank[at]] + steps
            open_ = open_[~found]
            symbol = self.last[rows[open_]]
            rows[open_] = self.before[symbol] + self.rank(symbol, rows[open_])
            steps += 1
        return out


def _shard(found: list[np.ndarray], phrases: Phrases, window: int):
    """Per document of a shard: number of hit words, items, and merged spans of words."""
    sizes = np.array([len(f) for f in found], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    empty = [(0, [], [])] * len(found)
    if not len(phrases.phrases) or not starts[-1]:
        return empty
    # a separator ends each document; runs of separators are one symbol
    joined = np.zeros(int(starts[-1]) + len(found), np.int32)
    place = np.arange(int(starts[-1])) + np.repeat(np.arange(len(found)), sizes)
    joined[place] = np.concatenate(found)
    keep = (joined != 0) | np.concatenate([[True], joined[:-1] != 0])
    symbols, origin = joined[keep], np.nonzero(keep)[0]
    index = FMIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.phrases)
    times = high - low
    if not times.sum():
        return empty
    which = np.repeat(np.arange(len(times)), times)
    rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + low[which]
    begin = origin[index.locate(rows)]
    doc = np.searchsorted(starts[:-1] + np.arange(len(found)), begin, "right") - 1
    begin = begin - doc
    edges = np.zeros(int(starts[-1]) + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + phrases.lengths[which], -1)
    hit = np.cumsum(edges[:-1]) > 0
    out = list(empty)
    owned = phrases.owner_starts
    for d in np.unique(doc):
        here = hit[starts[d] : starts[d + 1]]
        change = np.flatnonzero(np.diff(here.astype(np.int8), prepend=0, append=0))
        numbers = np.unique(which[doc == d])
        items = np.unique(np.concatenate([phrases.owners[owned[w] : owned[w + 1]] for w in numbers]))
        out[d] = (int(here.sum()), items.tolist(), list(zip(change[::2].tolist(), change[1::2].tolist())))
    return out


def character_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as character offsets."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


_HITS = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<begin:int,end:int>>"


def _searched(shared, window: int, shard_words: int, first_pass: bool):
    """Fills the columns of `_HITS`, or adds the hits of one more part of the benchmark to them."""

    def search(batches):
        import pyarrow as pa

        phrases = shared.value
        types = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
        names = [c.split()[0] for c in _HITS.split(", ")]

        def shard(part, texts, symbols):
            rows = []
            found = _shard(symbols, phrases, window)
            old = zip(*[part.column(c).to_pylist() for c in names]) if not first_pass else [(0, 0, [], [])] * len(texts)
            for text, numbers, (n_hit, items, spans), (_, old_hit, old_items, old_spans) in zip(texts, symbols, found, old):
                items = [phrases.items[i] for i in items]
                spans = [{"begin": a, "end": b} for a, b in character_spans(text, spans)] if spans else []
                if old_items:
                    items, spans = sorted({*old_items, *items}), _union([*old_spans, *spans])
                    n_hit = sum(len(_WORD.findall(text[s["begin"] : s["end"]])) for s in spans)
                rows.append((len(numbers), n_hit, items, spans))
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
            kept = [n for n in part.schema.names if n not in names]
            return pa.RecordBatch.from_arrays([part.column(n) for n in kept] + columns, kept + names)

        for batch in batches:
            start, symbols, total = 0, [], 0
            texts = batch.column("text").to_pylist()
            for place, text in enumerate(texts, 1):
                words = words_of(text)
                symbols.append(np.fromiter(map(phrases.vocabulary.__getitem__, words), np.int32, len(words)))
                total += len(words)
                if total >= shard_words or place == len(texts):
                    yield shard(batch.slice(start, place - start), [t or "" for t in texts[start:place]], symbols)
                    start, symbols, total = place, [], 0

    return search


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    shard_words: int = SHARD_WORDS, benchmark_bytes: int = BENCHMARK_BYTES, carry: str | None = None,
) -> DataFrame:
    """`doc_id, text, n_words, n_hit, items, spans` for each row of `docs`: how many words stand in
    an occurrence of a benchmark window, the items (as strings, sorted) that own such windows, and
    the merged occurrences as character offsets.

    The phrases go to every task, so they are bounded: a benchmark of more than `benchmark_bytes` is
    searched in several passes, each with the items of one part of it. The column `carry` comes along
    as `carried`. Defined results: a null text
    has no words; a null id stays null; items without words, or without an id, match nothing;
    repeated rows and items give the same as single ones, row by row; empty tables give no rows or no
    hits; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text")
    ).where("item is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + F.octet_length("item"))).first()[0] or 0
    passes = -(-size // benchmark_bytes) or 1
    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    out = docs.select(*columns, *([F.col(carry).alias("carried")] if carry else []))
    for part in range(passes):
        chosen = items if passes == 1 else items.where(spread("item", over=passes) == part)
        phrases = spark.sparkContext.broadcast(Phrases([tuple(r) for r in chosen.orderBy("item", "text").collect()], window))
        schema = T.StructType([f for f in out.schema if f.name in ("doc_id", "text", "carried")])
        for field in T._parse_datatype_string(_HITS):
            schema = schema.add(field)
        out = out.mapInArrow(_searched(phrases, window, shard_words, part == 0), schema)
        if passes > 1:
            out = written(out, "benchmark-pass")
    return out


def _union(spans) -> list[dict]:
    """Spans that overlap as one."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["begin"], s["end"])):
        if out and s["begin"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], s["end"])
        else:
            out.append({"begin": s["begin"], "end": s["end"]})
    return out


def items_digest(items: str):
    """SHA-256 of the comma-joined item ids."""
    return F.sha2(F.array_join(items, ","), 256)


def without_spans(text: str = "text", spans: str = "spans"):
    """The text without the characters of its spans, which are in order and do not touch."""
    return F.expr(
        f"concat(array_join(transform(sequence(0, size({spans})), i -> "
        f"substring({text}, if(i = 0, 1, element_at({spans}, i).end + 1), "
        f"if(i = size({spans}), length({text}), element_at({spans}, i + 1).begin) "
        f"- if(i = 0, 0, element_at({spans}, i).end))), ''))"
    )
