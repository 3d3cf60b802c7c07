"""Removal of repeated passages by hashing the units of lines.

A line is a unit; a long line is cut further at words whose hash says so, so that a passage gives the
same units wherever in a line it stands. Units are normalised (case, white space) and their digests
grouped globally; the occurrence that ranks first, by document id and place, stays. Repeated units
that follow one another form a run. A run's ends lie between words in general, so they are moved
outwards word by word as long as the document and the run's first occurrence agree. Runs of enough
words are cut out of the text, and their original offsets are returned.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sluicebox.llm.common import WordHashes, mixed, written

MIN_WORDS = 40
SEED_WORDS = 10
TELLING_WORDS = 4
UNIT_EVERY = 6
UNIT_MOST = 32

_UNITS = "doc_id bigint, start int, n_words int, digest bigint"
_WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def hashed_words(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's words, A-Z as a-z, and for each line that has words its number of the word
    after it."""
    words: list[bytes] = []
    ends = []
    for line in text.encode().lower().split(b"\n"):
        words.extend(line.split())
        ends.append(len(words))
    ends = np.array(ends, np.int64)
    return hashes.of(words), ends[np.diff(ends, prepend=0) > 0]


def units(words: np.ndarray, line_ends: np.ndarray, every: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and digest of each unit."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = mixed(words, 7) % np.uint64(every) == 0
    edge[line_ends - 1] = True
    ends = np.flatnonzero(edge) + 1
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    if sizes.max() > most:
        # a stretch without edges is cut at fixed steps from its start
        cuts = -(-sizes // most)
        step = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        stop = np.repeat(ends, cuts)
        starts = np.repeat(starts, cuts) + step * most
        sizes = np.minimum(stop - starts, most)
    place = (np.arange(len(words)) - np.repeat(starts, sizes)).astype(np.uint64)
    digests = np.add.reduceat(mixed(words ^ mixed(place, 3), 11), starts)
    return starts, sizes, digests.view(np.int64)


def _all_units(every: int, most: int):
    def cut(batches):
        hashes = WordHashes()
        for batch in batches:
            found = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                starts, sizes, digests = units(*hashed_words(text, hashes), every, most)
                found.append((np.full(len(starts), doc_id, np.int64), starts, sizes, digests))
                if sum(len(f[1]) for f in found) > 200_000:
                    yield pd.DataFrame(dict(zip(("doc_id", "start", "n_words", "digest"), map(np.concatenate, zip(*found)))))
                    found = []
            if found:
                yield pd.DataFrame(dict(zip(("doc_id", "start", "n_words", "digest"), map(np.concatenate, zip(*found)))))

    return cut


def _runs(repeated: DataFrame, seed_words: int, min_words: int) -> DataFrame:
    """Stretches of repeated units that follow one another, from the first to the last unit that does
    not recur by chance, with the places in the kept documents where they begin and end."""
    in_doc = Window.partitionBy("doc_id").orderBy("start")
    end = F.col("start") + F.col("n_words")
    # rows that repeat a document repeat its units
    follows = F.lag(end).over(in_doc).eqNullSafe(F.col("start")) | F.lag("start").over(in_doc).eqNullSafe(F.col("start"))
    stretches = repeated.withColumn("breaks", (~follows).cast("int")).withColumn("stretch", F.sum("breaks").over(in_doc))
    # units of few words recur by chance
    telling = F.col("n_words") >= TELLING_WORDS
    place = lambda at: F.struct("start", F.col("kept_doc").alias("doc"), at.alias("at"))
    left, right = place(F.col("kept_start")), place(F.col("kept_start") + F.col("n_words"))
    # a long stretch of such units alone is one all the same
    either = lambda f, x: F.coalesce(f(F.when(telling, x)), F.when(F.sum("n_words") >= min_words, f(x)))
    runs = stretches.groupBy("doc_id", "stretch").agg(
        either(F.min, left).alias("left"), either(F.max, right).alias("right"), either(F.max, end).alias("last"),
        F.array_sort(F.collect_list(F.struct("start", "digest"))).alias("units"),
    ).where(F.col("last") - F.col("left.start") >= seed_words)
    return runs.select(
        "doc_id", F.col("left.start").alias("first"), "last",
        F.filter("units", lambda u: (u["start"] >= F.col("left.start")) & (u["start"] < F.col("last"))).alias("units"),
        F.col("left.doc").alias("left_doc"), F.col("left.at").alias("left_at"),
        F.col("right.doc").alias("right_doc"), F.col("right.at").alias("right_at"),
    )


def _contexts(reach: int):
    """Hashes of the `reach` words before and after asked places of a document."""

    def contexts(batches):
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for text, asked in zip(batch["text"], batch["asked"]):
                words, _ = hashed_words(text, hashes)
                for a in asked:
                    found = words[max(0, a["at"] - reach) : a["at"]] if a["side"] == 0 else words[a["at"] : a["at"] + reach]
                    rows.append((a["doc_id"], a["first"], a["side"], found.tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "first", "side", "words"])

    return contexts


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    different = np.flatnonzero(a[:n] != b[:n])
    return int(different[0]) if len(different) else n


def _kept_spans(text: str, runs: list[dict], hashes: WordHashes, min_words: int, every: int, most: int) -> list[tuple[int, int]]:
    """Character spans of the runs of a text, their ends moved outwards, that have enough words."""
    words, ends = hashed_words(text, hashes)
    starts, _, digests = units(words, ends, every, most)
    digest_at = dict(zip(starts.tolist(), digests.tolist()))
    merged: list[list[int]] = []
    parts = []
    for r in runs:
        # a run speaks of the text it was found in; another text under the id stays
        if any(digest_at.get(u["start"]) != u["digest"] for u in r["units"]):
            continue
        before = np.frombuffer(r["before"] or b"", np.uint64)[::-1]
        after = np.frombuffer(r["after"] or b"", np.uint64)
        parts.append((r["first"] - _agreeing(words[: r["first"]][::-1][: len(before)], before),
                      r["last"] + _agreeing(words[r["last"] : r["last"] + len(after)], after)))
    for first, last in sorted(parts):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    merged = [m for m in merged if m[1] - m[0] >= min_words]
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)] if merged else []
    return [(places[a], places[b]) for a, b in merged]


def _without(min_words: int, every: int, most: int):
    def cut(batches):
        import pyarrow as pa

        hashes = WordHashes()
        spans_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, removed = batch.column("text").to_pylist(), [[]] * batch.num_rows
            for k, runs in enumerate(batch.column("runs").to_pylist()):
                text = texts[k]
                if runs is None or text is None:
                    continue
                spans = _kept_spans(text, runs, hashes, min_words, every, most)
                edges = [0, *(e for span in spans for e in span), len(text)]
                texts[k] = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                removed[k] = [{"begin": a, "end": b} for a, b in spans]
            kept = [n for n in batch.schema.names if n not in ("text", "runs")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(texts, pa.string()), pa.array(removed, spans_type)],
                [*kept, "text", "removed"],
            )

    return cut


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
    seed_words: int = SEED_WORDS, every: int = UNIT_EVERY, most: int = UNIT_MOST, carry: str | None = None,
) -> DataFrame:
    """`doc_id, text, removed` for each row of `docs`: the text without repeated passages of at least
    `min_words` words, and the removed spans as character offsets of the original text.

    Of equal units the one in the document with the smallest id, and there the first, stays. A run
    of repeated units needs `seed_words` words before its ends are moved. The column `carry` comes
    along as `carried`. Defined results: a null
    text stays null, an empty one empty; rows without an id are neither searched nor cut; rows that
    repeat a document are one document, each cut alike; an empty table gives no rows; other columns
    are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        *([F.col(carry).alias("carried")] if carry else []),
    )
    usable = rows.select("doc_id", "text").where("doc_id is not null and text is not null")
    found = written(usable.mapInPandas(_all_units(every, most), _UNITS), "units")
    kept = written(
        found.groupBy("digest").agg(
            F.min(F.struct("doc_id", "start")).alias("kept"), F.count(F.lit(1)).alias("often"),
        ).where("often > 1").select("digest", F.col("kept.doc_id").alias("kept_doc"), F.col("kept.start").alias("kept_start")),
        "kept-units",
    )
    repeated = found.join(kept, "digest").where("doc_id <> kept_doc or start <> kept_start")
    runs = written(_runs(repeated, seed_words, min_words), "runs")

    side = lambda name, n: F.struct(
        F.col(f"{name}_doc").alias("of_doc"), F.col(f"{name}_at").alias("at"), F.lit(n).alias("side"), "doc_id", "first"
    )
    asked = (
        runs.select(F.inline(F.array(side("left", 0), side("right", 1))))
        # places that many runs ask for are looked up in parts
        .groupBy("of_doc", F.pmod(F.hash("doc_id"), F.lit(64)).alias("part"))
        .agg(F.collect_list(F.struct("doc_id", "first", "side", "at")).alias("asked"))
    )
    contexts = (
        usable.join(asked, usable["doc_id"] == asked["of_doc"]).select("text", "asked")
        .mapInPandas(_contexts(most), "doc_id bigint, first int, side int, words binary")
        .groupBy("doc_id", "first").agg(
            F.max(F.when(F.col("side") == 0, F.col("words"))).alias("before"),
            F.max(F.when(F.col("side") == 1, F.col("words"))).alias("after"),
        )
    )
    by_doc = (
        runs.select("doc_id", "first", "last", "units").join(contexts, ["doc_id", "first"], "left")
        .groupBy(F.col("doc_id").alias("of_doc"))
        .agg(F.collect_list(F.struct("first", "last", "units", "before", "after")).alias("runs"))
    )
    joined = rows.join(by_doc, rows["doc_id"] == by_doc["of_doc"], "left").drop("of_doc")
    schema = T.StructType([f for f in joined.schema if f.name not in ("text", "runs")]).add("text", "string")
    return joined.mapInArrow(
        _without(min_words, every, most), schema.add("removed", T._parse_datatype_string("array<struct<begin:int,end:int>>"))
    )
