import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicebox.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (3, ""), (4, None), (5, "... !"),
    (6, "Two three, FOUR five six seven eight nine ten eleven"), (10, "é1 ß2 ñ3"), (1, "another text under one id"), (None, "lone words"),
]
DOCS = [
    (1, "x One two three four five six seven eight nine TEN y short\nitem z"), (2, None), (3, ""), (4, "short"), (5, "item short item"),
    (6, "é1, ß2 ñ3 é1 ß2 ñ3"), (7, "two three four five six seven eight nine ten eleven twelve thirteen " * 3),
    (8, "another text under one id lone words"), (9, "short " * 4000 + "item"), (9, "short " * 4000 + "item"), (None, "short item"),
    (11, "one two three four five six seven eight nine"),
]


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items):
    mine, hit, found = words(text), set(), set()
    for item, t in items:
        theirs = words(t)
        if item is None or not theirs:
            continue
        n = min(10, len(theirs))
        windows = {tuple(theirs[k : k + n]) for k in range(len(theirs) - n + 1)}
        for k in range(len(mine) - n + 1):
            if tuple(mine[k : k + n]) in windows:
                found.add(str(item))
                hit.update(range(k, k + n))
    return len(mine), len(hit), sorted(found)


@pytest.mark.parametrize("bound,shard", [(10_000, 1_000_000), (40, 5)])
def test_hits_equal_brute_force(spark, texts, bound, shard):
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, words string")
    found = dc.benchmark_hits(texts(DOCS), benchmark, shard_words=shard, benchmark_bytes=bound)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute(t, ITEMS)) for i, t in DOCS), key=repr)


def test_spans_and_digest(spark, texts):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dc.benchmark_hits(texts(DOCS), benchmark, carry="n_tokens").select(
        "*", dc.without_spans().alias("rest"), dc.items_digest("items").alias("digest")).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].rest == "x  y  z" and by_id[6].rest == "" and by_id[5].rest == "item "
    assert by_id[1].digest == hashlib.sha256(b"1,2").hexdigest() and by_id[2].digest == hashlib.sha256(b"").hexdigest()
    assert {r.carried for r in rows} == {"x"}


def test_empty_tables(spark, texts):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.benchmark_hits(texts([]), benchmark).collect() == []
    none = dc.benchmark_hits(texts(DOCS), benchmark.where(F.lit(False))).collect()
    assert len(none) == len(DOCS) and not any(r.n_hit for r in none)


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_all_occurrences(seed):
    rng = np.random.default_rng(seed)
    n_symbols = int(rng.integers(1, 40))
    text = rng.integers(0, n_symbols + 1, int(rng.integers(1, 400)))
    if seed % 2:
        text = np.concatenate([text] * 5)
    index = dc.FMIndex(text, n_symbols)
    phrases = np.zeros((60, 4), np.int64)
    for row in phrases:
        size = int(rng.integers(1, 5))
        at = int(rng.integers(0, len(text)))
        part = text[at : at + size] if rng.random() < 0.7 else rng.integers(1, n_symbols + 1, size)
        part = part[part > 0] if len(part) else part
        if len(part):
            row[4 - len(part) :] = part
    low, high = index.search(phrases)
    for phrase, a, b in zip(phrases, low, high):
        wanted = phrase[phrase > 0]
        if not len(wanted):
            continue
        here = [k for k in range(len(text) - len(wanted) + 1) if (text[k : k + len(wanted)] == wanted).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == here


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(0)
    for text in ([0], [1, 1, 1, 1, 0], rng.integers(0, 3, 300).tolist() + [0], [2, 1] * 100):
        order = dc.suffix_array(np.array(text), 31).tolist()
        assert order == sorted(range(len(text)), key=lambda k: text[k:])
