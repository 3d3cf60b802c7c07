import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest

from sluicebox.llm import packing, token_counts
from sluicebox.llm.queries import vocabulary

ROWS = [
    (1, "Hello, world's  best\nline! 1234"), (2, ""), (3, None), (4, "<|endoftext|>a<|startoftext|> b"),
    (5, "ΑΣ Straße İstanbul J̌ é ñ 日本語 😀‍👩   x\x85y\x1cz"), (6, "word " * 5000), (6, "word " * 5000),
    (None, "no id"), (7, "a" * 3000), (8, "'S 'll 't !'s ''"), (9, "the the the"),
]


@pytest.fixture(scope="module")
def libraries():
    from tokenizers import Tokenizer

    return {n: Tokenizer.from_file(vocabulary(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


def test_counts_equal_the_library(texts, libraries):
    tokenizer = libraries["word_bpe_49k.json"]
    found = token_counts.count_tokens(texts(ROWS), vocabulary("word_bpe_49k.json"), limit=100).collect()
    count = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    expected = Counter((i, len((t or "").encode()), count(t), count(t) > 100) for i, t in ROWS)
    assert Counter(tuple(r) for r in found) == expected


def test_every_character_counts_as_in_the_library(texts, libraries):
    tokenizer = libraries["word_bpe_49k.json"]
    characters = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    rows = [(k, "".join(f"a{c}b {c}{c}" for c in characters[k : k + 64])) for k in range(0, len(characters), 64)]
    found = token_counts.count_tokens(texts(rows), vocabulary("word_bpe_49k.json")).collect()
    expected = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in rows}
    wrong = [hex(r["doc_id"]) for r in found if r["n_tokens"] != expected[r["doc_id"]]]
    assert len(found) == len(rows) and len(wrong) <= 0.01 * len(rows), wrong


def test_no_documents(texts):
    assert token_counts.count_tokens(texts([]), vocabulary("word_bpe_49k.json")).collect() == []
    assert packing.pack(texts([]), vocabulary("byte_bpe_50k.json")).collect() == []


def test_encoder_equals_the_library(libraries):
    encoding = packing.byte_level_encoding(vocabulary("byte_bpe_50k.json"))
    tokenizer = libraries["byte_bpe_50k.json"]
    for text in [t or "" for _, t in ROWS] + ["  two  spaces\t\n\n x ", "<|endoftext|><|endoftext|>", " 　a1b2½"]:
        assert encoding.encode(text, allowed_special="all") == tokenizer.encode(text, add_special_tokens=False).ids


def one_by_one(lengths, capacity):
    """Best-fit decreasing, document by document."""
    remaining, bins = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect_left(remaining, length)
        if k == len(remaining):
            bins += 1
            insort(remaining, capacity - length)
        else:
            insort(remaining, remaining.pop(k) - length)
    return bins, sorted(remaining)


@pytest.mark.parametrize("seed", range(8))
def test_plan_on_counts_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64, 100])
    lengths = [min(capacity, 1 + int(rng.expovariate(6 / capacity))) for _ in range(rng.choice([1, 30, 700]))]
    runs = packing.plan(Counter(lengths), capacity)
    place = packing._placed(runs)
    import pandas as pd

    ranks, rows = Counter(), []
    for length in lengths:
        rows.append((length, ranks[length]))
        ranks[length] += 1
    placed = next(place([pd.DataFrame(rows, columns=["length", "rank"])]))
    used = defaultdict(list)
    for length, bin_, offset in placed.itertuples(index=False):
        used[bin_].append((offset, length))
    for spans in used.values():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip([(0, 0), *spans], [*spans, (sum(n for _, n in spans), 0)]))
    left = sorted(capacity - sum(n for _, n in spans) for spans in used.values())
    assert (len(used), left) == one_by_one(lengths, capacity)


def test_packing(texts, libraries):
    capacity = 64
    tokenizer = libraries["byte_bpe_50k.json"]
    found = packing.pack(texts(ROWS), vocabulary("byte_bpe_50k.json"), capacity=capacity).toPandas()
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
    expected = Counter()
    for i, t in ROWS:
        tokens = ids(t)
        first = len(tokens) % capacity or capacity
        for piece, a in enumerate([0, *range(first, len(tokens), capacity)]):
            b = first if piece == 0 else a + capacity
            expected[(i, piece, a, b - a, zlib.crc32(np.array(tokens[a:b], "<u4").tobytes()))] += 1
    rows = [(None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found.itertuples()]
    assert Counter(rows) == expected
    ordered = found.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()
    assert ordered.groupby("sequence_id")["length"].sum().max() <= capacity
    assert found["sequence_id"].nunique() == one_by_one(found["length"].tolist(), capacity)[0]
