import math
import random
import zlib

import numpy as np
import pytest

from sluicebox.llm import language_model as lm
from sluicebox.llm import toxicity as tx

WORDS = ["tree", "river", "stone", "cloud", "bird", "grass", "wind", "sand", "moss", "hill"]
BAD = ["grubword", "zorkish", "blatfer"]


def document(rng, n, bad):
    words = [rng.choice(WORDS) + rng.choice(["", "s", "ly", "en"]) for _ in range(n)]
    if bad:
        for k in rng.sample(range(n), max(1, n // 12)):
            words[k] = rng.choice(BAD)[:5] + rng.choice(["a", "o", "ix", "um", "ern"])
    return " ".join(words)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(0)
    return [(i, document(rng, rng.choice([15, 60, 200]), i % 3 == 0), int(i % 3 == 0)) for i in range(1, 400)]


@pytest.fixture(scope="module")
def fitted(spark, labelled):
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in labelled] + [(None, "x", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in labelled] + [(1, 1, None), (None, 1, 1), (99999, 0, 1)], "doc_id long, quality int, toxic int")
    return docs, tx.fit(docs, labels)


def test_held_out_accuracy(fitted, labelled):
    docs, net = fitted
    truth = {i: y for i, _, y in labelled}
    rows = [r for r in tx.score(docs, net).collect() if r.doc_id is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_edge_texts(spark, fitted, texts):
    _, net = fitted
    rng = random.Random(5)
    long = document(rng, 20_000, False)
    rows = [(1, None), (2, ""), (3, " \n "), (4, long), (5, long + " grubwern zorkiix"), (5, long + " grubwern zorkiix"), (None, "tree"), (6, "x" * 5000)]
    found = tx.score(texts(rows), net).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r.score for r in found}
    assert by_id[1] == by_id[2] == by_id[3] < 0.7
    # the last words of a long text count as the first ones do
    assert by_id[4] < by_id[5]
    assert tx.score(texts([]), net).collect() == []
    kept = tx.without_toxic(texts(rows), net)
    assert kept.columns == texts(rows).columns and kept.count() == sum(s.score < 0.7 for s in found)


def test_no_labels(spark, texts):
    docs = texts([(1, "a b"), (2, "c d")])
    net = tx.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert [r.score for r in tx.score(docs, net).collect()] == [0.5, 0.5]


def test_gradients():
    """Gradients of the gate inputs and of weights against differences."""
    rng = np.random.default_rng(0)
    net = tx.Network()
    for k, v in net.p.items():
        net.p[k] = v.astype(np.float64)
    gates = rng.standard_normal((6, 3, 6 * tx.STATE))
    mask = np.ones((6, 3))
    mask[4:, 1] = 0
    pull = rng.standard_normal(3)
    value = lambda: float(net.forward(gates, mask)[0] @ pull)
    _, kept = net.forward(gates, mask, keep=True)
    grad, d_gates = net.backward(pull, kept, mask)
    for name in ("U0", "U1", "A", "a", "v", "w", "c"):
        flat = net.p[name].ravel()
        for k in rng.choice(flat.size, min(4, flat.size), replace=False):
            old = flat[k]
            flat[k] = old + 1e-3
            up = value()
            flat[k] = old - 1e-3
            down = value()
            flat[k] = old
            assert np.isclose((up - down) / 2e-3, np.asarray(grad[name]).ravel()[k], rtol=0.05, atol=1e-3), name
    for at in ((0, 0, 3), (5, 2, 30), (3, 1, 12), (2, 0, 40)):
        old = gates[at]
        gates[at] = old + 1e-3
        up = value()
        gates[at] = old - 1e-3
        down = value()
        gates[at] = old
        assert np.isclose((up - down) / 2e-3, d_gates[at], rtol=0.05, atol=1e-3)


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 48, 49, 1000):
        starts = tx.window_starts(n)
        covered = {w for s in starts for w in range(s, min(n, s + tx.WINDOW))}
        assert covered == set(range(n)) and (n <= tx.WINDOW) == (len(starts) == 1)


PATTERN = "the old king sat on the high chair and the young queen sat on the low chair".split()


@pytest.fixture(scope="module")
def language(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(PATTERN * 4)) for i in range(300)] + [(1000 + i, f"rare{rng.random()} word{i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, lm.fit(docs, vocabulary=30, share=2, rounds=2)


def test_model_learns_order(language):
    _, model = language
    reader = lm.Reader(model.lexicon)
    rng = random.Random(1)
    text = " ".join(PATTERN * 4)
    shuffled = text.split()
    rng.shuffle(shuffled)
    good, bad = (x.sum() for x in model.log_probs(reader, [text, " ".join(shuffled)]))
    untrained = lm.Model(model.lexicon, lm.parameters(model.lexicon)).log_probs(lm.Reader(model.lexicon), [text])[0].sum()
    assert good > bad + 5 and good > untrained + 20


def test_scores_are_sums_of_masked_conditionals(language):
    """Word by word, without batches: the distribution of a place does not depend on its word."""
    _, model = language
    text = "the old king sat on rare0 chair"
    got = model.log_probs(lm.Reader(model.lexicon), [text, "x", text])
    words = lm.words_of(text)
    numbers = [model.lexicon.number.get(w, model.lexicon.other) for w in words]
    for k, word in enumerate(words):
        around = [numbers[k + d] if 0 <= k + d < len(words) else 0 for d in range(-lm.REACH, lm.REACH + 1) if d]
        expected = math.log(chances(model, around)[numbers[k]])
        if numbers[k] == model.lexicon.other:
            expected += model.lexicon.spelled([word])[0]
        assert np.isclose(got[0][k], expected, atol=1e-4) and got[0][k] == got[2][k]


def chances(model, around):
    """Probability of each number between the given ones, choice by choice."""
    lexicon = model.lexicon
    e, w1, b1, vectors, biases = (w.astype(np.float64) for w in model.weights)
    hidden = np.tanh(np.concatenate([e[a] for a in around]) @ w1 + b1)
    out = {}
    for number in range(1, lexicon.other + 1):
        at = slice(lexicon.start[number], lexicon.start[number] + lexicon.length[number])
        turns = zip(lexicon.node[at].tolist(), lexicon.turn[at].tolist())
        out[number] = math.prod(1 / (1 + math.exp(-turn * (hidden @ vectors[node] + biases[node]))) for node, turn in turns)
    return out


def test_chances_of_all_words_sum_to_one(language):
    model = language[1]
    for around in ([0, 0, 1, 2], [3, 1, model.lexicon.other, 5]):
        assert np.isclose(sum(chances(model, around).values()), 1)
    assert np.allclose(np.exp(model.lexicon.spelling).reshape(257, 257).sum(1), 1)
    # without neighbours' part the paths give the shares of the counts
    start = lm.Model(model.lexicon, lm.parameters(model.lexicon))
    the = model.lexicon.number[b"the"]
    assert np.isclose(chances(start, [0, 0, 0, 0])[the], 4 * 4 * 300 / (300 * 4 * len(PATTERN) + 100), rtol=1e-3)


def test_scores_do_not_depend_on_the_batch(language):
    _, model = language
    rng, found = random.Random(8), {}
    texts = [" ".join(rng.choices(PATTERN + ["new", "rare1"], k=rng.randint(1, 90))) for _ in range(30)]
    for _ in range(150):
        batch = rng.choices(texts, k=rng.randint(1, 20))
        for text, scores in zip(batch, model.log_probs(lm.Reader(model.lexicon), batch)):
            assert found.setdefault(text, scores.tobytes()) == scores.tobytes()


def test_paths_are_a_huffman_code():
    counts = np.array([40, 30, 20, 5, 3, 2])
    nodes, turns, starts, odds = lm.huffman_paths(counts)
    lengths = np.diff(starts)
    assert lengths.tolist() == [1, 2, 3, 4, 5, 5] and len(odds) == 5
    assert len({tuple(zip(nodes[a:b], turns[a:b])) for a, b in zip(starts, starts[1:])}) == 6
    assert lm.huffman_paths(np.array([7]))[2].tolist() == [0, 0]


def test_vocabulary_grows_with_the_words(spark):
    sizes = []
    for n in (500, 40_000):
        docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(k, n, 50))) for k in range(50)], "doc_id long, text string")
        sizes.append(lm.counted(lm.blocks_of(lm._rows(docs, "doc_id", "text"))).other - 1)
    assert sizes == [500, 4096]


def test_edge_documents(language, texts):
    _, model = language
    rows = [(1, None), (2, ""), (3, "The OLD king"), (3, "The OLD king"), (None, "x"), (4, "chair " * 30_000)]
    found = {r.doc_id: r for r in lm.score(texts(rows), model).collect()}
    assert (found[1].n_words, found[1].log_prob, found[1].mean_log_prob) == (0, 0.0, None) == (found[2].n_words, found[2].log_prob, found[2].mean_log_prob)
    assert found[3].n_words == 3 and found[4].n_words == 30_000 and found[None].log_prob < 0
    assert lm.score(texts([]), lm.fit(texts([]))).collect() == []


def test_rounds_train_on_every_position_once(spark, texts, monkeypatch):
    rows = [(i, " ".join(PATTERN[(i + k) % len(PATTERN)] for k in range(3 * i))) for i in range(40)]
    seen = []
    made = lm.written

    def kept(df, name, **options):
        out = made(df, name, **options)
        seen.extend(r["n"] for r in (out.collect() if name == "trained" else []))
        return out

    monkeypatch.setattr(lm, "written", kept)
    lm.fit(texts(rows))
    assert sum(seen) == sum(len(t.split()) for _, t in rows)
