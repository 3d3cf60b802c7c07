"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

A word enters as the embedding of its hash and the mean embedding of its character 3- and 4-grams.
Windows of words that overlap by half run through a gated recurrent unit in both directions;
attention pools the states of a window, and a linear layer scores it. A document's score is its
highest window, calibrated to a probability. The network is trained in numpy on the driver, from a
bounded sample of labelled documents; scoring is a map over documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sluicebox.llm.common import mixed

WINDOW = 32
STRIDE = 16
WORD_BUCKETS, GRAM_BUCKETS = 1 << 14, 1 << 14
WORD_SIZE, GRAM_SIZE, STATE = 8, 8, 8
GRAMS = (3, 4)
# bounds of the training sample: documents of each label, windows of a document
SAMPLE_DOCS = 1500
SAMPLE_WINDOWS = 12
EPOCHS = 8
BATCH_DOCS = 32
WORD_SHOWN = 0.5
DECAY = 0.01
BATCH_WINDOWS = 2048
KNOWN_WORDS = 150_000


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words between ASCII white space, in UTF-8."""
    return (text or "").lower().encode().split()


def features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its bucket; of all words their n-gram buckets and where each word's begin."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(data))
    grams, owners = [], []
    owner = np.repeat(np.arange(len(words)), sizes)
    for n in GRAMS:
        rolled = np.zeros(len(data), np.uint64)
        for k in range(n):
            rolled = rolled * np.uint64(0x100000001B3)
            rolled[: len(data) - k] += data[k:]
        whole = left >= n
        grams.append(mixed(rolled[whole], n) % np.uint64(GRAM_BUCKETS))
        owners.append(owner[whole])
    gram, by = np.concatenate(grams).astype(np.int64), np.concatenate(owners)
    order = np.argsort(by, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(by, minlength=len(words)))[:-1]])
    place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
    bucket = np.add.reduceat(mixed(data * np.uint64(1 << 20) + place.astype(np.uint64), 9), ends - sizes)
    return (bucket % np.uint64(WORD_BUCKETS)).astype(np.int64), gram[order], starts.astype(np.int64)


def window_starts(n: int) -> np.ndarray:
    """First words of overlapping windows that cover `n` words; one window for no words."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and their gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = WORD_SIZE + GRAM_SIZE, STATE
        draw = lambda *shape, scale=0.3: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "word": draw(WORD_BUCKETS, WORD_SIZE, scale=0.1), "gram": draw(GRAM_BUCKETS, GRAM_SIZE, scale=0.1),
            "W0": draw(d, 3 * h), "U0": draw(h, 3 * h), "b0": np.zeros(3 * h, np.float32),
            "W1": draw(d, 3 * h), "U1": draw(h, 3 * h), "b1": np.zeros(3 * h, np.float32),
            "A": draw(2 * h, h), "a": np.zeros(h, np.float32), "v": draw(h),
            "w": draw(2 * h), "c": np.zeros(1, np.float32),
        }
        self.slope, self.shift = np.float32(1), np.float32(0)

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        bucket, gram, starts = features(words)
        counts = np.diff(starts, append=len(gram))
        means = np.add.reduceat(self.p["gram"][gram], starts) / counts[:, None]
        return np.concatenate([self.p["word"][bucket], means], axis=1), (bucket, gram, counts)

    def projected(self, words: list[bytes]) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        x, _ = self.inputs(words)
        return np.concatenate([x @ self.p["W0"] + self.p["b0"], x @ self.p["W1"] + self.p["b1"]], axis=1).astype(np.float32)

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows from their gate inputs (step, window, both directions) and mask."""
        steps, n, h = gates.shape[0], gates.shape[1], STATE
        states = np.zeros((steps, n, 2 * h), np.float32)
        tapes = []
        for side in (0, 1):
            u, state, tape = self.p[f"U{side}"], np.zeros((n, h), np.float32), []
            for t in range(steps) if side == 0 else reversed(range(steps)):
                g = gates[t, :, 3 * h * side : 3 * h * (side + 1)]
                q = state @ u
                zr = _sigmoid(g[:, : 2 * h] + q[:, : 2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(g[:, 2 * h :] + r * q[:, 2 * h :])
                new = (state + z * (c - state)) * mask[t][:, None]
                if keep:
                    tape.append((t, state, z, r, c, q[:, 2 * h :]))
                state = new
                states[t, :, h * side : h * (side + 1)] = new
            tapes.append(tape)
        hidden = np.tanh(states @ self.p["A"] + self.p["a"])
        score = np.where(mask > 0, hidden @ self.p["v"], np.float32(-1e9))
        weight = np.exp(score - score.max(0)) * mask
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tnd->nd", weight, states)
        logits = pooled @ self.p["w"] + self.p["c"]
        return logits, (states, hidden, weight, pooled, tapes)

    def backward(self, d_logits: np.ndarray, kept, mask: np.ndarray):
        """Gradients of the parameters and of the gate inputs."""
        states, hidden, weight, pooled, tapes = kept
        h, grad = STATE, {}
        grad["w"], grad["c"] = pooled.T @ d_logits, d_logits.sum(keepdims=True)
        d_pooled = d_logits[:, None] * self.p["w"]
        d_weight = np.einsum("nd,tnd->tn", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        grad["v"] = np.einsum("tn,tnh->h", d_score, hidden)
        d_hidden = d_score[:, :, None] * self.p["v"] * (1 - hidden**2)
        grad["A"] = np.einsum("tnd,tnh->dh", states, d_hidden)
        grad["a"] = d_hidden.sum((0, 1))
        d_states = weight[:, :, None] * d_pooled + d_hidden @ self.p["A"].T
        d_gates = np.zeros((*mask.shape, 6 * h), np.float32)
        for side in (0, 1):
            u = self.p[f"U{side}"]
            d_u, carried = np.zeros_like(u), np.zeros((mask.shape[1], h), np.float32)
            for t, before, z, r, c, q in reversed(tapes[side]):
                d_new = (d_states[t, :, h * side : h * (side + 1)] + carried) * mask[t][:, None]
                d_c = d_new * z * (1 - c**2)
                d_z = d_new * (c - before) * z * (1 - z)
                d_r = d_c * q * r * (1 - r)
                d_q = np.concatenate([d_z, d_r, d_c * r], axis=1)
                d_gates[t, :, 3 * h * side : 3 * h * (side + 1)] = np.concatenate([d_z, d_r, d_c], axis=1)
                d_u += before.T @ d_q
                carried = d_new * (1 - z) + d_q @ u.T
            grad[f"U{side}"] = d_u
        return grad, d_gates


def _window_words(docs: list[list[bytes]], words: dict[bytes, int]) -> list[np.ndarray]:
    """Word numbers of each document; 0 is the padding."""
    return [np.fromiter((words.setdefault(w, len(words) + 1) for w in d), np.int64, len(d)) for d in docs]


def train(samples: list[tuple[list[list[bytes]], int]], seed: int = 7, epochs: int = EPOCHS) -> Network:
    """Fit to documents given as windows of words and a label. A document's logit is the log of the
    summed exponentials of its windows', so the label need not hold in every window."""
    net, rng = Network(seed), np.random.default_rng(seed)
    labels = np.array([y for _, y in samples])
    if not len(samples) or labels.min() == labels.max():
        # nothing to tell apart: the score is the smoothed share of the label
        share = (labels.sum() + 1) / (len(labels) + 2)
        net.slope, net.shift = np.float32(0), np.float32(np.log(share / (1 - share)))
        return net
    numbers: dict[bytes, int] = {}
    docs = [_window_words(windows, numbers) for windows, _ in samples]
    listed = list(numbers)
    bucket, gram, starts = features(listed)
    counts = np.diff(starts, append=len(gram))
    first, second = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}
    step, d, h = 0, WORD_SIZE + GRAM_SIZE, STATE
    weights = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH_DOCS):
            chosen = order[at : at + BATCH_DOCS]
            windows = [w for k in chosen for w in docs[k]]
            owner = np.repeat(np.arange(len(chosen)), [len(docs[k]) for k in chosen])
            ids = np.zeros((WINDOW, len(windows)), np.int64)
            for n, w in enumerate(windows):
                ids[: len(w), n] = w
            mask = (ids > 0).astype(np.float32)
            used, place = np.unique(ids[ids > 0] - 1, return_inverse=True)
            spans = [np.arange(starts[u], starts[u] + counts[u]) for u in used]
            flat = gram[np.concatenate(spans)] if spans else np.zeros(0, np.int64)
            begins = np.concatenate([[0], np.cumsum(counts[used])[:-1]]).astype(np.int64)
            # a word's own embedding is left out at random, so that its characters have to tell
            shown = (rng.random(len(used)) < WORD_SHOWN)[:, None]
            x = np.concatenate([
                net.p["word"][bucket[used]] * shown, np.add.reduceat(net.p["gram"][flat], begins) / counts[used][:, None],
            ], axis=1).astype(np.float32)
            gates = np.zeros((WINDOW, len(windows), 6 * h), np.float32)
            by_word = np.concatenate([x @ net.p["W0"] + net.p["b0"], x @ net.p["W1"] + net.p["b1"]], axis=1)
            gates[ids > 0] = by_word[place]
            logits, kept = net.forward(gates, mask, keep=True)
            # per document: log-sum-exp over its windows
            edges = np.flatnonzero(np.diff(owner, prepend=-1))
            top = np.maximum.reduceat(logits, edges)[owner]
            part = np.exp(logits - top)
            total = np.add.reduceat(part, edges)
            doc_logit = np.log(total) + np.maximum.reduceat(logits, edges)
            error = (_sigmoid(doc_logit) - labels[chosen]) * weights[chosen] / len(chosen)
            d_logits = (error[owner] * part / total[owner]).astype(np.float32)
            grad, d_gates = net.backward(d_logits, kept, mask)
            flat_gates = d_gates[ids > 0]
            by_place = np.argsort(place, kind="stable")
            summed = np.add.reduceat(flat_gates[by_place], np.concatenate([[0], np.cumsum(np.bincount(place))[:-1]]))
            d_x = np.zeros((len(used), d), np.float32)
            for side in (0, 1):
                part_gates = summed[:, 3 * h * side : 3 * h * (side + 1)]
                grad[f"W{side}"], grad[f"b{side}"] = x.T @ part_gates, part_gates.sum(0)
                d_x += part_gates @ net.p[f"W{side}"].T
            d_x[:, :WORD_SIZE] *= shown
            grad["word"] = np.stack([np.bincount(bucket[used], d_x[:, k], WORD_BUCKETS) for k in range(WORD_SIZE)], axis=1)
            spread_x = np.repeat(d_x[:, WORD_SIZE:] / counts[used][:, None], counts[used], axis=0)
            grad["gram"] = np.stack([np.bincount(flat, spread_x[:, k], GRAM_BUCKETS) for k in range(GRAM_SIZE)], axis=1)
            step += 1
            rate = 0.01 * min(1.0, 2 * (1 - epoch / epochs))
            for k, g in grad.items():
                g = g.astype(np.float32)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                net.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-7)
                if g.ndim > 1:
                    net.p[k] *= 1 - rate * DECAY
    _calibrate(net, [w for w, _ in samples], labels)
    return net


def _calibrate(net: Network, docs: list[list[list[bytes]]], labels: np.ndarray) -> None:
    """Logistic fit of the label on the highest window, towards the middle of the two classes."""
    scorer = Scorer(net)
    logits = np.array([scorer.windows(windows).max() for windows in docs])
    slope, shift = 1.0, 0.0
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    # labels a little inside of 0 and 1 keep the fit finite where the classes are apart
    target = np.where(labels == 1, 0.98, 0.02)
    for _ in range(50):
        p = _sigmoid(slope * logits + shift)
        g, w = weight * (p - target), weight * p * (1 - p) + 1e-6
        hess = np.array([[(w * logits * logits).sum(), (w * logits).sum()], [(w * logits).sum(), w.sum()]])
        move = np.linalg.solve(hess + np.eye(2) * 1e-3, [(g * logits).sum(), g.sum()])
        slope, shift = slope - np.clip(move[0], -1, 1), shift - np.clip(move[1], -1, 1)
    net.slope, net.shift = np.float32(max(slope, 1e-3)), np.float32(shift)


class Scorer:
    """Scores texts; remembers the projections of words it has seen while they fit."""

    def __init__(self, net: Network):
        self.net, self.size = net, 6 * STATE
        self._clear()

    def _clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.table = np.zeros((1, self.size), np.float32)
        self.filled = 1

    def _numbers(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.words) > KNOWN_WORDS:
            self._clear()
        known = len(self.words)
        out = _window_words(docs, self.words)
        new = list(self.words)[known:] if len(self.words) > known else []
        if new:
            rows = np.concatenate([self.net.projected(new[k : k + 20_000]) for k in range(0, len(new), 20_000)])
            need = self.filled + len(new)
            if need > len(self.table):
                grown = np.zeros((max(need, 2 * len(self.table)), self.size), np.float32)
                grown[: self.filled] = self.table[: self.filled]
                self.table = grown
            self.table[self.filled : need] = rows
            self.filled = need
        return out

    def _logits(self, ids: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(ids), BATCH_WINDOWS):
            part = np.ascontiguousarray(ids[k : k + BATCH_WINDOWS].T)
            mask = (part > 0).astype(np.float32)
            out.append(self.net.forward(self.table[part], mask)[0])
        return np.concatenate(out)

    def windows(self, windows: list[list[bytes]]) -> np.ndarray:
        ids = np.zeros((len(windows), WINDOW), np.int64)
        for k, w in enumerate(self._numbers(windows)):
            ids[k, : len(w)] = w
        return self._logits(ids)

    def texts(self, texts: list[str | None]) -> np.ndarray:
        """Probability of each text, from all of its windows."""
        numbers = self._numbers([words_of(t) for t in texts])
        firsts = [window_starts(len(n)) for n in numbers]
        sizes = np.array([len(f) for f in firsts])
        joined = np.concatenate([*numbers, np.zeros(WINDOW, np.int64)])
        offsets = np.concatenate([[0], np.cumsum([len(n) for n in numbers])])
        begin = np.concatenate([f + o for f, o in zip(firsts, offsets)])
        end = np.repeat(offsets[1:], sizes)
        at = begin[:, None] + np.arange(WINDOW)
        ids = np.where(at < end[:, None], joined[np.minimum(at, len(joined) - 1)], 0)
        top = np.maximum.reduceat(self._logits(ids), np.cumsum(sizes) - sizes)
        return _sigmoid(self.net.slope * top.astype(np.float64) + self.net.shift)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's label is never learnt from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1


def _sampled_windows(most: int):
    def sample(batches):
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = words_of(text)
                firsts = window_starts(len(words))
                # evenly over the whole text
                chosen = firsts[np.unique(np.linspace(0, len(firsts) - 1, min(most, len(firsts))).round().astype(int))]
                rows.append((int(toxic), [b"\n".join(words[k : k + WINDOW]) for k in chosen]))
            yield pd.DataFrame(rows, columns=["toxic", "windows"])

    return sample


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS,
) -> Network:
    """Train on at most `sample_docs` documents of each label, taken by the hash of their ids, and at
    most `sample_windows` windows of each. Held-out documents are never among them; labels that are
    null or belong to no document teach nothing."""
    known = (
        labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # the broadcast side has at most 2 * sample_docs rows of two numbers; an id with several rows gives one
    joined = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max(F.struct("text", "toxic")).alias("r"))
    found = joined.select("doc_id", "r.*").mapInPandas(_with_ids(sample_windows), "doc_id bigint, toxic int, windows array<binary>")
    samples = sorted((r["doc_id"], [bytes(w).split(b"\n") if w else [] for w in r["windows"]], r["toxic"]) for r in found.collect())
    return train([(windows, toxic) for _, windows, toxic in samples])


def _with_ids(most: int):
    sample = _sampled_windows(most)

    def run(batches) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for out in sample([batch]):
                yield out.assign(doc_id=batch["doc_id"].to_numpy())

    return run


def _parts(scorer: Scorer, texts: list[str | None]) -> np.ndarray:
    """Scores in parts of about a million characters, so that a batch of long texts stays small."""
    sizes = np.cumsum([len(t or "") for t in texts])
    cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(sizes // 1_000_000, prepend=0)) + 1, [len(texts)]]))
    scores = [scorer.texts(texts[a:b]) for a, b in zip(cuts, cuts[1:])]
    return np.concatenate(scores) if scores else np.zeros(0)


def _scored(shared):
    def score(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"].to_numpy(object)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": _parts(scorer, texts)})

    return score


def _kept(shared, text_col: str, threshold: float):
    def keep(batches):
        import pyarrow as pa

        scorer = Scorer(shared.value)
        for batch in batches:
            scores = _parts(scorer, batch.column(text_col).to_pylist())
            yield batch.filter(pa.array(scores < threshold))

    return keep


def without_toxic(docs: DataFrame, net: Network, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Rows of `docs`, all columns as they are, whose texts score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return docs.mapInArrow(_kept(shared, text_col, threshold), docs.schema)


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """`doc_id, held_out, score, predicted` for each row of `docs`; only the text enters the score.

    Defined results: null and empty texts are one window of padding and get its score; a null id
    stays null and counts as not held out; repeated rows get equal scores; an empty table gives no
    rows; without labels of both kinds every score is the smoothed share of the label; other columns
    are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    scored = rows.mapInPandas(_scored(shared), "doc_id bigint, score double")
    return scored.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
