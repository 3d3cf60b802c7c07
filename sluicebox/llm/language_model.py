"""Masked pseudo-likelihood of documents.

A word is predicted from the words on both sides of it, never from itself: the embeddings of its
neighbours pass a hidden layer, and the word is reached by a path of binary choices, each of which the
hidden layer makes by a vector of its own. The paths are those of a Huffman code over the counts of
the whole corpus, so every word of the vocabulary has its own path and a frequent word a short one.
Words outside the vocabulary end one path, behind which they are spelled by byte pairs, again with
counts of the whole corpus. A document's score is the sum of the conditional log-probabilities of its
words.

Counts cover every word of every document, and the vocabulary grows with the number of distinct words.
The network is trained in numpy where the documents are: each round's tasks train on a share of the
positions of all their documents that no other round has, until each position was a target, and the
tasks' parameters are averaged, weighted by positions, over a tree.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sluicebox.llm.common import mixed, written

# the vocabulary is the power of two from this times the root of the number of distinct words
VOCABULARY_PER_ROOT = 16
LEAST_VOCABULARY = 1024
REACH = 2
EMBEDDING, HIDDEN = 4, 8
SHARE = 2
ROUNDS = 2
BATCH = 8192
RATE = 0.03
COUNTED_WORDS = 400_000
KNOWN_WORDS = 400_000
BLOCK_WORDS = 500_000
# words scored at once
SCORED = 16_384
# parameters averaged at once
BRANCHES = 16
END = 256


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words between ASCII white space, in UTF-8."""
    return (text or "").lower().encode().split()


class Numbers(dict):
    """Words in the order in which they were first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(batches):
    """Documents in blocks of about `BLOCK_WORDS` words: the block's distinct words in the order in which
    they came and how often, and its documents as numbers of those."""
    known, ids, sizes, numbers, held = Numbers(), [], [], [], 0

    def block() -> pd.DataFrame:
        joined = np.concatenate(numbers)
        return pd.DataFrame({
            "ids": [ids], "sizes": [np.array(sizes, np.int64).tobytes()], "numbers": [joined.tobytes()],
            "words": [b"\n".join(known)], "counts": [np.bincount(joined, minlength=len(known)).tobytes()],
        })

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].astype("Int64").to_numpy(object, na_value=None), batch["text"]):
            words = words_of(text)
            ids.append(doc_id)
            sizes.append(len(words))
            numbers.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
            held += len(words)
            if held >= BLOCK_WORDS or len(ids) >= BLOCK_WORDS:
                yield block()
                known, ids, sizes, numbers, held = Numbers(), [], [], [], 0
    if ids:
        yield block()


def _counted(batches):
    counts: Counter = Counter()

    def frame():
        return pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    for batch in batches:
        for words, found in zip(batch["words"], batch["counts"]):
            for word, n in zip(bytes(words).split(b"\n"), np.frombuffer(found, np.int64).tolist()):
                counts[word] += n
            if len(counts) > COUNTED_WORDS:
                yield frame()
                counts.clear()
    if counts:
        yield frame()


def byte_pairs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a 257 x 257 table for each byte after the one before it, ends included, and where each
    word's cells begin."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    after = np.full(int(sizes.sum()), END, np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    last = np.zeros(len(after), bool)
    last[starts + sizes - 1] = True
    after[~last] = data
    before = np.concatenate([[END], after[:-1]])
    return before * 257 + after, starts


def _paired(batches):
    for batch in batches:
        for first in range(0, len(batch), 50_000):
            part = batch.iloc[first : first + 50_000]
            words = [bytes(w) for w in part["word"]]
            cells, _ = byte_pairs(words)
            found = np.bincount(cells, np.repeat(part["n"].to_numpy(np.float64), [len(w) + 1 for w in words]), 257 * 257)
            at = np.flatnonzero(found)
            yield pd.DataFrame({"cell": at, "n": found[at].astype(np.int64)})


def huffman_paths(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inner nodes and turns (-1, 1) on the way to each symbol, flat, where each symbol's begin, and the
    log odds of the turns of each node. Symbols come with descending counts; a single one has no path."""
    n = len(counts)
    weight = np.concatenate([counts[::-1].astype(np.float64), np.zeros(max(0, n - 1))])
    parent, turn = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int8)
    odds = np.zeros(max(1, n - 1))
    leaf, inner = 0, n
    for made in range(n, 2 * n - 1):
        # the two lightest of what has no parent; leaves and inner nodes are each in order
        two = []
        for _ in range(2):
            if leaf < n and (inner >= made or weight[leaf] <= weight[inner]):
                two.append(leaf)
                leaf += 1
            else:
                two.append(inner)
                inner += 1
        left, right = two
        weight[made] = weight[left] + weight[right]
        parent[left] = parent[right] = made
        turn[left], turn[right] = -1, 1
        odds[made - n] = math.log(weight[right] / weight[left])
    nodes, turns, starts = [], [], np.zeros(n, np.int64)
    at = 0
    for symbol in range(n):
        starts[symbol], k = at, n - 1 - symbol
        while k != 2 * n - 2:
            nodes.append(parent[k] - n)
            turns.append(turn[k])
            k = parent[k]
            at += 1
    return np.array(nodes, np.int64), np.array(turns, np.float64), np.append(starts, at), odds


class Lexicon:
    """Numbers and paths of words. 0 is the space outside a document, which is never predicted; the last
    number is any word outside the vocabulary."""

    def __init__(self, words: list[tuple[bytes, int]], pairs: dict[int, int], n_outside: int):
        self.number = {w: k + 1 for k, (w, _) in enumerate(words)}
        self.other = len(words) + 1
        counts = np.array([*(n for _, n in words), max(1, n_outside)], np.float64)
        by_count = np.argsort(-counts, kind="stable")
        nodes, turns, starts, self.odds = huffman_paths(counts[by_count])
        # paths by number, of which 0 has none
        place = np.empty(len(counts), np.int64)
        place[by_count] = np.arange(len(counts))
        self.length = np.concatenate([[0], np.diff(starts)[place]])
        self.start = np.concatenate([[0], starts[:-1][place]])
        self.node = nodes.astype(np.uint16 if len(counts) < 1 << 16 else np.int32)
        self.turn = turns.astype(np.float32)
        table = np.full(257 * 257, 0.5)
        for cell, n in pairs.items():
            table[cell] += n
        table = table.reshape(257, 257)
        self.spelling = np.log(table / table.sum(1, keepdims=True)).ravel()

    def spelled(self, words: list[bytes]) -> np.ndarray:
        cells, starts = byte_pairs(words)
        return np.add.reduceat(self.spelling[cells], starts)

    def by_depth(self, numbers: np.ndarray):
        """Order of the numbers by falling length of their paths, and for each depth the nodes and turns
        that the paths have there, of as many of the first numbers as go so deep."""
        sizes = self.length[numbers]
        order = np.argsort(-sizes.astype(np.int16), kind="stable")
        start, deep = self.start[numbers[order]], np.cumsum(np.bincount(sizes)[::-1])[::-1]
        return order, ((self.node[at := start[:n] + d], self.turn[at]) for d, n in enumerate(deep[1:].tolist()))


class Reader:
    """Turns texts into word numbers and the log-probability that each word's number is spelled so."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known = Numbers()
        self.numbers, self.shares = [np.zeros(0, np.int64)], [np.zeros(0)]

    def read(self, texts) -> tuple[list[np.ndarray], list[np.ndarray]]:
        if len(self.known) > KNOWN_WORDS:
            self.known, self.numbers, self.shares = Numbers(), [np.zeros(0, np.int64)], [np.zeros(0)]
        seen = len(self.known)
        places = []
        for text in texts:
            words = words_of(text)
            places.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        new = list(self.known)[seen:] if len(self.known) > seen else []
        if new:
            numbers = np.array([self.lexicon.number.get(w, self.lexicon.other) for w in new], np.int64)
            shares = np.zeros(len(new))
            outside = np.flatnonzero(numbers == self.lexicon.other)
            if len(outside):
                shares[outside] = self.lexicon.spelled([new[k] for k in outside])
            self.numbers, self.shares = [np.concatenate([*self.numbers, numbers])], [np.concatenate([*self.shares, shares])]
        return [self.numbers[0][p] for p in places], [self.shares[0][p] for p in places]


def parameters(lexicon: Lexicon, seed: int = 11) -> list[np.ndarray]:
    """Embeddings, hidden layer, and the nodes' vectors and biases. The vectors start at zero and the
    biases at the odds of the counts, which is the distribution of words without any neighbours."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
    return [
        draw(lexicon.other + 1, EMBEDDING, scale=0.3), draw(2 * REACH * EMBEDDING, HIDDEN, scale=0.3), np.zeros(HIDDEN, np.float32),
        np.zeros((len(lexicon.odds), HIDDEN), np.float32), lexicon.odds.astype(np.float32),
    ]


def _shapes(lexicon: Lexicon) -> list[tuple[int, ...]]:
    n = len(lexicon.odds)
    return [(lexicon.other + 1, EMBEDDING), (2 * REACH * EMBEDDING, HIDDEN), (HIDDEN,), (n, HIDDEN), (n,)]


def flat(weights: list[np.ndarray]) -> bytes:
    return np.concatenate([w.ravel() for w in weights]).astype(np.float32).tobytes()


def unflat(data: bytes, lexicon: Lexicon) -> list[np.ndarray]:
    values, out, at = np.frombuffer(data, np.float32), [], 0
    for shape in _shapes(lexicon):
        n = int(np.prod(shape))
        out.append(values[at : at + n].reshape(shape).copy())
        at += n
    return out


def neighbours(docs: list[np.ndarray], chosen: np.ndarray | None = None) -> np.ndarray:
    """For every word of all documents, or the chosen ones, the numbers of the words around it, 0 outside
    its document."""
    gap = np.zeros(REACH, np.int64)
    padded = np.concatenate([gap, *(x for d in docs for x in (d, gap))])
    sizes = np.array([len(d) for d in docs], np.int64)
    at = np.arange(sizes.sum()) + np.repeat(np.arange(len(docs)) * REACH, sizes) + REACH
    at = at if chosen is None else at[chosen]
    around = [k for k in range(-REACH, REACH + 1) if k]
    return padded[at[:, None] + np.array(around)]


def _summed(at: np.ndarray, columns: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and the sums of their entries in each column; columns are contiguous rows here."""
    at = at.astype(np.intp)
    used = np.flatnonzero(np.bincount(at, minlength=size))
    return used, np.stack([np.bincount(at, c, size)[used] for c in columns], axis=1).astype(np.float32)


def train_on(lexicon: Lexicon, weights: list[np.ndarray], moments: list, around: np.ndarray, target: np.ndarray, step: int, rate: float) -> None:
    """One step of Adam on a batch of masked positions."""
    e, w1, b1, vectors, biases = weights
    order, levels = lexicon.by_depth(target)
    around = around[order]
    x = e[around].reshape(len(around), -1)
    # from here on a row for each hidden unit, so that sums run along the positions
    hidden = np.ascontiguousarray(np.tanh(x @ w1 + b1).T)
    by_unit, d_hidden = np.ascontiguousarray(vectors.T), np.zeros_like(hidden)
    met, errors, passed = [], [], []
    for nodes, turns in levels:
        n, towards = len(nodes), by_unit.take(nodes, axis=1)
        reached = hidden[:, :n]
        logits = (reached * towards).sum(0) + biases[nodes]
        error = -turns / (1 + np.exp(np.minimum(turns * logits, 30))) / np.float32(len(target))
        d_hidden[:, :n] += towards * error
        met.append(nodes)
        errors.append(error)
        passed.append(reached * error)
    if not met:
        return
    d_hidden = (d_hidden * (1 - hidden * hidden)).T
    used_nodes, d_vectors = _summed(np.concatenate(met), [*np.concatenate(passed, axis=1), np.concatenate(errors)], len(biases))
    d_x = np.ascontiguousarray((d_hidden @ w1.T).reshape(-1, EMBEDDING).T)
    used, d_rows = _summed(around.ravel(), d_x, len(e))
    grads = [(used, d_rows), (slice(None), x.T @ d_hidden), (slice(None), d_hidden.sum(0)),
             (used_nodes, d_vectors[:, :-1]), (used_nodes, d_vectors[:, -1])]
    for k, (rows, grad) in enumerate(grads):
        first, second = moments[k]
        m = first[rows] * 0.9 + 0.1 * grad
        v = second[rows] * 0.99 + 0.01 * grad * grad
        first[rows], second[rows] = m, v
        weights[k][rows] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


def batch_size(step: int) -> int:
    """Positions of a step: few at first, so that a task with little to read takes many steps too."""
    return min(BATCH, 32 << (step // 16))


def _read(shared):
    """Blocks in the lexicon's numbers, and of each document the log-probability of all its spellings."""

    def read(batches):
        lexicon = shared.value
        for batch in batches:
            for ids, sizes, numbers, words in zip(batch["ids"], batch["sizes"], batch["numbers"], batch["words"]):
                words = bytes(words).split(b"\n") if words else []
                number_of = np.array([lexicon.number.get(w, lexicon.other) for w in words], np.int32)
                share_of, outside = np.zeros(len(words)), np.flatnonzero(number_of == lexicon.other)
                if len(outside):
                    share_of[outside] = lexicon.spelled([words[k] for k in outside])
                numbers, n = np.frombuffer(numbers, np.int32), np.frombuffer(sizes, np.int64)
                spelled = np.bincount(np.repeat(np.arange(len(n)), n), share_of[numbers], len(n)) if len(numbers) else np.zeros(len(n))
                yield pd.DataFrame({
                    "ids": [list(ids)], "sizes": [sizes], "numbers": [number_of[numbers].tobytes() if len(numbers) else b""],
                    "spelled": [spelled.tobytes()],
                })

    return read


def _documents(batches):
    """Of parts of about half a million words: ids, numbers by document, and sums of spellings."""
    for batch in batches:
        for ids, sizes, numbers, spelled in zip(batch["ids"], batch["sizes"], batch["numbers"], batch["spelled"]):
            ends, numbers, spelled = np.cumsum(np.frombuffer(sizes, np.int64)), np.frombuffer(numbers, np.int32), np.frombuffer(spelled)
            cuts = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(ends // 500_000, prepend=0)) + 1, [len(ends)]]))
            for a, b in zip(cuts, cuts[1:]):
                yield ids[a:b], [numbers[i:j] for i, j in zip(np.concatenate([[0], ends])[a:b], ends[a:b])], spelled[a:b]


def _trained(shared, share: int, turn: int = 0):
    def train(batches):
        lexicon, data = shared.value
        weights = unflat(data, lexicon)
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        step, seen, held, wanted = 0, 0, [], []
        for found, numbers, _ in _documents(batches):
            sizes = np.array([len(n) for n in numbers])
            if not sizes.sum():
                continue
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            ids = np.array([0 if i is None else i for i in found], np.int64).view(np.uint64)
            chosen = np.flatnonzero(mixed(np.repeat(mixed(ids, 1), sizes) ^ place.astype(np.uint64), 2) % np.uint64(share) == turn % share)
            held.append(neighbours(numbers, chosen))
            wanted.append(np.concatenate(numbers)[chosen])
            if sum(map(len, wanted)) >= BATCH:
                around, target = np.concatenate(held), np.concatenate(wanted)
                k = 0
                while len(target) - k >= batch_size(step):
                    n, step = batch_size(step), step + 1
                    train_on(lexicon, weights, moments, around[k : k + n], target[k : k + n], step, RATE)
                    k += n
                seen += k
                held, wanted = [around[k:]], [target[k:]]
        if sum(map(len, wanted)):
            around, target = np.concatenate(held), np.concatenate(wanted)
            seen += len(target)
            while len(target):
                n, step = batch_size(step), step + 1
                train_on(lexicon, weights, moments, around[:n], target[:n], step, RATE)
                around, target = around[n:], target[n:]
        if seen:
            yield pd.DataFrame({"part": [uuid.uuid4().int >> 66], "n": [seen], "weights": [flat(weights)]})

    return train


def _averaged(rows: pd.DataFrame) -> pd.DataFrame:
    n = rows["n"].to_numpy(np.float64)
    total = sum(np.frombuffer(w, np.float32).astype(np.float64) * m for w, m in zip(rows["weights"], n))
    return pd.DataFrame({"part": [uuid.uuid4().int >> 66], "n": [int(n.sum())], "weights": [(total / n.sum()).astype(np.float32).tobytes()]})


def averaged(parts: DataFrame) -> bytes | None:
    """Mean of the tasks' parameters, weighted by their positions: about `BRANCHES` of them in a task, and
    again until one is left."""
    while (left := parts.count()) > 1:
        branch = F.lit(0) if left <= 2 * BRANCHES else F.pmod("part", F.lit(-(-left // BRANCHES)))
        parts = written(parts.groupBy(branch.alias("branch")).applyInPandas(_averaged, parts.schema), "averaged")
    mean = parts.first()
    return bytes(mean["weights"]) if mean else None


class Model:
    """Scores words; equal texts get equal scores wherever they stand, because every number that enters a
    word's score is found by sums of the same terms in the same order."""

    def __init__(self, lexicon: Lexicon, weights: list[np.ndarray]):
        self.lexicon, self.weights = lexicon, weights
        e, w1, self.b1, self.vectors, self.biases = weights
        # what a word adds to the hidden layer from each place around
        parts = [w1[k * EMBEDDING : (k + 1) * EMBEDDING].astype(np.float64) for k in range(2 * REACH)]
        # a row for each hidden unit, as of the nodes' vectors
        self.adds = [np.ascontiguousarray((e.astype(np.float64) @ w).T.astype(np.float32)) for w in parts]
        self.by_unit = np.ascontiguousarray(self.vectors.T)

    def of_numbers(self, numbers: list[np.ndarray]) -> np.ndarray:
        """Conditional log-probability of each number of all documents."""
        around, target = neighbours(numbers), np.concatenate(numbers)
        out = np.zeros(len(target))
        for k in range(0, len(target), SCORED):
            near, wanted = around[k : k + SCORED], target[k : k + SCORED]
            order, levels = self.lexicon.by_depth(wanted)
            near, hidden = near[order], self.b1[:, None]
            for place, adds in enumerate(self.adds):
                hidden = hidden + adds.take(near[:, place], axis=1)
            hidden = np.tanh(hidden)
            found, chance, depth = np.zeros(len(wanted)), np.ones(len(wanted)), 0
            for nodes, turns in levels:
                n, towards = len(nodes), self.by_unit.take(nodes, axis=1)
                logits = self.biases[nodes]
                for unit in range(HIDDEN):
                    logits = logits + hidden[unit, :n] * towards[unit]
                chance[:n] *= 1 / (1 + np.exp(np.minimum(-turns * logits, 30)))
                if n and (depth := depth + 1) % 16 == 0:
                    # a product of sixteen choices is far from the smallest number
                    found, chance = found + np.log(chance), np.ones(len(wanted))
            out[k + order] = found + np.log(chance)
        return out

    def log_probs(self, reader: Reader, texts) -> list[np.ndarray]:
        """Conditional log-probability of each word of each text."""
        numbers, shares = reader.read(texts)
        return np.split(self.of_numbers(numbers) + np.concatenate(shares), np.cumsum([len(n) for n in numbers])[:-1])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def blocks_of(rows: DataFrame) -> DataFrame:
    """Documents cut into words, once for the counts, all rounds and the scores; written."""
    return written(rows.mapInPandas(_blocks, "ids array<bigint>, sizes binary, numbers binary, words binary, counts binary"), "word-blocks")


def counted(blocks: DataFrame, vocabulary: int | None = None) -> Lexicon:
    """Lexicon of all words of the blocks. The driver holds the vocabulary, by default the power of two
    from 16 times the root of the number of distinct words, and the 257 x 257 table of byte pairs."""
    counts = written(
        blocks.select("words", "counts").where(F.octet_length("words") > 0).mapInPandas(_counted, "word binary, n bigint")
        .groupBy("word").agg(F.sum("n").alias("n")), "word-counts",
    )
    if vocabulary is None:
        wanted = max(LEAST_VOCABULARY, VOCABULARY_PER_ROOT * math.isqrt(counts.count()))
        vocabulary = 1 << (wanted - 1).bit_length()
    top = [(bytes(r["word"]), r["n"]) for r in counts.orderBy(F.col("n").desc(), "word").limit(vocabulary).collect()]
    last = top[-1][::-1] if top else (0, b"")
    outside = counts.where((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("word") > F.lit(bytearray(last[1])))))
    n_outside = outside.agg(F.sum("n")).first()[0] or 0
    pairs = outside.mapInPandas(_paired, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    return Lexicon(top, {r["cell"]: r["n"] for r in pairs.collect()}, n_outside)


def numbered(blocks: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Blocks in the lexicon's numbers, written."""
    shared = blocks.sparkSession.sparkContext.broadcast(lexicon)
    read = blocks.select("ids", "sizes", "numbers", "words").mapInPandas(_read(shared), "ids array<bigint>, sizes binary, numbers binary, spelled binary")
    return written(read, "word-numbers")


def trained(documents: DataFrame, lexicon: Lexicon, share: int = SHARE, rounds: int = ROUNDS) -> Model:
    """Train the network on one in `share` positions of every document in each round, others than in the
    rounds before; `share` rounds take every position once."""
    weights = flat(parameters(lexicon))
    for turn in range(rounds):
        shared = documents.sparkSession.sparkContext.broadcast((lexicon, weights))
        parts = documents.mapInPandas(_trained(shared, share, turn), "part bigint, n bigint, weights binary")
        weights = averaged(written(parts, "trained")) or weights
    return Model(lexicon, unflat(weights, lexicon))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int | None = None, share: int = SHARE, rounds: int = ROUNDS) -> Model:
    """Count all words of `docs` and train the network on all of their positions."""
    blocks = blocks_of(_rows(docs, id_col, text_col))
    lexicon = counted(blocks, vocabulary)
    return trained(numbered(blocks, lexicon), lexicon, share, rounds)


def _scored(shared):
    def score(batches):
        model = shared.value
        for ids, numbers, spelled in _documents(batches):
            sizes = [len(n) for n in numbers]
            sums = [x.sum() for x in np.split(model.of_numbers(numbers), np.cumsum(sizes)[:-1])]
            yield pd.DataFrame({"doc_id": pd.array(list(ids), "Int64"), "n_words": sizes, "log_prob": np.array(sums) + spelled})

    return score


def score_numbered(documents: DataFrame, model: Model) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(model)
    scored = documents.mapInPandas(_scored(shared), "doc_id bigint, n_words bigint, log_prob double")
    return scored.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, n_words, log_prob, mean_log_prob` for each row of `docs`.

    Defined results: null and empty texts have no words, a log-probability of 0 and no mean; a null id
    stays null; repeated rows get equal scores; an empty table gives no rows, and a model of an empty
    corpus spells every word evenly; other columns are not read.
    """
    return score_numbered(numbered(blocks_of(_rows(docs, id_col, text_col)), model.lexicon), model)


def fit_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int | None = None) -> DataFrame:
    """`score(docs, fit(docs))`, with the texts cut into words once."""
    blocks = blocks_of(_rows(docs, id_col, text_col))
    lexicon = counted(blocks, vocabulary)
    documents = numbered(blocks, lexicon)
    return score_numbered(documents, trained(documents, lexicon))
