"""Language of documents, found in two steps: its family first, then the language within the family.

A text becomes the counts of its letter n-grams, hashed; the square roots of their shares are a vector of
length one. Logistic regression over all families names the family. Within it a linear support vector
machine for each pair of languages votes for one of the two; most votes win. Both are trained in numpy on
the driver from a bounded sample of labelled documents, each read whole; prediction is a map over documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

UNDETERMINED = "und"
LONGEST_GRAM = 4
BITS = 14
BUCKETS = 1 << BITS
# bound of the training sample: documents of each language
SAMPLE_DOCS = 500
EPOCHS = 12
BATCH = 32
PIECE = 1 << 20

# fixed values: families of languages by their ISO 639-1 codes; all others are one more family
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "austronesian": "id jv ms tl",
    "sinitic": "yue zh",
}
OTHER_FAMILY = "other"


def family_of(language: str, families: Mapping[str, str] = FAMILIES) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in families.items() if code in codes.split()), OTHER_FAMILY)


class Letters:
    """Which code points are letters, looked up once a process."""

    _table: np.ndarray | None = None

    @classmethod
    def table(cls) -> np.ndarray:
        if cls._table is None:
            cls._table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls._table


def cleaned(text: str | None) -> np.ndarray:
    """Lower-case code points of the letters, with one space for any run of others, at both ends too;
    empty where there is no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = Letters.table()[points]
    if not letter.any():
        return np.zeros(0, np.uint32)
    spaced = np.concatenate([[32], np.where(letter, points, 32), [32]]).astype(np.uint32)
    return spaced[(spaced != 32) | np.concatenate([[True], spaced[:-1] != 32])]


def gram_counts(points: np.ndarray) -> np.ndarray:
    """Counts by bucket of all n-grams up to the longest; a long text goes a piece at a time."""
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(points), PIECE):
        # a piece sees the points after it, so n-grams across its end count once, where they begin
        piece = points[start : start + PIECE + LONGEST_GRAM - 1]
        own, rolled = min(PIECE, len(points) - start), np.zeros(len(piece), np.uint32)
        for n in range(1, LONGEST_GRAM + 1):
            if len(piece) < n:
                break
            rolled = rolled[: len(piece) - n + 1] * np.uint32(0x01000193) + piece[n - 1 :]
            hashed = (rolled[:own] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            counts += np.bincount((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS), minlength=BUCKETS)
    return counts


def vector(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)


class Sample:
    """Sparse vectors of labelled documents."""

    def __init__(self, rows: Sequence[tuple[str, np.ndarray, np.ndarray]]):
        self.languages = [language for language, _, _ in rows]
        self.rows = [(at, values) for _, at, values in rows]

    def dense(self, chosen: Sequence[int]) -> np.ndarray:
        out = np.zeros((len(chosen), BUCKETS), np.float32)
        for k, i in enumerate(chosen):
            at, values = self.rows[i]
            out[k, at] = values
        return out

    def batches(self, members: np.ndarray, classes: np.ndarray, epochs: int, rng) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Progress, vectors and classes; every class is drawn as often as the largest."""
        groups = [members[classes == c] for c in range(classes.max() + 1)]
        most = max(map(len, groups))
        for epoch in range(epochs):
            drawn = np.concatenate([rng.permutation(np.resize(rng.permutation(g), most)) for g in groups])
            labels = np.repeat(np.arange(len(groups)), most)
            mixed_up = rng.permutation(len(drawn))
            for k in range(0, len(drawn), BATCH):
                part = mixed_up[k : k + BATCH]
                yield (epoch + k / len(drawn)) / epochs, self.dense(drawn[part]), labels[part]


def train_softmax(sample: Sample, members: np.ndarray, classes: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of a logistic regression over the classes."""
    n = classes.max() + 1
    w, b = np.zeros((n, BUCKETS), np.float32), np.zeros(n, np.float32)
    for done, x, y in sample.batches(members, classes, EPOCHS, rng):
        scores = x @ w.T + b
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        rate = 20.0 * (1 - done) / len(y)
        w -= rate * (p.T @ x)
        b -= 0.01 * rate * p.sum(0)
    return w, b


def train_svm(sample: Sample, members: np.ndarray, sides: np.ndarray, rng, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Hinge loss with a squared penalty, by steps that shrink with their number; sides are 0 and 1.

    The margin of the given documents sets the scale of the score, so that the median of those on the
    right side counts as one.
    """
    w, mean, step = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float64), 0
    for _, x, y in sample.batches(members, sides, EPOCHS, rng):
        step += 1
        sign = np.where(y == 1, 1.0, -1.0).astype(np.float32)
        short = sign * (x @ w) < 1
        rate = 1.0 / (penalty * (step + 100.0))
        w *= np.float32(1 - rate * penalty)
        w += np.float32(rate / len(y)) * ((sign * short) @ x)
        # no solution is longer than this
        w *= np.float32(min(1.0, 1 / (np.sqrt(penalty) * max(1e-9, float(np.linalg.norm(w))))))
        mean += (w - mean) / step
    signs = np.where(sides == 1, 1.0, -1.0)
    margins = np.concatenate([sample.dense(members[k : k + 256]) @ mean for k in range(0, len(members), 256)]) * signs
    right = margins[margins > 0]
    return mean.astype(np.float32), float(np.median(right)) if len(right) else 1.0


@dataclass
class Model:
    """Families, their languages, and the linear functions that tell them apart, one row each."""

    families: list[list[str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, BUCKETS), np.float32))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    # (family, first language, second language, row, scale)
    pairs: list[tuple[int, int, int, int, float]] = field(default_factory=list)

    def predict(self, text: str | None) -> tuple[str, float]:
        points = cleaned(text)
        if not len(points) or not self.families:
            return UNDETERMINED, 0.0
        values = self.weights @ vector(gram_counts(points)) + self.biases
        share = np.exp(values[: len(self.families)] - values[: len(self.families)].max())
        share /= share.sum()
        family = int(share.argmax())
        languages = self.families[family]
        votes, sure = np.zeros(len(languages)), np.zeros(len(languages))
        for of, a, b, row, scale in self.pairs:
            if of == family:
                # towards the second language
                p = 1.0 / (1.0 + np.exp(-np.clip(3.0 * values[row] / scale, -30, 30)))
                votes[b if p > 0.5 else a] += 1
                sure[a], sure[b] = sure[a] + 1 - p, sure[b] + p
        # equal votes go to the surer one, then to the first name
        best = max(range(len(languages)), key=lambda k: (votes[k], sure[k], -k))
        within = sure[best] / (len(languages) - 1) if len(languages) > 1 else 1.0
        return languages[best], float(share[family] * within)


def train(sample: Sample, families: Mapping[str, str] = FAMILIES, seed: int = 13) -> Model:
    """Family regression and pairwise machines; none for no documents."""
    rng = np.random.default_rng(seed)
    by_family: dict[str, list[str]] = {}
    for language in sorted(set(sample.languages)):
        by_family.setdefault(family_of(language, families), []).append(language)
    grouped = [by_family[name] for name in sorted(by_family)]
    if not grouped:
        return Model()
    place = {language: k for k, group in enumerate(grouped) for language in group}
    members, classes = np.arange(len(sample.rows)), np.array([place[x] for x in sample.languages])
    if len(grouped) > 1:
        w, b = train_softmax(sample, members, classes, rng)
    else:
        w, b = np.zeros((1, BUCKETS), np.float32), np.zeros(1, np.float32)
    rows, biases, pairs = [*w], [*b], []
    for k, group in enumerate(grouped):
        for first, second in itertools.combinations(range(len(group)), 2):
            chosen = np.array([i for i, x in enumerate(sample.languages) if x in (group[first], group[second])])
            sides = np.array([int(sample.languages[i] == group[second]) for i in chosen])
            machine, scale = train_svm(sample, chosen, sides, rng)
            pairs.append((k, first, second, len(rows), max(scale, 1e-6)))
            rows.append(machine)
            biases.append(0.0)
    return Model(grouped, np.stack(rows), np.array(biases, np.float32), pairs)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is never learnt from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _vectors(batches):
    for batch in batches:
        out = []
        for language, text in zip(batch["lang"], batch["text"]):
            counts = gram_counts(cleaned(text))
            at = np.flatnonzero(counts)
            if len(at):
                out.append((language, at.astype(np.uint16).tobytes(), vector(counts)[at].tobytes()))
        yield pd.DataFrame(out, columns=["lang", "at", "shares"])


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, families: Mapping[str, str] = FAMILIES,
) -> Model:
    """Train on at most `sample_docs` documents of each language, taken by the hash of their ids. Documents
    that are held out or have no language, text or id teach nothing."""
    known = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    # the smallest hashes of each language; a first cut by its number of documents leaves little to rank
    numbered = known.select("lang", "doc_id").withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # a row a language, as many as the model has
    drawn = numbered.join(F.broadcast(counts), "lang").where(F.col("draw") * F.col("n") <= 1.5 * sample_docs + 50)
    first = Window.partitionBy("lang").orderBy("draw", "doc_id")
    ranked = drawn.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample_docs)
    ids = ranked.select(F.col("lang").alias("of_lang"), F.col("doc_id").alias("of_doc")).distinct()
    same = (F.col("lang") == F.col("of_lang")) & (F.col("doc_id") == F.col("of_doc"))
    # at most `sample_docs` ids of each language; rows that repeat an id are one
    chosen = known.join(F.broadcast(ids), same).groupBy("lang", "doc_id").agg(F.max("text").alias("text"))
    rows = chosen.mapInPandas(_vectors, "lang string, at binary, shares binary").collect()
    rows = sorted((r["lang"], bytes(r["at"]), bytes(r["shares"])) for r in rows)
    return train(Sample([(x, np.frombuffer(at, np.uint16), np.frombuffer(s, np.float32)) for x, at, s in rows]), families)


def _predicted(shared):
    def run(batches):
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"].to_numpy(object)]
            found = [shared.value.predict(t) for t in texts]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [x for x, _ in found],
                "score": np.array([s for _, s in found], np.float64),
            })

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id, held_out, lang_pred, score` for each row of `docs`; only the text enters the prediction.

    The score is the family's probability times the mean of what the winner's pairs give it.

    Defined results: null texts and texts without a letter are `und` with score 0, as is everything where
    nothing was learnt; a null id stays null and counts as not held out; repeated rows get equal
    predictions; texts are read whole, long ones a piece at a time; an empty table gives no rows; a
    language that is alone in its family is certain once the family is; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    found = rows.mapInPandas(_predicted(shared), "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
