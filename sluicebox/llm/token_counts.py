"""Token counts of whole texts, without materialising ids.

A text is cut into pre-tokens. A block of documents keeps one dictionary of its distinct pre-tokens
and, for each document, frequencies by dictionary index. The dictionaries of all blocks meet in one
shuffle, where each distinct pre-token is split into pieces once; the piece counts go back to the
blocks and are summed with the frequencies. What is shuffled are dictionaries and small integers,
not texts.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sluicebox.llm.common import written

# Fixed values of the vocabulary file: its pre-token pattern and its special strings.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPECIAL = ("<|startoftext|>", "<|endoftext|>")

BLOCK_WORDS = 200_000
BLOCK_CHARS = 24_000_000
DICTIONARY_ROW = 20_000

_BLOCKS = (
    "block bigint, doc_id bigint, n_bytes bigint, n_special bigint, idx binary, freq binary, "
    "first int, words array<string>"
)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers with their low bytes first, then the next bytes and so on; compresses well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _normal(text: str) -> str:
    # lower-casing is by character: a final capital sigma has no form of its own
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _blocks(batches):
    import regex

    find = regex.compile(PRE_TOKEN).findall
    special = regex.compile("|".join(map(regex.escape, SPECIAL)))
    rows: list[tuple] = []
    words: dict[str, int] = {}
    chars = 0

    def closed():
        block = uuid.uuid4().int >> 65
        frame = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_special", "idx", "freq"], dtype=object)
        yield frame.assign(block=block, first=None, words=None)
        listed = list(words)
        for first in range(0, len(listed), DICTIONARY_ROW):
            yield pd.DataFrame({"block": [block], "first": [first],
                                "words": [listed[first : first + DICTIONARY_ROW]]}).assign(
                doc_id=None, n_bytes=None, n_special=None, idx=None, freq=None)

    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            text = text or ""
            n_special = len(special.findall(text)) if "<|" in text else 0
            parts = special.split(text) if n_special else [text]
            counted = Counter()
            for part in parts:
                counted.update(find(_normal(part)))
            idx = np.fromiter((words.setdefault(w, len(words)) for w in counted), np.uint32, len(counted))
            freq = np.fromiter(counted.values(), np.uint32, len(counted))
            order = np.argsort(idx)
            idx = np.diff(idx[order], prepend=np.uint32(0))
            rows.append((None if pd.isna(doc_id) else int(doc_id), len(text.encode()), n_special,
                         _planes(idx), _planes(freq[order])))
            chars += len(text)
            if len(words) >= BLOCK_WORDS or chars >= BLOCK_CHARS:
                for frame in closed():
                    yield frame[names]
                rows, words, chars = [], {}, 0
    if rows:
        for frame in closed():
            yield frame[names]


def _pieces(path: str):
    """Piece counts of sorted pre-tokens, each distinct one split once."""

    def count(batches):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        last, last_n = None, 0
        for batch in batches:
            words = batch["word"].to_numpy(object)
            new = np.concatenate([[words[0] != last], words[1:] != words[:-1]]) if len(words) else np.zeros(0, bool)
            found: list[int] = []
            distinct = list(words[new])
            for start in range(0, len(distinct), 5000):
                part = tokenizer.encode_batch_fast(distinct[start : start + 5000], add_special_tokens=False)
                found.extend(len(e.ids) for e in part)
            # rows in front of the first new word belong to the last word of the batch before
            n = np.array([last_n, *found], np.int64)[np.cumsum(new)]
            if len(words):
                last, last_n = words[-1], int(n[-1])
            yield pd.DataFrame({"of_block": batch["block"], "idx": batch["idx"], "n": n})

    return count


def _summed(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    pieces = np.zeros(int(counts["idx"].max()) + 1 if len(counts) else 1, np.int64)
    pieces[counts["idx"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    totals = [
        int(special) + int(pieces[np.cumsum(_numbers(idx))] @ _numbers(freq).astype(np.int64))
        for special, idx, freq in zip(docs["n_special"], docs["idx"], docs["freq"])
    ]
    return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "n_bytes": docs["n_bytes"], "n_tokens": totals})


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` for each row of `docs`.

    Tokens are those of `tokenizers` with the file `vocabulary`, without added begin and end tokens;
    a special string inside a text counts as its one token. Defined results: a null or empty text
    has 0 bytes and 0 tokens; a null id stays null; repeated rows give repeated rows; an empty table
    gives no rows; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = written(rows.mapInPandas(_blocks, _BLOCKS), "token-blocks")
    units = (
        blocks.where("words is not null")
        .select("block", "first", F.posexplode("words").alias("place", "word"))
        .select("block", (F.col("first") + F.col("place")).alias("idx"), "word")
    )
    # equal pre-tokens of all blocks lie side by side; a word has one row a block at most
    counts = (
        units.repartition("word").sortWithinPartitions("word")
        .mapInPandas(_pieces(vocabulary), "of_block bigint, idx int, n int")
    )
    summed = (
        blocks.where("words is null").select("block", "doc_id", "n_bytes", "n_special", "idx", "freq")
        .groupBy("block").cogroup(counts.groupBy("of_block"))
        .applyInPandas(_summed, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    )
    return summed.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
