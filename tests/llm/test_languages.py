"""Languages of texts: features against plain counting, held-out accuracy, and defined results."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from sluicebox.llm import languages

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    # names that the operator uses itself
    T.StructField("score", T.StringType()), T.StructField("of_doc", T.IntegerType()), T.StructField("lang_pred", T.IntegerType()),
])
# parts of words: near pairs share most of theirs
PARTS = {
    "de": "sch ein ung der keit lich ver und zu ge", "nl": "sch een ing der heid lijk ver en te ge",
    "es": "cion ado ar que os la de mente es ll", "pt": "cao ado ar que os a de mente es lh",
    "xx": "qa qo qi qu wa wo wi zz kk qq",
}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, x, "s", 1, 2) for i, t, x in rows], SCHEMA)


def corpus(n, seed=1, least=5, most=60):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(PARTS))
        parts = PARTS[lang].split()
        words = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(least, most))]
        rows.append((i, " ".join(words).capitalize() + f". {i}", lang))
    return rows


@pytest.fixture(scope="module")
def learnt(spark):
    return languages.fit(frame(spark, corpus(700)))


def test_grams_are_counted_once_each(monkeypatch):
    text = "Straße  42 – É, 中文 x!" * 7
    points = languages.cleaned(text)
    assert "".join(map(chr, points)) == " " + " ".join(["straße é 中文 x"] * 7) + " "
    whole = languages.gram_counts(points)
    plain = Counter()
    for n in range(1, languages.LONGEST_GRAM + 1):
        for k in range(len(points) - n + 1):
            h = 0
            for p in points[k : k + n]:
                h = (h * 0x01000193 + int(p)) % 2**32
            h = (h ^ n) * 0x9E3779B1 % 2**32
            plain[(h ^ (h >> 15)) * 0x85EBCA6B % 2**32 >> (32 - languages.BITS)] += 1
    assert {int(b): int(whole[b]) for b in np.flatnonzero(whole)} == dict(plain)
    for piece in (1, 3, 10):
        monkeypatch.setattr(languages, "PIECE", piece)
        assert (languages.gram_counts(points) == whole).all()


def test_held_out_accuracy_and_families(spark, learnt):
    assert learnt.families == [["de", "nl"], ["xx"], ["es", "pt"]]
    rows = corpus(700)
    truth = {i: x for i, _, x in rows}
    found = languages.predict(frame(spark, rows), learnt).collect()
    assert len(found) == len(rows)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_held_out_labels_and_ids_change_nothing(spark):
    rows = corpus(200)
    lied = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, t, x in rows]
    more = lied + [(None, "zu und ein", "xx"), (None, None, "de"), (5000, None, "xx"), (5001, "12 34", "xx"), (5002, "der die", None)]
    a, b = languages.fit(frame(spark, rows)), languages.fit(frame(spark, more))
    assert a.families == b.families and (a.weights == b.weights).all() and a.pairs == b.pairs


def test_defined_results(spark, learnt):
    rows = [(1, None, "de"), (2, "", "de"), (3, " 12 ?! \n", "de"), (None, "schlich und verkeit", "de"), (5, "z", None), (6, "Z" * 300_000, None),
            (7, "unglich schein zu verkeit " * 60_000, None), (8, "unglich schein zu verkeit " * 9, None), (8, "unglich schein zu verkeit " * 9, "es")]
    found = languages.predict(frame(spark, rows), learnt).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [by_id[i][0]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and by_id[1][0]["score"] == 0
    assert by_id[None][0]["lang_pred"] == "de" and by_id[None][0]["held_out"] is False
    assert by_id[5][0]["lang_pred"] in PARTS and by_id[6][0]["lang_pred"] in PARTS
    assert by_id[7][0]["lang_pred"] == "de" and by_id[8][0] == by_id[8][1]
    assert languages.predict(frame(spark, []), learnt).collect() == []


def test_little_to_learn_from(spark):
    nothing = languages.fit(frame(spark, [(1, "text", None), (2, None, "de")]))
    assert languages.predict(frame(spark, [(1, "text", "de")]), nothing).first()["lang_pred"] == "und"
    rows = [(i, "ein und zu", "de") for i in range(10)]
    model = languages.fit(frame(spark, rows))
    assert languages.predict(frame(spark, [(1, "qa", None)]), model).first()[2:] == ("de", 1.0)
    # languages that no table names are one family
    odd = languages.fit(frame(spark, rows[:0] + [(i, "aaa" if i % 2 else "bbb", "A" if i % 2 else "") for i in range(40)]))
    assert odd.families == [["", "A"]]
    found = languages.predict(frame(spark, [(1, "aaa aaa", None), (2, "bbb", None)]), odd).collect()
    assert [r["lang_pred"] for r in found] == ["A", ""]


def test_the_sample_is_bounded_by_language(spark, monkeypatch):
    met = []
    monkeypatch.setattr(languages, "train", lambda sample, families: met.extend(sample.languages))
    languages.fit(frame(spark, corpus(300)), sample_docs=9)
    assert Counter(met) == {x: 9 for x in PARTS}
