import random

import pytest
from pyspark.sql import types as T

import corpus_pipeline
from sluicebox.llm import decontamination, near_duplicates, packing, substrings, toxicity
from sluicebox.llm.common import importable
from sluicebox.llm.queries import ORACLES, QUERIES
from test_duplicates import brute, prose

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("carried", T.TimestampType()), T.StructField("runs", T.ArrayType(T.IntegerType())), T.StructField("whole", T.BinaryType()),
])


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    """Tables of a data folder: clean documents, toxic ones, copies, passages, benchmark items."""
    rng = random.Random(11)
    clean = {i: prose(rng, rng.choice([5, 40, 150])) for i in range(1, 120)}
    toxic = {i: prose(rng, 60) + " grubwern blatfix zorkium " + prose(rng, 10) + " grubwum zorkia" for i in range(200, 320)}
    base = prose(rng, 80)
    near = {400 + k: base + f" tail{k}" for k in range(6)}
    passage = prose(rng, 70)
    shared = {500 + k: prose(rng, 50) + " " + passage + " " + prose(rng, 50) for k in range(5)}
    item = " ".join(f"item{k}" for k in range(14))
    leaks = {600 + k: prose(rng, 30) + " " + item + " " + prose(rng, 30) for k in range(3)}
    docs = {**clean, **toxic, **near, **shared, **leaks}
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(1, docs[1], "en", "s", 0), (700, "", None, None, None), (701, None, "en", "s", None), (None, docs[3], "x", "y", 3)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(*r, None, [1], b"x") for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in docs if i < 320]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(9, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, {"toxic": toxic, "clean": clean, "near": near, "shared": shared, "leaks": leaks, "passage": passage, "item": item}


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_each_stage_against_plain_versions(spark, folder):
    path, docs, kinds = folder
    df = spark.read.parquet(f"{path}/documents.parquet")

    found = corpus_pipeline.drop_toxic(spark, df, path)
    assert found.schema == df.schema
    left = {r.doc_id for r in found.collect()}
    assert not left & set(kinds["toxic"]) and set(docs) - set(kinds["toxic"]) <= left and {None, 700, 701} <= left

    df = df.where(f"doc_id is null or doc_id not in ({','.join(map(str, kinds['toxic']))})")
    found = corpus_pipeline.drop_near_duplicates(spark, df, path)
    assert found.schema == df.schema
    before = rows_of(df)
    expected = brute([(i, t) for i, t in before if i is not None], corpus_pipeline.WORDS, corpus_pipeline.PERCENT)
    kept = [(i, t) for i, t in dict.fromkeys(before) if i is None or expected[i][1] == i]
    assert rows_of(found) == sorted(kept, key=repr)
    assert [i for i, _ in kept if i in kinds["near"]] == [400]

    found = corpus_pipeline.cut_repeats(spark, found, path)
    assert found.schema == df.schema
    texts = dict(rows_of(found))
    assert sum(kinds["passage"] in texts[i] for i in kinds["shared"]) == 1 and kinds["passage"] in texts[500]
    assert all(texts[i] == docs[i] for i in kinds["clean"])
    assert all(r.n_chars == len(r.text) for r in found.collect() if r.text is not None)

    found = corpus_pipeline.cut_benchmark(spark, found, path)
    assert found.schema == df.schema
    after = dict(rows_of(found))
    assert not any("item3" in (t or "") for t in after.values())
    assert all(after[i] == texts[i] for i in texts if i not in kinds["leaks"])

    packed = corpus_pipeline.pack(spark, found, path).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_run(spark, folder):
    path, docs, kinds = folder
    found = corpus_pipeline.run(spark, path).collect()
    ids = {r.doc_id for r in found}
    assert set(kinds["clean"]) <= ids and not ids & set(kinds["toxic"]) and ids & set(kinds["near"]) == {400}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_of_no_documents(spark, folder):
    path, _, _ = folder
    none = spark.read.parquet(f"{path}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, path).collect() == [], name


def test_workers_find_the_repository(spark):
    root = str(corpus_pipeline.__file__).rsplit("/", 1)[0]
    importable(lambda session: None)(spark)
    assert root in spark.sparkContext.environment["PYTHONPATH"].split(":")


def test_registered():
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in QUERIES
    assert all(m for m in (decontamination, near_duplicates, packing, substrings, toxicity))
