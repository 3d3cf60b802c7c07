"""A training corpus from raw documents: five stages, each written and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sluicebox.llm import decontamination, near_duplicates, packing, substrings, toxicity
from sluicebox.llm.common import importable, table, written

WORDS, PERCENT = 5, 80


def _packed_columns(docs: DataFrame) -> DataFrame:
    """Id, text and all columns as one, so that no name of a document's columns can clash."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("whole"))


def _with_text(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """Columns of `docs` with the changed text and its length; texts that were cut to nothing go."""
    text = F.col("text")
    columns = [
        text.alias("text") if f.name == "text"
        else F.length(text).cast(f.dataType).alias("n_chars") if f.name == "n_chars"
        else F.col("carried").getField(f.name).alias(f.name)
        for f in docs.schema
    ]
    before = F.trim(F.col("carried").getField("text"))
    return changed.where((F.length(F.trim(text)) > 0) | before.isNull() | (F.length(before) == 0)).select(*columns)


@importable
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, learnt from the labels that are not held out."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@importable
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; of rows that repeat a document one."""
    found = near_duplicates.near_duplicates(docs, words=WORDS, percent=PERCENT)
    rejected = found.where(~F.col("kept")).select(F.col("doc_id").alias("of_doc")).distinct()
    left = docs.join(rejected, docs["doc_id"] == rejected["of_doc"], "left_anti")
    # rows without an id are told apart by their texts
    same = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy(F.xxhash64("text"))
    nth = "".join(docs.columns) + "_nth"
    return left.withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1).drop(nth)


@importable
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return _with_text(docs, substrings.remove_repeats(_packed_columns(docs), carry="whole"))


@importable
def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans that benchmark items own."""
    hits = decontamination.benchmark_hits(_packed_columns(docs), table(spark, sf_dir, "benchmark"), carry="whole")
    changed = hits.withColumn("text", F.when(F.size("spans") > 0, decontamination.without_spans()).otherwise(F.col("text")))
    return _with_text(docs, changed)


@importable
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their places in sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", cut_benchmark),
    ("best_fit_packing", pack),
]

# a trained network decides in the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
