import pytest
from pyspark.sql import types as T

from sluicebox.llm.common import importable


@pytest.fixture(autouse=True)
def workers_import(spark):
    importable(lambda session: None)(spark)


@pytest.fixture
def texts(spark):
    """Documents with columns that clash with names the operators use."""

    def make(rows):
        schema = T.StructType([
            T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
            T.StructField("n_tokens", T.StringType()), T.StructField("runs", T.IntegerType()),
            T.StructField("carried", T.IntegerType()), T.StructField("spans", T.StringType()),
        ])
        return spark.createDataFrame([(i, t, "x", None, 3, "y") for i, t in rows], schema)

    return make
