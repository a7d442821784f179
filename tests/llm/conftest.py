import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOC = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                  StructField("source", StringType())])


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows."""
    def make(rows):
        return spark.createDataFrame([tuple(r) + (None,) * (4 - len(r)) for r in rows], DOC)
    return make


def texts(n, seed=0, words=60, vocabulary=400):
    import random
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(5, words))) for _ in range(n)]
