import pytest
from pyspark.sql import functions as F

TEXT = "the quick brown fox jumps over the lazy dog while another sleepy animal looks on from the warm green hill"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """Small tables need few shuffle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """Nulls in every column, empty and very long texts, repeated rows, an
    extra column for every name an operator might use."""
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    rows = [
        (1, TEXT, "en", "a"), (2, TEXT, "en", "a"), (3, "", None, "a"), (4, None, "en", None), (5, "   \n\t ", "fr", "b"),
        (6, long, "fr", "b"), (6, long, "fr", "b"), (None, TEXT, "en", "a"), (None, None, None, None),
        (7, "x", "de", "c"), (8, "a" * 70_000, "de", "c"), (9, TEXT.upper(), "en", "c"), (10, "é́ \U0001F600 <|endoftext|> \x00", "xx", "c"),
    ]
    cols = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, cols)
    for name in ("id", "size", "kept", "score", "_id", "_keep", "_gone", "_times", "_norm", "label", "word", "taken", "bands"):
        docs = docs.withColumn(name, F.lit("clash"))
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    docs.coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (6, None, None), (None, 1, 0), (7, 1, 0), (8, 0, 1), (9, 1, 0), (10, 0, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def n_rows(awkward):
    return awkward.count()
