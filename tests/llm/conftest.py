import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    return (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


#: Null in any column, empty and repeated texts, special strings, odd white space, a long text, clashing extra columns.
ODD_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 2),
    (4, "The quick  brown\tfox jumps over the lazy dog again and again", "en", "a", 3),
    (5, "<|endoftext|> x <|startoftext|>", "fr", "b", 4),
    (6, "Ünïcödé 漢字 😀 \x1c\x85\xa0 'tis it's", "de", "b", 5),
    (7, "word " * 6000, "en", "c", 6),
    (None, "a row without an id", "en", "c", 7),
    (3, "", "en", "a", 2),
    (9, "   \n\n\t ", "en", "c", 8),
    (10, "12345 !!! ###", "en", "c", 8),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
