import pytest
from pyspark.sql import functions as F

from asklens.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

LONG = "the quick brown fox jumps over the lazy dog again and again until evening " * 20_000
PROSE = " ".join(f"word{i} goes here" for i in range(40))
ODD = [
    (1, PROSE, "en", "a", 10),
    (2, PROSE.replace(" ", "  \n"), "en", "a", 10),        # equal after white space is normalised
    (2, PROSE.replace(" ", "  \n"), "en", "a", 10),        # a repeated row
    (3, None, None, None, None),
    (4, "", "fr", None, 0),
    (None, PROSE, None, "b", None),                        # a null id
    (None, None, None, "b", None),
    (5, LONG, "en", "b", len(LONG)),
    (6, LONG + " end", "en", "b", len(LONG) + 4),
    (7, " \t\n\x0b\x0c\r ", "de", "c", 7),                 # white space only
    (8, "Released under the MIT License. Mail a.b@c.example.com or +1 (310) 555-4510, host 10.0.0.300", "en", "c", 1),
    (9, "ÜBER straße ́combining <|endoftext|> it's 12.5 🙂 漢字 ab cd  x", "de", "ß", 1),
    (10, "1234 5678 9012 3456 4111 1111 1111 1111 1.2.3.4 1.2.3.4.5.6.7.8", "xx", "Z", 1),
    (7, "another text under the same id as before", "en", "c", 7),
]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names the operators use themselves."""
    df = spark.createDataFrame(ODD, DOC_SCHEMA)
    clash = ["row_no", "ROW_NO_", "norm", "digest", "kept", "size", "key", "host", "fp", "salt", "n_words", "taken", "root", "__text"]
    return df.select("*", *[F.lit("x").alias(c) for c in clash]).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def word_file():
    return tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_file():
    return tokenizer_file("byte_bpe_50k.json")


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
