import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

ODD = [
    (1, "one two three four five six seven", "en", "a", 33),
    (1, "one two three four five six seven", "en", "a", 33),
    (2, None, None, None, None),
    (None, "no id here at all", "en", "a", 17),
    (3, "", "en", None, 0),
    (4, " \t\n ", "en", "b", 4),
    (5, "x" * 70_000 + " " + "word " * 20_000, "en", "b", 170_001),
    (6, "é ü ñ 🎉 日本語 \x00 end", "fr", "c", 18),
    (7, "one two three four five six seven", "de", "c", 33),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns whose names operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, COLUMNS).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in ("h", "n", "key", "known", "size", "ids_", "name", "first", "comp", "a", "b", "tid", "row")})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
