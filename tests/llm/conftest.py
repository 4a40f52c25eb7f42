import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names the operators use themselves."""
    words = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    base = [f"word{i} alpha beta{i % 7} gamma delta{i % 3} line\nshared line of text number one here" for i in range(60)]
    texts = [None, "", "  \n\t ", "a", "one two three", words, words + " end", *base, base[0], base[0] + " more"]
    rows = [(i, t, "s" if i % 3 else None, i) for i, t in enumerate(texts)] + [(7, base[0], "s", 7), (None, "no id at all here", "s", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long").selectExpr("*", "1 AS tag", "2 AS n", "3 AS id", "'x' AS word")
