import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture()
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "same text of seven words it is"),
            (5, "same text of seven words it is"), (6, "same text of seven words it is"), (7, long), (8, long + " end"),
            (None, "same text of seven words it is"), (None, None)]
    df = spark.createDataFrame([(i, t, None, None, 0, "x", 1.0, True, 3) for i, t in rows],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                               "class string, score double, contaminated boolean, n_words int")
    return df
