import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))

from helpers import rows_of  # noqa: E402

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that the operators use inside
                     T.StructField("id", T.StringType()), T.StructField("key", T.LongType()), T.StructField("_row", T.LongType())])

#: nulls, empty and blank texts, one word, repeated rows and ids, ties, odd characters, a very long text
EDGE = [
    (None, None, None, None), (10**6, None, "en", "s"), (10**6 + 1, "", None, "s"), (10**6 + 2, " \t\n\x0b\x0c\r ", "en", None),
    (10**6 + 3, "word", "en", "s"), (10**6 + 4, "same row twice", "en", "s"), (10**6 + 4, "same row twice", "en", "s"),
    (10**6 + 4, "same id, other text", "en", "s"), (10**6 + 5, "İstanbul ẞtraße ﬁ é  x y <|endoftext|> 'S it's ΑΣ \x1c \x00", "en", "s"),
    (10**6 + 6, "1.2.3.4 1.2.3.4.5.6.7.8 999.1.1.1 a@b.c_x@y.zz +1 (743) 555-3824 4111 1111 1111 1111 00255.1.1.1", "en", "s"),
    (10**6 + 7, "A b C d e " * 30_000, "en", "s"), (10**6 + 8, "7" * 50_000 + " " + "x" * 50_000 + "@" + "y" * 1000, "en", "s"),
]


@pytest.fixture(scope="session")
def doc_rows():
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows_of("documents")]
    return rows + EDGE


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    full = [(*r, len(r[1] or ""), "clash", 5, 7) for r in doc_rows]
    return spark.createDataFrame(full, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
