"""Rows that every operator on documents must take: nulls in every column,
empty and very long texts, ties, repeated rows and clashing column names."""

import pytest
from pyspark.sql import types as T

from streamlake.llm.common import prepare

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("source", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ("id", "row", "key", "sha", "h", "size", "node", "copies", "kept",
                                                 "bucket", "class", "digest", "doc", "rate", "sid", "_copy")]])

LONG = " ".join(f"word{k * 7919 % 10007}" for k in range(30000))
PROSE = " ".join(f"tale{k}" for k in range(120))
ODD = [
    (1, PROSE, "a"), (2, PROSE, "a"), (2, PROSE, "a"), (3, PROSE.replace("tale60", "tail60"), "b"),
    (4, None, None), (5, "", "b"), (6, " \t\n ", "c"), (7, "one two", "c"), (8, "one  two", None),
    (9, LONG, "b"), (None, "no id here", "a"), (None, None, None), (10, LONG + " end", "c"),
    (11, "x" * 50000, "d"), (12, "Ünïcode wörds \u00a0 and \u2028 odd \x1c space ‱ \U0001F600", "d"),
    (13, "same id", "e"), (13, "but another text than before", "e"), (14, PROSE.upper(), "f"),
]


@pytest.fixture(scope="session")
def ctx(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def odd_docs(ctx):
    return ctx.createDataFrame([(i, t, s, *["clash"] * 16) for i, t, s in ODD], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(ctx):
    return ctx.createDataFrame([], SCHEMA)
