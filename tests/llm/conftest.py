from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        *(T.StructField(name, T.LongType()) for name in ("size", "taken", "key", "row", "fp", "h", "t", "n", "spans", "group")),
    ]
)


def make_texts():
    rng = random.Random(5)
    syllables = ["ra", "to", "mi", "né", "lu", "ko", "sa", "the", "of"]

    def prose(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))

    passage = prose(60)
    long = prose(3000)
    plain = prose(120)
    return [
        None,
        "",
        " \t\n ",
        "one",
        "two words",
        plain,
        plain,
        plain + " end",
        prose(30) + " " + passage + " " + prose(40),
        passage + "\n" + prose(25) + " " + passage,
        prose(10) + passage,
        long,
        long[:5000] + " cut " + long[5100:],
        "a" * 700,
        "line with a word\n" * 40,
        "ab" * 450 + prose(5),
        "STOP!! NOW!! " * 30,
        "sum $$$ of *** all %%% " * 20,
        "word " * 50,
        prose(300),
    ]


@pytest.fixture(scope="session")
def messy_rows():
    """Rows with nulls in every column, empty and long texts, ties and repeated rows."""
    rows = []
    for i, text in enumerate(make_texts()):
        rows.append((i, text, ("en", "de", None)[i % 3], ("a", "b", None, "a")[i % 4], None, *[i] * 10))
    rows.append((None, "an id is missing here " * 8, "en", "c", 1, *[None] * 10))
    rows += [rows[5], rows[5], rows[14]]
    return rows


@pytest.fixture
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, DOCUMENTS).repartition(3)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def labels(spark):
    schema = "doc_id long, quality int, toxic int"
    rows = [(i, int(i < 13), 0) for i in range(20)] + [(None, 1, 0), (3, None, None), (5, 1, 1), (999, 0, 0)]
    return spark.createDataFrame(rows, schema)
