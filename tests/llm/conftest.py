import pytest
from pyspark.sql import functions as F

from llm.llm_helpers import prose

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, quality string, pii int, contamination int, "
          "class_id string, n_links string, representative string, shard string, slot string, _odd array<int>")


def edge_rows():
    """NULLs in any column, empty and white-space texts, a very long text, ties and repeated rows."""
    clash = ("q", 1, 2, "c", "l", "r", "s", "t", [1, None])
    a, b = prose(1, 120), prose(2, 300)
    rows = [
        (1, a, "en", "s1"), (2, a, "en", "s1"), (2, a, "en", "s1"), (3, b, None, "s1"), (4, None, "en", None),
        (None, b + " more", None, None), (5, "", "en", "s1"), (6, " \t\n\x0b ", "de", "s2"), (7, "one", "en", "s1"),
        (8, prose(3, 30_000), "en", "s2"), (9, "one two three", "en", "s1"), (None, None, None, None),
        (10, "x" * 50_000, "en", "s1"), (11, "é中 \U0001f600 " + prose(4, 80), "de", "s2"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), *clash) for r in rows]


@pytest.fixture()
def edge(spark):
    """Extra columns whose names clash with those that operators add."""
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(2).cache()


@pytest.fixture()
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tiny_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
