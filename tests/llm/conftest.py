import pytest
from pyspark.sql import functions as F

TEXTS = {
    1: "The cat of the house and the dog of the yard sat in the sun as it was by now.\nA line.\nA line.",
    2: None,
    3: "",
    4: " \t\n\x0b\x0c\r ",
    5: "word " * 30_000,
    6: "Schöne Grüße, İstanbul ﬁn 你好世界 é́ \U0001F600\n# * $ % & | < >",
    7: "The cat of the house and the dog of the yard sat in the sun as it was by now.\nA line.\nA line.",
}
SCHEMA = "doc_id bigint, text string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empties, blanks, a long text, many scripts, copies and a repeated row."""
    rows = [(i, t, f"s{i % 2}") for i, t in TEXTS.items()] + [(7, TEXTS[7], "s1"), (None, "no id here at all", None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def spread(spark):
    """Adds columns whose names clash with ones that operators use inside."""
    def add(df):
        for name in ("id", "row", "_kept", "_rank", "_place", "component", "Lines", "n", "a.b"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit("x"))
        return df
    return add


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
