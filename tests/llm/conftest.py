import pytest

SF = "/root/testdata/sf0.001"

#: Names that operators use inside, as extra columns that must not disturb them.
CLASH = ("bucket", "digest", "sha", "top", "n", "h", "fp", "cls", "t1", "t2", "data", "size", "start", "row", "uid", "length",
         "first", "again", "capture", "id", "toks", "hits", "k")


@pytest.fixture(scope="session")
def sf():
    return SF


def with_clash(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH if c not in df.columns])


def docs_of(spark, rows):
    """Documents of (doc_id, text) with clashing extra columns."""
    return with_clash(spark.createDataFrame(rows, "doc_id long, text string"))
