import pytest

from goldseam.llm.registry import importable

SF = "/root/testdata/sf0.001"
DDL = "doc_id bigint, text string, lang string, source string, cid string, region string, hash string, _kept int, email string"


@pytest.fixture(autouse=True)
def _importable(spark):
    importable(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture
def odd(spark):
    """Documents with nulls, empty, blank, long, repeated rows, and columns named like ours."""
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "x"), (4, "x"), (None, "x"), (None, None), (5, "word " * 40_000), (6, "é" * 50_000), (7, "\x00\x01日本 😀")]
    return spark.createDataFrame([(i, t, None, None, "c", "r", "h", 1, "e") for i, t in texts], DDL)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture
def by_doc():
    """Rows of a result as dicts, sorted by doc_id with nulls last."""
    return lambda df: sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
