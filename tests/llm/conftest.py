import pytest
from pyspark.sql import Row

SF = "/root/testdata/sf0.001"
#: Column names that operators use inside; the tables of ``odd_docs`` have them as extra columns.
CLASHING = ("kept", "f", "h", "key", "text_hash", "runs", "n_rows", "component_id", "cleaned", "score", "repeated")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    """doc_id -> text of the small table."""
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


ODD_TEXTS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "word " * 40_000), (6, "x" * 150_000),
    (7, "tied text of seven words in all"), (8, "tied text of seven words in all"),
    (9, "row that is repeated"), (9, "row that is repeated"), (None, "row without an id"), (None, None),
    (10, "ünï©ødé \U0001f389 中文 ▁   \x0b \x85 end"), (11, "\n".join(f"line {i} of many lines" for i in range(3000))),
    (12, "\n\n\n"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, *("extra",) * len(CLASHING)) for i, t in ODD_TEXTS], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def make(spark):
    def made(rows, schema="doc_id long, text string"):
        return spark.createDataFrame([tuple(r) if not isinstance(r, Row) else r for r in rows], schema)

    return made
