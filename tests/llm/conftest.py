import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text[, lang]) rows."""

    def made(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1]) if r[1] else 0, *[f"x{i}" for i in range(len(extra))]) for r in rows]
        return spark.createDataFrame(full, ", ".join([DOCS, *[f"`{name}` string" for name in extra]]))

    return made
