import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def corpus(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, " \
         "fp int, key string, length string, root string, `a b` int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    passage = " ".join(f"word{i % 97} of{i % 13} line{i % 7}" for i in range(40))
    long = "\n".join(f"{passage} number {i}" for i in range(120))
    mail = "write to a.b@mail.example.com or 10.0.0.1 or 4111 1111 1111 1111 or +1 (555) 123-4567"
    texts = [None, "", " \n\t ", "one", long, long, passage, passage + " end", mail, mail, "123 456",
             "ÄÖÜ straße ñandú", "\x00\x1c odd \x01 bytes", "same", "same"]
    rows = [(i, t, "en" if i % 3 else None, None, None, "x", i, "k", None, "r", None)
            for i, t in enumerate(texts)]
    rows += [rows[4], rows[13], (None, "no id", None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
