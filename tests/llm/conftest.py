import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs; every third source is 'a', others 'b'."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "a" if (i or 0) % 3 else "b", len(t or "")) for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, white space, a null key, repeated rows, a text without line or word ends, a long one."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [(1, None), (2, ""), (3, " \n\t "), (None, "no key at all here"), (4, "same words stand here twice"), (4, "same words stand here twice"), (5, "x" * 5000), (6, long), (7, "é 😀\nü"), (8, "one")]
