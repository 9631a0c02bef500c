import pytest

DDL = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, shard int, row long, copies int, digest string, n long, key string"
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty and repeated rows, one long text, and columns with names used inside."""
    long = " ".join(f"w{i}" for i in range(30_000))
    texts = [
        (1, "the cat sat on the mat today"),
        (2, "The Cat sat on the mat today"),
        (2, "The Cat sat on the mat today"),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, long),
        (None, "the cat sat on the mat today"),
        (None, None),
        (7, "Ünïcode ß line\nsecond line\n"),
        (8, "99 !!"),
    ]
    rows = [
        (i, t, "en" if i and i % 2 else None, "s" if i and i % 3 else None, None, 9.0, 7, 1, 2, "d", 3, "k")
        for i, t in texts
    ]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
