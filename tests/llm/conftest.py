import pytest

#: Texts that every operator must take: null, empty, blanks, long without a blank, repeats, other scripts, special strings.
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and the quick brown fox sleeps."),
    (2, "the quick brown fox jumps over the lazy dog and the quick brown fox sleeps."),
    (3, None),
    (4, ""),
    (5, "  \n\t "),
    (6, "x" * 5000),
    (7, "naïve café ßtraße 数据 \U0001f600 don't  stop<|endoftext|> \xa0 end"),
    (8, "word " * 3000),
    (1, "The quick brown fox jumps over the lazy dog and the quick brown fox sleeps."),
    (None, "a row without an id"),
    (8, "another text of the same id"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """The texts above, with further columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "src0", 0, 7, b"k", "f", 1.0) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key long, ids binary, fp string, score double").repartition(3).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def tokenizer():
    from barmill.llm.queries import tokenizer

    return tokenizer()
