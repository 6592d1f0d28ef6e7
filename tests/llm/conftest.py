import pytest

# rows that every operator must bear: nulls, empty, blank and long texts, repeats, clashing columns
ODD = [
    (1, "one two three four five six seven"),
    (1, "one two three four five six seven"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "word"),
    (None, "a text without an id, long enough to be cut into several words"),
    (6, "ONE two three four five six seven"),
    (7, "x" * 5000),
    (8, "lorem ipsum dolor sit amet " * 4000),
    (9, "été  où\n\n naïve 😀 日本語 　 end\t"),
    (10, "<|endoftext|> it's a <|endoftext|>"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with columns named like those the operators use inside."""
    rows = [(i, t, "en" if i else None, None if i == 3 else "s", len(t or ""), "k", 1, 2, 3, 4) for i, t in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "key string, mark int, node int, part int, n int",
    )


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
