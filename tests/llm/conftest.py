import pytest

LOREM = (
    "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu "
    "nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, and columns whose names clash."""
    long_text = " ".join(f"{w}{i % 977}" for i in range(6000) for w in ("word", "thing"))
    rows = [
        (1, LOREM, "en", "s"),
        (1, LOREM, "en", "s"),
        (1, "Another text with the same id, quite short.", "en", None),
        (2, None, "en", "s"),
        (3, "", None, "s"),
        (None, LOREM, None, None),
        (None, "no id and nothing else here", "en", "s"),
        (4, "   \n\t ", "en", "s"),
        (5, "1234 !!! 5678", "en", "s"),
        (6, long_text, "en", "s"),
        (-7, "Ünïcödé тест 中文字符 emoji 😀 don't", "xx", "s"),
        (2**40, LOREM + " and more", "en", "s"),
    ]
    clashing = [(*r, 5, "k", 1.5, "t", 3) for r in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, k string, score double, id string, size int"
    return spark.createDataFrame(clashing, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
