import pytest

#: Texts that every operator on documents must take: null, empty, blank, ties, repeats, long.
ODD_TEXTS = [None, "", " \t\n", "one", "one", "two words", "a b c d e f", "A B C D E F", "ñandú ß 漢字 🙂",
             "token = abcdef0123456789", "▁ ▁▁ ▁x", "x" * 3000, "lorem ipsum dolor sit amet " * 400]

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, fp string, "
              "size string, kept string, score string, html string, __row string")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, with extra columns named like the operators' own, a repeated row and null columns."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}", None, "k", "f", "9", "no", "1", "h", "r")
            for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id", None, None, None, *["z"] * 7), (None, None, None, None, None, *["z"] * 7)]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def odd_rows(odd_docs):
    return odd_docs.collect()
