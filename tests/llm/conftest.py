import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string"

#: Nulls in every column, empty and blank texts, repeated rows, a long text, columns with clashing names.
ODD = [
    (1, "the cat sat on the mat and the dog sat too", "en", "a", 42, 0.5, "x"),
    (1, "the cat sat on the mat and the dog sat too", "en", "a", 42, 0.5, "x"),
    (2, None, "en", "a", None, None, None),
    (3, "", None, "b", 0, None, None),
    (4, " \t\n ", "fr", None, 4, None, None),
    (None, "le chat et le chien sont sur le tapis", "fr", "b", 37, 0.1, "y"),
    (5, "12 34 !! ?", "fr", "c", 10, 0.1, "y"),
    (6, "a long text about many things, again and again. " * 4000, "en", "a", 192000, 0.1, "y"),
    (7, "THE cat sat on the mat and the dog sat too", None, "c", 42, 0.1, "y"),
    (8, "l'été est là   　 <|endoftext|> 日本語", "fr", "é", 30, 0.1, "y"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
