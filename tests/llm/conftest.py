import pytest

ROWS = [
    (0, "The cat sat on the mat with the dog and a bird in the quiet old house", "en", "s"),
    (1, None, "en", "s"),
    (2, "", None, "s"),
    (3, "The cat sat on the mat with the dog and a bird in the quiet old house", "en", "s"),
    (3, "The cat sat on the mat with the dog and a bird in the quiet old house", "en", "s"),
    (4, "... 123 !!", "en", None),
    (5, "Le chat est sur la table avec le chien et un oiseau dans la vieille maison", "fr", "s"),
    (None, "lonely words of nobody", None, "s"),
    (6, "w " * 30_000 + "end", "en", "s"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and a column whose name an operator uses itself."""
    schema = "doc_id bigint, text string, lang string, source string, score string, doc string, edge string, class string"
    return spark.createDataFrame([(*r, "x", "y", "z", "c") for r in ROWS], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    """A folder of small tables as the queries read them."""
    import os

    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path
