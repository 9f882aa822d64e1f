from __future__ import annotations

import pytest

# Nulls in every column, empty and blank texts, repeated rows, one id with two texts, a long text, characters outside
# the basic plane; the further columns have names that the operators use themselves.
EDGE = [
    (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (None, "the cat sat on the mat", "en"), (None, None, None),
    (4, "the cat sat on the mat", "en"), (4, "the cat sat on the mat", "en"), (5, "The CAT  sat on\nthe mat", None),
    (6, "le chat est sur la table de la cuisine", "fr"), (6, "another text of the same id", "en"), (7, "a", "en"),
    (8, "1234 5678 --- !!!", "en"), (9, "the cat and the dog " * 4000, "en"), (10, "日本語 \U0001F600 naïve É <|endoftext|> x", None),
    (-11, "le chat et le chien " * 300 + "\n" + "le chat et le chien", "fr"),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, lang, "s", 0, "x", 1) for i, t, lang in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _row string, score int, n_tokens string, _doc int")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def both(documents, edge):
    """The generated documents and the odd ones."""
    columns = ["doc_id", "text", "lang"]
    moved = documents.selectExpr("doc_id + 1000 as doc_id", "text", "lang")
    return moved.unionByName(edge.select(*columns))
